"""Corpus operators for training data: dedup, filters, joins, mixing, shards and language models.

Each module holds one operator with its own interface; ``queries`` registers them over the
``documents`` table.  Nothing outside this subpackage imports it.
"""
