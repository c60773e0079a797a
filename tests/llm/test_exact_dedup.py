from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from corpus_brute import lower_ascii

from kpiforge.llm.exact_dedup import exact_groups


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[lower_ascii(r.text or "")].append(r.doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=repr)


# few hash bits: most blocks share their hash with other contents, and names still tell them apart
@pytest.mark.parametrize("block_bytes, hash_bits", [(4096, 64), (16, 64), (64, 2)])
def test_matches_brute_force(odd, block_bytes, hash_bits):
    got = exact_groups(odd, block_bytes=block_bytes, hash_bits=hash_bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(odd.collect())


def test_documents(docs):
    got = exact_groups(docs, block_bytes=256, hash_bits=6).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs.collect())


def test_empty_table(nothing):
    assert exact_groups(nothing).count() == 0


def test_block_borders(spark):
    """Texts that share whole blocks, or only differ in how far they go."""
    texts = ["a" * 8, "a" * 16, "a" * 17, "a" * 16 + "b", "b" + "a" * 16, "", "a" * 16]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_groups(df, block_bytes=8).collect()}
    assert got == {0: (0, 1), 1: (6, 2), 2: (2, 1), 3: (3, 1), 4: (4, 1), 5: (5, 1), 6: (6, 2)}


def test_a_contested_name_is_not_the_mark_for_no_neighbour(spark):
    """Every block shares its hash with the others, and the longer text's second one comes first."""
    df = spark.createDataFrame([(0, "b" * 8), (1, "b" * 8 + "a" * 8)], "doc_id long, text string")
    assert sorted(r.group_size for r in exact_groups(df, block_bytes=8, hash_bits=0).collect()) == [1, 1]
