from __future__ import annotations

import json
import random
import zlib

import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kpiforge.llm.token_counts import counter, fitting_bytes, prefix_counts, prefix_totals, refuse_other_rules

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'re", "'ll", "é", "ñ", "1", "23", "!", "...", "the", "ing", " hello",
         "<|endoftext|>", "<|", " ", "　", "\x1c", "日本", "\U0001f600", "'", "\r\n", "-", "____", "\x00", "́"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(library, text):
    store = counter(PATH).changes(text)
    totals, at = prefix_totals(store), 0
    assert len(store) == len(text.encode())
    for i, c in enumerate(text):
        at += len(c.encode())
        assert totals[at - 1] == len(library.encode(text[:i + 1], add_special_tokens=False).ids), repr(text[:i + 1])


def test_every_prefix_of_mixed_pieces(library):
    rng = random.Random(4)
    for _ in range(700):
        check(library, "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 9))))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=12))
def test_every_prefix_of_any_text(text):
    check(Tokenizer.from_file(PATH) if not hasattr(check, "lib") else check.lib, text)


check.lib = Tokenizer.from_file(PATH)


def test_documents_match_the_library(library, odd, docs, nothing):
    for df in (odd, docs):
        want = [(x.doc_id, len((x.text or "").encode()), len(library.encode(x.text or "", add_special_tokens=False).ids))
                for x in df.collect()]
        rows = prefix_counts(df, PATH).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in rows), key=repr) == sorted(want, key=repr)
        for r in rows:
            assert r.over_limit == (r.n_tokens > 1024)
            assert prefix_totals(zlib.decompress(r.prefix_store))[-1:].tolist() in ([r.n_tokens], [])
    assert prefix_counts(nothing, PATH).count() == 0


def test_budget(library):
    text = "The quick brown fox, café and  " + "x" * 300 + " jumps over 1234567 dogs."
    store = counter(PATH).changes(text)
    for budget in (0, 1, 5, 30, 1000):
        cut = fitting_bytes(store, budget)
        whole = text.encode()[:cut].decode("utf-8", "ignore")
        assert len(library.encode(whole, add_special_tokens=False).ids) <= budget
    assert fitting_bytes(store, 1000) == len(text.encode())


@pytest.mark.parametrize("change, named", [
    ({"pre_tokenizer": {"type": "Whitespace"}}, "pre_tokenizer"),
    ({"pre_tokenizer": None}, "pre_tokenizer"),
    ({"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True}}, "pre_tokenizer"),
    ({"normalizer": {"type": "NFC"}}, "normalizer"),
    ({"model": {"type": "BPE", "ignore_merges": True}}, "ignore_merges"),
    ({"added_tokens": [{"content": "<x>", "lstrip": True}]}, "added_tokens.lstrip")])
def test_files_with_other_rules_are_refused(change, named):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    refuse_other_rules(spec)
    with pytest.raises(ValueError, match=named):
        refuse_other_rules(spec | change)
