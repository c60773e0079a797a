from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from kpiforge.llm import merkle
from kpiforge.llm.queries import op11_merkle_manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """The root over the nodes, and each node's siblings and folding function, by the definition."""
    ways = [[] for _ in nodes]
    own = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(own):
            first = at - at % 3
            ways[i].append((nodes[first:at], nodes[at + 1:first + 3]))
            own[i] = at // 3
        nodes = [sha("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], ways


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in order:
        own = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[s] = (own, *climb([leaf(r) for r in own]))
    root, tops = climb([subs[s][1] for s in order])
    out = []
    for s, top in zip(order, tops):
        own, sub, ways = subs[s]
        for r, way in zip(own, ways):
            cut = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            now = leaf((*r[:4], r[4].replace("\n", "")) if cut else r)
            proof = ""
            for left, right in way + top:
                proof += "".join(left + right)
                now = sha("".join(left) + now + "".join(right))
            out.append((r[0], leaf(r), sub, root, sha(proof), now, now == root))
    return sorted(out, key=repr)


def found(df, levels):
    got = merkle.manifest(df, carry={"altered": merkle.without_newlines(df)}, levels=levels)
    got = got.select("id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("p"),
                     merkle.fold(F.col("altered"), F.col("proof")).alias("f")).withColumn("ok", F.col("f") == F.col("root"))
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_documents_match_the_definition(docs, levels):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert found(docs, levels) == brute(rows)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 9, 10, 28, 82])
def test_every_number_of_leaves(spark, count):
    rows = [(i, "s", None, i, f"text\n{i}") for i in range(count)] + [(i, f"t{i}", "en", 0, "") for i in range(count % 5)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    assert found(df, 1) == brute(rows)


def test_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in odd.collect()]
    for levels in (1, 6):
        assert found(odd, levels) == brute(rows)
    assert merkle.manifest(nothing).count() == 0


def test_hot_source_with_equal_rows(spark):
    rows = [(5, "hot", "en", 1, "same\ntext")] * 200 + [(None, None, None, None, None)] * 40 + [(i, "b", "en", 1, "x") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert found(df, 2) == brute(rows)


def test_query(spark, sf_small, docs):
    got = op11_merkle_manifest(spark, sf_small)
    assert got.columns[:7] == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
