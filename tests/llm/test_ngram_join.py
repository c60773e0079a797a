from __future__ import annotations

import random
import re

import duckdb
import pytest
from corpus_brute import lower_ascii

from kpiforge.llm.ngram_join import one_of_each, similar_groups
from kpiforge.llm.queries import ORACLE_SQL


def sets(rows, words=4):
    out = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
        grams = [tuple(w[i:i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else [tuple(w)] if w else []
        out.setdefault(doc, []).append(frozenset(grams))
    return out


def brute(rows, percent=85):
    """Components over all pairs of rows, and every row's set size."""
    nodes = [(d, s) for d, own in sets(rows).items() for s in own]
    root = list(range(len(nodes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, x) in enumerate(nodes):
        for j, (b, y) in enumerate(nodes[:i]):
            both = len(x & y)
            if a is not None and a == b or x and y and 100 * both >= percent * (len(x) + len(y) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(nodes):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i))) for i, (d, s) in enumerate(nodes)), key=repr)


def near_copies(seed=1):
    """Chains and stars of near copies around the threshold, exact copies, and unrelated texts that share lines."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    rows, n = [], 0
    for size in (8, 30, 60, 147):
        base = [word() for _ in range(size)]
        rows += [(n := n + 1, " ".join(base)) for _ in range(4)]
        step = list(base)
        for k in range(25):
            edit = list(base)
            for _ in range(rng.randint(1, 5)):
                edit[rng.randrange(size)] = word()
            rows.append((n := n + 1, " ".join(edit)))
            step[rng.randrange(size)] = word()  # a chain: each like the one before
            rows.append((n := n + 1, "\t".join(step).upper()))
    line = " ".join(word() for _ in range(9))
    rows += [(n := n + 1, line + "\n" + " ".join(word() for _ in range(rng.randint(0, 40)))) for _ in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells", [1 << 20, 64])
def test_near_copies_match_all_pairs(spark, cells):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = similar_groups(df, cells=cells).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, similar_groups(docs).collect()), key=repr) == brute(rows)


def test_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, similar_groups(odd).collect()), key=repr) == brute(rows)
    comps = {r.doc_id: r.component_id for r in similar_groups(odd).collect()}
    assert comps[2] == 1 and comps[8] == 7 and comps[13] == 12 and comps[4] == 4 and comps[6] == 6 and comps[None] is None
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 3, 4, 5, 6, 7, 9, 10, None, 11, 12], key=repr)
    assert similar_groups(nothing).count() == 0 and one_of_each(nothing).count() == 0


def test_null_and_repeated_ids(spark):
    """Rows without an id link and bridge; an id with two texts links both; one row of each component stays."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    rows = []
    for doc in (None, None, None, 5, 7, 7, 9):  # near copies, each changed at another word
        own = list(words)
        own[rng.randrange(4, 190)] = f"changed{len(rows)}"
        rows.append((doc, " ".join(own)))
    other = " ".join(reversed(words))
    rows += [(7, other), (30, other.upper()), (31, ""), (31, other + " x"), (None, ""), (None, None), (None, "one two three four five"),
             (None, "one two three four five"), (40, "one two three four"), (41, "alone in the world here"), (41, "alone in the world here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = similar_groups(df).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert {r.component_id for r in got if r.n_shingles > 100} == {5}
    kept = sorted(((r.doc_id, r.text) for r in one_of_each(df).collect()), key=repr)
    # the large component, 40, 41, the texts without words, and one of two equal rows without an id
    assert sorted((d for d, _ in kept), key=repr) == sorted([5, 40, 41, None, None, None], key=repr)
    assert kept.count((None, "one two three four five")) == 1


def test_bridge_without_an_id(spark):
    """Two documents are linked only through a row that has no id."""
    base = [f"w{i}" for i in range(100)]
    edit = lambda *places: " ".join(f"x{i}" if i in places else w for i, w in enumerate(base))
    rows = [(1, edit(10)), (None, edit()), (2, edit(90)), (3, edit(0, 20, 40, 60, 80))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, similar_groups(df).collect()), key=repr) == brute(rows)


def test_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_small}/documents.parquet'")
    want = con.execute(ORACLE_SQL["op4_ngram_join"]).fetchall()
    got = similar_groups(spark.read.parquet(f"{sf_small}/documents.parquet")).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == sorted(want)
