"""Language identification, toxicity, language model and decontamination: brute force where there is one,
held-out quality where a model is learned."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus_brute import lower_ascii

from kpiforge.llm import toxicity
from kpiforge.llm.decontam import clean, common_subsequence, leaks
from kpiforge.llm.langid import identify
from kpiforge.llm.lm import best_classes, class_scores, exchange, train
from kpiforge.llm.text import hash_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def more(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def crc(doc):
    return zlib.crc32(str(doc).encode())


# ---------------------------------------------------------------- language
def test_language_of_held_out_documents(more):
    lang = {r.doc_id: r.lang for r in more.collect()}
    rows = identify(more).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    apart = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in apart]) > 0.97


def test_language_of_odd_rows(odd, nothing):
    rows = {r.doc_id: r for r in identify(odd).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (4, 5, 6))
    assert {r.lang_pred for r in rows.values()} <= {"en", "de", "fr", "und"}
    assert identify(nothing).count() == 0


# ---------------------------------------------------------------- toxicity
def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    word, gram = np.arange(1, 30), np.arange(1, 50)
    p = {k: v.astype(np.float64) if v.dtype != np.int32 else v for k, v in toxicity.initial(word, gram).items()}
    first = np.r_[0, np.sort(rng.choice(np.arange(1, 45), 19, replace=False))]
    features = (rng.integers(1, 30, 20), rng.integers(1, 50, 45), first)
    at = rng.integers(0, 20, (5, 7))
    there = (np.arange(7)[None] < np.array([7, 3, 1, 6, 5])[:, None]).astype(float)
    label, weight = np.array([1, 0, 1, 0, 1.0]), np.ones(5)

    def loss():
        x = toxicity.forward(p, toxicity.embed(p, features), at, there).astype(float)
        return (np.logaddexp(0, x) - label * x).mean()

    for name, g in toxicity.gradients(p, features, at, there, label, weight).items():
        for i in np.argsort(-np.abs(g.ravel()))[:3]:
            old = p[name].ravel()[i]
            p[name].ravel()[i] = old + 1e-3
            up = loss()
            p[name].ravel()[i] = old - 1e-3
            down = loss()
            p[name].ravel()[i] = old
            assert abs((up - down) / 2e-3 - g.ravel()[i]) < 1e-4 + 1e-2 * abs(g.ravel()[i]), name


def test_windows_cover_every_word():
    counts = np.array([0, 1, 32, 33, 48, 49, 500])
    begin, size, row = toxicity.windows(counts)
    base = np.cumsum(counts) - counts
    for r, n in enumerate(counts):
        seen = set()
        for b, s in zip(begin[row == r], size[row == r]):
            assert 0 < s <= toxicity.WINDOW
            seen |= set(range(b - base[r], b - base[r] + s))
        assert seen == set(range(n))


def test_toxicity_of_held_out_documents(spark):
    """On planted words: texts of three languages' worth of words, some with words of a toxic family."""
    rng = np.random.default_rng(3)
    syllables = ["ba", "no", "ti", "re", "lu", "ka", "me", "so", "di", "fu"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    rows, labels = [], []
    for doc in range(900):
        words, toxic = [word() for _ in range(rng.integers(20, 160))], int(doc % 5 == 0)
        for at in rng.integers(0, len(words), 4 * toxic):
            words[at] = rng.choice(["Zorgvile", "zorgvex!", "ZORGVOM", "grublot,", "grubnak"])
        rows.append((doc, " ".join(words)))
        labels.append((doc, toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    toxic = dict(labels)
    got = toxicity.score(df, marks).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (crc(r.doc_id) % 4 == 2) for r in got)
    apart = [r for r in got if r.held_out]
    assert np.mean([r.predicted for r in apart if toxic[r.doc_id]]) > 0.9
    assert np.mean([r.predicted for r in apart if not toxic[r.doc_id]]) < 0.1


def test_toxicity_sample_has_whole_texts():
    """A text of the sample keeps all its windows, whatever its place in the text; none is cut."""
    words = [f"word{i}" for i in range(2_000)] + ["x" * 9_000]
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8], pa.int64()), pa.array([1, 0], pa.int32()),
                                        pa.array([" ".join(words), None])], ["order", "toxic", "text"])
    (out,) = toxicity._training_windows(iter([batch]))
    starts, sizes, _ = toxicity.windows(np.array([len(words)]))
    assert out.column("text").to_pylist() == [" ".join(words[a:a + n]) for a, n in zip(starts, sizes)]
    assert set(out.column("order").to_pylist()) == {7}
    assert out.column("cost").to_pylist()[0] == 1 and out.column("cost").to_pylist()[-1] == 18


def test_toxicity_sample_is_bounded_by_texts_and_size():
    each = toxicity.TEXT_WINDOWS
    # by order; what does not fit is passed over and smaller ones after it are not
    assert toxicity.choose([(3, 1), (1, each), (2, 10 * each), (4, each)], 3) == [1, 3, 4]
    assert toxicity.choose([(k, 1) for k in range(9)], 4) == [0, 1, 2, 3]
    assert toxicity.choose([(1, each + 1)], 1) == [] and toxicity.choose([], 5) == []


def test_toxicity_of_odd_rows(spark, odd, nothing):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.score(odd, none).collect()
    assert len(rows) == odd.count() and all(r.score == 0 and r.predicted == 0 for r in rows)
    some = spark.createDataFrame([(i, int(i in (1, 3, 9))) for i in range(14)], "doc_id long, toxic int")
    rows = toxicity.score(odd, some).collect()
    assert all(r.score == 0 for r in rows if r.doc_id in (4, 5, 6)) and len(rows) == odd.count()
    assert toxicity.score(nothing, none).count() == 0


# ---------------------------------------------------------- language model
def brute_base(rows):
    words = {id(r): re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(r.text or "")) + [None] for r in rows}
    learned = lambda r: r.doc_id is not None and crc(r.doc_id) % 10 != 0
    c = Counter(w for r in rows if learned(r) for w in words[id(r)])
    n, v = sum(c.values()), len(c)
    out = []
    for r in rows:
        own = words[id(r)]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        out.append((r.doc_id, not learned(r), len(own), sum(c[w] > 0 for w in own), n, round(base, 4)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("lookup", [1 << 18, 50])
def test_class_model_base_matches_brute_force(odd, docs, lookup):
    """Also with a small look-up table, so that most words go through the join."""
    for df in (odd, docs):
        got = class_scores(df, rounds=1, lookup=lookup).collect()
        assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
                       for r in got), key=repr) == brute_base(df.collect())


def test_class_model_beats_the_base_and_sums_to_one(more):
    rows = [r for r in class_scores(more).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert all(r.score < 0 and abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) < 1e-6 * r.perplexity for r in rows)


def test_words_beyond_the_vocabulary_get_classes_of_their_own(spark):
    """Rare words of two kinds of contexts that all end in the same four bytes, with few units."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        kind = "ab"[i % 2]
        middle = lambda: f"{kind}x{rng.integers(60)}zzzz" if rng.random() < 0.5 else f"{kind}m{rng.integers(3)}"  # noqa: B023, E731
        rows.append((" ".join(f"{kind}{rng.integers(3)} {middle()} {kind}e{rng.integers(3)}" for _ in range(6)),))
    texts = spark.createDataFrame(rows, "text string").repartition(3)
    model, tail = train(texts, classes=8, vocabulary=18, lookup=40)
    cls = {r.word: r.cls for r in tail.collect()}
    of = lambda kind: [cls[int(np.uint64(hash_of(f"{kind}x{i}zzzz")).view(np.int64))] for i in range(60)]
    assert len(cls) == 120 and not set(of("a")) & set(of("b")) and len(model.words) <= 40


def test_moves_follow_the_exchange():
    """A word moves as in a round of the exchange in which it is the only one with counts of its own."""
    rng = np.random.default_rng(5)
    classes, size = 6, 40
    for _ in range(50):
        left, right = rng.integers(0, 4, (2, size, classes)) * (rng.random((2, size, classes)) < 0.4)
        right[0], left[0] = 9, 9
        left[:, 0] += np.maximum(right.sum(1) - left.sum(1), 0)
        right[:, 0] += np.maximum(left.sum(1) - right.sum(1), 0)
        cls = np.r_[0, rng.integers(1, classes, size - 1)]
        pairs = np.zeros((classes, classes))
        np.add.at(pairs.T, cls, left.astype(float))
        first = int(np.argsort(-right.sum(1), kind="stable")[1 if right.sum(1).argmax() == 0 else 0])
        sums = np.bincount(cls, weights=right.sum(1), minlength=classes)
        got = best_classes(left[[first]], right[[first]], cls[[first]], pairs, sums)
        assert got[0] == exchange(left, right, cls)[first]


def test_class_model_scores_do_not_depend_on_the_table(docs, odd):
    """Words beyond the look-up table have the classes, and so the scores, they would have in it (the units are the same)."""
    for df in (docs, odd):
        all_, few = ({(r.doc_id, r.n_tokens, r.n_known): r.score for r in class_scores(df, rounds=1, vocabulary=20, lookup=n).collect()}
                     for n in (1 << 18, 120))
        assert all_.keys() == few.keys() and all(abs(all_[k] - few[k]) < 1e-6 * (1 + abs(few[k])) for k in all_)


def test_class_table_has_exactly_its_size(spark, odd, monkeypatch):
    """Frequent words beyond the table, and words of equal counts, leave it neither larger nor smaller."""
    from kpiforge.llm import lm
    monkeypatch.setattr(lm, "COUNT_BINS", 64)  # counts from here on share a bin of the histogram
    words = spark.createDataFrame([(i, 70 + i % 3) for i in range(40)] + [(100 + i, 1) for i in range(300)], "word long, n long")
    for most in (1, 10, 40, 41, 200, 340, 1000):
        got = sorted((tuple(r) for r in lm._most_frequent(words, most).collect()), key=lambda r: (-r[1], r[0]))
        assert got == sorted((tuple(r) for r in words.collect()), key=lambda r: (-r[1], r[0]))[:most]
    model, _ = train(odd.filter("doc_id IS NOT NULL").select("text"), rounds=1, vocabulary=20, lookup=120)
    assert len(model.words) == 120 and len(np.unique(model.words)) == 120


def test_class_model_probabilities_sum_to_one(docs):
    """Over classes after each class, and over the words of each class with one unknown word."""
    from kpiforge.llm import lm
    for lookup in (1 << 18, 500):
        model, tail = train(docs.select("text"), rounds=1, vocabulary=100, lookup=lookup)
        assert np.allclose((10.0 ** model.trans).sum(1), 1)
        rest = tail.toPandas()
        rest = rest[~np.isin(rest["word"].to_numpy(np.int64), model.words.view(np.int64))]
        mass = np.bincount(np.r_[model.cls, rest["cls"]], np.r_[model.counts, rest["n"]] + lm.ADD, len(model.below)) + lm.ADD
        mass[lm.END] += model.end_count + lm.ADD
        assert np.allclose(mass / 10.0 ** model.below, 1)


def test_class_model_holds_little_in_a_task():
    """Hashing a large batch leaves no tables beyond a slice's, and counts are summed over a bounded number of words."""
    from kpiforge.llm import lm, text
    text._POWERS.clear()
    rng = np.random.default_rng(9)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 1_000_000, 500)) for _ in range(700)]
    batch = pa.RecordBatch.from_arrays([pa.array([*texts, "x" * (text.SLICE_BYTES + 9), None, ""])], ["t"])
    got = Counter()
    for out in lm._word_counts(iter([batch, batch])):
        assert out.num_rows <= lm.COUNTED + text.SLICE_BYTES
        got.update(dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist())))
    want = Counter(w for t in [*texts, "x" * (text.SLICE_BYTES + 9)] for w in t.split())
    assert got == {int(np.uint64(hash_of(w)).view(np.int64)): 2 * n for w, n in want.items()}
    assert all(len(p) <= text.SLICE_BYTES + 2 for p in text._POWERS.values())


@pytest.mark.parametrize("counted", [1, 1 << 19])
def test_neighbours_do_not_depend_on_what_is_counted_at_once(spark, monkeypatch, counted):
    """Counts by hand of the classes around units, over slices counted alone and together."""
    from kpiforge.llm import lm
    monkeypatch.setattr(lm, "COUNTED", counted)
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    units = np.array([hash_of(w) for w in "abc"], np.uint64)
    cls = np.r_[0, 1, 2, 3, np.full(lm.SUFFIXES, 4)]
    texts = ["a b c a", None, "", "c x", "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    state = type("State", (), {"value": (units, cls)})()
    (out,) = lm._neighbours(state, 5)(iter([batch, batch]))
    left, right = np.frombuffer(b"".join(out.column(2).to_pylist()), np.int64).reshape(2, -1, 5)
    kinds = {"a": 1, "b": 2, "c": 3, "x": 4}
    steps = Counter()
    for t in [*texts, *texts]:
        line = [0, *(kinds[w] for w in (t or "").split()), 0]
        steps.update(zip(line, line[1:]))
    group = np.minimum(np.arange(len(cls)), 4)
    pairs = np.zeros((2, 5, 5), np.int64)
    np.add.at(pairs[0], group, left)
    np.add.at(pairs[1], group, right)
    assert all(pairs[0][b, a] == pairs[1][a, b] == steps[a, b] for a in range(5) for b in range(5))


def test_words_stay_whole_between_batches():
    """Sorted rows cut into small batches: a word's rows come together, also when it fills several batches."""
    from kpiforge.llm import lm
    rng = np.random.default_rng(10)
    word = np.sort(np.r_[rng.integers(-50, 50, 300), np.full(400, 7)])
    place, n = rng.integers(0, 9, len(word)).astype(np.int32), rng.integers(1, 5, len(word))
    batches = [pa.RecordBatch.from_arrays([pa.array(word[i:i + 13]), pa.array(place[i:i + 13]), pa.array(n[i:i + 13])], ["word", "place", "n"])
               for i in range(0, len(word), 13)]
    want, got, parts = Counter(), Counter(), list(lm._whole_words(iter(batches), 40))
    for w, p, k in zip(word.tolist(), place.tolist(), n.tolist()):
        want[w, p] += k
    for ws, ps, ks in parts:
        for w, p, k in zip(ws.tolist(), ps.tolist(), ks.tolist()):
            got[w, p] += k
    seen = [set(ws.tolist()) for ws, _, _ in parts]
    assert got == want and len(parts) > 3 and sum(map(len, seen)) == len(set(word.tolist()))
    assert max(len(ws) for ws, _, _ in parts) < 80
    assert not list(lm._whole_words(iter([]), 40))


def test_class_model_steps_need_no_python_rows(docs):
    """The class steps come as Arrow: no tasks that turn Python rows into Spark's."""
    assert "ExistingRDD" not in class_scores(docs, rounds=1)._jdf.queryExecution().executedPlan().toString()


def test_class_model_of_nothing(nothing):
    assert class_scores(nothing).count() == 0


# ---------------------------------------------------------- decontamination
def test_common_subsequence():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            old = 0
            for j, y in enumerate(b):
                old, row[j + 1] = row[j + 1], old + 1 if x == y else max(row[j + 1], row[j])
        return row[-1]

    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(1, 30)).tolist(), rng.integers(0, 6, rng.integers(0, 40)).tolist()
        assert common_subsequence(a, b) == slow(a, b)


def test_segment_sums_are_made_some_at_a_time(monkeypatch):
    """The sums of all segments, bit by bit; no call adds up more segments than stay in the cache."""
    from kpiforge.llm import decontam
    rng = np.random.default_rng(11)
    rows, begins = rng.standard_normal((50, 9)).astype(np.float32), np.r_[0, np.cumsum(rng.integers(1, 40, 299))]
    at = rng.integers(0, 50, begins[-1] + 5)
    weight = rng.random(len(at)).astype(np.float32)
    want = np.add.reduceat(weight[:, None] * rows[at], begins, axis=0)
    for segments in (1, 32, 300, 1000):
        monkeypatch.setattr(decontam, "SEGMENTS", segments)
        assert (decontam._summed(weight, rows, at, begins) == want).all()
    assert decontam._summed(weight[:0], rows, at[:0], begins[:0]).shape == (0, 9)


def test_leaks_match_verbatim_items(spark, more):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    words = lambda t: re.findall(r"\w+", t.lower())
    items = {r.item_id: " ".join(words(r.text)) for r in benchmark.collect()}
    text = {r.doc_id: " ".join(words(r.text)) for r in more.collect()}
    want = {(d, i) for d, t in text.items() for i, s in items.items() if s in t}
    got = {(r.doc_id, r.item_id) for r in leaks(more, benchmark).collect()}
    assert want and want <= got
    assert len(got - want) <= 0.02 * len(want) + 1


def test_paraphrases_and_clean_documents(spark, more):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    rng = np.random.default_rng(2)
    rows = [(r.doc_id, r.text) for r in more.limit(300).collect()]
    held = {}
    for r in benchmark.orderBy("item_id").limit(20).collect():
        words = r.text.split()
        for at in rng.choice(len(words), max(1, len(words) // 8), replace=False):
            words[at] = "changed"
        held[10_000 + r.item_id] = r.item_id
        rows.append((10_000 + r.item_id, rows[0][1][:600] + " " + " ".join(words) + " " + rows[1][1][:600]))
    got = leaks(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert sum(pair in found for pair in held.items()) >= 18


def test_long_and_common_items_match_verbatim(spark):
    """A 1,500-word item, and an item of words that most documents have, beside items with rare words."""
    rng = np.random.default_rng(6)
    word = lambda n=5_000: f"w{rng.integers(n)}"
    common = [f"c{i}" for i in range(15)]
    rows = [" ".join([*rng.permutation(common)[:13], *(word() for _ in range(60))]) for _ in range(400)]
    long_, short = " ".join(word() for _ in range(1500)), " ".join(common)
    items = [(1, long_), (2, short), *((10 + i, " ".join(word() for _ in range(30))) for i in range(30))]
    rows += [f"{rows[0]} {long_} {rows[1]}", " ".join(word() for _ in range(9)) + f" {short} " + " ".join(word() for _ in range(60))]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.item_id) for r in leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(400, 1), (401, 2)} <= got and not any(i == 1 and d != 400 or i >= 10 for d, i in got)


def test_decontamination_of_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "the quick brown fox jumps over the lazy dog again"), (None, "!!!")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(odd, items).collect()}
    assert got == {(1, 3), (2, 3)}
    kept = clean(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3
    assert leaks(nothing, items).count() == 0 and clean(odd, items.limit(0)).count() == odd.count()


def test_many_items_share_the_passes(spark, monkeypatch):
    """Over 1,000 items: one pass for all spaces and one search, and every copy is found."""
    from kpiforge.llm import decontam
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(1040)]
    docs = [(i, " ".join(word() for _ in range(60)) + " " + (items[i * 50][1] if i < 20 else word())) for i in range(60)]
    calls = []
    spaces = decontam.latent_spaces
    monkeypatch.setattr(decontam, "latent_spaces", lambda texts, some, *a: calls.append(len(some)) or spaces(texts, some, *a))
    found = leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(2),
                  spark.createDataFrame(items, "item_id long, text string"), rank=32)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i * 50) for i in range(20)}
    assert len(calls) <= -(-sum(calls) // decontam.BLOCKS_A_PASS) and sum(calls) >= 4
