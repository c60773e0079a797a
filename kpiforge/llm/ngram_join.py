"""Exact n-gram Jaccard join by grouped prefixes, and the components of its links.

A document is the set of its distinct word n-grams, as 64-bit hashes in one global order: rare
first.  Two sets with Jaccard similarity t or more share a token among the first
``n - ceil(t n) + 1`` of each.  Documents with the same prefix and size are one group; groups that
share a prefix token at positions that still allow the needed overlap are candidate pairs; a pair's
prefixes bound its overlap exactly and prune it; what is left is expanded to members and
verified on the texts.

The order comes from a count of all documents' n-grams in a fixed number of hash cells: tokens of
fuller cells come later.  Any order gives the same result, so the cells only decide how much work
there is.

A large group of near copies is not expanded into its pairs.  In each bucket (documents sharing a
prefix token, or a whole prefix) only pairs with one pivot are verified first; documents that this
links need no further comparison with each other.  Then every candidate pair whose members are still
in different components is verified, so no link between components is lost.

A node is a text: rows go by a 64-bit key of their id and text, sets by a 128-bit digest, so nulls and repeated ids do
not mix up texts.

Defined cases: texts without words (or null) have an empty set and link with nothing; a text of
fewer than ``words`` words is one n-gram; equal sets link; a null id links like any other row but
names no component (null where a component has no other ids); rows that repeat an id are linked with each
other whatever their texts; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.text import PARTS, chunks, free_names, mix, row_key, slices, store, vector_sum, word_hashes

WORDS = 4
PERCENT = 85
CELLS = 1 << 20
ID_BITS = 1 << 23


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of every row."""
    hashes, counts = word_hashes(data, offsets)
    ends = np.cumsum(counts)
    if len(hashes) >= words:
        grams = hashes[:len(hashes) - words + 1].copy()
        for k in range(1, words):
            grams = mix(grams) + hashes[k:len(hashes) - words + 1 + k]
        grams = mix(grams)
    for end, count in zip(ends.tolist(), counts.tolist()):
        if count >= words:
            yield np.unique(grams[end - count:end - words + 1])
        elif count:
            one = hashes[end - count:end - count + 1]
            for k in range(1, count):
                one = mix(one) + hashes[end - count + k]
            # the number of words keeps short sequences apart from n-grams
            yield mix(one ^ np.uint64(count))
        else:
            yield np.zeros(0, np.uint64)


def _count_cells(words: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(cells, np.int64)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                tokens = np.concatenate(list(shingles(data, offsets, words)))
                np.add.at(total, (tokens & np.uint64(cells - 1)).astype(np.int64), 1)
        part = TaskContext.get().partitionId()
        yield chunks(part, total)
    return run


def rarity(texts: DataFrame, words: int = WORDS, cells: int = CELLS) -> np.ndarray:
    """Grade of every hash cell, by its count over all documents: the higher, the later its tokens come."""
    total = vector_sum(texts.mapInArrow(_count_cells(words, cells), PARTS), cells)
    mean = max(float(total.mean()), 1.0)
    # eighths of a standard error around the mean, then the logarithm: even a token in a few dozen
    # documents raises its cell, and so comes late
    z = (total - mean) / np.sqrt(mean)
    fine = np.clip(np.floor(8 * z) + 40, 0, 120)
    return np.where(z <= 10, fine, np.minimum(120 + 8 * np.log2(np.maximum(z, 10) / 10), 255)).astype(np.uint8)


def need(size: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of a set of this size with any set it can link with."""
    return -(-percent * size // 100)


def _sets(words: int, percent: int, grades):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grade = grades.value
        last = np.uint64(len(grade) - 1)
        for batch in batches:
            sizes, names, groups, prefixes = [], [], [], []
            for _, _, data, offsets in slices(batch.column(2)):
                for tokens in shingles(data, offsets, words):
                    n = len(tokens)
                    ordered = tokens[np.argsort(grade[(tokens & last).astype(np.int64)], kind="stable")]
                    prefix = ordered[:n - int(need(n, percent)) + 1 if n else 0].tobytes()
                    sizes.append(n)
                    names.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    groups.append(hashlib.blake2b(prefix, digest_size=16).digest())
                    prefixes.append(prefix)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(names, pa.binary()),
                 pa.array(groups, pa.binary()), pa.array(prefixes, pa.binary())], ["id", "doc", "n", "set", "grp", "prefix"])
    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = [np.frombuffer(p.as_buffer(), np.int64) for p in batch.column(3)]
        counts = np.array([len(t) for t in tokens], np.int64)
        if not counts.sum():
            continue
        at = np.repeat(np.arange(len(tokens)), counts)
        pos = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        take = lambda i: batch.column(i).take(pa.array(at))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(tokens)), take(0), take(1), take(2), pa.array(pos.astype(np.int32))],
            ["token", "gid", "n", "docs", "pos"])


def _shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token: drop tokens with a single row."""
    held: pa.RecordBatch | None = None  # last row seen, while it may still be a single
    kept_token = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        token = rows.column(0).to_numpy()
        same = token[1:] == token[:-1]
        keep = np.r_[same, False] | np.r_[token[0] == kept_token if kept_token is not None else False, same]
        held = None if keep[-1] else rows.slice(len(token) - 1)
        kept_token = token[-1] if keep[-1] else None
        out = rows.filter(pa.array(keep))
        if out.num_rows:
            yield out


def overlap_needed(a: Column, b: Column, percent: int) -> Column:
    """ceil(percent (a + b) / (100 + percent)), in integers."""
    return F.floor((F.lit(percent) * (a + b) + (99 + percent)) / (100 + percent)).cast("int")


def _fits(percent: int, x: str, y: str) -> Column:
    """Whether the first shared token at these positions leaves room for the needed overlap."""
    left = F.least(F.col(f"{x}.n") - F.col(f"{x}.pos"), F.col(f"{y}.n") - F.col(f"{y}.pos"))
    return left >= overlap_needed(F.col(f"{x}.n"), F.col(f"{y}.n"), percent)


def _prefix_bound(percent: int, grades):
    """Keep group pairs whose prefixes allow the needed overlap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grade = grades.value
        last = np.uint64(len(grade) - 1)
        for batch in batches:
            na, nb = batch.column(2).to_pylist(), batch.column(4).to_pylist()
            keep = []
            for i in range(batch.num_rows):
                a = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                b = np.frombuffer(batch.column(5)[i].as_buffer(), np.uint64)
                order = lambda t: (grade[(t & last).astype(np.int64)].astype(np.uint64), t)
                ga, gb = order(a)[0], order(b)[0]
                # up to the smaller of the two last tokens, both prefixes are complete
                end = min((int(ga[-1]), int(a[-1])), (int(gb[-1]), int(b[-1])))
                upto = lambda g, t: int(((g < end[0]) | ((g == end[0]) & (t <= np.uint64(end[1])))).sum())
                ra, rb = upto(ga, a), upto(gb, b)
                common = len(np.intersect1d(a[:ra], b[:rb], assume_unique=True))
                most = common + min(na[i] - ra, nb[i] - rb)
                keep.append(100 * most >= percent * (na[i] + nb[i] - most))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def _verify(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [(t for _, _, data, offsets in slices(batch.column(i)) for t in shingles(data, offsets, words))
                     for i in (2, 3)]
            keep = []
            for a, b in zip(*sides):  # one pair's sets at a time
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def _some_ids(bits: np.ndarray):
    """A map-side filter: ids whose bit is unset are not needed (others may be)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bits.value
        for batch in batches:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            cell = (mix(ids) & np.uint64(ID_BITS - 1)).astype(np.int64)
            yield batch.filter(pa.array((held[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1))
    return run


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array((mix(ids) & np.uint64(ID_BITS - 1)).astype(np.int64))], ["bit"])


def needed_texts(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the wanted ids; a fixed-size bitmap of them keeps other texts from being shuffled."""
    words = (ids.select("id").mapInArrow(_bits, "bit long")
             .groupBy(F.expr("bit div 64").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).collect())
    bits = np.zeros(ID_BITS // 64, np.int64)
    for r in words:  # at most ID_BITS / 64 rows
        bits[r.word] = r.bits
    held = texts.sparkSession.sparkContext.broadcast(bits.view(np.uint8))
    some = texts.select("id", "text").mapInArrow(_some_ids(held), "id long, text string")
    return some.join(ids.select("id").distinct(), "id", "left_semi")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of row keys whose texts link."""
    pairs = store(pairs.distinct(), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    known = store(needed_texts(texts, ids).dropDuplicates(["id"]), "texts")
    both = (pairs.join(known.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
            .join(known.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .select("a", "b", "ta", "tb"))
    return store(both.mapInArrow(_verify(words, percent), "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every linked id, by contraction: each id joins its neighbour of lowest hash.

    The order is by a hash, so long chains shrink by a constant share in every round.
    """
    key = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    edges = links.select("a", "b").filter("a <> b")
    roots = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = store(both.groupBy("a").agg(F.min(key("b")).alias("m"))
                       .select(F.col("a").alias("id"), F.least("m", key("a"))["v"].alias("root")), "lowest")
        if roots is None:
            roots = lowest
        else:
            step = lowest.withColumnsRenamed({"id": "at", "root": "next"})
            roots = store(roots.join(step, F.col("root") == F.col("at"), "left")
                          .select("id", F.coalesce("next", "root").alias("root")), "roots")
        a = lowest.withColumnsRenamed({"id": "a", "root": "ra"})
        b = lowest.withColumnsRenamed({"id": "b", "root": "rb"})
        edges = store(edges.join(a, "a").join(b, "b").filter("ra <> rb")
                      .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return roots


def similar_groups(df: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
                   text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    return _components_of_rows(df, words, percent, id_col, text_col, cells).select(
        F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "component_id")


def _components_of_rows(df: DataFrame, words: int, percent: int, id_col: str, text_col: str, cells: int = CELLS) -> DataFrame:
    """id (key of the row), doc (its id), n, root (its component) and component_id of every row of ``df``."""
    spark = df.sparkSession
    texts = df.select(row_key(F.col(id_col), F.col(text_col)).alias("id"), F.col(id_col).cast("long").alias("doc"),
                      F.col(text_col).alias("text"))
    grades = spark.sparkContext.broadcast(rarity(texts.select("text"), words, cells))
    docs = store(texts.mapInArrow(_sets(words, percent, grades),
                                  "id long, doc long, n int, set binary, grp binary, prefix binary"), "sets")
    # equal sets are one class, equal prefixes and sizes one group; both go by their smallest key
    classes = docs.filter("n > 0").groupBy("set", "n", "grp").agg(F.min("id").alias("cls"))
    groups = store(docs.filter("n > 0").groupBy("n", "grp").agg(
        F.min("id").alias("gid"), F.count(F.lit(1)).alias("docs"), F.first("prefix").alias("prefix")), "groups")
    classes = store(classes.join(groups.select("n", "grp", "gid"), ["n", "grp"])
                    .select("cls", "gid", "set"), "classes")
    # postings of tokens that two groups share; rarest position first, so the first is the pivot
    postings = (groups.select("gid", "n", "docs", "prefix")
                .mapInArrow(_postings, "token long, gid long, n int, docs long, pos int"))
    shared = store(postings.repartition("token").sortWithinPartitions("token")
                   .mapInArrow(_shared_only, "token long, gid long, n int, docs long, pos int"), "postings")
    pivot = shared.groupBy("token").agg(F.min(F.struct(
        "pos", (-F.col("docs")).alias("fewer"), "gid", "n")).alias("p"))
    pivot = pivot.select("token", "p.pos", "p.gid", "p.n").alias("x")
    stars = (shared.alias("y").join(pivot, F.col("x.token") == F.col("y.token"))
             .filter(F.col("x.gid") != F.col("y.gid")).filter(_fits(percent, "x", "y"))
             .select(F.least("x.gid", "y.gid").alias("a"), F.greatest("x.gid", "y.gid").alias("b")))
    near = _allowed(stars, groups, percent, grades)
    inside = classes.filter("cls <> gid").select(F.col("gid").alias("a"), F.col("cls").alias("b"))
    links = verified(near.unionByName(inside), texts, words, percent)
    roots = components(links) if not links.isEmpty() else None

    # what the stars left open: candidate pairs of classes in different components
    if roots is None:
        placed = classes.withColumn("root", F.col("cls"))
    else:
        placed = store(classes.join(roots.withColumnRenamed("id", "cls"), "cls", "left")
                       .withColumn("root", F.coalesce("root", "cls")), "placed")
    whole = placed.groupBy("gid").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    # a group's component, or null while its members are in several
    whole = whole.select("gid", F.when(F.col("low") == F.col("high"), F.col("low")).alias("root"))
    marked = store(shared.join(whole, "gid"), "marked")
    lead = marked.groupBy("token").agg(
        F.min(F.struct("pos", (-F.col("docs")).alias("fewer"), "gid", "n", "root")).alias("p"))
    lead = lead.select("token", F.col("p.root").alias("main"))
    apart = lambda x, y: ~F.coalesce(F.col(f"{x}.root") == F.col(f"{y}.root"), F.lit(False))
    # one side is outside the pivot's component; inside it nothing is left to find
    outside = (marked.join(lead, "token").filter(~F.coalesce(F.col("root") == F.col("main"), F.lit(False))).alias("x"))
    rest = (outside.join(marked.alias("y"), F.col("x.token") == F.col("y.token"))
            .filter(F.col("x.gid") != F.col("y.gid")).filter(apart("x", "y")).filter(_fits(percent, "x", "y"))
            .select(F.least("x.gid", "y.gid").alias("a"), F.greatest("x.gid", "y.gid").alias("b")))
    rest = _allowed(rest, groups, percent, grades)
    left = placed.select(F.col("gid").alias("a"), F.col("cls").alias("ca"), F.col("root").alias("ra"))
    right = placed.select(F.col("gid").alias("b"), F.col("cls").alias("cb"), F.col("root").alias("rb"))
    members = (rest.join(left, "a").join(right, "b").filter("ra <> rb")
               .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")))
    head = placed.filter("cls = gid").select("gid", F.col("root").alias("main"))
    astray = placed.join(head, "gid").filter("root <> main").select("gid", F.col("cls").alias("ca"), F.col("root").alias("ra"))
    within = (astray.join(placed.select("gid", F.col("cls").alias("cb"), F.col("root").alias("rb")), "gid")
              .filter("ra <> rb").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")))
    more = verified(members.unionByName(within).join(links, ["a", "b"], "left_anti"), texts, words, percent)
    if not more.isEmpty():
        links = links.unionByName(more)
        roots = components(links)
    return _labelled(docs, classes, links)


def _allowed(pairs: DataFrame, groups: DataFrame, percent: int, grades) -> DataFrame:
    """The distinct group pairs that their prefixes do not rule out."""
    side = lambda k, n, p: groups.select(F.col("gid").alias(k), F.col("n").alias(n), F.col("prefix").alias(p))
    both = (pairs.distinct().join(side("a", "na", "pa"), "a").join(side("b", "nb", "pb"), "b")
            .select("a", "b", "na", "pa", "nb", "pb"))
    return store(both.mapInArrow(_prefix_bound(percent, grades), "a long, b long"), "near")


def _labelled(docs: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    # a row of an empty set is a class of its own
    rows = store(docs.select("id", "doc", "n", "set").join(classes.select("set", "cls"), "set", "left")
                 .select("id", "doc", "n", F.coalesce(F.when(F.col("n") > 0, F.col("cls")), "id").alias("cls")), "rows")
    # the classes of a repeated id, each tied to one of them
    kinds = rows.filter("doc IS NOT NULL").select("doc", "cls").distinct()
    several = kinds.groupBy("doc").agg(F.min("cls").alias("a"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    ties = store(kinds.join(several.select("doc", "a"), "doc").select("a", F.col("cls").alias("b")).filter("a <> b"), "ties")
    edges = links.select("a", "b").unionByName(ties)
    if edges.isEmpty():
        rows = rows.withColumn("root", F.col("cls"))
    else:
        roots = components(edges).withColumnRenamed("id", "cls")
        rows = rows.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    smallest = rows.groupBy("root").agg(F.min("doc").alias("component_id"))
    return rows.join(smallest, "root").select("id", "doc", "n", "root", "component_id")


def one_of_each(df: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row of each component of ``df`` stays: the one with the smallest id (null ids last), of equal rows any."""
    found = store(_components_of_rows(df, words, percent, id_col, text_col), "members")
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc").isNull(), "doc", "id"))["id"].alias("id"))
    # how many rows have the key: a copy of a row, id and text, has it too
    stay = found.select("id").join(first.select("id"), "id", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("rows"))
    key, rows = free_names(df, "__keep", "__rows")
    stay = store(stay.withColumnsRenamed({"id": key, "rows": rows}), "stay")
    own = df.withColumn(key, row_key(F.col(id_col), F.col(text_col)))
    once = own.join(stay.filter(F.col(rows) == 1).select(key), key, "left_semi")
    repeated = stay.filter(F.col(rows) > 1).select(key)
    if not repeated.isEmpty():
        once = once.unionByName(own.join(repeated, key, "left_semi").dropDuplicates([key]))
    return once.select(*df.columns)
