"""Merkle manifest of a table by butterfly exchange.

Every row is a leaf: the SHA-256 of its fields, each with its length.  The leaves of a source, by
ascending id, are cut into aligned blocks of ``FANOUT ** LEVELS``; a block's subtree is built in
one place.  Then blocks exchange subtree roots in rounds: in round r, the blocks that agree in all digits
(base ``FANOUT``) of their number but the r-th form a group, swap the roots of their subtrees and each
of them hashes the parent.  All blocks of a subtree do the same hashing redundantly, so after the
last round every block knows its source's root and the siblings on its way up, and no pass leads down again.
Numbers between the blocks a source has and the next power of the fanout are ghosts: they
have no leaves, but pass on the roots of incomplete subtrees.  The sources' roots are the leaves of the top
tree, which is built in the same way.

No group is larger than a block or the fanout, whatever share of the rows a source has; positions come
from a range partition (``ranks.positions``).  Texts are hashed where they are scanned; only digests are shuffled.

Defined cases: a null field is ``-`` and differs from an empty one; a null source is a source of its own, the first;
null ids come first; rows that repeat an id stand by their digest; equal rows are leaves of their own, each with
its own proof; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from kpiforge.llm.ranks import positions
from kpiforge.llm.text import store

FANOUT = 3
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# one step of a proof: how many siblings stand to the left, and the siblings
_STEP = StructType([StructField("at", IntegerType()), StructField("others", ArrayType(StringType()))])
PROOF = ArrayType(_STEP)
_ARROW_PROOF = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.string()))]))


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values, each as its UTF-8 byte count, ``:`` and itself; a null is ``-``."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _height(leaves: int) -> int:
    """Levels above this many leaves."""
    height = 0
    while FANOUT ** height < leaves:
        height += 1
    return height


def _levels(nodes: list[str], height: int) -> list[list[str]]:
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        levels.append([_hash(below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return levels


def _proofs(levels: list[list[str]]) -> list[list[dict]]:
    """The steps from every leaf to the top of its block."""
    above: list[list[dict]] = [[] for _ in levels[-1]]
    for nodes in reversed(levels[:-1]):
        here = []
        for i in range(len(nodes)):
            first, at = i - i % FANOUT, i % FANOUT
            run = nodes[first:first + FANOUT]
            here.append([{"at": at, "others": run[:at] + run[at + 1:]}, *above[i // FANOUT]])
        above = here
    return above


def _block_height(rows: int, levels: int) -> int:
    return levels if rows > FANOUT ** levels else _height(rows)


def _block_root(levels: int):
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("__pos")
        top = _levels(block.column("__leaf").to_pylist(), _block_height(block.column("__rows")[0].as_py(), levels))
        return pa.table({"__tree": block.column("__tree")[:1], "__block": block.column("__block")[:1],
                         "__rows": block.column("__rows")[:1], "__digest": pa.array([top[-1][0]], pa.string())})
    return run


def _block_proofs(levels: int, keep: list[str]):
    def run(leaves: pa.Table, known: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("__pos")
        inside = _proofs(_levels(leaves.column("__leaf").to_pylist(),
                                 _block_height(leaves.column("__rows")[0].as_py(), levels)))
        upper = known.column("__path")[0].as_py()
        same = {c: pa.repeat(known.column(c)[0], len(leaves)) for c in ("__top", "__root")}
        return pa.table({**{c: leaves.column(c) for c in keep}, **same,
                         "__proof": pa.array([steps + upper for steps in inside], _ARROW_PROOF)})
    return run


def _butterfly(blocks: DataFrame, levels: int) -> DataFrame:
    """(__tree, __block, __path, __top): every block's siblings above its own subtree, and its tree's root."""
    size = FANOUT ** levels
    count = F.expr(f"cast(ceil(__rows / {size}D) as long)")
    state = store(blocks.select("__tree", count.alias("__blocks"), "__block", "__digest",
                                F.array().cast(PROOF).alias("__path")), "blocks")
    most = state.agg(F.max("__blocks")).first()[0] or 1
    done = state.filter("__blocks = 1")
    # ghosts: each block b stands in for b + blocks, b + 2 blocks, ... below the next power of the fanout
    slots = F.lit(1)
    for k in range(1, _height(most) + 1):
        slots = F.when(F.col("__blocks") > FANOUT ** (k - 1), F.lit(FANOUT ** k)).otherwise(slots)
    state = (state.filter("__blocks > 1").withColumn("__slots", slots)
             .withColumn("__turn", F.explode(F.sequence(F.lit(0), F.lit(FANOUT - 1))))
             .withColumn("__own", F.col("__turn") == 0)
             .withColumn("__block", F.col("__block") + F.col("__turn") * F.col("__blocks"))
             .filter("__block < __slots")
             .select("__tree", "__blocks", "__block", F.when(F.col("__own"), F.col("__digest")).alias("__digest"), "__path"))
    reach = 1
    while reach < most:
        group = state.groupBy("__tree", "__blocks", F.expr(f"__block div {FANOUT * reach}").alias("__parent"),
                              F.expr(f"__block % {reach}").alias("__lane")).agg(
            F.collect_list(F.struct(F.expr(f"__block div {reach} % {FANOUT}").alias("digit"), "__digest",
                                    "__block", "__path")).alias("__peers"))  # one of each digit
        run = F.filter(F.sort_array(F.transform("__peers", lambda p: F.struct(p["digit"], p["__digest"]))),
                       lambda p: p["__digest"].isNotNull())
        swapped = group.withColumn("__run", run).select("__tree", "__blocks", F.explode("__peers").alias("me"), "__run")
        step = F.struct(
            F.size(F.filter("__run", lambda p: p["digit"] < F.col("me.digit"))).alias("at"),
            F.transform(F.filter("__run", lambda p: p["digit"] != F.col("me.digit")), lambda p: p["__digest"]).alias("others"))
        parent = F.sha2(F.array_join(F.transform("__run", lambda p: p["__digest"]), "").cast("binary"), 256)
        state = store(swapped.select(
            "__tree", "__blocks", F.col("me.__block").alias("__block"),
            F.when(F.size("__run") > 0, parent).alias("__digest"),
            F.when(F.col("me.__block") < F.col("__blocks"), F.concat("me.__path", F.array(step.cast(_STEP))))
            .otherwise(F.array().cast(PROOF)).alias("__path")), "round")
        reach *= FANOUT
        done = done.unionByName(state.filter(f"__blocks <= {reach} AND __block < __blocks"))
        state = state.filter(f"__blocks > {reach}")
    return done.select("__tree", "__block", "__path", F.col("__digest").alias("__top"))


def _placed(rows: DataFrame, order: list[str], levels: int) -> tuple[DataFrame, DataFrame]:
    """The rows with position and block, and the blocks as the butterfly leaves them."""
    size = FANOUT ** levels
    placed = store(positions(rows, "__tree", order).withColumn("__block", F.expr(f"__pos div {size}")), "leaves")
    blocks = placed.select("__tree", "__block", "__pos", "__rows", "__leaf").groupBy("__tree", "__block").applyInArrow(
        _block_root(levels), "__tree string, __block long, __rows long, __digest string")
    return placed, _butterfly(blocks, levels)


def _proven(placed: DataFrame, known: DataFrame, keep: list[str], levels: int) -> DataFrame:
    fields = [placed.schema[c] for c in keep]
    out = StructType([*fields, StructField("__top", StringType()), StructField("__root", StringType()),
                      StructField("__proof", PROOF)])
    return (placed.groupBy("__tree", "__block").cogroup(known.groupBy("__tree", "__block"))
            .applyInArrow(_block_proofs(levels, keep), out))


def manifest(df: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
             carry: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``df``: id, source, leaf, subroot (its source's), root, proof, and the ``carry`` columns.

    ``proof`` lists, from the leaf up through the subroot to the root, the siblings of each step and how many of them
    stand to the left.  ``fold`` recomputes the root from a leaf and a proof.
    """
    carry = carry or {}
    held = {f"__carry{i}": c for i, c in enumerate(carry.values())}
    # "" for null, and a mark before any other source: null first, then by UTF-8 bytes
    tree = F.when(F.col(source_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source_col).cast("string")))
    rows = df.select(tree.alias("__tree"), F.col(id_col).cast("long").alias("__id"), digest(*(F.col(c) for c in fields)).alias("__leaf"),
                     F.monotonically_increasing_id().alias("__row"), *(c.alias(k) for k, c in held.items()))
    placed, known = _placed(rows, ["__id", "__leaf", "__row"], levels)
    known = store(known, "known")
    sources = known.filter("__block = 0").select(F.lit("").alias("__tree"), F.col("__tree").alias("__source"),
                                                 F.col("__top").alias("__leaf"))
    top_placed, top = _placed(sources, ["__source"], levels)
    top = _proven(top_placed, top.withColumn("__root", F.col("__top")), ["__source"], levels).select(
        F.col("__source").alias("__tree"), "__root", F.col("__proof").alias("__upper"))
    known = known.join(store(top, "sources"), "__tree").select(
        "__tree", "__block", "__top", "__root", F.concat("__path", "__upper").alias("__path"))
    proven = _proven(placed, known, ["__tree", "__id", "__leaf", *held], levels)
    return proven.select(
        F.col("__id").alias("id"), F.when(F.col("__tree") != "", F.expr("substring(__tree, 2)")).alias("source"),
        F.col("__leaf").alias("leaf"), F.col("__top").alias("subroot"), F.col("__root").alias("root"),
        F.col("__proof").alias("proof"), *(F.col(k).alias(name) for k, name in zip(held, carry)))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    def up(below: Column, step: Column) -> Column:
        left = F.array_join(F.slice(step["others"], F.lit(1), step["at"]), "")
        right = F.array_join(F.slice(step["others"], step["at"] + 1, F.lit(FANOUT)), "")
        return F.sha2(F.concat(left, below, right).cast("binary"), 256)
    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda s: s["others"])), "").cast("binary"), 256)


def without_newlines(df: DataFrame) -> Column:
    """The leaf of a row of documents after its text lost its newlines, where 2 divides the id's checksum."""
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.translate("text", "\n", ""))
    return digest(*(F.coalesce(text, F.col("text")) if c == "text" else F.col(c) for c in FIELDS))
