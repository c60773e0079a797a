"""Line dedup over hashes, with per-document keep bitmaps.

Every line becomes (128-bit hash of its key, document, position).  Those small rows are range
partitioned by hash and sorted by hash, document and position; a streaming window carries the
first document of each key.  A hot key is cut into ``runs`` by document, each streamed on its own,
and the few first rows of the runs give the key's first document.  A line is dropped where its
document is not that one.  Text never takes part: the result is a bitmap per document, kept as the
64-line words that have a dropped line, and is applied to the text only where the caller wants it.

Only DataFrame functions are used.  Keys are told apart by two independent 64-bit hashes.

Defined cases: a null or empty text is one empty line; a null id is no document to keep lines
for, so its lines are neither dropped nor make others drop; rows that repeat an id are one document,
each with its own text (positions of drops are by row, as the same position in two rows of an id may
hold different lines); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.llm.text import free_names, store

MIN_CHARS = 10
RUNS = 64
# fixed values: the white space stripped from both ends of a line, and the letters lower-cased
STRIP = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; pure ASCII takes the fast built-in."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(df: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(__h1, __h2, __doc, __text, __pos) of every line whose key has at least ``min_chars`` characters.

    ``__text`` is a hash of the row's text: it tells rows that share an id apart.
    """
    lines = (df.select(F.col(id_col).alias("__doc"), F.xxhash64(F.col(text_col)).alias("__text"),
                       F.posexplode(text_lines(F.col(text_col))).alias("__pos", "__line"))
             .filter("__doc IS NOT NULL")
             .withColumn("__key", F.trim("__line", F.lit(STRIP)))
             .filter(F.char_length("__key") >= min_chars)
             .withColumn("__key", ascii_lower(F.col("__key"))))
    return lines.select(F.xxhash64("__key").alias("__h1"), F.xxhash64(F.lit("second"), "__key").alias("__h2"),
                        "__doc", "__text", "__pos")


def dropped_lines(hashes: DataFrame, runs: int = RUNS) -> DataFrame:
    """(__doc, __text, __pos) of the lines whose key has an earlier document."""
    run = F.pmod(F.xxhash64("__doc"), F.lit(runs))
    placed = (hashes.withColumn("__run", run)
              .repartitionByRange("__h1", "__h2", "__run")
              .sortWithinPartitions("__h1", "__h2", "__run", "__doc", "__pos"))
    stream = Window.partitionBy("__h1", "__h2", "__run").orderBy("__doc", "__pos")
    placed = placed.withColumn("__first", F.first("__doc").over(
        stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # one row for each key, run and document change at most; partial sums meet per key
    firsts = (placed.groupBy("__h1", "__h2")
              .agg(F.min("__first").alias("__keeper"), F.max("__doc").alias("__last"))
              .filter("__keeper < __last").drop("__last"))
    return (hashes.join(firsts, ["__h1", "__h2"]).filter("__doc > __keeper")
            .select("__doc", "__text", "__pos"))


def bitmaps(dropped: DataFrame) -> DataFrame:
    """One row per document with a dropped line: words (word number, bits of dropped lines), n_dropped."""
    words = (dropped.groupBy("__doc", "__text", F.expr("__pos div 64").cast("int").alias("__word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(__pos % 64 as int))")).alias("__bits")))
    return (words.groupBy("__doc", "__text")
            .agg(F.array_sort(F.collect_list(F.struct("__word", "__bits"))).alias("__words"),
                 F.sum(F.bit_count("__bits")).alias("n_dropped")))


def keep_bitmap(df: DataFrame, min_chars: int = MIN_CHARS, runs: int = RUNS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``df`` with n_dropped and keep_bitmap.

    keep_bitmap lists only the words with a dropped line, as (word, keep); bit b of word w is line
    64 w + b, and lines of words that are not listed are kept.
    """
    hashes = store(line_hashes(df, min_chars, id_col, text_col), "line-hashes")
    marks = bitmaps(dropped_lines(hashes, runs))
    marks = marks.withColumn("__keep", F.transform("__words", lambda w: F.struct(
        w["__word"].alias("word"), F.bitwise_not(w["__bits"]).alias("keep")))).drop("__words")
    doc, text, number, keep = free_names(df, "__doc", "__text", "__n", "__keep")
    marks = marks.select(F.col("__doc").alias(doc), F.col("__text").alias(text), F.col("n_dropped").alias(number),
                         F.col("__keep").alias(keep))
    own = F.xxhash64(df[text_col])
    return (df.join(marks, (marks[doc] == df[id_col]) & (marks[text] == own), "left")
            .select(*(df[c] for c in df.columns if c not in ("n_dropped", "keep_bitmap")),
                    F.coalesce(marks[number], F.lit(0)).cast("long").alias("n_dropped"),
                    marks[keep].alias("keep_bitmap")))


def kept_text(text: Column, bitmap: Column) -> Column:
    """The text without its dropped lines."""
    gap = lambda w, i: w["word"] - F.when(i == 0, F.lit(-1)).otherwise(
        F.get(bitmap, i - 1)["word"]) - 1
    dense = F.flatten(F.transform(bitmap, lambda w, i: F.concat(
        F.array_repeat(F.lit(-1).cast("long"), gap(w, i)), F.array(w["keep"]))))
    lines = text_lines(text)
    bit = lambda d, i: F.getbit(F.get(d, F.floor(i / 64).cast("int")), (i % 64).cast("int"))
    # the bitmap is bound once by the outer transform, not rebuilt for each line
    kept = F.transform(F.array(dense), lambda d: F.filter(
        lines, lambda line, i: F.coalesce(bit(d, i), F.lit(1)) == 1))
    return F.when(bitmap.isNull(), F.coalesce(text, F.lit(""))).otherwise(
        F.array_join(F.get(kept, F.lit(0)), "\n"))
