"""Registered queries ``opN_<name>`` over the whole ``documents`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.llm import (
    decontam, exact_dedup, hard_negatives, langid, line_dedup, lm, merkle, mixing, ngram_join, sharding, simhash, token_counts,
    toxicity,
)
from kpiforge.llm.text import documents, ship


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(documents(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.copies(mixing.word_sizes(documents(spark, sf_dir)))
    return (taken.withColumn("__row", F.explode(F.array_repeat(F.lit(0), F.col("__rows").cast("int"))))
            .select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"), "source_size", "target",
                    (F.col("copies") * F.col("__size")).cast("long").alias("taken"), "copies"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(documents(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.prefix_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                      with_store=False)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    marked = line_dedup.keep_bitmap(docs)
    kept = line_dedup.kept_text(F.col("text"), F.col("keep_bitmap"))
    return marked.select("doc_id", F.size(line_dedup.text_lines(F.col("text"))).cast("long").alias("n_lines"),
                         "n_dropped", F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.class_scores(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    proven = merkle.manifest(docs, carry={"altered": merkle.without_newlines(docs)})
    folded = merkle.fold(F.col("altered"), F.col("proof"))
    return proven.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
                         folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, label=label)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _shipped(fn) for name, fn in {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_language": op3_language,
    "op4_ngram_join": op4_ngram_join,
    "op5_decontaminate": op5_decontaminate,
    "op6_mix": op6_mix,
    "op7_shards": op7_shards,
    "op8_token_counts": op8_token_counts,
    "op9_line_dedup": op9_line_dedup,
    "op10_class_lm": op10_class_lm,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_simhash": op13_simhash,
}.items()}

# DuckDB SQL of the queries that SQL can express on whole tables
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": f"""
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM t JOIN g USING (t)""",
    # links by shared shingles, and what each document reaches
    "op4_ngram_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'),
                                       lambda x: x <> '') AS w
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, i, i + 3), ' ') END AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
        FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)""",
    "op9_line_dedup": f"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
            FROM documents),
        k AS (
            SELECT doc_id, pos, line,
                   translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             '{_UPPER}', '{_LOWER}') AS key
            FROM l),
        f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key),
        m AS (SELECT k.*, coalesce(k.doc_id > f.first_doc, false) AS dropped FROM k LEFT JOIN f USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM m GROUP BY doc_id""",
    # trees level by level; a step of a proof is its left and its right siblings, apart by a comma
    "op11_merkle_manifest": r"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS rid, doc_id, source, text,
                   concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                             coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
                   list_reduce(list_prepend(4294967295, [ord(x) FOR x IN string_split(doc_id::VARCHAR, '')]),
                               lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                                   lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS crc
            FROM documents),
        e AS (SELECT rid, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                     CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS altered, head FROM d),
        l AS (SELECT rid, doc_id, source, leaf, sha256(head || coalesce(strlen(altered) || ':' || altered, '-')) AS altered,
                     row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM e),
        t AS (
            SELECT source, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM l
            UNION ALL
            SELECT source, level + 1, p, digest, count(*) OVER (PARTITION BY source)
            FROM (SELECT source, level, pos // 3 AS p, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
                  FROM t WHERE n > 1 GROUP BY source, level, pos // 3)),
        s AS (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM t WHERE n = 1),
        u AS (
            SELECT 0 AS level, pos, digest, count(*) OVER () AS n FROM s
            UNION ALL
            SELECT level + 1, p, digest, count(*) OVER ()
            FROM (SELECT level, pos // 3 AS p, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
                  FROM u WHERE n > 1 GROUP BY level, pos // 3)),
        tr AS (SELECT source, level, pos // 3 AS run, list(digest ORDER BY pos) AS nodes FROM t WHERE n > 1 GROUP BY ALL),
        ur AS (SELECT level, pos // 3 AS run, list(digest ORDER BY pos) AS nodes FROM u WHERE n > 1 GROUP BY ALL),
        way AS (
            SELECT rid, level, nodes, (l.pos // (3 ** level)::BIGINT % 3)::INTEGER + 1 AS place
            FROM l JOIN tr ON l.source IS NOT DISTINCT FROM tr.source AND tr.run = l.pos // (3 ** (level + 1))::BIGINT
            UNION ALL
            SELECT rid, 1000 + level, nodes, (s.pos // (3 ** level)::BIGINT % 3)::INTEGER + 1
            FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source JOIN ur ON ur.run = s.pos // (3 ** (level + 1))::BIGINT),
        proof AS (
            SELECT rid, list(array_to_string(list_slice(nodes, 1, place - 1), '') || ',' || array_to_string(list_slice(nodes, place + 1, 3), '') ORDER BY level) AS steps
            FROM way GROUP BY rid),
        f AS (
            SELECT doc_id, leaf, s.digest AS subroot, (SELECT digest FROM u WHERE n = 1) AS root,
                   sha256(replace(array_to_string(coalesce(steps, []), ''), ',', '')) AS proof_sha256,
                   list_reduce(list_prepend(altered, coalesce(steps, [])),
                               lambda a, w: sha256(split_part(w, ',', 1) || a || split_part(w, ',', 2))) AS folded_root
            FROM l JOIN s ON l.source IS NOT DISTINCT FROM s.source LEFT JOIN proof USING (rid))
        SELECT *, folded_root = root AS verified FROM f""",
    "op12_hard_negatives": """
        WITH r AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   list_dot_product(a.q, b.q)::BIGINT AS score
            FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
               other_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 5""",
}
