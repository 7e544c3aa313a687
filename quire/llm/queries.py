"""Registered queries of the operators and their DuckDB SQL.

Every query applies its operator with production parameters to the whole of
its table.  SQL is given where it can say the same thing and run on whole
tables; the other queries are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, hard_negatives, interpolation, mixing, packing, quality, resampling, simhash_dedup
from . import substring_dedup, token_files, topk, toxicity, url_filter

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_groups(table(spark, sf_dir, "documents"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(vectors, vec_id % 50 == 0)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.lm_scores(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_substring_dedup, op3_simhash_dedup, op4_topk_search, op5_exact_dedup,
                            op6_toxicity, op7_quality, op8_packing, op9_mixing, op10_token_files,
                            op11_hard_negatives, op12_resampling, op13_lm_scoring)}

# Java's [\x20\x09-\x0D] in RE2 notation
_SPACE = r"[\x20\x09-\x0D]+"

ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": rf"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS words
  FROM documents),
g AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 11, 1))) AS p FROM w),
h AS (SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS gram FROM g),
later AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY gram) < doc_id AS dup FROM h),
gone AS (SELECT doc_id, list(DISTINCT q) AS places
         FROM (SELECT doc_id, unnest(range(p, p + 13)) AS q FROM later WHERE dup) GROUP BY doc_id),
kept AS (SELECT w.doc_id, words, coalesce(places, []) AS places FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(places, i)), ' ')) AS kept_sha256
FROM kept
""",
    "op4_topk_search": """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings),
d AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.bits, c.bits), lambda z: CAST(z[1] <> z[2] AS INTEGER))) AS INTEGER)
               AS distance
      FROM c q, c WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
""",
    "op5_exact_dedup": rf"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
""",
    "op12_resampling": r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
lowered AS (
  SELECT 'd' AS kind, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  FROM benchmark),
features AS (
  SELECT kind, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM lowered),
per_text AS (SELECT kind, doc_id, w, count(*) AS n FROM features GROUP BY ALL),
named AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(hex(w)) // 2),
              lambda i: CAST('0x' || substr(hex(w), 2 * i + 1, 2) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM per_text), crc),
buckets AS (
  SELECT bucket, sum(CASE WHEN kind = 'd' THEN n ELSE 0 END) AS s, sum(CASE WHEN kind = 'b' THEN n ELSE 0 END) AS t
  FROM per_text JOIN named USING (w) GROUP BY bucket),
sums AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM buckets),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(all_s + 10000 AS DOUBLE))
                                      / (CAST(s + 1 AS DOUBLE) * CAST(all_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM buckets, sums),
weights AS (
  SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight
  FROM per_text JOIN named USING (w) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)),
able AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored LEFT JOIN able USING (doc_id)
""",
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, "pipeline": pipeline}


def oracles() -> dict[str, str]:
    import corpus_pipeline
    more = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**ORACLE_SQL, **more}
