"""Importance resampling towards a target distribution (op12).

Method: array-scored weights, then parallel sorting by regular sampling.

1. Features are all runs of 1 to ``longest`` consecutive words of a text (A-Z
   lower-cased, words are runs of ASCII letters, digits and characters from
   U+0080 on), each hashed to one of ``buckets``.  One pass over the documents
   and one over the target texts count the buckets; a task sends one row per
   bucket it has met.
2. The counts give an array with one integer gain per bucket; a document's
   weight is the sum of its features' gains, looked up in that array.
3. score = weight + Gumbel noise from a digest of the id, so the documents with
   the highest scores are a draw without replacement in proportion to
   exp(weight / 1000).
4. Ranks are exact and come from ``regular_sampling``; no task or driver sees
   all documents.

A null text has no features (weight 0).  Documents with fewer than
``least_words`` words are scored but never drawn.  A null id draws its noise as
the empty text does and loses ties; repeated rows have the same score and
follow each other in rank.  An empty document or target table is fine: every
gain then compares with smoothed counts.  A very long text is worked on whole,
as a batch of its own (``words``).  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_view, shared_table, text_slices, utf8
from .regular_sampling import ranked
from .words import ALPHANUMERIC, LOWER, counts_per_text, number, split

BUCKETS, LONGEST, SEED = 10_000, 1, 2024
LEAST_WORDS, PERCENT = 20, 10


def features(data: np.ndarray, offsets: np.ndarray, buckets: int, longest: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, its text, number of words of each text)."""
    data = LOWER[data]
    start, end, packed = split(data, offsets, ALPHANUMERIC)
    per_text = counts_per_text(start, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), per_text)
    code, distinct = number(start, end, packed)
    names = distinct.to_pylist()
    bucket = np.array([zlib.crc32(w) % buckets for w in names], np.int64)
    out, texts = [bucket[code]], [text]
    for n in range(2, longest + 1):
        at = np.flatnonzero(text[:len(text) - n + 1] == text[n - 1:]) if len(text) >= n else np.zeros(0, np.int64)
        runs, back = np.unique(np.stack([code[at + k] for k in range(n)], axis=1), axis=0, return_inverse=True)
        named = np.array([zlib.crc32(b" ".join(names[c] for c in r)) % buckets for r in runs.tolist()], np.int64)
        out.append(named[back.reshape(-1)] if len(at) else at)
        texts.append(text[at])
    return np.concatenate(out), np.concatenate(texts), per_text


def bucket_counts(texts: DataFrame, text_col: str, buckets: int, longest: int) -> np.ndarray:
    """Features of all texts per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                bucket, _, _ = features(*byte_view(part.column("text")), buckets, longest)
                total += np.bincount(bucket, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["bucket", "n"])

    rows = (texts.select(utf8(text_col).alias("text")).mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())          # at most `buckets` rows
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole gain of each bucket: 1000 times the log ratio of smoothed shares."""
    n = len(source)
    s, t = source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, longest: int) -> DataFrame:
    """(id, n_words, n_features, weight) of every document."""
    src = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                bucket, text, words = features(*byte_view(part.column("text")), len(gain), longest)
                n = part.num_rows
                weight = np.bincount(text, gain[bucket], minlength=n)         # whole numbers, exact in doubles
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(words), pa.array(np.bincount(text, minlength=n)),
                     pa.array(weight.astype(np.int64))], names=["id", "n_words", "n_features", "weight"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED, ranges: int | None = None) -> DataFrame:
    """One row per document: id, n_features, weight, score, rank.  ``rank`` is
    1, 2, .. for the drawn ones, ``percent`` of the documents with at least
    ``least_words`` words, and null for the others."""
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_text_col, buckets, longest))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = shared_table(weights(docs, gain, id_col, text_col, longest).withColumn("score", F.col("weight") + noise)
                          .withColumn("row", F.monotonically_increasing_id()), "scored")
    able = F.col("n_words") >= least_words
    drawn = scored.where(able).count() * percent // 100
    placed = ranked(scored.where(able), "score", "id", "row", "rank", ranges)
    kept = ["id", "n_features", "weight", "score"]
    out = (placed.select(*kept, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
           .unionByName(scored.where(~able).select(*kept, F.lit(None).cast("long").alias("rank"))))
    return out.withColumnRenamed("id", id_col)
