"""Reconciliation of published versions by a digest tree.

A version published here is dealt into buckets by a hash of its key (a folder
per bucket) and carries a digest per bucket, written beside it.  A digest is free
of row order and counts repeated rows: the number of rows and the sums of two 60
bit parts of each row's MD5 digest, so adding up partial sums is all it takes.

Two versions are compared leaf by leaf: first the digest rows (``buckets`` of
them, whatever the size of the table), and only where they differ the rows.  Equal
versions cost no scan of the tables at all; a change of a few keys costs their
buckets, since the others' folders are pruned from the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import row_digest
from . import snapshot_store as store

BUCKETS = 256
BUCKET = "_bucket"


def _part(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)")


def bucket_digests(df: DataFrame, columns: list[str]) -> DataFrame:
    """(_bucket, n, a, b) of a table that has the bucket column."""
    hashed = df.select(BUCKET, row_digest(columns).alias("d"))
    return hashed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.sum(_part(F.col("d"), 1)).alias("a"),
                                      F.sum(_part(F.col("d"), 16)).alias("b"))


def _digest_root(root: str) -> str:
    return f"{root.rstrip('/')}/digests"


def publish_digested(df: DataFrame, root: str, version: int, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Publish ``df`` in buckets of ``key`` with its digests; the version as
    readers see it (without the bucket column)."""
    dealt = df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    path = store.publish(dealt.hint("rebalance", BUCKET), root, version, partition_by=[BUCKET])
    written = df.sparkSession.read.parquet(path)
    bucket_digests(written, df.columns).coalesce(1).write.mode("errorifexists").parquet(
        store.version_path(_digest_root(root), version))
    return written.drop(BUCKET)


def unequal_buckets(spark: SparkSession, root: str, before: int, after: int) -> list[int]:
    """Buckets whose digests differ (at most as many as there are buckets)."""
    def digests(version: int, name: str) -> DataFrame:
        return store.read_version(spark, _digest_root(root), version).select(BUCKET, F.struct("n", "a", "b").alias(name))
    met = digests(before, "was").join(digests(after, "now"), BUCKET, "full")
    return sorted(r[0] for r in met.filter(~F.col("was").eqNullSafe(F.col("now"))).select(BUCKET).collect())


def differing_rows(spark: SparkSession, root: str, before: int, after: int) -> DataFrame:
    """Rows that one version has more often than the other: ``side`` (before
    or after), the table's columns, and ``copies``."""
    old, new = store.read_version(spark, root, before), store.read_version(spark, root, after)
    columns = [c for c in old.columns if c != BUCKET]
    opened = unequal_buckets(spark, root, before, after)

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.filter(F.col(BUCKET).isin(opened)).select(*columns, F.lit(sign).alias("_sign"))
    both = side(old, 1).unionByName(side(new, -1))
    left = both.groupBy(*columns).agg(F.sum("_sign").alias("_left")).filter(F.col("_left") != 0)
    return left.select(F.when(F.col("_left") > 0, F.lit("before")).otherwise(F.lit("after")).alias("side"), *columns,
                       F.abs("_left").alias("copies"))
