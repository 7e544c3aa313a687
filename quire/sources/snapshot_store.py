"""Versioned snapshot storage (F10, SURVEY §7.4).

Plain Parquet has no UPDATE/DELETE and a path cannot be overwritten while a
job still reads it, so every job publishes its result to a new
``version=N`` folder under a table root and readers are handed that path.
A truncate is the publication of an empty DataFrame with the same schema.
Each publication is one atomic Spark write job (task commits + one job
commit), which replaces the application's periodic commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={int(version)}"


def publish(df: DataFrame, root: str, version: int, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as version ``version`` of the table at ``root``; an
    existing version is never overwritten (the write fails instead)."""
    path = version_path(root, version)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def truncate(df: DataFrame) -> DataFrame:
    """DELETE FROM t / TRUNCATE: an empty table with the same schema."""
    return df.sparkSession.createDataFrame([], df.schema)


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(version_path(root, version))


def publish_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> str:
    """Publish ``df`` as a catalog table bucketed and sorted by ``key`` with
    its files at ``path`` (shared storage).  Tables bucketed on the same key
    with the same bucket count join and aggregate on that key without a
    shuffle: orders and order_items by order_id serve every order report
    (totals, receipts, quantities) from co-located buckets."""
    (df.write.mode("errorifexists").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(table))
    return table
