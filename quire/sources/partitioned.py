"""Tables that are changed partition by partition.

``snapshot_store`` publishes a whole new version for every change.  A table
published here is partitioned (the catalogue by category) and registered in the
session's catalog; a job writes the partitions that it touches, with dynamic
partition overwrite, and the files of all others stay as they are.  A change of
one category costs that category, whatever the size of the catalogue.

The overwrite stages its files and swaps whole partitions when the job commits.
A partition that a rename leaves empty is dropped from the catalog; being an
external table's, its files stay on disk, out of every reader's sight, until the
table is next published whole.  Readers see the table through the catalog.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import restrict_to


_MODE = "spark.sql.sources.partitionOverwriteMode"


def publish_partitioned(df: DataFrame, table: str, path: str, by: str) -> DataFrame:
    """Publish ``df`` as catalog table ``table`` at ``path``, a folder per
    value of ``by`` (rebalanced on it, so that a value is not a file per task)."""
    (df.hint("rebalance", by).write.mode("errorifexists").partitionBy(by).option("path", path).format("parquet")
     .saveAsTable(table))
    return df.sparkSession.table(table)


def _overwrite(rows: DataFrame, table: str, by: str) -> None:
    """Replace the partitions that ``rows`` has."""
    spark = rows.sparkSession
    # as a write option the mode comes too late for the check that the table is not being read
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        rows.select(*spark.table(table).columns).hint("rebalance", by).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(_MODE, before)


def rename_values(spark: SparkSession, table: str, by: str, mapping: dict[str, str]) -> DataFrame:
    """UPDATE table SET by = new WHERE by = old, for a small literal
    mapping.  Reads and writes the partitions of the old and the new values
    only; all renames happen at once (a name may be old in one pair and new in
    another)."""
    moves = {o: n for o, n in mapping.items() if o != n}
    if not moves:
        return spark.table(table)
    touched = spark.table(table).filter(F.col(by).isin(*sorted({*moves, *moves.values()})))
    case: Column | None = None
    for o, n in moves.items():
        case = F.when(F.col(by) == o, F.lit(n)) if case is None else case.when(F.col(by) == o, F.lit(n))
    _overwrite(touched.withColumn(by, case.otherwise(F.col(by))), table, by)
    for gone in sorted(set(moves) - set(moves.values())):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({by} = :gone)", args={"gone": gone})
    return spark.table(table)


def update_rows(spark: SparkSession, table: str, by: str, key: str, changes: DataFrame,
                apply: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """rewrite the partitions that hold a changed key.  ``changes`` has
    one row per ``key``; ``apply(rows, changes)`` gives the rows with the
    changes made, in the same partitions.  Which partitions these are is found
    by a semi join on the key column alone and meets the table as a join on
    ``by``, so the scan of the others is pruned at run time."""
    current = spark.table(table)
    touched = restrict_to(current.select(key, by), changes, key).select(by).distinct()
    rows = current.join(touched, by, "left_semi")
    _overwrite(apply(rows, changes), table, by)
    return spark.table(table)
