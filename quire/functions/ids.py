"""Generated keys (GENERATED BY DEFAULT AS IDENTITY) for new rows.

``assign_ids`` gives the rows of a DataFrame consecutive ids
``base + 1 .. base + n`` in the order of ``order_cols``.  The result equals
``row_number() OVER (ORDER BY order_cols) + base`` but never moves all rows
into one task:

1. ``orderBy`` range-partitions and sorts the rows (a sample-based split, so
   partitions are balanced when the order key is unique); the input is kept
   (memory and disk) for the sampling and sorting passes;
2. the sorted rows are checkpointed, so the counting pass and the numbering
   pass see the same partitions even if executors are lost and tasks re-run;
3. one count per partition is collected (bounded by the partition count) and
   turned into prefix offsets on the driver, which go back as a broadcast
   table of one row per partition;
4. each row's id = base + offset(partition) + position inside the partition,
   where the position comes from ``monotonically_increasing_id`` (partition
   index in the upper bits, row position in the lower 33 bits).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_POS_BITS = 33


def max_id(df: DataFrame, col: str) -> int:
    """Largest existing id, 0 for an empty table (one scalar to the driver)."""
    v = df.agg(F.max(F.col(col)).alias("m")).first()["m"]
    return int(v) if v is not None else 0


def max_ids(pairs: list[tuple[DataFrame, str]]) -> list[int]:
    """Largest existing id of several tables in one job (0 for an empty
    table)."""
    from .combine import one_row
    row = one_row({f"m{i}": t.agg(F.max(F.col(c)).cast("long").alias(f"m{i}"))
                   for i, (t, c) in enumerate(pairs)}).first()
    return [int(row[f"m{i}"]) if row[f"m{i}"] is not None else 0 for i in range(len(pairs))]


def assign_ids(df: DataFrame, order_cols: list, id_col: str, base: int = 0,
               base_from: tuple[DataFrame, str] | None = None) -> DataFrame:
    """``base_from=(table, column)`` starts the ids after that column's
    maximum; it is computed in the same job as the partition counts."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    # the range sort reads its input twice (a sampling job for the range
    # bounds, then the sort): keep the input for the two passes instead of
    # evaluating its plan twice.  A lost cached block is recomputed from
    # lineage; the checkpoint below is what fixes the partitions.
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stable = src.orderBy(*order).checkpoint(eager=True)
    finally:
        src.unpersist()

    stats = (stable.groupBy(F.spark_partition_id().alias("pid"))
             .agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("m")))
    if base_from is not None:
        table, col = base_from
        stats = stats.unionByName(table.agg(F.lit(-1).alias("pid"), F.lit(0).cast("long").alias("n"),
                                            F.max(F.col(col)).cast("long").alias("m")))
    counts = {}
    for r in stats.collect():           # one row per partition, plus the maximum
        if r["pid"] == -1:
            base = int(r["m"]) if r["m"] is not None else 0
        else:
            counts[r["pid"]] = r["n"]
    # partitions without a count have no rows, so offsets up to the last
    # non-empty partition suffice
    n_parts = max(counts) + 1 if counts else 0
    offsets, running = [], 0
    for p in range(n_parts):
        offsets.append(running)
        running += counts.get(p, 0)
    if not offsets:
        offsets = [0]

    # one row per partition: a size bound by construction, so broadcast it
    # (a literal array in the projection would ship with every task)
    off = spark.createDataFrame([(p, o) for p, o in enumerate(offsets)], "_pid int, _off long")
    tagged = stable.withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", _POS_BITS).cast("int"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _POS_BITS)
    new_id: Column = (F.lit(base) + F.col("_off") + pos + F.lit(1)).cast("long")
    return (tagged.join(F.broadcast(off), "_pid")
            .withColumn(id_col, new_id).drop("_mid", "_pid", "_off"))
