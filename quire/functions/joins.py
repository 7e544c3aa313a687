"""Join helpers for request-driven lookups.

A request table (often small) is usually the *left* side of a LEFT OUTER,
SEMI or ANTI join against a large snapshot.  For those join types Spark can
only broadcast the right side, so without help the whole snapshot would be
shuffled to answer a few lookups.  ``restrict_to`` first streams the large
table against the request keys (large ⋉ keys): the keys are on the right,
AQE broadcasts them when their measured size is small, and only matching
rows of the large table continue.  When both sides are large the semi join
is a shuffle on the same key the following join uses, so that exchange is
shared rather than added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a large table that one task sorts, about.
ROWS_PER_TASK = 500_000


def restrict_to(big: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``big`` whose key value(s) occur in ``keys``."""
    cols = [on] if isinstance(on, str) else list(on)
    return big.join(keys.select(*cols), cols, "left_semi")


def parts_for(big: DataFrame, keys: DataFrame) -> int | None:
    """Partitions for joins of ``big`` with ``keys``, so that a task's rows do
    not grow with the tables; None where the session's own number does or the
    keys are few (``big`` is then streamed against them)."""
    if keys.limit(ROWS_PER_TASK + 1).count() <= ROWS_PER_TASK:
        return None
    parts = -(-big.count() // ROWS_PER_TASK)
    return parts if parts > int(big.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def dealt(df: DataFrame, key: str, parts: int | None) -> DataFrame:
    """``df`` in ``parts`` partitions by ``key`` (None: as it is).  All sides of
    a join on ``key`` need it, or Spark deals them anew."""
    return df.repartition(parts, key) if parts else df


def hashed(df: DataFrame, parts: int | None) -> DataFrame:
    """Build side of joins of dealt tables: one row per key, at most about
    ``ROWS_PER_TASK`` in a task, so a hash table needs less than two sorts."""
    return df.hint("shuffle_hash") if parts else df


def left_join_spread(df: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Left join whose rows without a key are spread over all tasks: they match
    nothing, but would all hash to one.  Both sides carry a hash of the key (a
    constant would be folded out of the join's keys), keyless rows one of the
    row."""
    part = F.when(F.col(on).isNull(), F.xxhash64(*[F.col(c) for c in df.columns])).otherwise(F.xxhash64(on))
    return (df.withColumn("_part", part)
            .join(lookup.withColumn("_part", F.xxhash64(on)), [on, "_part"], "left").drop("_part"))
