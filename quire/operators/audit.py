"""Audit rows of a job, captured from its snapshots (I22, LOG_ACTION).

The application writes who changed which table, the action, the details as
JSON and the time, from inside each procedure.  Here the job's snapshots say what
changed, whatever the job was:

1. Digest first: each side of the table is reduced to (key, 128-bit digest of
   the row) and the sides are added up per key, so rows travel as 24 bytes and
   equal rows end there.  A partial aggregate runs before the shuffle; a key is
   in a table once, and one that (wrongly) repeats is reduced per map task.
2. Only changed keys go on: both tables are restricted to them (a semi join whose
   key side AQE broadcasts when it is small) and joined once for the details.
3. The log rows are numbered after the log's last number and appended: the log
   is the job's second output.

Details are one JSON object: the key, and under "values" for an update the
changed columns with their new values, for an insert all columns with theirs, for
a delete with the old ones; values as text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.ids import assign_ids
from ..functions.joins import restrict_to
from .changes import snapshot_changes


def row_digest(columns: list[str]) -> Column:
    """128 bits of all columns: NULLs, column borders and types told apart."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}).cast("binary"))


def changed_keys(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys whose rows differ between the two sides, or that one side lacks."""
    digest = row_digest(columns)

    def side(df: DataFrame, name: str, other: str) -> DataFrame:
        return df.select(key, digest.alias(name), F.lit(None).cast("string").alias(other))
    both = side(before, "_before", "_after").unionByName(side(after, "_after", "_before"))
    return (both.groupBy(key).agg(F.max("_before").alias("_before"), F.max("_after").alias("_after"))
            .filter(~F.col("_before").eqNullSafe(F.col("_after"))).select(key))


def captured_changes(before: DataFrame, after: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """``changes.snapshot_changes`` of the changed keys alone."""
    cols = columns or [c for c in before.columns if c != key]
    keys = changed_keys(before, after, key, cols)
    return snapshot_changes(restrict_to(before, keys, key), restrict_to(after, keys, key), key, cols)


@dataclass
class Logged:
    """``log``: the whole audit log; ``added``: its new rows."""
    log: DataFrame
    added: DataFrame


def log_action(audit_log: DataFrame, before: DataFrame, after: DataFrame, key: str, what_table: str, now: Column,
               who: str | Column = "admin", base: int | None = None) -> Logged:
    """Append one audit row per changed row of ``what_table``.  Numbers follow
    the log's last one (or ``base``, an identity's mark), in key order."""
    changes = captured_changes(before, after, key)
    actor = who if isinstance(who, Column) else F.lit(who)
    named = F.to_json(F.struct(F.col(key).alias(key)), {"ignoreNullFields": "false"})
    details = F.concat(F.regexp_replace(named, r"\}$", ""), F.lit(',"values":'), F.col("details_json"), F.lit("}"))
    order = [F.col(key), F.col("change")]
    numbered = (assign_ids(changes, order, "log_id", base_from=(audit_log, "log_id")) if base is None
                else assign_ids(changes, order, "log_id", base=base))
    added = numbered.select(F.col("log_id").cast("long"), actor.alias("who"), F.lit(what_table).alias("what_table"),
                            F.col("change").alias("action"), details.alias("details_json"), now.alias("ts"))
    added = added.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.AUDIT_SCHEMA.fields])
    return Logged(audit_log.select(*S.AUDIT_SCHEMA.fieldNames()).unionByName(added), added)
