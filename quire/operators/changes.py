"""Change log between two snapshots (I22) and the audit listing.

The application writes audit rows from inside its procedures; here the log
is derived by comparing the snapshot before a job with the one after it:
one full outer join on the key, a presence marker per side, and a null-safe
comparison per column.  The join is a single shuffle on the key for both
snapshots; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_changes(before: DataFrame, after: DataFrame, key: str,
                     columns: list[str] | None = None) -> DataFrame:
    """Rows of kind INSERT / DELETE / UPDATE with the names of the changed
    columns (comma separated, in column order) for updates and the changed
    fields as JSON."""
    cols = columns or [c for c in before.columns if c != key]
    b = before.select(key, *[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_in_b"))
    a = after.select(key, *[F.col(c).alias(f"_a_{c}") for c in cols], F.lit(True).alias("_in_a"))
    j = b.join(a, key, "full")
    changed = F.concat_ws(",", *[F.when(~F.col(f"_b_{c}").eqNullSafe(F.col(f"_a_{c}")), F.lit(c))
                                 for c in cols])
    kind = (F.when(F.col("_in_b").isNull(), F.lit("INSERT"))
            .when(F.col("_in_a").isNull(), F.lit("DELETE")).otherwise(F.lit("UPDATE")))
    # details: {column: value as text} — the changed columns with their new
    # value for an update, every column for an insert (new values) or a
    # delete (old values)
    entries = []
    for c in cols:
        take = (kind != "UPDATE") | ~F.col(f"_b_{c}").eqNullSafe(F.col(f"_a_{c}"))
        value = F.when(kind == "DELETE", F.col(f"_b_{c}").cast("string")) \
            .otherwise(F.col(f"_a_{c}").cast("string"))
        entries.append(F.when(take, F.struct(F.lit(c).alias("k"), value.alias("v"))))
    details = F.to_json(F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    return (j.select(key, kind.alias("change"),
                     F.when(kind == "UPDATE", changed).alias("changed_columns"),
                     details.alias("details_json"))
            .filter((F.col("change") != "UPDATE") | (F.col("changed_columns") != "")))


def view_logs(audit_log: DataFrame, n: int | None = None, action: str | None = None) -> DataFrame:
    """Audit rows, newest first (ties by id); optionally of one action (a
    pushed-down filter) or the first n (TakeOrderedAndProject)."""
    df = audit_log if action is None else audit_log.filter(F.col("action") == action)
    df = df.orderBy(F.col("ts").desc_nulls_last(), F.col("log_id").desc())
    return df if n is None else df.limit(n)
