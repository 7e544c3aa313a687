"""Exact dedup by a tree merge of sorted digest runs (DataFrame functions only).

Every partition makes one run: its distinct digests, sorted, each with the
smallest row that has it and the number of its rows.  Runs meet in binomial
rounds: in every round ``FAN_IN`` neighbouring runs become one, merged on the
digest (Spark sorts both by it: the minimum of a struct aggregates by sort),
keeping the smallest identifier and the sum of counts.  A digest is only
merged with its equal when an independent 64-bit hash and the byte length
agree too, so the identifier that survives a level is verified there.

Because a run holds a digest once, a group that holds a third of all rows is
one row per run from the first level on.  The answer goes back the same way:
root to runs on the digest, runs to rows on (run, digest), so the rows of a
hot group meet it spread over all runs.

Defined results: null text counts as empty; texts are equal when equal after
each white-space run became one space (nothing is trimmed); rows with a null
id come after all others; of rows with the same id and text (repeated rows)
exactly one stays; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, numbered_table, rows_first, shared_table

#: Runs merged into one per round.
FAN_IN = 16

_KEY = ["digest", "check", "n_bytes"]


def normalised(text_col: str):
    return F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), SPACE, " ")


def digest_rows(docs: DataFrame, id_col: str, text_col: str, row_col: str | None = None) -> DataFrame:
    """(run, row, id, digest, check, n_bytes) of every row, written once."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    norm = docs.select(F.col(id_col).alias("id"), row.alias("row"), F.spark_partition_id().alias("run"),
                       normalised(text_col).alias("t"))
    return shared_table(norm.select("run", "row", "id", F.unhex(F.sha2("t", 256)).alias("digest"),
                                    F.xxhash64("t").alias("check"),
                                    F.octet_length("t").cast("long").alias("n_bytes")), "digests")


def make_runs(rows: DataFrame) -> DataFrame:
    """One sorted run per input partition."""
    return rows.groupBy("run", *_KEY).agg(F.min(rows_first(F.col("id"), F.col("row"))).alias("best"),
                                          F.count(F.lit(1)).alias("n"))


def tree_merge(runs: DataFrame, n_runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """Merge rounds until one run is left: (digest, check, n_bytes, best, n)."""
    level = runs
    while n_runs > 1:
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
                 .groupBy("run", *_KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n")))
        n_runs = -(-n_runs // fan_in)
    return level.drop("run")


def group_rows(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """rows -> (row, id, digest, best struct<no_id,id,row>, group_size)."""
    last = rows.agg(F.max("run").alias("m")).first()["m"]      # one scalar
    runs = make_runs(rows)
    root = tree_merge(runs, 0 if last is None else int(last) + 1, fan_in)
    down = runs.select("run", *_KEY).join(
        root.select(*_KEY, "best", F.col("n").alias("group_size")), _KEY)
    return (rows.join(down, ["run", *_KEY])
            .select("row", "id", "digest", "best", "group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    g = group_rows(digest_rows(docs, id_col, text_col))
    return g.select(F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
                    (F.col("best.row") == F.col("row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies: all columns of the rows that stay."""
    base, row = numbered_table(docs, "dedup-docs")
    g = group_rows(digest_rows(base, id_col, text_col, row))
    stay = g.where(F.col("best.row") == F.col("row")).select(F.col("row").alias(row))
    return base.join(stay, row, "left_semi").select(*docs.columns)
