"""Sales sums kept up to date over versions of the line table.

Per book the rollup holds counts and sums of its lines; both add up, so a version
of the line table is covered by the sums of the version before plus a signed
delta: what its job's new lines add and what the removed ones take away.  A delta
reads only the lines that the job touched.  Deltas are published beside the line
table's versions; ``current`` adds up those of the versions asked for (a handful
of rows per book), and ``compact`` replaces them by one.

Sums of nothing are NULL and counts of nothing 0, as in the full aggregates: the
counts of non-NULL values are carried for that.  A book that a third of all lines
belong to is one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.joins import restrict_to
from ..sources import snapshot_store as store

#: Counts and sums over all lines, and over those that belong to an order.
SUMS = ("n_lines", "n_qty", "qty", "n_amount", "amount", "sold_lines", "sold_n_qty", "sold_qty", "sold_n_amount",
        "sold_amount")


def _sums(lines: DataFrame) -> list[Column]:
    qty = F.col("qty").cast("long")
    amount = (F.col("qty") * F.col("price")).cast(S.MONEY_SUM)
    out = []
    for prefix, among in (("", F.lit(True)), ("sold_", F.col("order_id").isNotNull())):
        out += [F.sum(among.cast("long")).alias("sold_lines" if prefix else "n_lines")]
        for value, name in ((qty, "qty"), (amount, "amount")):
            out += [F.sum((among & value.isNotNull()).cast("long")).alias(f"{prefix}n_{name}"),
                    F.coalesce(F.sum(F.when(among, value)), F.lit(0)).cast(value_type(name)).alias(prefix + name)]
    return out


def value_type(name: str):
    return "long" if name.endswith("qty") else S.MONEY_SUM


def book_sums(lines: DataFrame) -> DataFrame:
    """(book_id, sums) of some lines."""
    return lines.groupBy("book_id").agg(*_sums(lines)).select("book_id", *SUMS)


def _added(parts: DataFrame) -> DataFrame:
    def total(c: str) -> Column:
        return F.sum(c).cast(S.MONEY_SUM if c.endswith("amount") and not c.endswith("n_amount") else "long").alias(c)
    return parts.groupBy("book_id").agg(*[total(c) for c in SUMS])


def negative(sums: DataFrame) -> DataFrame:
    return sums.select("book_id", *[(-F.col(c)).alias(c) for c in SUMS])


def delta(added: DataFrame | None, removed: DataFrame | None) -> DataFrame:
    """Signed sums of a job that adds some lines and removes others."""
    parts = ([book_sums(added)] if added is not None else []) + ([negative(book_sums(removed))] if removed is not None else [])
    return parts[0] if len(parts) == 1 else _added(parts[0].unionByName(parts[1]))


def order_delta(before: DataFrame, after: DataFrame, touched: DataFrame) -> DataFrame:
    """Signed sums of a job that changed lines of the orders ``touched``:
    their lines after less their lines before.  A changed line counts as removed
    and added."""
    return delta(restrict_to(after, touched, "order_id"), restrict_to(before, touched, "order_id"))


# -- versions --------------------------------------------------------------------------------

def publish(sums: DataFrame, root: str, version: int) -> None:
    """Publish the sums of version 1, or the delta that leads to ``version``."""
    store.publish(sums, f"{root}/sales", version)


def current(spark: SparkSession, root: str, versions: range) -> DataFrame:
    """Sums per book that cover the last of ``versions`` (the first is a full
    one or a compacted one); books without lines are left out."""
    parts = spark.read.parquet(*[store.version_path(f"{root}/sales", v) for v in versions])
    return _added(parts.select("book_id", *SUMS)).filter(F.col("n_lines") > 0)


def compact(spark: SparkSession, root: str, versions: range, to_root: str) -> None:
    """The same coverage as one version under another root."""
    publish(current(spark, root, versions), to_root, versions[-1])


# -- reports ---------------------------------------------------------------------------------

def _or_null(count: str, value: str) -> Column:
    return F.when(F.col(count) > 0, F.col(value))


def sales_by_title(sums: DataFrame, books: DataFrame) -> DataFrame:
    """D4 from the sums."""
    named = sums.join(books.select("book_id", "title"), "book_id")
    return (named.groupBy("title").agg(F.sum(_or_null("n_qty", "qty")).cast("long").alias("qty"),
                                       F.sum(_or_null("n_amount", "amount")).cast(S.MONEY_SUM).alias("revenue"))
            .orderBy(F.col("qty").desc_nulls_first(), F.col("title").asc_nulls_last()))


def popular_products(sums: DataFrame, books: DataFrame, limit: int) -> DataFrame:
    """I1 from the sums."""
    sold = sums.filter(F.col("sold_lines") > 0).select(
        "book_id", _or_null("sold_n_qty", "sold_qty").alias("qty"), _or_null("sold_n_amount", "sold_amount").alias("revenue"))
    return (sold.join(books.select("book_id", "title", "author"), "book_id")
            .select("book_id", "title", "author", "qty", "revenue")
            .orderBy(F.col("qty").desc_nulls_last(), F.col("revenue").desc_nulls_last(), F.col("book_id").asc())
            .limit(limit))


def items_sold(sums: DataFrame) -> DataFrame:
    """The line count of I2 from the sums."""
    return sums.agg(F.coalesce(F.sum("sold_qty"), F.lit(0)).cast("long").alias("items_sold"))
