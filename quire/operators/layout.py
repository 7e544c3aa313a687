"""Access paths and statistics.

The application compared category lookups with and without a B-tree index.
On Spark the access path is the file layout: a catalogue written
``partitionBy("category")`` lets an equality lookup read only that
category's folder (``PartitionFilters`` in the plan), and sorting by author
inside the files gives Parquet min/max row-group skipping for author
lookups.  Optimizer statistics become a column profile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.combine import stack_rows


def write_category_layout(books: DataFrame, path: str, n_files_per_category: int | None = None
                          ) -> None:
    """Partition by category; within files sort by author.  By default rows
    are rebalanced on category: a category's rows come together (not one small
    file per task and category), AQE merges small categories into a task and
    splits a hot one at the advisory partition size.  ``n_files_per_category``
    hashes rows by (category, author) into that many tasks instead."""
    if n_files_per_category:
        df = books.repartition(n_files_per_category, "category", "author")
    else:
        df = books.hint("rebalance", "category")
    (df.sortWithinPartitions("category", "author")
       .write.mode("errorifexists").partitionBy("category").parquet(path))


def lookup_category(spark: SparkSession, path: str, category: str,
                    columns: tuple[str, ...] = ("title",)) -> DataFrame:
    """Pruned read: only the folder of ``category`` is listed and scanned."""
    return (spark.read.parquet(path).filter(F.col("category") == category)
            .select(*columns))


# -- access paths by author, isbn and id -----------------------------------------------------

#: Rows of a Parquet row group are bounded by bytes; a page index and a Bloom
#: filter per row group decide whether a lookup reads it.
LOOKUP_BLOCK = 16 * 1024 * 1024
BLOOM_COLUMNS = ("isbn", "book_id", "title")
_BLOOM_FPP = 0.01


def write_lookup_layout(books: DataFrame, path: str, bloom_columns: tuple[str, ...] = BLOOM_COLUMNS,
                        values_per_group: int = 200_000, block_bytes: int = LOOKUP_BLOCK) -> None:
    """The catalogue laid out for lookups of single values.

    Range partitioned and sorted by author: an author's rows are neighbours, so
    minima and maxima of row groups (and of pages) leave one or two to read.
    ``bloom_columns`` (isbn, id, title) lie in no order there, so each row
    group carries a Bloom filter of them: a lookup reads the groups that may hold
    the value, about one in a hundred of the others.  A filter of
    ``values_per_group`` distinct values takes about 1.2 bytes each.  An author
    with a large part of all rows is split by the id in the sort key."""
    w = (books.repartitionByRange(F.col("author"), F.col("book_id")).sortWithinPartitions("author", "book_id")
         .write.mode("errorifexists").option("parquet.block.size", block_bytes))
    for c in bloom_columns:
        w = (w.option(f"parquet.bloom.filter.enabled#{c}", "true")
             .option(f"parquet.bloom.filter.expected.ndv#{c}", values_per_group)
             .option(f"parquet.bloom.filter.fpp#{c}", _BLOOM_FPP))
    w.parquet(path)


def lookup_value(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """Rows with ``column`` = ``value``: the filter reaches the Parquet reader,
    which skips row groups by statistics, dictionaries and Bloom filters."""
    return spark.read.parquet(path).filter(F.col(column) == F.lit(value))


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: rows, NULLs, min, max (as text) and distinct
    values.  Counts, minima and maxima come from one aggregate pass;
    ``exact=False`` adds HyperLogLog distinct counts to it.  Exact ones come from
    ``distinct_counts``."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in df.columns:
        aggs += [F.count(F.col(c)).alias(f"{c}__nn"),
                 F.min(F.col(c)).cast("string").alias(f"{c}__min"),
                 F.max(F.col(c)).cast("string").alias(f"{c}__max")]
        if not exact:
            aggs.append(F.approx_count_distinct(F.col(c)).alias(f"{c}__nd"))
    one = df.agg(*aggs)
    specs = [(c, [F.col("_n").cast("long"), (F.col("_n") - F.col(f"{c}__nn")).cast("long"),
                  F.col(f"{c}__min"), F.col(f"{c}__max"),
                  (F.lit(None) if exact else F.col(f"{c}__nd")).cast("long")])
             for c in df.columns]
    out = stack_rows(one, "column_name", specs, ["n_rows", "n_nulls", "min_value", "max_value", "n_distinct"])
    if not exact:
        return out
    counts = distinct_counts(df)
    return (out.drop("n_distinct").join(counts, "column_name", "left")
            .select("column_name", "n_rows", "n_nulls", "min_value", "max_value",
                    F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct")))


def distinct_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_distinct): exact numbers of distinct non-NULL values.

    Every row is unpivoted to (column, value) pairs and these are reduced in two
    aggregates, by (column, value) and by column.  ``count_distinct`` of many
    columns would expand each row to one whole copy per column; a pair carries
    its own value only, and repeated values end in the map-side aggregate.
    Values are compared as text, which tells the values of one type apart
    (binary as hexadecimal digits; nested ones as JSON)."""
    def text(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.when(F.col(f.name).isNotNull(), F.to_json(F.struct(F.col(f.name)), {"ignoreNullFields": "false"}))
        return F.hex(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name).cast("string")

    pairs = stack_rows(df, "column_name", [(f.name, [text(f)]) for f in df.schema.fields], ["value"])
    return (pairs.filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.lit(1).alias("_one"))
            .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct")))


# -- sketches that merge over versions --------------------------------------------------------

#: log2 of the sketch's registers: 4096 give a standard error of 1.6 %.
SKETCH_BITS = 12


def column_sketches(df: DataFrame) -> DataFrame:
    """One mergeable row per column: n_rows, n_nulls and a HyperLogLog sketch
    of its values (as text).  Stored beside a version, sketches of added rows
    merge with those of the versions before without reading these again."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in df.columns:
        aggs += [F.count(F.col(c)).alias(f"{c}__nn"),
                 F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias(f"{c}__hll")]
    specs = [(c, [F.col("_n").cast("long"), (F.col("_n") - F.col(f"{c}__nn")).cast("long"), F.col(f"{c}__hll")])
             for c in df.columns]
    return stack_rows(df.agg(*aggs), "column_name", specs, ["n_rows", "n_nulls", "sketch"])


def merged_sketches(parts: DataFrame) -> DataFrame:
    """Sketch rows of several versions (or parts of a table) as one set."""
    return parts.groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
                                            F.hll_union_agg("sketch").alias("sketch"))


def sketched_profile(sketches: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_nulls, n_distinct) with estimated distincts."""
    return sketches.select("column_name", "n_rows", "n_nulls", F.hll_sketch_estimate("sketch").alias("n_distinct"))
