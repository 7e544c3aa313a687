"""Lookups by author, isbn and id skip row groups."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quire.operators import layout
from quire.session import scratch_dir


@pytest.fixture(scope="module")
def laid_out(spark):
    """20,000 books, a third by one author, in many small row groups."""
    books = spark.range(20_000).select(
        F.col("id").alias("book_id"), F.concat(F.lit("isbn-"), F.sha1(F.col("id").cast("string"))).alias("isbn"),
        F.concat(F.lit("T"), F.col("id") * 7919 % 20_000).alias("title"),
        F.when(F.col("id") % 3 == 0, "Popular").otherwise(F.concat(F.lit("A"), F.col("id") % 500)).alias("author"))
    path = scratch_dir(spark, "t-lookup")
    layout.write_lookup_layout(books, path, values_per_group=500, block_bytes=32 * 1024)
    groups = sum(pq.ParquetFile(f).metadata.num_row_groups for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet"))
    return books, path, groups


def rows_scanned(df):
    """Rows that the scan gave out, whole row groups and pages skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_author_lookup_reads_neighbours_only(spark, laid_out):
    books, path, groups = laid_out
    found = layout.lookup_value(spark, path, "author", "A77")
    assert groups > 20
    assert sorted(r.book_id for r in found.collect()) == sorted(
        r.book_id for r in books.filter("author = 'A77'").collect())
    assert rows_scanned(found) < 20_000 / 5
    hot = layout.lookup_value(spark, path, "author", "Popular")
    assert hot.count() == 6667


@pytest.mark.parametrize("column, value", [("isbn", "sha"), ("title", "T7919"), ("book_id", 12_345)])
def test_value_lookup_skips_by_bloom_filter(spark, laid_out, column, value):
    books, path, groups = laid_out
    if value == "sha":
        value = books.filter("book_id = 12345").first().isbn
    found = layout.lookup_value(spark, path, column, value)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in books.filter(F.col(column) == value).collect()]
    assert rows_scanned(found) < 20_000 / 5


def test_unknown_values_read_nothing_much(spark, laid_out):
    _, path, _ = laid_out
    found = layout.lookup_value(spark, path, "isbn", "isbn-" + "5" * 40)
    assert found.count() == 0 and rows_scanned(found) < 20_000 / 5


def test_files_carry_bloom_filters(spark, laid_out):
    books, path, groups = laid_out
    plain = scratch_dir(spark, "t-plain")
    layout.write_lookup_layout(books, plain, bloom_columns=(), block_bytes=32 * 1024)

    def size(folder):
        return sum(os.path.getsize(f) for f in glob.glob(f"{folder.removeprefix('file:')}/*.parquet"))
    assert size(path) - size(plain) > groups * len(layout.BLOOM_COLUMNS) * 500        # about 1.2 bytes a value each
