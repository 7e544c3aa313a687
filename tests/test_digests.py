"""Audit capture, reconciliation by digests, distinct counts and sketches."""

import json
import os

from pyspark.sql import functions as F

from quire import schemas as S
from quire.operators import audit, layout
from quire.operators.changes import snapshot_changes
from quire.session import scratch_dir
from quire.sources import reconcile
from quire.sources import snapshot_store as store


def now():
    return F.lit("2025-01-01 00:00:00").cast(S.TS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, rows):
    return spark.createDataFrame(rows, "k long, a string, b double")


def log(spark, rows=()):
    return spark.createDataFrame(list(rows), S.AUDIT_SCHEMA)


def test_captured_changes_equal_the_full_comparison(spark):
    before = table(spark, [(i, f"v{i % 5}", None if i % 7 == 0 else i / 2) for i in range(60)])
    after = table(spark, [(i, f"v{i % 5}" if i % 11 else None, None if i % 7 == 0 else i / 2 + (i == 9)) for i in range(5, 70)])
    got, want = audit.captured_changes(before, after, "k"), snapshot_changes(before, after, "k")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 15


def test_digest_tells_nulls_and_borders_apart(spark):
    rows = [(1, "ab", "c"), (2, "a", "bc"), (3, None, "x"), (4, "", "x"), (5, "null", "x")]
    df = spark.createDataFrame(rows, "k long, a string, b string")
    assert df.select(audit.row_digest(["a", "b"]).alias("d")).distinct().count() == 5


def test_log_action_appends_numbered_rows(spark):
    start = log(spark, [(4, "x", "t", "OLD", "{}", None)])
    a, b = table(spark, [(1, "p", 1.0), (2, "q", 2.0)]), table(spark, [(2, "r", 2.0), (3, None, 3.0)])
    res = audit.log_action(start, a, b, "k", "things", now(), who="ann")
    rows = {r.log_id: r for r in res.log.collect()}
    assert sorted(rows) == [4, 5, 6, 7] and {rows[i].who for i in (5, 6, 7)} == {"ann"}
    assert [rows[i].action for i in (5, 6, 7)] == ["DELETE", "UPDATE", "INSERT"]
    assert json.loads(rows[6].details_json) == {"k": 2, "values": {"a": "r"}}
    assert json.loads(rows[5].details_json) == {"k": 1, "values": {"a": "p", "b": "1.0"}}
    again = audit.log_action(res.log, b, b, "k", "things", now())
    assert again.added.count() == 0 and again.log.count() == 4
    marked = audit.log_action(start, a, b, "k", "things", now(), base=100)
    assert sorted(r.log_id for r in marked.added.collect()) == [101, 102, 103]


def test_wide_rows_are_joined_for_changed_keys_only(spark):
    a = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("a"))
    p = plan(audit.changed_keys(a, a.withColumn("a", F.lit("x")), "k", ["a"]))
    assert "partial_max" in p and "Join" not in p
    assert audit.changed_keys(a, a.withColumn("a", F.when(F.col("k") == 7, "y").otherwise("x")), "k", ["a"]).collect()[0].k == 7


# -- digest tree -----------------------------------------------------------------------------

def test_equal_versions_open_no_bucket(spark):
    root = scratch_dir(spark, "t-digest")
    df = table(spark, [(i % 50, f"v{i % 3}", 0.5) for i in range(300)])           # repeated rows too
    reconcile.publish_digested(df, root, 1, "k", 8)
    reconcile.publish_digested(df.orderBy(F.desc("a")).repartition(5), root, 2, "k", 8)
    assert reconcile.unequal_buckets(spark, root, 1, 2) == []
    diff = reconcile.differing_rows(spark, root, 1, 2)
    assert diff.count() == 0 and "FileScan" not in diff._jdf.queryExecution().optimizedPlan().toString()


def test_only_unequal_buckets_are_read(spark):
    root = scratch_dir(spark, "t-digest")
    first = [(i, f"v{i}", 0.5) for i in range(100)] + [(5, "v5", 0.5)] * 2
    second = [(i, f"v{i}" if i != 42 else "new", 0.5) for i in range(100)] + [(5, "v5", 0.5), (None, None, None)]
    reconcile.publish_digested(table(spark, first), root, 1, "k", 16)
    reconcile.publish_digested(table(spark, second), root, 2, "k", 16)
    opened = reconcile.unequal_buckets(spark, root, 1, 2)
    assert 1 <= len(opened) <= 3
    diff = reconcile.differing_rows(spark, root, 1, 2)
    assert sorted(map(tuple, diff.collect()), key=str) == sorted(
        [("before", 42, "v42", 0.5, 1), ("after", 42, "new", 0.5, 1), ("before", 5, "v5", 0.5, 1), ("after", None, None, None, 1)],
        key=str)
    assert "PartitionFilters: [_bucket" in plan(diff)
    folders = os.listdir(store.version_path(root, 1).removeprefix("file:"))
    assert sum(f.startswith("_bucket=") for f in folders) > len(opened)


# -- statistics ------------------------------------------------------------------------------

def test_exact_distincts_do_not_expand_rows(spark):
    df = spark.createDataFrame([(i % 7, f"v{i % 5}" if i % 3 else None, [i % 2], None, bytes([i % 4])) for i in range(100)],
                               "a long, b string, c array<int>, d string, e binary")
    got = {r.column_name: r.n_distinct for r in layout.distinct_counts(df).collect()}
    assert got == {"a": 7, "b": 5, "c": 2, "e": 4}
    plain = df.select("a", "b", "d")
    profile = layout.column_profile(plain)
    assert {r.column_name: (r.n_rows, r.n_nulls, r.n_distinct) for r in profile.collect()} == \
        {"a": (100, 0, 7), "b": (100, 34, 5), "d": (100, 100, 0)}
    assert "Expand" not in plan(profile)
    assert {r.column_name: r.n_distinct for r in layout.column_profile(plain.limit(0)).collect()} == {"a": 0, "b": 0, "d": 0}


def test_sketches_of_versions_merge(spark):
    def part(lo, hi):
        return spark.range(lo, hi).select(F.col("id"), (F.col("id") % 1000).alias("m"), F.lit(None).cast("string").alias("n"))
    root = scratch_dir(spark, "t-sketch")
    for version, (lo, hi) in enumerate([(0, 30_000), (20_000, 60_000)], 1):
        store.publish(layout.column_sketches(part(lo, hi)), root, version)
    merged = layout.merged_sketches(spark.read.parquet(*[store.version_path(root, v) for v in (1, 2)]))
    got = {r.column_name: r for r in layout.sketched_profile(merged).collect()}
    assert (got["id"].n_rows, got["n"].n_nulls) == (70_000, 70_000)
    for column, exact in (("id", 60_000), ("m", 1000), ("n", 0)):
        assert abs(got[column].n_distinct - exact) <= 0.05 * exact       # three standard errors of 1.6 %
