"""Identity marks and tables changed partition by partition."""

import os
import uuid
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quire import schemas as S
from quire.operators import in_turn
from quire.session import scratch_dir
from quire.sources import identity, partitioned
from quire.sources import snapshot_store as store

D = Decimal


def rows(spark, ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "id long, name string")


def test_deleted_numbers_do_not_come_back(spark):
    root = scratch_dir(spark, "t-identity")
    first = identity.publish_first(rows(spark, [1, 2, 7]), root, ["id"])
    store.publish(first.filter("id < 7"), root, 2)                        # the newest row goes
    new = identity.take_ids(spark.createDataFrame([("b",), ("a",)], "name string"), ["name"], root, 3, "id")
    assert {r.name: r.id for r in new.collect()} == {"a": 8, "b": 9}
    # version 3 was reserved but never published: a gap, and the next batch goes on
    again = identity.take_ids(spark.createDataFrame([("c",)], "name string"), ["name"], root, 4, "id")
    assert again.first().id == 10 and identity.current_mark(spark, root, "id") == 10


def test_a_version_is_reserved_once(spark):
    root = scratch_dir(spark, "t-identity")
    identity.publish_first(rows(spark, [1]), root, ["id"])
    identity.take_ids(rows(spark, [0]).select("name"), ["name"], root, 2, "id")
    with pytest.raises(AnalysisException):
        identity.take_ids(rows(spark, [0]).select("name"), ["name"], root, 2, "id")


def test_loaded_ids_and_empty_batches(spark):
    root = scratch_dir(spark, "t-identity")
    identity.publish_first(rows(spark, []), root, ["id"])
    assert identity.current_mark(spark, root, "id") == 0
    assert identity.raise_mark(spark, root, 2, rows(spark, [50, 3]), "id") == 50
    assert identity.take_ids(rows(spark, []).select("name"), ["name"], root, 3, "id").count() == 0
    assert identity.raise_mark(spark, root, 4, rows(spark, [20]), "id") == 50


# -- partitions ------------------------------------------------------------------------------

def catalogue(spark):
    cats = ["A", "B", "C", None]
    books = [(i, None, f"T{i}", "A", D("1.00"), i, cats[i % 4], None, None, None, None, None, 0) for i in range(40)]
    name, path = f"t_{uuid.uuid4().hex[:12]}", scratch_dir(spark, "t-catalogue")
    partitioned.publish_partitioned(spark.createDataFrame(books, S.BOOKS_SCHEMA), name, path, "category")
    return name, path.removeprefix("file:")


def files(path):
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
            for d in os.listdir(path) if d.startswith("category=")}


def test_a_rename_touches_its_categories_only(spark):
    name, path = catalogue(spark)
    before = files(path)
    out = partitioned.rename_values(spark, name, "category", {"A": "B"})
    after = files(path)
    assert {r["category"]: r["count"] for r in out.groupBy("category").count().collect()} == {"B": 20, "C": 10, None: 10}
    kept = [d for d in before if d not in ("category=A", "category=B")]
    assert len(kept) == 2 and all(before[d] == after[d] for d in kept) and before["category=B"] != after["category=B"]
    swapped = partitioned.rename_values(spark, name, "category", {"B": "C", "C": "B"})
    assert {r["category"]: r["count"] for r in swapped.groupBy("category").count().collect()} == {"C": 20, "B": 10, None: 10}
    nothing = files(path)
    partitioned.rename_values(spark, name, "category", {"Z": "Z"})
    assert files(path) == nothing
    assert partitioned.rename_values(spark, name, "category", {"it's": "D"}).count() == 40


def test_an_update_touches_the_partitions_of_its_keys(spark):
    name, path = catalogue(spark)
    before = files(path)
    req = spark.createDataFrame([(1, 4, D("9.00"), 1), (2, 4, D("8.00"), 2), (3, 99, D("1.00"), 1)],
                                "seq long, book_id long, price decimal(10,2), stock long")
    out = partitioned.update_rows(spark, name, "category", "book_id", req,
                                  lambda r, c: in_turn.update_books(r, c).snapshot)
    after = files(path)
    assert [d for d in before if before[d] != after[d]] == ["category=A"]
    assert out.count() == 40 and out.filter("book_id = 4").select("price", "stock").first() == (D("8.00"), 2)


def test_other_partitions_are_not_read(spark):
    name, _ = catalogue(spark)
    touched = spark.table(name).filter(F.col("category").isin("A", "B"))
    assert "PartitionFilters: [category" in touched._jdf.queryExecution().executedPlan().toString()
