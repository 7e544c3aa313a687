"""Sales sums kept over versions equal the full aggregates."""

from decimal import Decimal

from pyspark.sql import functions as F

from quire import schemas as S
from quire.operators import rollups, sales
from quire.operators import snapshots as ops
from quire.session import scratch_dir

D = Decimal
LINE = "order_id long, book_id long, qty long, price decimal(10,2)"


def lines(spark, rows):
    return spark.createDataFrame([(o, b, q, None if p is None else D(p)) for o, b, q, p in rows], LINE)


def books(spark):
    return spark.createDataFrame([(i, None, f"T{i % 2}", "A", D("1.00"), 1, "C", None, None, None, None, None, 0)
                                  for i in range(1, 6)], S.BOOKS_SCHEMA)


def same(a, b):
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_versions_add_up(spark):
    root = scratch_dir(spark, "t-rollup")
    first = [(1, 1, 2, "10.00"), (1, 2, None, "5.00"), (2, 1, 1, "9.00"), (None, 3, 4, "1.00"), (3, 4, 2, None)]
    added = [(2, 2, 3, "5.00"), (None, 1, 1, "10.00")]
    second = first + added
    third = [r if r[:2] != (1, 1) else (1, 1, 1, "10.00") for r in second if r[:2] != (2, 2)]        # orders 1 and 2 change
    fourth = [r for r in third if r[0] != 3]                                                           # order 3 goes
    t = [lines(spark, x) for x in (first, second, third, fourth)]
    touched = spark.createDataFrame([(1,), (2,)], "order_id long")
    rollups.publish(rollups.book_sums(t[0]), root, 1)
    rollups.publish(rollups.delta(lines(spark, added), None), root, 2)
    rollups.publish(rollups.order_delta(t[1], t[2], touched), root, 3)
    rollups.publish(rollups.delta(None, t[2].filter("order_id = 3")), root, 4)
    for version in range(1, 5):
        sums, full = rollups.current(spark, root, range(1, version + 1)), t[version - 1]
        same(sums, rollups.book_sums(full))
        same(rollups.sales_by_title(sums, books(spark)), sales.sales_by_title(full, books(spark)))
        same(rollups.popular_products(sums, books(spark), 9), sales.popular_products(full, books(spark), 9))
        assert rollups.items_sold(sums).first()[0] == full.filter("order_id is not null").agg(F.sum("qty")).first()[0]
    other = scratch_dir(spark, "t-rollup")
    rollups.compact(spark, root, range(1, 5), other)
    same(rollups.current(spark, other, range(4, 5)), rollups.book_sums(t[3]))


def test_empty_line_tables(spark):
    root = scratch_dir(spark, "t-rollup")
    rollups.publish(rollups.book_sums(lines(spark, [])), root, 1)
    sums = rollups.current(spark, root, range(1, 2))
    assert sums.count() == 0 and rollups.items_sold(sums).first()[0] == 0


def test_delta_of_the_lines_a_job_names(spark):
    """The lines that order_remove_items took and left give the same sums as all
    lines of its orders, also where an order comes twice."""
    rows = [(1, 1, 5, "10.00"), (1, 1, 5, "9.00"), (1, 2, 1, "3.00"), (2, 1, 2, "1.00"), (None, 1, 1, "1.00"), (1, None, 1, "1.00")]
    t = lines(spark, rows)
    req = spark.createDataFrame([(1, 1, 7), (2, 1, 2), (3, 1, 1)], "order_id long, book_id long, qty long")
    for times in (1, 2):
        orders = spark.createDataFrame([(o, 1, None, S.ORDER_NEW, D("0.00")) for o in (1, 2) for _ in range(times)], S.ORDERS_SCHEMA)
        cut = ops.order_remove_items(orders, t, req)
        assert sorted(map(str, cut.removed.collect())) == sorted(map(str, lines(spark, rows[:2] + rows[3:4]).collect()))
        sums = [rollups._added(rollups.book_sums(t).unionByName(x)).filter("n_lines > 0") for x in (
            rollups.delta(cut.lowered, cut.removed), rollups.order_delta(t, cut.order_items, cut.touched))]
        same(sums[0], sums[1])
        same(sums[0], rollups.book_sums(cut.order_items))
