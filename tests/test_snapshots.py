"""Edge cases of the snapshot jobs on small literal tables: duplicates,
unknown keys, NULL overwrite vs keep, references, paid orders, defaults."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quire import schemas as S
from quire.operators import snapshots as ops
from quire.operators.accounts import first_by_seq
from quire.operators.changes import snapshot_changes

def now():
    return F.lit("2025-01-01 00:00:00").cast(S.TS)

D = Decimal


@pytest.fixture
def roles(spark):
    return spark.createDataFrame(S.ROLES, S.ROLES_SCHEMA)


@pytest.fixture
def users(spark):
    rows = [(1, "ivan", "H1", 1, "ACTIVE", None), (2, "anna", "H2", 2, "ACTIVE", None),
            (3, "boss", "H3", 3, "ACTIVE", None)]
    return spark.createDataFrame(rows, S.USERS_SCHEMA)


@pytest.fixture
def customers(spark):
    rows = [(10, 1, "Иван", "ivan@mail.com", None, None, "ACTIVE", None)]
    return spark.createDataFrame(rows, S.CUSTOMERS_SCHEMA)


@pytest.fixture
def books(spark):
    def b(i, title, price, stock, disc=None):
        return (i, f"isbn-{i}", title, "A", D(price), stock, "C", None, None, None,
                None if disc is None else D(disc), None, 0)
    rows = [b(1, "One", "100.00", 5, "10.00"), b(2, "Two", "200.00", 0), b(3, "Same", "50.00", 1),
            b(4, "Same", "60.00", 2)]
    return spark.createDataFrame(rows, S.BOOKS_SCHEMA)


@pytest.fixture
def orders(spark):
    rows = [(100, 10, None, S.ORDER_NEW, D("0.00")), (101, 10, None, S.ORDER_PAID, D("500.00")),
            (102, 10, None, S.ORDER_NEW, D("0.00"))]
    return spark.createDataFrame(rows, S.ORDERS_SCHEMA)


@pytest.fixture
def items(spark):
    rows = [(None, 101, 1, 5, D("100.00")), (None, 100, 3, 2, D("50.00"))]
    return spark.createDataFrame(rows, S.ORDER_ITEMS_SCHEMA).drop("order_item_id")


def reasons(df, key="username"):
    return {r[key]: r.reason for r in df.collect()}


def test_first_by_seq_keeps_lowest(spark):
    req = spark.createDataFrame([(2, "a"), (1, "a"), (3, "b")], "seq long, k string")
    w, l = first_by_seq(req, "k")
    assert sorted((r.seq, r.k) for r in w.collect()) == [(1, "a"), (3, "b")]
    assert [r.seq for r in l.collect()] == [2]


def test_first_by_seq_one_winner_per_key(spark):
    rows = [(1, "a", 5), (1, "a", 4), (1, "a", 4), (None, "b", 1), (None, "c", 1), (7, "c", 2)]
    rows += [(3, "d", 0)] * 9000                       # repeats come back in several arrays
    req = spark.createDataFrame(rows, "seq long, k string, v int")
    w, l = first_by_seq(req, "k")
    won, lost = [tuple(r) for r in w.collect()], [tuple(r) for r in l.collect()]
    assert sorted(won, key=str) == sorted([(1, "a", 4), (None, "b", 1), (7, "c", 2), (3, "d", 0)], key=str)
    assert sorted(won + lost, key=str) == sorted(rows, key=str)


def test_update_with_tied_requests_keeps_the_row_count(spark):
    books = spark.range(10).select(F.col("id").alias("book_id"), F.lit(D("1.00")).cast(S.PRICE).alias("price"),
                                   F.lit(1).cast("long").alias("stock"))
    req = spark.createDataFrame([(1, 3, D("2.00"), 5), (1, 3, D("3.00"), 6), (None, 4, D("4.00"), 7)],
                                "seq long, book_id long, price decimal(10,2), stock long")
    res = ops.update_books(books, req)
    assert res.snapshot.count() == 10 and res.rejects.count() == 1
    assert {r.book_id: r.stock for r in res.snapshot.collect() if r.stock > 1} == {3: 5, 4: 7}


def test_add_users_rejects_and_ids(spark, users, roles):
    req = spark.createDataFrame(
        [(1, "new1", "h", "Customer"), (2, "new1", "h", "Seller"), (3, "ivan", "h", "Customer"),
         (4, "admin", "h", "Admin"), (5, "Admin", "h", "Admin"), (6, "x", "h", "Courier")],
        "seq long, username string, password_hash string, role_name string")
    res = ops.add_users(users, roles, req, now())
    added = {r.username: (r.user_id, r.role_id, r.status) for r in res.added.collect()}
    assert added == {"new1": (4, 1, "ACTIVE"), "Admin": (5, 3, "ACTIVE")}
    rej = {(r.seq, r.reason) for r in res.rejects.collect()}
    assert rej == {(2, "duplicate request"), (3, "exists"), (4, "reserved username"),
                   (6, "unknown role")}
    assert res.snapshot.count() == 5


def test_register_clients_two_tables(spark, users, customers, roles):
    req = spark.createDataFrame(
        [(1, "kate", "h", "Kate", "kate@x.org"), (2, "anna", "h", "Anna", "a@x.org"),
         (3, "bob", "h", "Bob", "ivan@mail.com"), (4, "eve", "h", "Eve", "kate@x.org")],
        "seq long, username string, password_hash string, full_name string, email string")
    res = ops.register_clients(users, customers, roles, req, now())
    added = res.added.collect()
    assert [(r.username, r.user_id, r.customer_id, r.role_id) for r in added] == [("kate", 4, 11, 1)]
    assert reasons(res.rejects) == {"anna": "exists", "bob": "email exists", "eve": "email exists"}
    assert res.customers.count() == 2


def test_upsert_updates_and_inserts(spark, users):
    req = spark.createDataFrame(
        [(1, "anna", "h", 3, "BLOCKED"), (2, "zed", "hz", 1, "ACTIVE"), (3, "zed", "hz", 2, "X"),
         (4, "admin", "h", 1, "ACTIVE")],
        "seq long, username string, password_hash string, role_id long, status string")
    res = ops.upsert_users(users, req, now())
    snap = {r.username: (r.user_id, r.role_id, r.status) for r in res.snapshot.collect()}
    assert snap["anna"] == (2, 3, "BLOCKED")
    assert snap["zed"] == (4, 1, "ACTIVE")
    assert "admin" not in snap
    assert snap["ivan"] == (1, 1, "ACTIVE")


def test_update_books_null_overwrites_edit_null_keeps(spark, books):
    upd = spark.createDataFrame([(1, 1, D("120.00"), None), (2, 99, D("1.00"), 1)],
                                "seq long, book_id long, price decimal(10,2), stock long")
    res = ops.update_books(books, upd)
    b1 = res.snapshot.filter("book_id = 1").first()
    assert (b1.price, b1.stock) == (D("120.00"), None)
    assert [r.reason for r in res.rejects.collect()] == ["not found"]

    edit = spark.createDataFrame([(1, 1, None, None, D("200.00"), None, None)],
                                 "seq long, book_id long, new_title string, new_author string, "
                                 "new_price decimal(10,2), new_stock long, new_category string")
    e1 = ops.product_edit(books, edit).snapshot.filter("book_id = 1").first()
    assert (e1.title, e1.price, e1.stock, e1.price_after_discount) == \
        ("One", D("200.00"), 5, D("180.00"))
    untouched = ops.product_edit(books, edit).snapshot.filter("book_id = 2").first()
    assert untouched.price_after_discount is None


def test_delete_referenced_rejected(spark, books, items):
    req = spark.createDataFrame([(1,), (2,), (42,)], "book_id long")
    res = ops.delete_by_key(books, "book_id", req, [(items, "book_id")])
    assert sorted(r.book_id for r in res.snapshot.collect()) == [1, 3, 4]
    assert reasons(res.rejects, "book_id") == {1: "referenced", 42: "not found"}


def test_product_delete_archives_or_removes(spark, books, items):
    req = spark.createDataFrame([(2,), (3,)], "book_id long")
    snap = {r.book_id: r for r in ops.product_delete(books, items, req).snapshot.collect()}
    assert 2 not in snap                          # unsold: removed
    assert snap[3].title == f"{S.ARCHIVE_PREFIX} Same" and snap[3].stock == 0 \
        and snap[3].is_archived == 1              # sold: archived
    assert snap[4].title == "Same"


def test_cascade_delete(spark, customers, orders, items):
    req = spark.createDataFrame([(10,)], "customer_id long")
    c = ops.cascade_delete(customers, orders, items, req)
    assert c.customers.count() == 0 and c.orders.count() == 0 and c.order_items.count() == 0
    got = sorted((r.table_name, r.key, r.n_rows) for r in c.deleted.collect())
    assert got == [("customers", 10, 1), ("order_items", 100, 1), ("order_items", 101, 1),
                   ("orders", 100, 1), ("orders", 101, 1), ("orders", 102, 1)]


def test_cart_and_place_orders_empty_cart_total_zero(spark, books, orders, customers):
    req = spark.createDataFrame([(1, 10, 1, 2), (2, 10, 77, 1)],
                                "seq long, customer_id long, book_id long, qty long")
    cart = ops.add_to_cart(books, req)
    assert [r.reason for r in cart.rejects.collect()] == ["book not found"]
    place = spark.createDataFrame([(1, 10), (2, 11)], "seq long, customer_id long")
    res = ops.place_orders(orders, customers, cart.added, place, now())
    new = res.added.collect()
    assert [(r.order_id, r.customer_id, r.total_amount, r.status) for r in new] == \
        [(103, 10, D("200.00"), S.ORDER_NEW)]
    assert [r.reason for r in res.rejects.collect()] == ["unknown customer"]
    empty_cart = spark.createDataFrame([], cart.added.schema)
    res2 = ops.place_orders(orders, customers, empty_cart, place.limit(1), now())
    assert res2.added.first().total_amount == D("0.00")


def test_paid_order_unchanged_by_add_items(spark, orders, books, items):
    req = spark.createDataFrame([(1, 101, 2, 1), (2, 100, 2, 3), (3, 999, 2, 1)],
                                "seq long, order_id long, book_id long, qty long")
    res = ops.order_add_items(orders, books, items, req)
    assert {r.order_id: r.total_amount for r in res.touched.collect()} == {100: D("700.00")}
    # the snapshot is the whole table
    assert res.snapshot.columns == orders.columns and res.snapshot.count() == orders.count()
    assert {r.seq: r.reason for r in res.rejects.collect()} == \
        {1: "order not open", 3: "order not found"}


def test_remove_items_drops_empty_lines(spark, orders, items):
    req = spark.createDataFrame([(100, 3, 1), (100, 3, 1)], "order_id long, book_id long, qty long")
    res = ops.order_remove_items(orders, items, req)
    assert res.order_items.filter("order_id = 100").count() == 0
    assert res.touched.first().total_amount == D("0.00")
    assert res.snapshot.count() == orders.count()


def test_remove_items_takes_the_quantity_once(spark, orders):
    lines = spark.createDataFrame([(100, 3, 5, D("10.00")), (100, 3, 4, D("10.00")), (100, 4, 1, D("2.00"))],
                                  "order_id long, book_id long, qty long, price decimal(10,2)")
    req = spark.createDataFrame([(100, 3, 6)], "order_id long, book_id long, qty long")
    res = ops.order_remove_items(orders, lines, req)
    left = sorted((r.book_id, r.qty) for r in res.order_items.collect())
    assert left == [(3, 3), (4, 1)] and res.touched.first().total_amount == D("32.00")


def test_buy_auto_uses_lowest_open_order_or_opens_one(spark, users, customers, orders, books, items):
    req = spark.createDataFrame([(1, "ivan", 1, 1), (2, "anna", 1, 1), (3, "ivan", 99, 1)],
                                "seq long, username string, book_id long, qty long")
    res = ops.buy_auto(users, customers, orders, books, items, req, now())
    lines = res.added.collect()
    assert [(r.username, r.order_id, r.new_order) for r in lines] == [("ivan", 100, False)]
    assert reasons(res.rejects) == {"anna": "not a customer", "ivan": "book not found"}

    none_open = orders.filter(F.col("status") != S.ORDER_NEW)
    res2 = ops.buy_auto(users, customers, none_open, books, items, req.limit(1), now())
    r = res2.added.first()
    assert (r.order_id, r.new_order) == (102, True)
    totals = {x.order_id: x.total_amount for x in res2.snapshot.collect()}
    assert totals[102] == r.qty * r.price and res2.order_items.count() == items.count() + 1


def test_toggle_status_audit_json(spark, users, customers):
    audit = spark.createDataFrame([(7, "x", "t", "a", "{}", None)], S.AUDIT_SCHEMA)
    req = spark.createDataFrame([(1, 2, "BLOCKED", "rules"), (2, 2, "ACTIVE", "oops"),
                                 (3, 9, "BLOCKED", "?")],
                                "seq long, user_id long, new_status string, reason string")
    res = ops.toggle_status(users, audit, req, now())
    a = res.added.collect()
    assert len(a) == 1 and a[0].log_id == 8
    assert json.loads(a[0].details_json) == {"user_id": 2, "old_status": "ACTIVE",
                                             "new_status": "BLOCKED", "reason": "rules"}
    assert res.snapshot.filter("user_id = 2").first().status == "BLOCKED"


def test_security_update_guard(spark, users, roles):
    req = spark.createDataFrame(
        [(1, "ivan", "ivan", "NEW", None), (2, "ivan", "boss", "X", "BLOCKED"),
         (3, "boss", "anna", None, "BLOCKED"), (4, "boss", "anna", "Y", None)],
        "seq long, viewer string, username string, new_password_hash string, new_status string")
    res = ops.security_update(users, roles, req)
    snap = {r.username: (r.password_hash, r.status) for r in res.snapshot.collect()}
    assert snap["ivan"] == ("NEW", "ACTIVE")      # self change; NULL status keeps
    assert snap["anna"] == ("H2", "BLOCKED")      # an Admin may change others
    assert snap["boss"] == ("H3", "ACTIVE")       # a Customer may not
    assert {r.seq: r.reason for r in res.rejects.collect()} == \
        {2: "not allowed", 4: "duplicate request"}


def test_apply_defaults_absent_vs_explicit_null(spark):
    absent = spark.createDataFrame([("u",)], "username string")
    given = spark.createDataFrame([("u", None)], "username string, status string")
    a = ops.apply_defaults(absent, "users", now()).first()
    g = ops.apply_defaults(given, "users", now()).first()
    assert a.status == "ACTIVE" and a.created_at == datetime(2025, 1, 1)
    assert g.status is None


def test_snapshot_changes(spark, books):
    after = (books.filter("book_id <> 2")
             .withColumn("price", F.when(F.col("book_id") == 1, F.lit(D("1.00")).cast(S.PRICE))
                         .otherwise(F.col("price")))
             .unionByName(books.filter("book_id = 4").withColumn("book_id", F.lit(9).cast("long"))))
    rows = {r.book_id: r for r in snapshot_changes(books, after, "book_id").collect()}
    got = {k: (r.change, r.changed_columns) for k, r in rows.items()}
    assert got == {1: ("UPDATE", "price"), 2: ("DELETE", None), 9: ("INSERT", None)}
    assert json.loads(rows[1].details_json) == {"price": "1.00"}
    assert json.loads(rows[2].details_json)["title"] == "Two"          # old values kept
    assert json.loads(rows[9].details_json)["price"] == "60.00"        # new values


def test_recategorise_literal_and_table_agree(spark, books):
    mapping = spark.createDataFrame([("C", "Учебная литература")], "old_category string, new_category string")
    a = {r.book_id: r.category for r in ops.recategorise(books, {"C": "Учебная литература"}).collect()}
    b = {r.book_id: r.category for r in ops.recategorise_by_table(books, mapping).collect()}
    assert a == b and set(a.values()) == {"Учебная литература"}


def test_publish_versions_and_truncate(spark, books):
    from quire.session import scratch_dir
    from quire.sources import snapshot_store as store
    root = scratch_dir(spark, "store")
    p1 = store.publish(books, root, 1)
    p2 = store.publish(store.truncate(books), root, 2)
    assert store.read_version(spark, root, 1).count() == 4
    assert store.read_version(spark, root, 2).count() == 0
    assert p1 != p2
    with pytest.raises(Exception):
        store.publish(books, root, 1)              # never overwrite a published version


def test_legacy_new_status_counts_as_open(spark, books, items):
    from quire.operators.sales import first_open_order
    orders = spark.createDataFrame(
        [(200, 10, None, S.ORDER_NEW_LEGACY, D("0.00")), (201, 10, None, None, D("0.00"))],
        S.ORDERS_SCHEMA)
    assert [r.order_id for r in first_open_order(orders).collect()] == [200]
    req = spark.createDataFrame([(1, 200, 1, 1), (2, 201, 1, 1)],
                                "seq long, order_id long, book_id long, qty long")
    res = ops.order_add_items(orders, books, items, req)
    assert [r.order_id for r in res.touched.collect()] == [200]
    assert {r.seq: r.reason for r in res.rejects.collect()} == {2: "order not open"}


def test_request_without_key_is_refused(spark, users, roles):
    req = spark.createDataFrame([(1, None, "h", "Customer"), (2, "neo", "h", "Customer")],
                                "seq long, username string, password_hash string, role_name string")
    res = ops.add_users(users, roles, req, now())
    assert [r.username for r in res.added.collect()] == ["neo"]
    assert {r.seq: r.reason for r in res.rejects.collect()} == {1: "key missing"}


def test_new_lines_are_numbered_and_tables_whole(spark, users, customers, orders, books):
    lines = spark.createDataFrame([(7, 100, 3, 5, D("10.00")), (9, 101, 4, 1, D("2.00"))], S.ORDER_ITEMS_SCHEMA)
    req = spark.createDataFrame([(2, 100, 1, 1), (1, 100, 2, 1)],
                                "seq long, order_id long, book_id long, qty long")
    added = ops.order_add_items(orders, books, lines, req)
    assert {r.order_item_id: r.book_id for r in added.order_items.collect()} == {7: 3, 9: 4, 10: 2, 11: 1}
    total = sum(r.qty * r.price for r in added.order_items.filter("order_id = 100").collect())
    assert {r.order_id: r.total_amount for r in added.snapshot.collect()}[100] == total

    cut = ops.order_remove_items(orders, added.order_items, spark.createDataFrame(
        [(100, 3, 2)], "order_id long, book_id long, qty long"))
    assert {r.order_item_id: r.qty for r in cut.order_items.collect()} == {7: 3, 9: 1, 10: 1, 11: 1}

    buy = spark.createDataFrame([(1, "ivan", 1, 1)], "seq long, username string, book_id long, qty long")
    bought = ops.buy_auto(users, customers, orders, books, lines, buy, now())
    assert sorted(r.order_item_id for r in bought.order_items.collect()) == [7, 9, 10]

    cart_req = spark.createDataFrame([(2, 10, 1, 1), (1, 11, 2, 4)],
                                     "seq long, customer_id long, book_id long, qty long")
    cart = ops.add_to_cart(books, cart_req, lines)
    assert {r.order_item_id: r.order_id for r in cart.snapshot.collect()} == {7: 100, 9: 101, 10: None, 11: None}
    place = spark.createDataFrame([(1, 10)], "seq long, customer_id long")
    placed = ops.place_orders(orders, customers, cart.added, place, now())
    new = placed.added.first().order_id
    assert {r.customer_id: r.order_id for r in placed.order_items.collect()} == {10: new, 11: None}
    assert [r.customer_id for r in placed.lines.collect()] == [10]


def test_tasks_of_large_tables_stay_small(spark, orders, books, monkeypatch):
    """Above a number of rows, lines and orders are dealt into partitions that
    follow the line table's size; the results are the same."""
    lines = spark.createDataFrame([(100 if i % 2 else None, i % 4, 5, D("10.00")) for i in range(90)],
                                  "order_id long, book_id long, qty long, price decimal(10,2)")
    add = spark.createDataFrame([(i, 100, 1, i) for i in range(5)], "seq long, order_id long, book_id long, qty long")
    cut = spark.createDataFrame([(100, 3, 7), (100, 1, 400), (999, 1, 1)], "order_id long, book_id long, qty long")

    def results():
        for res in (ops.order_add_items(orders, books, lines, add), ops.order_remove_items(orders, lines, cut)):
            for df in (res.touched, res.snapshot, res.order_items):
                plan = df._jdf.queryExecution().executedPlan().toString()
                yield "order_id" in plan and ", 45), REPARTITION_BY_NUM" in plan, sorted(map(str, df.collect()))

    small = list(results())
    monkeypatch.setattr("quire.functions.joins.ROWS_PER_TASK", 2)
    large = list(results())
    assert [x for _, x in small] == [x for _, x in large]
    assert not any(x for x, _ in small) and [x for x, _ in large] == [True, True, False] * 2


def test_requests_without_email_are_spread(spark, users, customers):
    req = spark.createDataFrame([(i, "ivan", f"a{i}", None, None, None) for i in range(800)],
                                "seq long, username string, new_address string, new_phone string, "
                                "new_full_name string, new_email string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        ok, _ = ops.resolved_contacts(users, customers, req, ["seq", "username"])
        sizes = [r["count"] for r in ok.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 800 and max(sizes) < 400
