"""Batches that change one key several times equal the same requests applied
one call at a time; refusals come before duplicates."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quire import schemas as S
from quire.operators import in_turn
from quire.operators import snapshots as ops

D = Decimal
UPDATE = "seq long, book_id long, price decimal(10,2), stock long"
EDIT = ("seq long, book_id long, new_title string, new_author string, new_price decimal(10,2), new_stock long, "
        "new_category string")
CONTACT = "seq long, username string, new_address string, new_phone string, new_full_name string, new_email string"


def now():
    return F.lit("2025-01-01 00:00:00").cast(S.TS)


def books(spark):
    rows = [(i, None, f"T{i}", "A", D("10.00"), i, "C", None, None, None, D("10.00") if i % 2 else None, None, 0)
            for i in range(1, 9)]
    return spark.createDataFrame(rows, S.BOOKS_SCHEMA)


def people(spark):
    users = [(i, f"u{i}", "h", 1, "ACTIVE", None) for i in range(1, 7)]
    customers = [(10 + i, i, f"N{i}", f"u{i}@x.org" if i < 5 else None, None, None, "ACTIVE", None) for i in range(1, 6)]
    return spark.createDataFrame(users, S.USERS_SCHEMA), spark.createDataFrame(customers, S.CUSTOMERS_SCHEMA)


def same(a, b):
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def one_by_one(spark, rows, ddl, start, job, key):
    now_, refused = start, []
    for r in sorted(rows, key=lambda r: r[0]):
        res = job(now_, spark.createDataFrame([r], ddl))
        refused += [(x.seq, x[key], x.reason) for x in res.rejects.collect()]
        now_ = spark.createDataFrame(res.snapshot.collect(), start.schema)     # cut the plan
    return now_, sorted(refused, key=str)


def refusals(res, key):
    return sorted(((x.seq, x[key], x.reason) for x in res.rejects.collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_updates_in_turn(spark, seed):
    r = random.Random(seed)
    rows = [(k, r.choice([1, 1, 1, 2, 3, 99]), D(r.randrange(100, 900)) / 100, r.choice([None, 0, 7])) for k in range(8)]
    r.shuffle(rows)
    batch = in_turn.update_books(books(spark), spark.createDataFrame(rows, UPDATE))
    want, refused = one_by_one(spark, rows, UPDATE, books(spark), ops.update_books, "book_id")
    same(batch.snapshot, want)
    assert refusals(batch, "book_id") == refused


@pytest.mark.parametrize("seed", range(2))
def test_edits_in_turn(spark, seed):
    r = random.Random(seed)
    rows = [(k, r.choice([1, 1, 2, 4, 99]), r.choice([None, f"t{k}"]), r.choice([None, f"a{k}"]),
             r.choice([None, D(r.randrange(100, 900)) / 100]), r.choice([None, k]), r.choice([None, "K"])) for k in range(8)]
    r.shuffle(rows)
    batch = in_turn.product_edit(books(spark), spark.createDataFrame(rows, EDIT))
    want, refused = one_by_one(spark, rows, EDIT, books(spark), ops.product_edit, "book_id")
    same(batch.snapshot, want)
    assert refusals(batch, "book_id") == refused


@pytest.mark.parametrize("seed", range(3))
def test_contacts_in_turn(spark, seed):
    r = random.Random(seed)
    users, customers = people(spark)
    # each customer asks for e-mails of its own choice or contested ones; none is given up for another
    rows = [(k, f"u{who}", r.choice([None, f"street {k}"]), None, None,
             r.choice([None, "u1@x.org", "free@x.org", "free@x.org"]) if who > 1 else r.choice([None, "u1@x.org"]))
            for k, who in enumerate(r.choice([1, 2, 2, 3, 6, 7]) for _ in range(7))]
    taken = [x[5] for x in rows]
    batch = in_turn.contact_update(users, customers, spark.createDataFrame(rows, CONTACT))
    want, refused = one_by_one(spark, rows, CONTACT, customers, lambda c, q: ops.contact_update(users, c, q), "username")
    same(batch.snapshot, want)
    assert refusals(batch, "username") == refused, taken
    emails = [x.email for x in batch.snapshot.collect() if x.email]
    assert len(emails) == len(set(emails))


def test_a_key_with_a_third_of_all_requests(spark):
    n = 30_000
    req = spark.range(n).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7 + 2).alias("book_id"),
                                (F.col("id") % 1000 / 10).cast("decimal(10,2)").alias("price"), F.col("id").alias("stock"))
    res = in_turn.update_books(books(spark), req.repartition(8))
    last = {b: max(i for i in range(n) if (1 if i % 3 == 0 else i % 7 + 2) == b) for b in range(1, 9)}
    assert {r.book_id: r.stock for r in res.snapshot.collect()} == last
    plan = in_turn.fold(req, "book_id", overwrite=("price", "stock"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_ties_and_null_positions(spark):
    rows = [(5, 1, D("1.00"), 1), (None, 1, D("2.00"), 2), (5, 2, D("3.00"), 3), (5, 2, D("4.00"), 1), (1, None, D("1.00"), 1)]
    res = in_turn.update_books(books(spark), spark.createDataFrame(rows, UPDATE))
    got = {r.book_id: (r.price, r.stock) for r in res.snapshot.collect()}
    assert got[1] == (D("2.00"), 2) and got[2] == (D("4.00"), 1)
    assert refusals(res, "book_id") == [(1, None, "key missing")]
    empty = in_turn.update_books(books(spark), spark.createDataFrame([], UPDATE))
    same(empty.snapshot, books(spark))


# -- refusals before duplicates, e-mails, orders placed twice ----------------------------------

def test_contact_update_keeps_emails_unique(spark):
    users, customers = people(spark)
    rows = [(1, "u1", None, None, None, "u2@x.org"), (2, "u1", "a", None, None, None), (3, "u3", None, None, None, "n@x.org"),
            (4, "u4", None, None, None, "n@x.org"), (5, "u2", None, None, None, "u2@x.org"), (6, "u6", "b", None, None, None)]
    res = ops.contact_update(users, customers, spark.createDataFrame(rows, CONTACT))
    assert refusals(res, "username") == [(1, "u1", "email exists"), (4, "u4", "email exists"), (6, "u6", "no profile")]
    got = {r.customer_id: (r.address, r.email) for r in res.snapshot.collect()}
    assert got[11] == ("a", "u1@x.org") and got[13][1] == "n@x.org" and got[14][1] == "u4@x.org"


def test_refused_request_does_not_use_up_its_key(spark):
    users, customers = people(spark)
    roles = spark.createDataFrame(S.ROLES, S.ROLES_SCHEMA)
    req = spark.createDataFrame([(1, "u1", "u2", "X", None), (2, "u2", "u2", "Y", None), (3, "u2", "u2", "Z", None)],
                                "seq long, viewer string, username string, new_password_hash string, new_status string")
    res = ops.security_update(users, roles, req)
    assert res.snapshot.filter("username = 'u2'").first().password_hash == "Y"
    assert refusals(res, "username") == [(1, "u2", "not allowed"), (3, "u2", "duplicate request")]
    add = spark.createDataFrame([(1, "n", "h", "Courier"), (2, "n", "k", S.ROLE_SELLER)],
                                "seq long, username string, password_hash string, role_name string")
    res = ops.add_users(users, roles, add, now())
    assert [(r.username, r.password_hash) for r in res.added.collect()] == [("n", "k")]
    reg = spark.createDataFrame([(1, "n", "h", "N", "u1@x.org"), (2, "n", "h", "N", "n@x.org")],
                                "seq long, username string, password_hash string, full_name string, email string")
    res = ops.register_clients(users, customers, roles, reg, now())
    assert [r.email for r in res.added.collect()] == ["n@x.org"]


def test_orders_placed_twice(spark):
    orders = spark.createDataFrame([(100, 10, None, S.ORDER_PAID, D("20.00"))], S.ORDERS_SCHEMA)
    customers = spark.createDataFrame([(10, None, "A", None, None, None, None, None)], S.CUSTOMERS_SCHEMA)
    lines = spark.createDataFrame([(10, 1, 2, D("10.00"), 100), (10, 2, 1, D("7.00"), None), (11, 3, 1, D("5.00"), None)],
                                  "customer_id long, book_id long, qty long, price decimal(10,2), order_id long")
    place = spark.createDataFrame([(1, 10)], "seq long, customer_id long")
    first = ops.place_orders(orders, customers, lines, place, now())
    assert {r.book_id: r.order_id for r in first.order_items.collect()} == {1: 100, 2: 101, 3: None}
    assert {r.order_id: r.total_amount for r in first.snapshot.collect()} == {100: D("20.00"), 101: D("7.00")}
    second = ops.place_orders(first.snapshot, customers, first.order_items, place, now())
    assert {r.book_id: r.order_id for r in second.order_items.collect()} == {1: 100, 2: 101, 3: None}
    assert {r.order_id: r.total_amount for r in second.snapshot.collect()} == {100: D("20.00"), 101: D("7.00"), 102: D("0.00")}
    assert second.lines.count() == 0
