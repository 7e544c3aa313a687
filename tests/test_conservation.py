"""Every request ends up applied or rejected exactly once, snapshots keep
their row counts, and ids stay unique (run on the smallest test tables)."""

import pytest
from pyspark.sql import functions as F

from quire.operators import snapshots as ops
from quire.plans import requests as R
from quire.plans import snapshots as P
from quire.sources.adapter import Domain


@pytest.fixture(scope="module")
def d(spark, small_dir):
    return Domain(spark, small_dir)


def n(df):
    return df.count()


def test_add_users_conserves_requests(d):
    req = R.user_signups(d).select("seq", "username", "password_hash", "role_name")
    res = ops.add_users(d.users, d.roles, req, R.as_of())
    assert n(res.added) + n(res.rejects) == n(req)
    assert res.snapshot.select("user_id").distinct().count() == n(d.users) + n(res.added)


def test_register_conserves_requests(d):
    req = R.user_signups(d).select("seq", "username", "password_hash", "full_name", "email")
    res = ops.register_clients(d.users, d.customers, d.roles, req, R.as_of())
    assert n(res.added) + n(res.rejects) == n(req)
    assert res.customers.select("customer_id").distinct().count() == n(d.customers) + n(res.added)


def test_upsert_conserves_requests(d):
    req = P.upsert_requests(d)
    res = ops.upsert_users(d.users, req, R.as_of())
    matched = req.join(d.users.select("username"), "username", "left_semi") \
        .groupBy("username").count().count()
    assert matched + n(res.added) + n(res.rejects) == n(req)
    assert n(res.snapshot) == n(d.users) + n(res.added)


def test_update_books_keeps_rows(d):
    req = P.book_update_requests(d)
    res = ops.update_books(d.books, req)
    assert n(res.snapshot) == n(d.books)
    applied = req.join(d.books.select("book_id"), "book_id", "left_semi") \
        .groupBy("book_id").count().count()
    assert applied + n(res.rejects) == n(req)


def test_product_add_conserves_requests(d):
    req = P.product_requests(d)
    res = ops.product_add_validated(d.books, req, R.as_of())
    assert n(res.added) + n(res.rejects) == n(req)


def test_cart_and_buy_conserve_requests(d):
    req = P.cart_requests(d)
    cart = ops.add_to_cart(d.books, req)
    assert n(cart.added) + n(cart.rejects) == n(req)
    buy = P.buy_requests(d)
    res = ops.buy_auto(d.users, d.customers, d.orders, d.books, d.order_items, buy, R.as_of())
    assert n(res.added) + n(res.rejects) == n(buy)
    # every new order id is unique and above the current maximum
    new = res.new_orders
    top = d.orders.agg(F.max("order_id")).first()[0]
    assert new.filter(F.col("order_id") <= top).count() == 0
    assert new.select("order_id").distinct().count() == n(new)


def test_delete_accounts_for_every_key(d):
    req = d.books.filter(F.col("stock") <= 3).select("book_id")
    res = ops.delete_by_key(d.books, "book_id", req, [(d.order_items, "book_id")])
    assert n(res.added) + n(res.rejects) == req.distinct().count()
    assert n(res.snapshot) == n(d.books) - n(res.added)


def test_toggle_and_order_items_conserve_requests(d):
    req = P.toggle_requests(d)
    res = ops.toggle_status(d.users, d.audit_log, req, R.as_of())
    assert n(res.added) + n(res.rejects) == n(req)
    add = P.add_item_requests(d)
    res2 = ops.order_add_items(d.orders, d.books, d.order_items, add)
    assert n(res2.added) + n(res2.rejects) == n(add)


def test_totals_equal_sum_of_lines(d):
    from quire.operators import sales
    rec = sales.receipt(d.orders, d.order_items, d.books)
    per_order = rec.groupBy("order_id").agg(F.sum("subtotal").alias("s"),
                                            F.max("lines_total").alias("t"),
                                            F.min("lines_total").alias("t2"))
    assert per_order.filter((F.col("s") != F.col("t")) | (F.col("t") != F.col("t2"))).count() == 0
    tot = sales.order_totals(d.orders, d.order_items).select("order_id", "lines_total")
    joined = per_order.join(tot, "order_id")
    assert joined.count() == per_order.count()
    assert joined.filter(F.col("s") != F.col("lines_total")).count() == 0
