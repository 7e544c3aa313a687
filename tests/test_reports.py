"""Reports on small literal tables: empty inputs, NULL keys, orders without
lines, shared titles and isbns (FIXTURES §6)."""

from decimal import Decimal

import pytest

from quire import schemas as S
from quire.operators import accounts as acc
from quire.operators import catalog as cat
from quire.operators import quality as q
from quire.operators import sales

D = Decimal


def book(i, title, isbn=None, price="10.00", stock=1, category="C", archived=0):
    return (i, isbn, title, "A", None if price is None else D(price), stock, category, None, None,
            None, None, None, archived)


@pytest.fixture
def books(spark):
    return spark.createDataFrame([book(1, "Same", "i-1"), book(2, "Same", "i-1"),
                                  book(3, "Other", "i-3", category=None),
                                  book(4, "Gone", "i-4", archived=1)], S.BOOKS_SCHEMA)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([(1, 10, None, S.ORDER_NEW, D("5.00")),
                                  (2, 10, None, S.ORDER_PAID, D("7.00")),
                                  (3, None, None, None, None)], S.ORDERS_SCHEMA)


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(None, 1, 1, 2, D("3.00")), (None, 1, 2, 1, D("4.00")),
                                  (None, 1, None, 5, D("1.00")), (None, None, 3, 9, D("1.00"))],
                                 S.ORDER_ITEMS_SCHEMA).drop("order_item_id")


def test_empty_inputs_give_empty_or_zero_results(spark):
    e_books = spark.createDataFrame([], S.BOOKS_SCHEMA)
    e_items = spark.createDataFrame([], S.ORDER_ITEMS_SCHEMA).drop("order_item_id")
    e_orders = spark.createDataFrame([], S.ORDERS_SCHEMA)
    e_users = spark.createDataFrame([], S.USERS_SCHEMA)
    assert sales.popular_products(e_items, e_books, 5).count() == 0
    assert sales.sales_by_title(e_items, e_books).count() == 0
    assert sales.order_qty(e_orders, e_items).count() == 0
    st = sales.view_statistics(e_books, e_users, e_orders).first()
    assert (st.books, st.users, st.orders) == (0, 0, 0)
    cust = spark.createDataFrame([], S.CUSTOMERS_SCHEMA)
    g = sales.general_stats(e_orders, cust, e_books, e_items).first()
    assert g.items_sold == 0
    assert cat.search_books(e_books, "x").count() == 0


def test_order_without_lines_has_zero_quantity_and_total(orders, items):
    qty = {r.order_id: r.qty for r in sales.order_qty(orders, items).collect()}
    assert qty == {1: 8, 2: 0, 3: 0}
    tot = {r.order_id: r.lines_total for r in sales.order_totals(orders, items).collect()}
    assert tot == {1: D("15.00"), 2: D("0.00"), 3: D("0.00")}


def test_shared_title_merges_in_sales_by_title(books, items):
    rows = {r.title: (r.qty, r.revenue) for r in sales.sales_by_title(items, books).collect()}
    # books 1 and 2 share a title; the line without a book id joins nothing
    assert rows == {"Same": (3, D("10.00")), "Other": (9, D("9.00"))}


def test_receipt_reconciles_lines_with_stored_total(orders, items, books):
    r = sales.receipt(orders, items, books).filter("order_id = 1").collect()
    assert {x.lines_total for x in r} == {D("10.00")}
    assert {x.difference for x in r} == {D("-5.00")}


def test_resolve_book_lowest_id_for_shared_isbn_and_title(spark, books):
    req = spark.createDataFrame([(1, "i-1", None), (2, "nope", "Same"), (3, None, None),
                                 (4, "nope", "nope")], "seq long, isbn string, title string")
    got = {r.seq: (r.book_id, r.matched_by) for r in acc.resolve_book(req, books).collect()}
    assert got == {1: (1, "isbn"), 2: (1, "title"), 3: (None, None), 4: (None, None)}


def test_null_category_and_archived_books_in_searches(books):
    assert {r.book_id for r in cat.search_category(books, None).collect()} == {1, 2, 4}
    assert {r.book_id for r in cat.search_books(books, keyword="o").collect()} == {3}
    assert {r.category for r in sales.distinct_categories(books).collect()} == {"C", None}


def test_key_exists_counts_duplicates_and_absent_keys(spark, books):
    req = spark.createDataFrame([(1,), (1,), (99,), (None,)], "book_id long")
    got = {r.book_id: r.n_matches for r in cat.key_exists(req, books, "book_id").collect()}
    assert got == {1: 1, 99: 0, None: 0}


def test_fk_violations_and_duplicate_keys(spark, books, orders, items):
    edges = [("order_items.order_id->orders", items, "order_id", orders, "order_id"),
             ("order_items.book_id->books", items, "book_id", books, "book_id")]
    assert q.fk_violations(edges).count() == 0
    dup = q.duplicate_keys("books", books, "isbn").collect()
    assert [(r.key_value, r.n) for r in dup] == [("i-1", 2)]


def test_column_profile_exact_and_approximate(spark, small_dir):
    from quire.operators import layout
    from quire.sources.adapter import Domain
    books = Domain(spark, small_dir).books.select("book_id", "title", "category", "price")
    exact = {r.column_name: r for r in layout.column_profile(books).collect()}
    approx = {r.column_name: r for r in layout.column_profile(books, exact=False).collect()}
    assert exact["category"].n_distinct == books.select("category").distinct().count()
    for c, r in exact.items():
        assert (r.n_rows, r.n_nulls, r.min_value, r.max_value) == \
            (approx[c].n_rows, approx[c].n_nulls, approx[c].min_value, approx[c].max_value)
        # HyperLogLog's default relative standard deviation is 5 %: allow 3 sigma
        assert abs(approx[c].n_distinct - r.n_distinct) <= max(2, 0.15 * r.n_distinct)
