"""Sales reports: order lines, the seller's order view, counts, sales by
title, popular books, order quantities and totals, receipts, dossiers.

Scale notes that apply to every function here:
* lines are aggregated (partial + final hash aggregate) to one row per key
  *before* they meet a dimension table, so a hot book or order is reduced
  map-side and joins never fan out;
* dimension joins carry no broadcast hint: AQE broadcasts a side only when
  its measured runtime size is under the broadcast threshold and otherwise
  keeps a shuffle join (with skew splitting);
* top-k reports end in ``orderBy(...).limit(n)``, planned as
  TakeOrderedAndProject (a per-partition top-n, then a merge of n rows per
  partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.combine import count_of, one_row
from ..functions.text import is_open_order


def money(c: Column) -> Column:
    return c.cast(S.MONEY_SUM)


def line_amount() -> Column:
    """qty × price of one order line."""
    return F.col("qty") * F.col("price")


def sold_lines(order_items: DataFrame) -> DataFrame:
    """Lines that belong to an order (cart lines have order_id NULL)."""
    return order_items.filter(F.col("order_id").isNotNull())


def book_sales(order_items: DataFrame) -> DataFrame:
    """One row per book: quantity sold and revenue (partial aggregation
    first, so a book with a third of all lines costs one row per task)."""
    return (sold_lines(order_items)
            .groupBy("book_id")
            .agg(F.sum("qty").cast("long").alias("qty"),
                 money(F.sum(line_amount())).alias("revenue")))


# C1 -------------------------------------------------------------------------
def order_lines(order_items: DataFrame, books: DataFrame) -> DataFrame:
    return (order_items.join(books.select("book_id", "title"), "book_id")
            .select("order_id", "book_id", "title", "qty", "price",
                    money(line_amount()).alias("subtotal")))


# C2 -------------------------------------------------------------------------
def seller_view_orders(orders: DataFrame, customers: DataFrame, order_items: DataFrame,
                       books: DataFrame) -> DataFrame:
    """All order lines with client name, title, qty and status, by order id.

    Join order is chosen (Spark keeps the written order unless CBO is on):
    orders meet customers first, so the line-sized intermediate is shuffled
    twice (by order, then by book) rather than three times when no side is
    small enough to broadcast."""
    o = orders.select("order_id", "customer_id", "status")
    c = customers.select("customer_id", F.col("full_name").alias("client"))
    li = order_items.select("order_id", "book_id", "qty")
    b = books.select("book_id", "title")
    oc = o.join(c, "customer_id")
    return (li.join(oc, "order_id").join(b, "book_id")
            .select("order_id", "client", "title", "qty", "status")
            # the other columns split an order with very many lines over tasks
            .orderBy(F.col("order_id").asc_nulls_last(), "title", "qty", "client"))


# D1 -------------------------------------------------------------------------
def view_statistics(books: DataFrame, users: DataFrame, orders: DataFrame) -> DataFrame:
    return one_row({"books": count_of(books, "books"), "users": count_of(users, "users"),
                    "orders": count_of(orders, "orders")})


# D2 -------------------------------------------------------------------------
def count_category(books: DataFrame, category: str | None = None) -> DataFrame:
    """Rows per category (batch form); with ``category`` the single count."""
    if category is not None:
        return books.filter(F.col("category") == category).agg(F.count(F.lit(1)).alias("n"))
    return books.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


# D3 -------------------------------------------------------------------------
def count_profiles(customers: DataFrame, users: DataFrame) -> DataFrame:
    return (customers.select("user_id").join(users.select("user_id"), "user_id")
            .agg(F.count(F.lit(1)).alias("n_profiles")))


# D4 -------------------------------------------------------------------------
def sales_by_title(order_items: DataFrame, books: DataFrame) -> DataFrame:
    """Quantity and revenue per title (books sharing a title merge), highest
    quantity first.  Lines are reduced per book before the join."""
    per_book = (order_items.groupBy("book_id")
                .agg(F.sum("qty").alias("qty"), F.sum(line_amount()).alias("revenue")))
    return (per_book.join(books.select("book_id", "title"), "book_id")
            .groupBy("title")
            .agg(F.sum("qty").cast("long").alias("qty"), money(F.sum("revenue")).alias("revenue"))
            .orderBy(F.col("qty").desc_nulls_first(), F.col("title").asc_nulls_last()))


# I1 -------------------------------------------------------------------------
def popular_products(order_items: DataFrame, books: DataFrame, limit: int) -> DataFrame:
    """Top ``limit`` books by quantity sold; ties by revenue, then book id.
    Only lines that belong to an order count as sold."""
    return (book_sales(order_items)
            .join(books.select("book_id", "title", "author"), "book_id")
            .select("book_id", "title", "author", "qty", "revenue")
            .orderBy(F.col("qty").desc_nulls_last(), F.col("revenue").desc_nulls_last(),
                     F.col("book_id").asc())
            .limit(limit))


# D5 -------------------------------------------------------------------------
def order_qty(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Quantity per order, 0 for orders without lines."""
    per_order = order_items.groupBy("order_id").agg(F.sum("qty").alias("q"))
    return (orders.select("order_id").join(per_order, "order_id", "left")
            .select("order_id", F.coalesce(F.col("q"), F.lit(0)).cast("long").alias("qty")))


# D6 -------------------------------------------------------------------------
def lines_total(order_items: DataFrame) -> DataFrame:
    return (sold_lines(order_items).groupBy("order_id")
            .agg(money(F.sum(line_amount())).alias("lines_total")))


def order_totals(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Σ price × qty per order (0 when the order has no lines)."""
    return (orders.select("order_id", "customer_id", "status")
            .join(lines_total(order_items), "order_id", "left")
            .select("order_id", "customer_id", "status",
                    F.coalesce(F.col("lines_total"), F.lit(0).cast(S.MONEY_SUM))
                     .alias("lines_total")))


# D7 -------------------------------------------------------------------------
def first_open_order(orders: DataFrame) -> DataFrame:
    """The open order of each customer; of several, the lowest id (the
    application takes "the first" without an order)."""
    return (orders.filter(is_open_order(F.col("status")))
            .groupBy("customer_id").agg(F.min("order_id").alias("order_id")))


# D8 -------------------------------------------------------------------------
def distinct_categories(books: DataFrame) -> DataFrame:
    return books.select("category").distinct().orderBy(F.col("category").asc_nulls_last())


# D9 -------------------------------------------------------------------------
def first_rows(books: DataFrame, n: int) -> DataFrame:
    """FETCH FIRST n ROWS; made repeatable by ordering on the key."""
    return books.orderBy(F.col("book_id").asc()).limit(n)


# D11 / I4 -------------------------------------------------------------------
def receipt(orders: DataFrame, order_items: DataFrame, books: DataFrame,
            only_orders: DataFrame | None = None) -> DataFrame:
    """Item lines with subtotal, the order's Σ lines and its stored total,
    and the difference between the two.

    The per-order Σ is an aggregate joined back on order_id rather than a
    window over the order, so an order holding a huge share of lines is
    reduced map-side and the join-back can be split by AQE.  It sums the
    receipt's own lines, so a line without a book counts in neither."""
    li = order_items
    o = orders.select("order_id", "status", "total_amount")
    if only_orders is not None:
        keys = only_orders.select("order_id").distinct()
        li = li.join(keys, "order_id", "left_semi")
        o = o.join(keys, "order_id", "left_semi")
    lines = order_lines(li, books)
    totals = lines.groupBy("order_id").agg(money(F.sum("subtotal")).alias("lines_total"))
    return (lines.join(totals, "order_id").join(o, "order_id")
            .select("order_id", "book_id", "title", "qty", "price", "subtotal", "status",
                    "lines_total", "total_amount",
                    money(F.col("total_amount") - F.col("lines_total")).alias("difference")))


# I2 -------------------------------------------------------------------------
def general_stats(orders: DataFrame, customers: DataFrame, books: DataFrame,
                  order_items: DataFrame) -> DataFrame:
    items = sold_lines(order_items).agg(
        F.coalesce(F.sum("qty"), F.lit(0)).cast("long").alias("items_sold"))
    return one_row({"orders": count_of(orders, "orders"),
                    "customers": count_of(customers, "customers"),
                    "books": count_of(books, "books"),
                    "items_sold": items})


# I3 -------------------------------------------------------------------------
def my_history(users: DataFrame, customers: DataFrame, orders: DataFrame,
               logins: DataFrame | None = None) -> DataFrame:
    """Orders per login, newest first (all logins, or those in ``logins``)."""
    u = users.select("user_id", "username")
    if logins is not None:
        u = u.join(logins.select("username").distinct(), "username", "left_semi")
    c = customers.select("customer_id", "user_id")
    o = orders.select("order_id", "customer_id", "order_date", "status", "total_amount")
    return (u.join(c, "user_id").join(o, "customer_id")
            .select("username", "order_id", "order_date", "status", "total_amount")
            .orderBy(F.col("username").asc(), F.col("order_date").desc_nulls_first(),
                     F.col("order_id").desc()))


# I8 -------------------------------------------------------------------------
def client_dossier(customers: DataFrame, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Profile plus order count, items bought and spend per customer.
    Lines are reduced per order, orders per customer, then one join."""
    per_order = (order_items.groupBy("order_id")
                 .agg(F.sum("qty").alias("items"), F.sum(line_amount()).alias("spend")))
    per_customer = (orders.select("order_id", "customer_id")
                    .join(per_order, "order_id", "left")
                    .groupBy("customer_id")
                    .agg(F.count(F.lit(1)).alias("n_orders"),
                         F.sum("items").alias("items"), F.sum("spend").alias("spend")))
    return (customers.select("customer_id", "full_name", "email", "status")
            .join(per_customer, "customer_id", "left")
            .select("customer_id", "full_name", "email", "status",
                    F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("n_orders"),
                    F.coalesce(F.col("items"), F.lit(0)).cast("long").alias("items"),
                    money(F.coalesce(F.col("spend"), F.lit(0))).alias("spend")))
