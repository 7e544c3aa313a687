"""Sales report keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import sales as ops
from ..sources.adapter import Domain
from . import register

POPULAR_LIMIT = 5        # the report's top-n (the application asks for the top 5)
FIRST_ROWS = 10          # FETCH FIRST 10 ROWS ONLY

_LINES_CTE = """
r_lines AS (
  SELECT i.order_id, i.book_id, b.title, i.qty, i.price,
         CAST(i.qty * i.price AS DECIMAL(38,2)) AS subtotal
  FROM v_order_items i JOIN v_books b ON i.book_id = b.book_id
)"""

_RECEIPT_SQL = """
SELECT l.order_id, l.book_id, l.title, l.qty, l.price, l.subtotal, o.status, t.lines_total,
       o.total_amount, CAST(o.total_amount - t.lines_total AS DECIMAL(38,2)) AS difference
FROM r_lines l
JOIN (SELECT order_id, CAST(SUM(subtotal) AS DECIMAL(38,2)) AS lines_total
      FROM r_lines GROUP BY order_id) t ON l.order_id = t.order_id
JOIN v_orders o ON l.order_id = o.order_id
"""


@register("popular_products", f"""
SELECT s.book_id, b.title, b.author, s.qty, s.revenue
FROM (SELECT book_id, CAST(SUM(qty) AS BIGINT) AS qty,
             CAST(SUM(qty * price) AS DECIMAL(38,2)) AS revenue
      FROM v_order_items WHERE order_id IS NOT NULL GROUP BY book_id) s
JOIN v_books b ON b.book_id = s.book_id
ORDER BY s.qty DESC NULLS LAST, s.revenue DESC NULLS LAST, s.book_id
LIMIT {POPULAR_LIMIT}
""")
def popular_products(d: Domain):
    """Top books by quantity sold."""
    return ops.popular_products(d.order_items, d.books, POPULAR_LIMIT)


@register("order_lines", """
SELECT i.order_id, i.book_id, b.title, i.qty, i.price,
       CAST(i.qty * i.price AS DECIMAL(38,2)) AS subtotal
FROM v_order_items i JOIN v_books b ON i.book_id = b.book_id
""")
def order_lines(d: Domain):
    """Item lines with title and subtotal."""
    return ops.order_lines(d.order_items, d.books)


@register("seller_view_orders", """
SELECT o.order_id, c.full_name AS client, b.title, i.qty, o.status
FROM v_orders o
JOIN v_customers c ON o.customer_id = c.customer_id
JOIN v_order_items i ON o.order_id = i.order_id
JOIN v_books b ON i.book_id = b.book_id
ORDER BY o.order_id
""")
def seller_view_orders(d: Domain):
    """Four-table join of all order lines."""
    return ops.seller_view_orders(d.orders, d.customers, d.order_items, d.books)


@register("view_statistics", """
SELECT (SELECT count(*) FROM v_books) AS books, (SELECT count(*) FROM v_users) AS users,
       (SELECT count(*) FROM v_orders) AS orders
""")
def view_statistics(d: Domain):
    """Row counts of books, users and orders."""
    return ops.view_statistics(d.books, d.users, d.orders)


@register("count_category", """
SELECT category, count(*) AS n FROM v_books GROUP BY category
""")
def count_category(d: Domain):
    """Filtered count, batch form (every category at once)."""
    return ops.count_category(d.books)


@register("count_profiles", """
SELECT count(*) AS n_profiles FROM v_customers c JOIN v_users u ON c.user_id = u.user_id
""")
def count_profiles(d: Domain):
    """D3: count over a join."""
    return ops.count_profiles(d.customers, d.users)


@register("sales_by_title", """
SELECT b.title, CAST(SUM(i.qty) AS BIGINT) AS qty,
       CAST(SUM(i.qty * i.price) AS DECIMAL(38,2)) AS revenue
FROM v_order_items i JOIN v_books b ON i.book_id = b.book_id
GROUP BY b.title ORDER BY qty DESC NULLS FIRST
""")
def sales_by_title(d: Domain):
    """Quantity and revenue per title."""
    return ops.sales_by_title(d.order_items, d.books)


@register("order_qty", """
SELECT o.order_id, CAST(COALESCE(q.q, 0) AS BIGINT) AS qty
FROM v_orders o LEFT JOIN (SELECT order_id, SUM(qty) AS q FROM v_order_items GROUP BY order_id) q
  ON o.order_id = q.order_id
""")
def order_qty(d: Domain):
    """Quantity per order, NULL to 0."""
    return ops.order_qty(d.orders, d.order_items)


@register("order_totals", """
SELECT o.order_id, o.customer_id, o.status,
       COALESCE(t.lines_total, CAST(0 AS DECIMAL(38,2))) AS lines_total
FROM v_orders o LEFT JOIN (
  SELECT order_id, CAST(SUM(qty * price) AS DECIMAL(38,2)) AS lines_total
  FROM v_order_items WHERE order_id IS NOT NULL GROUP BY order_id) t ON o.order_id = t.order_id
""")
def order_totals(d: Domain):
    """Order total = Σ price × qty of its lines."""
    return ops.order_totals(d.orders, d.order_items)


@register("first_open_order", f"""
SELECT customer_id, min(order_id) AS order_id FROM v_orders
WHERE status = '{S.ORDER_NEW}' GROUP BY customer_id
""")
def first_open_order(d: Domain):
    """One open order per customer (lowest id)."""
    return ops.first_open_order(d.orders)


@register("distinct_categories", """
SELECT DISTINCT category FROM v_books ORDER BY 1 NULLS LAST
""")
def distinct_categories(d: Domain):
    """SELECT DISTINCT category ORDER BY 1."""
    return ops.distinct_categories(d.books)


@register("first_rows", f"""
SELECT * FROM v_books ORDER BY book_id LIMIT {FIRST_ROWS}
""")
def first_rows(d: Domain):
    """FETCH FIRST n ROWS (ordered by key so it repeats)."""
    return ops.first_rows(d.books, FIRST_ROWS)


@register("receipt", _RECEIPT_SQL, extra_ctes=_LINES_CTE)
def receipt(d: Domain):
    """Receipt lines with the order's Σ lines and stored total."""
    return ops.receipt(d.orders, d.order_items, d.books)


@register("order_details", _RECEIPT_SQL + f"WHERE o.status = '{S.ORDER_NEW}'\n",
          extra_ctes=_LINES_CTE)
def order_details(d: Domain):
    """I4: receipt of the requested orders (here: every open order)."""
    requested = d.orders.filter(F.col("status") == S.ORDER_NEW).select("order_id")
    return ops.receipt(d.orders, d.order_items, d.books, only_orders=requested)


@register("general_stats", """
SELECT (SELECT count(*) FROM v_orders) AS orders, (SELECT count(*) FROM v_customers) AS customers,
       (SELECT count(*) FROM v_books) AS books,
       (SELECT CAST(COALESCE(SUM(qty), 0) AS BIGINT) FROM v_order_items
         WHERE order_id IS NOT NULL) AS items_sold
""")
def general_stats(d: Domain):
    """Orders, customers, books, items sold."""
    return ops.general_stats(d.orders, d.customers, d.books, d.order_items)


@register("my_history", """
SELECT u.username, o.order_id, o.order_date, o.status, o.total_amount
FROM v_users u JOIN v_customers c ON u.user_id = c.user_id
JOIN v_orders o ON o.customer_id = c.customer_id
ORDER BY u.username, o.order_date DESC, o.order_id DESC
""")
def my_history(d: Domain):
    """Order history of every login, newest first."""
    return ops.my_history(d.users, d.customers, d.orders)


@register("client_dossier", """
SELECT c.customer_id, c.full_name, c.email, c.status,
       CAST(COALESCE(pc.n_orders, 0) AS BIGINT) AS n_orders,
       CAST(COALESCE(pc.items, 0) AS BIGINT) AS items,
       CAST(COALESCE(pc.spend, 0) AS DECIMAL(38,2)) AS spend
FROM v_customers c LEFT JOIN (
  SELECT o.customer_id, count(*) AS n_orders, SUM(po.items) AS items, SUM(po.spend) AS spend
  FROM v_orders o LEFT JOIN (
    SELECT order_id, SUM(qty) AS items, SUM(qty * price) AS spend
    FROM v_order_items GROUP BY order_id) po ON o.order_id = po.order_id
  GROUP BY o.customer_id) pc ON c.customer_id = pc.customer_id
""")
def client_dossier(d: Domain):
    """I8: profile, order count, items and spend per customer."""
    return ops.client_dossier(d.customers, d.orders, d.order_items)
