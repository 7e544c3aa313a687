"""Keys of every other output of the change jobs: whole tables and rejects.

``snapshots`` registers one result per job.  Here are the tables that the jobs
change beside it and the requests that they refuse, with the reason, over the
same request tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import snapshots as ops
from ..sources.adapter import Domain
from . import register
from . import requests as R
from . import snapshots as P
from .requests import AS_OF_SQL, as_of

NEW = S.ORDER_NEW


def _refused_first(src: str, key: str, reason: str) -> str:
    """SQL of the rejects where rules come before duplicates."""
    return f"""
SELECT seq, {key}, reason FROM (SELECT r.*, {reason} AS reason FROM {src} r) t WHERE reason IS NOT NULL
UNION ALL
SELECT seq, {key}, 'duplicate request' FROM (
  SELECT * FROM (SELECT r.*, {reason} AS reason FROM {src} r) t WHERE reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY seq) > 1) d"""


def _first_then_found(src: str, key: str, table: str) -> str:
    """SQL of the rejects of keyed updates: repeats, then unknown keys."""
    return f"""
SELECT seq, {key}, reason FROM (
  SELECT seq, {key}, CASE WHEN row_number() OVER (PARTITION BY {key} ORDER BY seq) > 1 THEN 'duplicate request'
                          WHEN {key} NOT IN (SELECT {key} FROM {table}) THEN 'not found' END AS reason
  FROM {src}) t WHERE reason IS NOT NULL"""


# -- order lines added, removed, bought --------------------------------------------------------

def _orders_sql(orders: str, touched: str, lines: str) -> str:
    """All orders, those of ``touched`` with the total of their ``lines``."""
    return f"""
SELECT o.* REPLACE (CASE WHEN x.order_id IS NOT NULL THEN CAST(COALESCE(t.t, 0) AS DECIMAL(12,2)) ELSE o.total_amount END
                    AS total_amount)
FROM {orders} o LEFT JOIN (SELECT DISTINCT order_id FROM {touched}) x ON o.order_id = x.order_id
LEFT JOIN (SELECT order_id, sum(qty * price) AS t FROM {lines} GROUP BY order_id) t ON o.order_id = t.order_id"""


_ADDED_LINES = """
r_added_lines AS (
  SELECT order_id, book_id, qty, price FROM v_order_items UNION ALL SELECT order_id, book_id, qty, price FROM r_add_ok)"""


@register("order_add_items_lines", "SELECT * FROM r_added_lines", extra_ctes=P._ADD_ITEMS_SQL + "," + _ADDED_LINES)
def order_add_items_lines(d: Domain):
    """The whole line table."""
    return ops.order_add_items(d.orders, d.books, d.order_items, P.add_item_requests(d)).order_items


@register("order_add_items_orders", _orders_sql("v_orders", "r_add_ok", "r_added_lines"),
          extra_ctes=P._ADD_ITEMS_SQL + "," + _ADDED_LINES)
def order_add_items_orders(d: Domain):
    """All orders; paid and shipped ones unchanged."""
    return ops.order_add_items(d.orders, d.books, d.order_items, P.add_item_requests(d)).snapshot


@register("order_add_items_rejects", f"""
SELECT seq, order_id, reason FROM (
  SELECT r.seq, r.order_id, CASE WHEN o.order_id IS NULL THEN 'order not found'
                                 WHEN o.status IS DISTINCT FROM '{NEW}' THEN 'order not open'
                                 WHEN b.book_id IS NULL THEN 'book not found' END AS reason
  FROM r_additem r LEFT JOIN v_orders o ON r.order_id = o.order_id LEFT JOIN v_books b ON r.book_id = b.book_id
) t WHERE reason IS NOT NULL
""", extra_ctes=P._ADD_ITEMS_SQL)
def order_add_items_rejects(d: Domain):
    return ops.order_add_items(d.orders, d.books, d.order_items, P.add_item_requests(d)).rejects


_LEFT_LINES = """
r_left_lines AS (
  SELECT order_id, book_id, qty, price FROM v_order_items WHERE order_id NOT IN (SELECT order_id FROM r_rem_ok)
  UNION ALL
  SELECT order_id, book_id, CAST(q AS BIGINT), price FROM (
    SELECT order_id, book_id, CASE WHEN minus IS NULL THEN qty ELSE least(qty, upto - minus) END AS q, price FROM r_upto) u
  WHERE q IS NULL OR q > 0)"""


@register("order_remove_items_lines", "SELECT * FROM r_left_lines", extra_ctes=P._REMOVE_SQL + "," + _LEFT_LINES)
def order_remove_items_lines(d: Domain):
    """The whole line table."""
    return ops.order_remove_items(d.orders, d.order_items, P.remove_item_requests(d)).order_items


@register("order_remove_items_orders", _orders_sql("v_orders", "r_rem_ok", "r_left_lines"),
          extra_ctes=P._REMOVE_SQL + "," + _LEFT_LINES)
def order_remove_items_orders(d: Domain):
    """All orders with refreshed totals."""
    return ops.order_remove_items(d.orders, d.order_items, P.remove_item_requests(d)).snapshot


@register("order_remove_items_rejects", f"""
SELECT r.order_id, r.book_id, 'order not open' AS reason
FROM (SELECT DISTINCT order_id, book_id FROM r_rem) r JOIN v_orders o ON r.order_id = o.order_id
WHERE o.status IS DISTINCT FROM '{NEW}'
""", extra_ctes=P._REMOVE_SQL)
def order_remove_items_rejects(d: Domain):
    """Returns on orders that are paid or shipped."""
    return ops.order_remove_items(d.orders, d.order_items, P.remove_item_requests(d)).rejects


_BOUGHT = f"""
r_bought AS (
  SELECT COALESCE(r.open_order, n.new_order) AS order_id, r.book_id, r.qty, b.price
  FROM r_buy2 r LEFT JOIN r_opened n ON r.customer_id = n.customer_id JOIN v_books b ON r.book_id = b.book_id),
r_bought_lines AS (SELECT order_id, book_id, qty, price FROM v_order_items UNION ALL SELECT * FROM r_bought),
r_bought_orders AS (
  SELECT * FROM v_orders
  UNION ALL
  SELECT new_order, customer_id, {AS_OF_SQL}, '{NEW}', CAST(0 AS DECIMAL(12,2)) FROM r_opened)"""


def _buy(d: Domain):
    return ops.buy_auto(d.users, d.customers, d.orders, d.books, d.order_items, P.buy_requests(d), as_of())


@register("buy_auto_lines", "SELECT * FROM r_bought_lines", extra_ctes=P._BUY_SQL + "," + _BOUGHT)
def buy_auto_lines(d: Domain):
    """I16: the whole line table."""
    return _buy(d).order_items


@register("buy_auto_orders", _orders_sql("r_bought_orders", "r_bought", "r_bought_lines"),
          extra_ctes=P._BUY_SQL + "," + _BOUGHT)
def buy_auto_orders(d: Domain):
    """I16: all orders, the opened ones with them."""
    return _buy(d).snapshot


@register("buy_auto_rejects", """
SELECT r.seq, r.username, CASE WHEN w.customer_id IS NULL THEN 'not a customer' ELSE 'book not found' END AS reason
FROM r_buy r LEFT JOIN (SELECT u.username, c.customer_id FROM v_users u JOIN v_customers c ON u.user_id = c.user_id) w
  ON r.username = w.username
WHERE w.customer_id IS NULL OR r.book_id NOT IN (SELECT book_id FROM v_books)
""", extra_ctes=P._BUY_SQL)
def buy_auto_rejects(d: Domain):
    return _buy(d).rejects


# -- carts placed once and twice over the whole line table ---------------------------------------

_PLACED = f"""
r_whole_cart AS (
  SELECT order_id, book_id, qty, price, CAST(NULL AS BIGINT) AS customer_id FROM v_order_items
  UNION ALL SELECT order_id, book_id, qty, price, customer_id FROM r_cart_lines),
r_placing AS (
  SELECT c_custkey AS customer_id, row_number() OVER (ORDER BY c_custkey) AS n, count(*) OVER () AS total
  FROM customer WHERE c_nationkey < 10),
r_first_orders AS (
  SELECT (SELECT max(order_id) FROM v_orders) + p.n AS order_id, p.customer_id, {AS_OF_SQL} AS order_date, '{NEW}' AS status,
         CAST(COALESCE(t.t, 0) AS DECIMAL(12,2)) AS total_amount
  FROM r_placing p LEFT JOIN (SELECT customer_id, sum(qty * price) AS t FROM r_cart_lines GROUP BY customer_id) t
    ON p.customer_id = t.customer_id)"""


def _place(d: Domain, times: int):
    """The same customers place their carts ``times`` in a row."""
    lines = ops.add_to_cart(d.books, P.cart_requests(d), d.order_items).snapshot
    who = d.raw("customer").filter(F.col("c_nationkey") < 10).select(
        F.col("c_custkey").alias("seq"), F.col("c_custkey").alias("customer_id"))
    orders = d.orders
    for _ in range(times):
        res = ops.place_orders(orders, d.customers, lines, who, as_of())
        orders, lines = res.snapshot, res.order_items
    return orders, lines


_PLACED_LINES = """
SELECT COALESCE(c.order_id, f.order_id) AS order_id, c.book_id, c.qty, c.price, c.customer_id
FROM r_whole_cart c LEFT JOIN r_first_orders f ON c.customer_id = f.customer_id"""


@register("place_orders_all_lines", _PLACED_LINES, extra_ctes=P._CART_REQ_SQL + "," + _PLACED)
def place_orders_all_lines(d: Domain):
    """every line, those of earlier orders unchanged."""
    return _place(d, 1)[1]


@register("place_orders_twice_lines", _PLACED_LINES, extra_ctes=P._CART_REQ_SQL + "," + _PLACED)
def place_orders_twice_lines(d: Domain):
    """a second call moves nothing again."""
    return _place(d, 2)[1]


@register("place_orders_twice", f"""
SELECT * FROM v_orders UNION ALL SELECT * FROM r_first_orders
UNION ALL
SELECT (SELECT max(order_id) FROM v_orders) + total + n, customer_id, {AS_OF_SQL}, '{NEW}', CAST(0 AS DECIMAL(12,2)) FROM r_placing
""", extra_ctes=P._CART_REQ_SQL + "," + _PLACED)
def place_orders_twice(d: Domain):
    """all orders after two calls; the second ones are empty."""
    return _place(d, 2)[0]


@register("add_to_cart_rejects", """
SELECT seq, book_id, 'book not found' AS reason FROM r_cart WHERE book_id NOT IN (SELECT book_id FROM v_books)
""", extra_ctes=P._CART_REQ_SQL)
def add_to_cart_rejects(d: Domain):
    return ops.add_to_cart(d.books, P.cart_requests(d)).rejects


# -- accounts ------------------------------------------------------------------------------------

@register("toggle_status_users", f"""
SELECT u.* REPLACE (CASE WHEN w.user_id IS NULL THEN u.status ELSE w.new_status END AS status)
FROM v_users u LEFT JOIN ({P._first('r_toggle', 'user_id')}) w ON u.user_id = w.user_id
""", extra_ctes=P._TOGGLE_SQL)
def toggle_status_users(d: Domain):
    """All users."""
    return ops.toggle_status(d.users, d.audit_log, P.toggle_requests(d), as_of()).snapshot


@register("toggle_status_rejects", _first_then_found("r_toggle", "user_id", "v_users"), extra_ctes=P._TOGGLE_SQL)
def toggle_status_rejects(d: Domain):
    return ops.toggle_status(d.users, d.audit_log, P.toggle_requests(d), as_of()).rejects


_CALLER = f"""(SELECT ro.role_name = '{S.ROLE_ADMIN}' FROM v_users u JOIN v_roles ro ON u.role_id = ro.role_id
   WHERE u.username = r.viewer)"""


@register("security_update_rejects", _refused_first("r_sec", "username", f"""
  CASE WHEN NOT (COALESCE({_CALLER}, false) OR r.viewer IS NOT DISTINCT FROM r.username) THEN 'not allowed'
       WHEN r.username NOT IN (SELECT username FROM v_users) THEN 'not found' END"""), extra_ctes=P._SECURITY_SQL)
def security_update_rejects(d: Domain):
    return ops.security_update(d.users, d.roles, P.security_requests(d)).rejects


_RESERVED = f"WHEN r.username = '{S.RESERVED_USERNAME}' THEN 'reserved username'"
_EXISTS = "WHEN r.username IN (SELECT username FROM v_users) THEN 'exists'"


@register("add_users_rejects", _refused_first("r_signups", "username", f"""
  CASE WHEN r.role_name NOT IN (SELECT role_name FROM v_roles) THEN 'unknown role' {_RESERVED} {_EXISTS} END"""),
          extra_ctes=R.USER_SIGNUPS_SQL)
def add_users_rejects(d: Domain):
    req = R.user_signups(d).select("seq", "username", "password_hash", "role_name")
    return ops.add_users(d.users, d.roles, req, as_of()).rejects


@register("add_roles_rejects", """
SELECT seq, role_name, reason FROM (
  SELECT seq, role_name, CASE WHEN row_number() OVER (PARTITION BY role_name ORDER BY seq) > 1 THEN 'duplicate request'
                              WHEN role_name IN (SELECT role_name FROM v_roles) THEN 'exists' END AS reason
  FROM r_rolereq) t WHERE reason IS NOT NULL
""", extra_ctes=P._ROLE_REQ_SQL)
def add_roles_rejects(d: Domain):
    return ops.add_roles(d.roles, P.role_requests(d)).rejects


def _register_rejects(src: str) -> str:
    reason = f"""CASE WHEN r.username = '{S.RESERVED_USERNAME}' THEN 'reserved username' {_EXISTS}
       WHEN r.email IN (SELECT email FROM v_customers) THEN 'email exists' END"""
    return _refused_first(src, "username", reason) + """
UNION ALL
SELECT seq, username, 'email exists' FROM (
  SELECT * FROM r_ok1 WHERE email IS NOT NULL QUALIFY row_number() OVER (PARTITION BY email ORDER BY seq) > 1) e"""


@register("register_clients_rejects", _register_rejects("r_signups"),
          extra_ctes=R.USER_SIGNUPS_SQL + "," + P._register_ctes("r_signups"))
def register_clients_rejects(d: Domain):
    req = R.user_signups(d).select("seq", "username", "password_hash", "full_name", "email")
    return ops.register_clients(d.users, d.customers, d.roles, req, as_of()).rejects


@register("customer_add_rejects", f"""
SELECT seq, username, CASE WHEN NOT regexp_matches(email, '{P.EMAIL_RULE_SQL}') THEN 'bad email' ELSE 'bad phone' END AS reason
FROM r_clients_raw
WHERE NOT regexp_matches(email, '{P.EMAIL_RULE_SQL}') OR (phone IS NOT NULL AND NOT regexp_matches(phone, '{P.PHONE_RULE_SQL}'))
UNION ALL {_register_rejects('r_clients')}
""", extra_ctes=P._CLIENT_REQ_SQL + "," + P._register_ctes("r_clients"))
def customer_add_rejects(d: Domain):
    """Sign-ups refused for their e-mail or phone, or as in F3."""
    return ops.customer_add_validated(d.users, d.customers, d.roles, P.client_requests(d), as_of()).rejects


@register("upsert_users_rejects", _refused_first("r_upsert", "username", f"""
  CASE WHEN r.username NOT IN (SELECT username FROM v_users) AND r.username = '{S.RESERVED_USERNAME}'
       THEN 'reserved username' END"""), extra_ctes=P._UPSERT_REQ_SQL)
def upsert_users_rejects(d: Domain):
    return ops.upsert_users(d.users, P.upsert_requests(d), as_of()).rejects


# -- catalogue and orders ------------------------------------------------------------------------

@register("update_books_rejects", _first_then_found("r_bookupd", "book_id", "v_books"), extra_ctes=P._BOOK_UPD_SQL)
def update_books_rejects(d: Domain):
    return ops.update_books(d.books, P.book_update_requests(d)).rejects


@register("update_order_status_rejects", _first_then_found("r_status", "order_id", "v_orders"), extra_ctes=P._STATUS_REQ_SQL)
def update_order_status_rejects(d: Domain):
    return ops.update_order_status(d.orders, P.status_requests(d)).rejects


@register("product_add_rejects", """
SELECT seq, isbn, reason FROM (
  SELECT seq, isbn, CASE WHEN title IS NULL OR trim(title) = '' THEN 'title missing'
                         WHEN NOT COALESCE(price > 0, false) THEN 'bad price'
                         WHEN NOT COALESCE(stock >= 0, false) THEN 'bad stock'
                         WHEN isbn IN (SELECT isbn FROM v_books) THEN 'isbn exists' END AS reason
  FROM r_products) t WHERE reason IS NOT NULL
UNION ALL
SELECT seq, isbn, 'isbn exists' FROM (
  SELECT * FROM r_products_ok WHERE isbn IS NOT NULL QUALIFY row_number() OVER (PARTITION BY isbn ORDER BY seq) > 1) e
""", extra_ctes=P._PRODUCT_REQ_SQL)
def product_add_rejects(d: Domain):
    return ops.product_add_validated(d.books, P.product_requests(d), as_of()).rejects


@register("delete_books_rejects", """
SELECT book_id, 'referenced' AS reason FROM v_books b
WHERE stock <= 2 AND EXISTS (SELECT 1 FROM v_order_items i WHERE i.book_id = b.book_id)
""")
def delete_books_rejects(d: Domain):
    req = d.books.filter(F.col("stock") <= 2).select("book_id")
    return ops.delete_by_key(d.books, "book_id", req, [(d.order_items, "book_id")]).rejects


@register("delete_users_rejects", f"""
SELECT user_id, 'referenced' AS reason FROM v_users u
WHERE status = '{S.STATUS_BLOCKED}' AND EXISTS (SELECT 1 FROM v_customers c WHERE c.user_id = u.user_id)
""")
def delete_users_rejects(d: Domain):
    req = d.users.filter(F.col("status") == S.STATUS_BLOCKED).select("user_id")
    return ops.delete_by_key(d.users, "user_id", req, [(d.customers, "user_id")]).rejects


@register("product_delete_rejects", """
SELECT l_partkey AS book_id, 'not found' AS reason FROM lineitem WHERE false
UNION ALL
SELECT -(s_suppkey + 1), 'not found' FROM supplier
""")
def product_delete_rejects(d: Domain):
    """Suppliers ask for books that do not exist."""
    req = d.raw("supplier").select((-(F.col("s_suppkey") + 1)).alias("book_id")).unionByName(
        d.books.filter(F.col("stock") <= 2).select("book_id"))
    return ops.product_delete(d.books, d.order_items, req).rejects


@register("order_create_rejects", """
SELECT s_suppkey AS seq, -(s_suppkey + 1) AS customer_id, 'unknown customer' AS reason FROM supplier
""")
def order_create_rejects(d: Domain):
    """suppliers' numbers are no customers."""
    req = d.raw("supplier").select(F.col("s_suppkey").alias("seq"), (-(F.col("s_suppkey") + 1)).alias("customer_id"))
    known = d.customers.select((F.col("customer_id") + 1_000_000_000).alias("seq"), "customer_id")
    return ops.order_create(d.orders, d.customers, req.unionByName(known), as_of()).rejects
