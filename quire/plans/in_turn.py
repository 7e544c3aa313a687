"""Keys of the jobs that apply several changes of one key in turn."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import in_turn as ops
from ..sources.adapter import Domain
from . import register
from .requests import SEQ_EXISTING
from .snapshots import _TOGGLE_SQL, toggle_requests

# Every order line asks for a change of its book: most books are changed many
# times, popular ones most often.  (order, line) pairs repeat, so ties occur.
_LINE_REQ_SQL = f"""
r_lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS seq, l_partkey AS book_id,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS stock
  FROM lineitem
  UNION ALL
  SELECT s_suppkey + {SEQ_EXISTING}, -(s_suppkey + 1), CAST(1 AS DECIMAL(10,2)), CAST(1 AS BIGINT) FROM supplier
),
r_line_last AS (
  SELECT * FROM r_lines
  QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY seq DESC, price DESC, stock DESC NULLS LAST) = 1
)"""


def line_requests(d: Domain):
    """UpdateBook per order line: its price, and its quantity as stock (cleared
    for returned lines); suppliers name books that do not exist."""
    li = d.raw("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.col("l_partkey").alias("book_id"),
        F.col("l_extendedprice").cast(S.PRICE).alias("price"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_quantity").cast("long")).alias("stock"))
    unknown = d.raw("supplier").select(
        (F.col("s_suppkey") + SEQ_EXISTING).alias("seq"), (-(F.col("s_suppkey") + 1)).alias("book_id"),
        F.lit(1).cast(S.PRICE).alias("price"), F.lit(1).cast("long").alias("stock"))
    return li.unionByName(unknown)


@register("update_books_in_turn", """
SELECT b.* REPLACE (CASE WHEN w.book_id IS NULL THEN b.price ELSE w.price END AS price,
                    CASE WHEN w.book_id IS NULL THEN b.stock ELSE w.stock END AS stock)
FROM v_books b LEFT JOIN r_line_last w ON b.book_id = w.book_id
""", extra_ctes=_LINE_REQ_SQL)
def update_books_in_turn(d: Domain):
    """a price and stock request per order line, applied in turn."""
    return ops.update_books(d.books, line_requests(d)).snapshot


@register("update_books_in_turn_rejects", """
SELECT seq, book_id, 'not found' AS reason FROM r_lines WHERE book_id NOT IN (SELECT book_id FROM v_books)
""", extra_ctes=_LINE_REQ_SQL)
def update_books_in_turn_rejects(d: Domain):
    return ops.update_books(d.books, line_requests(d)).rejects


_EDIT_LINES_SQL = """
r_edits AS (
  SELECT l_orderkey * 10 + l_linenumber AS seq, l_partkey AS book_id,
         CASE WHEN l_linenumber = 1 THEN 'Edition ' || CAST(l_orderkey AS VARCHAR) END AS title,
         CASE WHEN l_returnflag = 'R' THEN 'Author ' || CAST(l_suppkey AS VARCHAR) END AS author,
         CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS DECIMAL(10,2)) END AS price,
         CASE WHEN l_linenumber > 3 THEN CAST(l_quantity AS BIGINT) END AS stock,
         CAST(NULL AS VARCHAR) AS category
  FROM lineitem
),
r_edit_last AS (
  SELECT book_id,
         arg_max(title, {'a': seq, 'c': coalesce(author, ''), 'd': coalesce(price, -1), 'e': coalesce(stock, -1), 't': title})
           FILTER (title IS NOT NULL) AS title,
         arg_max(author, {'a': seq, 'b': coalesce(title, ''), 'c': author}) FILTER (author IS NOT NULL) AS author,
         arg_max(price, {'a': seq, 'b': coalesce(title, ''), 'c': coalesce(author, ''), 'd': price}) FILTER (price IS NOT NULL) AS price,
         arg_max(stock, {'a': seq, 'b': coalesce(title, ''), 'c': coalesce(author, ''), 'd': coalesce(price, -1), 'e': stock})
           FILTER (stock IS NOT NULL) AS stock
  FROM r_edits GROUP BY book_id
)"""


def edit_lines(d: Domain):
    """MANAGE_PRODUCT_EDIT per order line: each names some of the columns."""
    li = d.raw("lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.col("l_partkey").alias("book_id"),
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("Edition "), F.col("l_orderkey").cast("string"))).alias("new_title"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("Author "), F.col("l_suppkey").cast("string"))).alias("new_author"),
        F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice").cast(S.PRICE)).alias("new_price"),
        F.when(F.col("l_linenumber") > 3, F.col("l_quantity").cast("long")).alias("new_stock"),
        F.lit(None).cast("string").alias("new_category"))


@register("product_edit_in_turn", """
SELECT b.* REPLACE (coalesce(e.title, b.title) AS title, coalesce(e.author, b.author) AS author,
    coalesce(e.price, b.price) AS price, coalesce(e.stock, b.stock) AS stock,
    CASE WHEN e.book_id IS NOT NULL AND b.discount_percent IS NOT NULL
         THEN CAST(coalesce(e.price, b.price) * (100 - b.discount_percent) * 0.01 AS DECIMAL(10,2))
         ELSE b.price_after_discount END AS price_after_discount)
FROM v_books b LEFT JOIN r_edit_last e ON b.book_id = e.book_id
""", extra_ctes=_EDIT_LINES_SQL)
def product_edit_in_turn(d: Domain):
    """Partial edits, many per book, composed column by column."""
    return ops.product_edit(d.books, edit_lines(d)).snapshot


_MOVES_SQL = f"""
r_moves AS (
  SELECT o_orderkey AS seq, c_name AS username, 'Ship to order ' || CAST(o_orderkey AS VARCHAR) AS address,
         CASE WHEN o_orderpriority = '1-URGENT' THEN '+7-' || CAST(o_orderkey AS VARCHAR) END AS phone,
         CASE WHEN o_orderstatus = 'P' THEN lower(c_mktsegment) || '.' || CAST(c_nationkey AS VARCHAR) || '@new.example.org'
              WHEN o_orderpriority = '5-LOW' THEN
                CASE WHEN o_orderstatus = 'F' THEN lower(c_name) || '@example.org'
                     ELSE 'customer#000000001@example.org' END END AS email
  FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL
  SELECT s_suppkey + {SEQ_EXISTING}, s_name, 'nowhere', NULL, NULL FROM supplier
),
r_move_who AS (
  SELECT r.*, w.customer_id,
         (SELECT min(c.customer_id) FROM v_customers c WHERE c.email = r.email) AS holder
  FROM r_moves r LEFT JOIN (SELECT u.username, c.customer_id FROM v_users u JOIN v_customers c ON u.user_id = c.user_id) w
    ON r.username = w.username
),
r_move_free AS (SELECT * FROM r_move_who WHERE customer_id IS NOT NULL AND (holder IS NULL OR holder = customer_id)),
r_takers AS (SELECT email, arg_min(customer_id, seq) AS taker FROM r_move_free WHERE email IS NOT NULL GROUP BY email),
r_move_ok AS (
  SELECT f.* FROM r_move_free f LEFT JOIN r_takers t ON f.email = t.email WHERE t.taker IS NULL OR t.taker = f.customer_id),
r_moved AS (
  SELECT customer_id, arg_max(address, seq) AS address, arg_max(phone, seq) FILTER (phone IS NOT NULL) AS phone,
         arg_max(email, seq) FILTER (email IS NOT NULL) AS email
  FROM r_move_ok GROUP BY customer_id
)"""


def move_requests(d: Domain):
    """MANAGE_CUSTOMER_DATA_UPDATE per order: a new address each, a phone for
    urgent ones; customers of one segment and nation ask for the same new
    e-mail, some for their own, some for customer 1's; suppliers have no login."""
    o, c = d.raw("orders"), d.raw("customer").withColumnRenamed("c_custkey", "o_custkey")
    low, status = F.col("o_orderpriority") == "5-LOW", F.col("o_orderstatus")
    wanted = F.concat(F.lower("c_mktsegment"), F.lit("."), F.col("c_nationkey").cast("string"), F.lit("@new.example.org"))
    email = (F.when(status == "P", wanted)
             .when(low & (status == "F"), F.concat(F.lower("c_name"), F.lit("@example.org")))
             .when(low, F.lit("customer#000000001@example.org")))
    key = F.col("o_orderkey").cast("string")
    a = o.join(c, "o_custkey").select(
        F.col("o_orderkey").alias("seq"), F.col("c_name").alias("username"),
        F.concat(F.lit("Ship to order "), key).alias("new_address"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("+7-"), key)).alias("new_phone"),
        F.lit(None).cast("string").alias("new_full_name"), email.alias("new_email"))
    none = F.lit(None).cast("string")
    return a.unionByName(d.raw("supplier").select(
        (F.col("s_suppkey") + SEQ_EXISTING).alias("seq"), F.col("s_name").alias("username"), F.lit("nowhere").alias("new_address"),
        none.alias("new_phone"), none.alias("new_full_name"), none.alias("new_email")))


@register("contact_update_in_turn", """
SELECT c.* REPLACE (coalesce(m.address, c.address) AS address, coalesce(m.phone, c.phone) AS phone,
                    coalesce(m.email, c.email) AS email)
FROM v_customers c LEFT JOIN r_moved m ON c.customer_id = m.customer_id
""", extra_ctes=_MOVES_SQL)
def contact_update_in_turn(d: Domain):
    """Profile changes per order in turn, e-mails kept unique."""
    return ops.contact_update(d.users, d.customers, move_requests(d)).snapshot


@register("contact_update_in_turn_rejects", """
SELECT seq, username, CASE WHEN customer_id IS NULL THEN 'no profile' ELSE 'email exists' END AS reason
FROM r_move_who WHERE seq NOT IN (SELECT seq FROM r_move_ok)
""", extra_ctes=_MOVES_SQL)
def contact_update_in_turn_rejects(d: Domain):
    return ops.contact_update(d.users, d.customers, move_requests(d)).rejects


@register("toggle_status_in_turn", """
SELECT u.* REPLACE (CASE WHEN t.user_id IS NULL THEN u.status ELSE t.status END AS status)
FROM v_users u LEFT JOIN (SELECT user_id, arg_max(new_status, seq) AS status FROM r_toggle GROUP BY user_id) t
  ON u.user_id = t.user_id
""", extra_ctes=_TOGGLE_SQL)
def toggle_status_in_turn(d: Domain):
    """Blocked for review, then unblocked in the same batch."""
    return ops.toggle_status(d.users, toggle_requests(d)).snapshot
