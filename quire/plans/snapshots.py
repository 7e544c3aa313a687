"""Snapshot-transform keys.

Each key builds its request table from the input tables (rules in the
docstrings), applies one job and returns the new snapshot or the new rows.
The SQL side states the same rules for DuckDB; ids there are
``max(id) + row_number() OVER (ORDER BY seq)``, which is what the Spark id
assignment must equal.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.ids import assign_ids
from ..functions.text import password_hash
from ..operators import snapshots as ops
from ..operators.catalog import archived_check as archived_check_op
from ..sources.adapter import Domain
from . import register
from . import requests as R
from .requests import AS_OF_SQL, SEQ_EXISTING, SEQ_SECOND, as_of

TS = AS_OF_SQL
NEW = S.ORDER_NEW
SHIP_BEFORE = "1997-01-01 00:00:00"    # paid orders placed before this get shipped
RECATEGORISE = {"ECONOMY": "Учебная литература"}


def _first(src: str, key: str) -> str:
    """SQL: rows of ``src`` that hold the lowest seq of their key."""
    return (f"SELECT * FROM {src} x WHERE x.seq = "
            f"(SELECT min(y.seq) FROM {src} y WHERE y.{key} = x.{key})")


# ---------------------------------------------------------------------------
# ids
# ---------------------------------------------------------------------------
@register("assign_ids", """
SELECT (SELECT max(user_id) FROM v_users) + row_number() OVER (ORDER BY s_name, s_suppkey)
         AS user_id, s_name AS username
FROM supplier
""")
def assign_ids_q(d: Domain):
    """one new user per supplier, ids after the current maximum in name
    order (range-partitioned numbering, no single-task window)."""
    s = d.raw("supplier").select(F.col("s_suppkey").alias("seq"), F.col("s_name").alias("username"))
    out = assign_ids(s, ["username", "seq"], "user_id", base_from=(d.users, "user_id"))
    return out.select("user_id", "username")


# ---------------------------------------------------------------------------
# Add users / roles if absent
# ---------------------------------------------------------------------------
_SIGNUP_OK_SQL = R.USER_SIGNUPS_SQL + f""",
r_signup_ok AS (
  SELECT w.*, ro.role_id FROM r_signups w JOIN v_roles ro ON w.role_name = ro.role_name
  WHERE w.username IS DISTINCT FROM '{S.RESERVED_USERNAME}'
    AND NOT EXISTS (SELECT 1 FROM v_users u WHERE u.username = w.username)
)"""


@register("add_users_new", f"""
SELECT (SELECT max(user_id) FROM v_users) + row_number() OVER (ORDER BY w.seq) AS user_id,
       w.username, w.password_hash, w.role_id, '{S.STATUS_ACTIVE}' AS status, {TS} AS created_at
FROM ({_first('r_signup_ok', 'username')}) w
""", extra_ctes=_SIGNUP_OK_SQL)
def add_users_new(d: Domain):
    """AddUser for every sign-up; returns the inserted users."""
    req = R.user_signups(d).select("seq", "username", "password_hash", "role_name")
    return ops.add_users(d.users, d.roles, req, as_of()).added


_ROLE_REQ_SQL = f"""
r_rolereq AS (
  SELECT c_custkey AS seq,
         CASE WHEN c_nationkey = 1 THEN '{S.ROLE_SELLER}' ELSE c_mktsegment END AS role_name
  FROM customer
),
r_new_roles AS (
  SELECT (SELECT max(role_id) FROM v_roles) + row_number() OVER (ORDER BY seq) AS role_id, role_name
  FROM (SELECT role_name, min(seq) AS seq FROM r_rolereq WHERE role_name IS NOT NULL
        GROUP BY role_name) x
  WHERE role_name NOT IN (SELECT role_name FROM v_roles)
)"""


def role_requests(d: Domain):
    """Each customer asks for a role named after their market segment
    (nation 1 asks for the existing Seller role)."""
    c = d.raw("customer")
    return c.select(F.col("c_custkey").alias("seq"),
                    F.when(F.col("c_nationkey") == 1, F.lit(S.ROLE_SELLER))
                     .otherwise(F.col("c_mktsegment")).alias("role_name"))


@register("add_roles_new", "SELECT role_id, role_name FROM r_new_roles", extra_ctes=_ROLE_REQ_SQL)
def add_roles_new(d: Domain):
    """AddRole for a batch; returns the inserted roles."""
    return ops.add_roles(d.roles, role_requests(d)).added


# ---------------------------------------------------------------------------
# registration
# ---------------------------------------------------------------------------
_REGISTER_TAIL = f"""
SELECT (SELECT max(user_id) FROM v_users) + row_number() OVER (ORDER BY seq) AS user_id,
       (SELECT max(customer_id) FROM v_customers) + row_number() OVER (ORDER BY seq) AS customer_id,
       username, (SELECT role_id FROM v_roles WHERE role_name = '{S.ROLE_CUSTOMER}') AS role_id,
       full_name, email{{phone}}
FROM r_ok2
"""


def _register_ctes(src: str) -> str:
    return f"""
r_ok0 AS (
  SELECT * FROM {src} r
  WHERE username IS DISTINCT FROM '{S.RESERVED_USERNAME}'
    AND NOT EXISTS (SELECT 1 FROM v_users u WHERE u.username = r.username)
    AND NOT EXISTS (SELECT 1 FROM v_customers c WHERE c.email = r.email)
),
r_ok1 AS ({_first('r_ok0', 'username')}),
r_ok2 AS (
  SELECT * FROM r_ok1 WHERE email IS NULL
     OR seq = (SELECT min(seq) FROM r_ok1 o2 WHERE o2.email = r_ok1.email)
)"""


@register("register_clients", _REGISTER_TAIL.format(phone=""),
          extra_ctes=R.USER_SIGNUPS_SQL + "," + _register_ctes("r_signups"))
def register_clients(d: Domain):
    """Register every sign-up as a client (user + profile)."""
    req = R.user_signups(d).select("seq", "username", "password_hash", "full_name", "email")
    return ops.register_clients(d.users, d.customers, d.roles, req, as_of()).added


EMAIL_RULE_SQL = ops.EMAIL_RULE.replace("'", "''")
PHONE_RULE_SQL = ops.PHONE_RULE.replace("'", "''")

_CLIENT_REQ_SQL = f"""
r_clients_raw AS (
  SELECT s_suppkey AS seq, lower(s_name) AS username, s_name || '#pw' AS password,
         s_name AS full_name,
         CASE WHEN s_nationkey % 5 = 0 THEN replace(lower(s_name), '#', '')
              ELSE replace(lower(s_name), '#', '.') || '@mail.example.org' END AS email,
         CASE WHEN s_nationkey % 7 = 0 THEN 'call me'
              ELSE '+7 900 ' || CAST(s_suppkey AS VARCHAR) END AS phone
  FROM supplier
),
r_clients AS (
  SELECT seq, username, upper(sha256(password)) AS password_hash, full_name, email, phone
  FROM r_clients_raw
  WHERE regexp_matches(email, '{EMAIL_RULE_SQL}')
    AND (phone IS NULL OR regexp_matches(phone, '{PHONE_RULE_SQL}'))
)"""


def client_requests(d: Domain):
    """One client sign-up per supplier: nations divisible by 5 give an
    email without '@', nations divisible by 7 a phone that is not a number."""
    s = d.raw("supplier")
    name = F.lower(F.col("s_name"))
    return s.select(
        F.col("s_suppkey").alias("seq"), name.alias("username"),
        F.concat(F.col("s_name"), F.lit("#pw")).alias("password"),
        F.col("s_name").alias("full_name"),
        F.when(F.col("s_nationkey") % 5 == 0, F.replace(name, F.lit("#"), F.lit("")))
         .otherwise(F.concat(F.replace(name, F.lit("#"), F.lit(".")),
                             F.lit("@mail.example.org"))).alias("email"),
        F.when(F.col("s_nationkey") % 7 == 0, F.lit("call me"))
         .otherwise(F.concat(F.lit("+7 900 "), F.col("s_suppkey").cast("string"))).alias("phone"))


@register("customer_add_validated", _REGISTER_TAIL.format(phone=", phone"),
          extra_ctes=_CLIENT_REQ_SQL + "," + _register_ctes("r_clients"))
def customer_add_validated(d: Domain):
    """Client sign-ups with email / phone validation and hashing."""
    return ops.customer_add_validated(d.users, d.customers, d.roles, client_requests(d),
                                      as_of()).added


# ---------------------------------------------------------------------------
# MERGE INTO users
# ---------------------------------------------------------------------------
_UPSERT_REQ_SQL = f"""
r_upsert AS (
  SELECT s_suppkey AS seq, s_name AS username, upper(sha256(s_name)) AS password_hash,
         CAST(2 AS BIGINT) AS role_id, '{S.STATUS_ACTIVE}' AS status FROM supplier
  UNION ALL
  SELECT s_suppkey + {SEQ_SECOND}, s_name, upper(sha256(s_name)), CAST(1 AS BIGINT),
         '{S.STATUS_BLOCKED}' FROM supplier WHERE s_nationkey < 5
  UNION ALL
  SELECT c_custkey + {SEQ_EXISTING}, c_name, upper(sha256(c_name)), CAST(3 AS BIGINT),
         '{S.STATUS_ACTIVE}' FROM customer WHERE c_nationkey = 1
),
r_upsert_w AS ({_first('r_upsert', 'username')})"""


def upsert_requests(d: Domain):
    """Suppliers join as sellers (nations 0–4 send a second, later request);
    customers of nation 1 become admins."""
    s, c = d.raw("supplier"), d.raw("customer")
    a = s.select(F.col("s_suppkey").alias("seq"), F.col("s_name").alias("username"),
                 F.lit(2).cast("long").alias("role_id"), F.lit(S.STATUS_ACTIVE).alias("status"))
    b = s.filter(F.col("s_nationkey") < 5).select(
        (F.col("s_suppkey") + SEQ_SECOND).alias("seq"), F.col("s_name").alias("username"),
        F.lit(1).cast("long").alias("role_id"), F.lit(S.STATUS_BLOCKED).alias("status"))
    e = c.filter(F.col("c_nationkey") == 1).select(
        (F.col("c_custkey") + SEQ_EXISTING).alias("seq"), F.col("c_name").alias("username"),
        F.lit(3).cast("long").alias("role_id"), F.lit(S.STATUS_ACTIVE).alias("status"))
    r = a.unionByName(b).unionByName(e)
    return r.withColumn("password_hash", password_hash(F.col("username")))


@register("upsert_users", f"""
SELECT u.user_id, u.username, u.password_hash,
       CASE WHEN w.username IS NOT NULL THEN w.role_id ELSE u.role_id END AS role_id,
       CASE WHEN w.username IS NOT NULL THEN w.status ELSE u.status END AS status, u.created_at
FROM v_users u LEFT JOIN r_upsert_w w ON u.username = w.username
UNION ALL
SELECT (SELECT max(user_id) FROM v_users) + row_number() OVER (ORDER BY seq), username,
       password_hash, role_id, status, {TS}
FROM r_upsert_w w
WHERE NOT EXISTS (SELECT 1 FROM v_users u WHERE u.username = w.username)
  AND username IS DISTINCT FROM '{S.RESERVED_USERNAME}'
""", extra_ctes=_UPSERT_REQ_SQL)
def upsert_users(d: Domain):
    """MERGE of role/status changes and new users; new users snapshot."""
    return ops.upsert_users(d.users, upsert_requests(d), as_of()).snapshot


# ---------------------------------------------------------------------------
# defaults
# ---------------------------------------------------------------------------
@register("apply_defaults", f"""
SELECT s_name AS username, '{S.STATUS_ACTIVE}' AS status, {TS} AS created_at,
       'absent' AS batch FROM supplier
UNION ALL
SELECT s_name, CAST(NULL AS VARCHAR), {TS}, 'explicit null' FROM supplier WHERE s_nationkey < 5
""")
def apply_defaults(d: Domain):
    """status/created_at take their defaults when the insert omits the
    column; an explicit NULL status stays NULL."""
    s = d.raw("supplier")
    absent = s.select(F.col("s_name").alias("username"))
    given = s.filter(F.col("s_nationkey") < 5).select(
        F.col("s_name").alias("username"), F.lit(None).cast("string").alias("status"))
    a = ops.apply_defaults(absent, "users", as_of()).withColumn("batch", F.lit("absent"))
    b = ops.apply_defaults(given, "users", as_of()).withColumn("batch", F.lit("explicit null"))
    cols = ["username", "status", "created_at", "batch"]
    return a.select(*cols).unionByName(b.select(*cols))


# ---------------------------------------------------------------------------
# INSERT ... SELECT
# ---------------------------------------------------------------------------
# Fixed values used by the application's profile-creating INSERT ... SELECT.
PROFILE_NAME_PREFIX = "Тестовый Клиент "
PROFILE_EMAIL_SUFFIX = "@mail.com"
PROFILE_PHONE = "+375290000000"
PROFILE_ADDRESS = "Адрес по умолчанию"


@register("insert_select_profile", f"""
SELECT (SELECT max(customer_id) FROM v_customers) + row_number() OVER (ORDER BY u.user_id)
         AS customer_id,
       u.user_id, '{PROFILE_NAME_PREFIX}' || upper(u.username) AS full_name,
       upper(u.username) || '{PROFILE_EMAIL_SUFFIX}' AS email, '{PROFILE_PHONE}' AS phone,
       '{PROFILE_ADDRESS}' AS address
FROM v_users u WHERE NOT EXISTS (SELECT 1 FROM v_customers c WHERE c.user_id = u.user_id)
""")
def insert_select_profile(d: Domain):
    """A default profile for every user that has none."""
    missing = d.users.join(d.customers.select("user_id"), "user_id", "left_anti")
    rows = missing.select(
        F.col("user_id").alias("seq"), "user_id",
        F.concat(F.lit(PROFILE_NAME_PREFIX), F.upper("username")).alias("full_name"),
        F.concat(F.upper("username"), F.lit(PROFILE_EMAIL_SUFFIX)).alias("email"),
        F.lit(PROFILE_PHONE).alias("phone"), F.lit(PROFILE_ADDRESS).alias("address"))
    out = ops.assign_new_ids(rows, d.customers, "customer_id")
    return out.select("customer_id", "user_id", "full_name", "email", "phone", "address")


# ---------------------------------------------------------------------------
# Catalogue add
# ---------------------------------------------------------------------------
_BOOK_COLS = ("book_id, isbn, title, author, price, stock, category, attributes_json, created_at, "
              "image_url, discount_percent, price_after_discount, is_archived")


def add_books_sql(src: str, req: str) -> str:
    return f"""
SELECT {_BOOK_COLS} FROM {src}
UNION ALL
SELECT (SELECT max(book_id) FROM {src}) + row_number() OVER (ORDER BY seq), CAST(NULL AS VARCHAR),
       title, author, price, stock, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), {TS},
       CAST(NULL AS VARCHAR), CAST(NULL AS DECIMAL(5,2)), CAST(NULL AS DECIMAL(10,2)), 0
FROM {req}"""


_NEW_BOOKS_SQL = """
r_newbooks AS (
  SELECT s_suppkey AS seq, 'Catalogue of ' || s_name AS title, s_name AS author,
         CAST(abs(s_acctbal) AS DECIMAL(10,2)) AS price, CAST(s_nationkey AS BIGINT) AS stock
  FROM supplier
)"""


def new_book_requests(d: Domain):
    """AddBook(title, author, price, stock): one catalogue per supplier."""
    s = d.raw("supplier")
    return s.select(F.col("s_suppkey").alias("seq"),
                    F.concat(F.lit("Catalogue of "), F.col("s_name")).alias("title"),
                    F.col("s_name").alias("author"),
                    F.abs(F.col("s_acctbal")).cast(S.PRICE).alias("price"),
                    F.col("s_nationkey").cast("long").alias("stock"))


@register("add_books", add_books_sql("v_books", "r_newbooks"), extra_ctes=_NEW_BOOKS_SQL)
def add_books(d: Domain):
    """AddBook for a batch; new catalogue snapshot."""
    return ops.add_books(d.books, new_book_requests(d), as_of()).snapshot


_PRODUCT_REQ_SQL = f"""
r_products AS (
  SELECT s_suppkey AS seq, '978-5-' || CAST(s_suppkey AS VARCHAR) AS isbn,
         CASE WHEN s_nationkey = 3 THEN NULL ELSE 'Catalogue of ' || s_name END AS title,
         s_name AS author, CAST(s_acctbal AS DECIMAL(10,2)) AS price,
         CAST(s_nationkey - 2 AS BIGINT) AS stock, 'Каталоги' AS category,
         'https://img.example.org/' || CAST(s_suppkey AS VARCHAR) || '.jpg' AS image_url
  FROM supplier
  UNION ALL
  SELECT s_suppkey + {SEQ_SECOND}, '978-5-' || CAST(s_suppkey AS VARCHAR), 'Second edition',
         s_name, CAST(10 AS DECIMAL(10,2)), CAST(1 AS BIGINT), 'Каталоги', NULL
  FROM supplier WHERE s_nationkey < 5
  UNION ALL
  SELECT book_id + {SEQ_EXISTING}, isbn, title, author, price, CAST(1 AS BIGINT), category, NULL
  FROM v_books WHERE stock = 50
),
r_products_ok AS (
  SELECT * FROM r_products
  WHERE title IS NOT NULL AND trim(title) <> '' AND price > 0 AND stock >= 0
    AND (isbn IS NULL OR NOT EXISTS (SELECT 1 FROM v_books b WHERE b.isbn = r_products.isbn))
),
r_products_w AS (
  SELECT * FROM r_products_ok WHERE isbn IS NULL
     OR seq = (SELECT min(seq) FROM r_products_ok o2 WHERE o2.isbn = r_products_ok.isbn)
)"""


def product_requests(d: Domain):
    """MANAGE_PRODUCT_ADD: one product per supplier (nation 3 sends no
    title, negative balances give a bad price, nations 0–1 a negative
    stock), a second edition with the same isbn from nations 0–4, and
    re-submissions of existing books with stock 50."""
    s = d.raw("supplier")
    a = s.select(
        F.col("s_suppkey").alias("seq"),
        F.concat(F.lit("978-5-"), F.col("s_suppkey").cast("string")).alias("isbn"),
        F.when(F.col("s_nationkey") == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Catalogue of "), F.col("s_name"))).alias("title"),
        F.col("s_name").alias("author"), F.col("s_acctbal").cast(S.PRICE).alias("price"),
        (F.col("s_nationkey") - 2).cast("long").alias("stock"),
        F.lit("Каталоги").alias("category"),
        F.concat(F.lit("https://img.example.org/"), F.col("s_suppkey").cast("string"),
                 F.lit(".jpg")).alias("image_url"))
    b = s.filter(F.col("s_nationkey") < 5).select(
        (F.col("s_suppkey") + SEQ_SECOND).alias("seq"),
        F.concat(F.lit("978-5-"), F.col("s_suppkey").cast("string")).alias("isbn"),
        F.lit("Second edition").alias("title"), F.col("s_name").alias("author"),
        F.lit(10).cast(S.PRICE).alias("price"), F.lit(1).cast("long").alias("stock"),
        F.lit("Каталоги").alias("category"), F.lit(None).cast("string").alias("image_url"))
    e = d.books.filter(F.col("stock") == 50).select(
        (F.col("book_id") + SEQ_EXISTING).alias("seq"), "isbn", "title", "author", "price",
        F.lit(1).cast("long").alias("stock"), "category",
        F.lit(None).cast("string").alias("image_url"))
    return a.unionByName(b).unionByName(e)


@register("product_add_validated", f"""
SELECT (SELECT max(book_id) FROM v_books) + row_number() OVER (ORDER BY seq) AS book_id,
       isbn, title, author, price, stock, category, CAST(NULL AS VARCHAR) AS attributes_json,
       {TS} AS created_at, image_url, CAST(NULL AS DECIMAL(5,2)) AS discount_percent,
       CAST(NULL AS DECIMAL(10,2)) AS price_after_discount, 0 AS is_archived
FROM r_products_w
""", extra_ctes=_PRODUCT_REQ_SQL)
def product_add_validated(d: Domain):
    """Validated product adds; returns the inserted books."""
    return ops.product_add_validated(d.books, product_requests(d), as_of()).added


# ---------------------------------------------------------------------------
# Updates and edits
# ---------------------------------------------------------------------------
_BOOK_UPD_SQL = f"""
r_bookupd AS (
  SELECT book_id AS seq, book_id, CAST(price * 90 * 0.01 AS DECIMAL(10,2)) AS price,
         CASE WHEN stock > 45 THEN NULL ELSE stock + 5 END AS stock
  FROM v_books WHERE category = 'PROMO'
  UNION ALL
  SELECT book_id + {SEQ_SECOND}, book_id, CAST(1 AS DECIMAL(10,2)), CAST(0 AS BIGINT)
  FROM v_books WHERE category = 'PROMO' AND stock < 5
  UNION ALL
  SELECT s_suppkey + {SEQ_EXISTING}, -(s_suppkey + 1), CAST(1 AS DECIMAL(10,2)), CAST(1 AS BIGINT)
  FROM supplier
),
r_bookupd_w AS ({_first('r_bookupd', 'book_id')})"""


def book_update_requests(d: Domain):
    """UpdateBook: PROMO books get 10 % off and +5 stock (stock above 45
    is cleared to NULL); low-stock PROMO books get a later, duplicate
    request; every supplier names a book id that does not exist."""
    b = d.books.filter(F.col("category") == "PROMO")
    a = b.select(F.col("book_id").alias("seq"), "book_id",
                 (F.col("price") * F.lit(90) * F.lit(0.01).cast("decimal(2,2)")).cast(S.PRICE)
                 .alias("price"),
                 F.when(F.col("stock") > 45, F.lit(None).cast("long"))
                  .otherwise(F.col("stock") + 5).alias("stock"))
    dup = b.filter(F.col("stock") < 5).select(
        (F.col("book_id") + SEQ_SECOND).alias("seq"), "book_id",
        F.lit(1).cast(S.PRICE).alias("price"), F.lit(0).cast("long").alias("stock"))
    s = d.raw("supplier")
    unk = s.select((F.col("s_suppkey") + SEQ_EXISTING).alias("seq"),
                   (-(F.col("s_suppkey") + 1)).alias("book_id"),
                   F.lit(1).cast(S.PRICE).alias("price"), F.lit(1).cast("long").alias("stock"))
    return a.unionByName(dup).unionByName(unk)


@register("update_books", """
SELECT b.book_id, b.isbn, b.title, b.author,
       CASE WHEN w.book_id IS NOT NULL THEN w.price ELSE b.price END AS price,
       CASE WHEN w.book_id IS NOT NULL THEN w.stock ELSE b.stock END AS stock,
       b.category, b.attributes_json, b.created_at, b.image_url, b.discount_percent,
       b.price_after_discount, b.is_archived
FROM v_books b LEFT JOIN r_bookupd_w w ON b.book_id = w.book_id
""", extra_ctes=_BOOK_UPD_SQL)
def update_books(d: Domain):
    """price and stock by key (NULL overwrites); new catalogue."""
    return ops.update_books(d.books, book_update_requests(d)).snapshot


def product_edit_sql(src: str) -> str:
    return f"""
SELECT b.book_id, b.isbn,
       COALESCE(e.new_title, b.title) AS title, COALESCE(e.new_author, b.author) AS author,
       COALESCE(e.new_price, b.price) AS price, COALESCE(e.new_stock, b.stock) AS stock,
       COALESCE(e.new_category, b.category) AS category, b.attributes_json, b.created_at,
       b.image_url, b.discount_percent,
       CASE WHEN e.book_id IS NOT NULL AND b.discount_percent IS NOT NULL
            THEN CAST(COALESCE(e.new_price, b.price) * (100 - b.discount_percent) * 0.01
                      AS DECIMAL(10,2))
            ELSE b.price_after_discount END AS price_after_discount,
       b.is_archived
FROM {src} b LEFT JOIN r_edit e ON b.book_id = e.book_id"""


_EDIT_REQ_SQL = """
r_edit AS (
  SELECT book_id AS seq, book_id,
         CASE WHEN stock > 40 THEN upper(title) END AS new_title,
         CAST(NULL AS VARCHAR) AS new_author,
         CAST(price + 10 AS DECIMAL(10,2)) AS new_price,
         CASE WHEN stock < 10 THEN stock + 100 END AS new_stock,
         CAST(NULL AS VARCHAR) AS new_category
  FROM v_books WHERE category = 'PROMO'
)"""


def edit_requests(d: Domain):
    """MANAGE_PRODUCT_EDIT for PROMO books: price +10, stock +100 when
    below 10, title upper-cased when stock > 40, other fields NULL (kept)."""
    b = d.books.filter(F.col("category") == "PROMO")
    return b.select(
        F.col("book_id").alias("seq"), "book_id",
        F.when(F.col("stock") > 40, F.upper("title")).alias("new_title"),
        F.lit(None).cast("string").alias("new_author"),
        (F.col("price") + F.lit(10)).cast(S.PRICE).alias("new_price"),
        F.when(F.col("stock") < 10, F.col("stock") + 100).alias("new_stock"),
        F.lit(None).cast("string").alias("new_category"))


@register("product_edit", product_edit_sql("v_books"), extra_ctes=_EDIT_REQ_SQL)
def product_edit(d: Domain):
    """Partial edit (NULL keeps) with discounted price recomputed."""
    return ops.product_edit(d.books, edit_requests(d)).snapshot


# ---------------------------------------------------------------------------
# order status
# ---------------------------------------------------------------------------
_STATUS_REQ_SQL = f"""
r_status AS (
  SELECT order_id AS seq, order_id, '{S.ORDER_SHIPPED}' AS status FROM v_orders
  WHERE status = '{S.ORDER_PAID}' AND order_date < TIMESTAMP '{SHIP_BEFORE}'
  UNION ALL
  SELECT s_suppkey + {SEQ_EXISTING}, -(s_suppkey + 1), '{S.ORDER_SHIPPED}' FROM supplier
)"""


def status_requests(d: Domain):
    """Paid orders placed before the cut-off are shipped; suppliers name
    orders that do not exist."""
    o = d.orders.filter((F.col("status") == S.ORDER_PAID)
                        & (F.col("order_date") < F.lit(SHIP_BEFORE).cast(S.TS)))
    a = o.select(F.col("order_id").alias("seq"), "order_id", F.lit(S.ORDER_SHIPPED).alias("status"))
    s = d.raw("supplier")
    b = s.select((F.col("s_suppkey") + SEQ_EXISTING).alias("seq"),
                 (-(F.col("s_suppkey") + 1)).alias("order_id"),
                 F.lit(S.ORDER_SHIPPED).alias("status"))
    return a.unionByName(b)


@register("update_order_status", """
SELECT o.order_id, o.customer_id, o.order_date,
       CASE WHEN r.order_id IS NOT NULL THEN r.status ELSE o.status END AS status, o.total_amount
FROM v_orders o LEFT JOIN r_status r ON o.order_id = r.order_id
""", extra_ctes=_STATUS_REQ_SQL)
def update_order_status(d: Domain):
    """Order status by key, unknown orders rejected; new orders."""
    return ops.update_order_status(d.orders, status_requests(d)).snapshot


# ---------------------------------------------------------------------------
# bulk update by predicate
# ---------------------------------------------------------------------------
_RECAT_CASE = " ".join(f"WHEN category = '{o}' THEN '{n}'" for o, n in RECATEGORISE.items())


@register("recategorise", f"""
SELECT book_id, isbn, title, author, price, stock, CASE {_RECAT_CASE} ELSE category END AS category,
       attributes_json, created_at, image_url, discount_percent, price_after_discount, is_archived
FROM v_books
""")
def recategorise(d: Domain):
    """rename a category across the whole catalogue."""
    return ops.recategorise(d.books, RECATEGORISE)


# ---------------------------------------------------------------------------
# deletes
# ---------------------------------------------------------------------------
@register("delete_books", """
SELECT * FROM v_books b
WHERE NOT (b.stock <= 2 AND NOT EXISTS (SELECT 1 FROM v_order_items i WHERE i.book_id = b.book_id))
   OR b.stock IS NULL
""")
def delete_books(d: Domain):
    """F8: DeleteBook for every book with stock <= 2; books with order
    lines are refused."""
    req = d.books.filter(F.col("stock") <= 2).select("book_id")
    return ops.delete_by_key(d.books, "book_id", req, [(d.order_items, "book_id")]).snapshot


@register("delete_users", f"""
SELECT * FROM v_users u
WHERE NOT (u.status = '{S.STATUS_BLOCKED}'
           AND NOT EXISTS (SELECT 1 FROM v_customers c WHERE c.user_id = u.user_id))
""")
def delete_users(d: Domain):
    """F8: DeleteUser for every blocked user; users with a profile are
    refused."""
    req = d.users.filter(F.col("status") == S.STATUS_BLOCKED).select("user_id")
    return ops.delete_by_key(d.users, "user_id", req, [(d.customers, "user_id")]).snapshot


@register("delete_roles", """
SELECT * FROM (SELECT role_id, role_name FROM v_roles UNION ALL SELECT role_id, role_name FROM r_new_roles) r
WHERE NOT (r.role_id IN (SELECT DISTINCT CAST(c_nationkey % 8 + 1 AS BIGINT) FROM customer)
           AND NOT EXISTS (SELECT 1 FROM v_users u WHERE u.role_id = r.role_id))
""", extra_ctes=_ROLE_REQ_SQL)
def delete_roles(d: Domain):
    """F8: after AddRole, DeleteRole for ids 1..8 (named by the customers'
    nations); roles held by users are refused."""
    roles = ops.add_roles(d.roles, role_requests(d)).snapshot
    req = d.raw("customer").select((F.col("c_nationkey") % 8 + 1).cast("long").alias("role_id"))
    return ops.delete_by_key(roles, "role_id", req, [(d.users, "role_id")]).snapshot


@register("cascade_delete", f"""
SELECT 'customers' AS table_name, customer_id AS key, CAST(1 AS BIGINT) AS n_rows
FROM v_customers WHERE status = '{S.STATUS_BLOCKED}'
UNION ALL
SELECT 'orders', o.order_id, CAST(1 AS BIGINT) FROM v_orders o
WHERE o.customer_id IN (SELECT customer_id FROM v_customers WHERE status = '{S.STATUS_BLOCKED}')
UNION ALL
SELECT 'order_items', i.order_id, count(*) FROM v_order_items i
WHERE i.order_id IN (SELECT o.order_id FROM v_orders o WHERE o.customer_id IN
                     (SELECT customer_id FROM v_customers WHERE status = '{S.STATUS_BLOCKED}'))
GROUP BY i.order_id
""")
def cascade_delete(d: Domain):
    """delete blocked customers with their orders and order lines;
    returns what was deleted per table."""
    req = d.customers.filter(F.col("status") == S.STATUS_BLOCKED).select("customer_id")
    return ops.cascade_delete(d.customers, d.orders, d.order_items, req).deleted


def product_delete_sql(src: str) -> str:
    p = S.ARCHIVE_PREFIX
    return f"""
SELECT b.book_id, b.isbn,
       CASE WHEN a.book_id IS NOT NULL AND NOT COALESCE(starts_with(b.title, '{p}'), false)
            THEN concat_ws(' ', '{p}', b.title) ELSE b.title END AS title,
       b.author, b.price, CASE WHEN a.book_id IS NOT NULL THEN CAST(0 AS BIGINT) ELSE b.stock END
         AS stock,
       b.category, b.attributes_json, b.created_at, b.image_url, b.discount_percent,
       b.price_after_discount, CASE WHEN a.book_id IS NOT NULL THEN 1 ELSE b.is_archived END
         AS is_archived
FROM {src} b
LEFT JOIN (SELECT DISTINCT book_id FROM {src} WHERE stock BETWEEN 1 AND 3
             AND book_id IN (SELECT book_id FROM v_order_items)) a ON b.book_id = a.book_id
WHERE NOT (b.stock BETWEEN 1 AND 3
           AND NOT EXISTS (SELECT 1 FROM v_order_items i WHERE i.book_id = b.book_id))
   OR b.stock IS NULL"""


def delete_requests(books):
    return books.filter(F.col("stock").between(1, 3)).select("book_id")


@register("product_delete", product_delete_sql("v_books"))
def product_delete(d: Domain):
    """Delete books with stock 1–3: unsold ones are removed, sold ones
    archived."""
    return ops.product_delete(d.books, d.order_items, delete_requests(d.books)).snapshot


@register("archived_check", f"""
SELECT book_id, title,
       COALESCE(starts_with(title, '{S.ARCHIVE_PREFIX}') AND stock = 0 AND is_archived = 1, false)
         AS archived
FROM ({product_delete_sql('v_books')}) x
""")
def archived_check(d: Domain):
    """The archived-book predicate over the catalogue after I11."""
    snap = ops.product_delete(d.books, d.order_items, delete_requests(d.books)).snapshot
    return archived_check_op(snap)


# ---------------------------------------------------------------------------
# Carts and orders
# ---------------------------------------------------------------------------
_CART_REQ_SQL = f"""
r_cart AS (
  SELECT c_custkey AS seq, c_custkey AS customer_id, c_custkey + c_nationkey * 100 AS book_id,
         CAST(c_nationkey % 5 + 1 AS BIGINT) AS qty FROM customer
  UNION ALL
  SELECT c_custkey + {SEQ_SECOND}, c_custkey, c_custkey * 2, CAST(1 AS BIGINT) FROM customer
  WHERE c_nationkey < 3
),
r_cart_lines AS (
  SELECT r.seq, r.customer_id, r.book_id, r.qty, b.price, CAST(NULL AS BIGINT) AS order_id
  FROM r_cart r JOIN v_books b ON r.book_id = b.book_id
)"""


def cart_requests(d: Domain):
    """Every customer adds one book (id = own key + 100 × nation, so some
    ids are unknown); nations 0–2 add a second book."""
    c = d.raw("customer")
    a = c.select(F.col("c_custkey").alias("seq"), F.col("c_custkey").alias("customer_id"),
                 (F.col("c_custkey") + F.col("c_nationkey") * 100).alias("book_id"),
                 (F.col("c_nationkey") % 5 + 1).cast("long").alias("qty"))
    b = c.filter(F.col("c_nationkey") < 3).select(
        (F.col("c_custkey") + SEQ_SECOND).alias("seq"), F.col("c_custkey").alias("customer_id"),
        (F.col("c_custkey") * 2).alias("book_id"), F.lit(1).cast("long").alias("qty"))
    return a.unionByName(b)


@register("add_to_cart", "SELECT * FROM r_cart_lines", extra_ctes=_CART_REQ_SQL)
def add_to_cart(d: Domain):
    """cart lines with the captured price (unknown books rejected)."""
    return ops.add_to_cart(d.books, cart_requests(d)).added


@register("place_orders", f"""
SELECT (SELECT max(order_id) FROM v_orders) + row_number() OVER (ORDER BY w.seq, w.customer_id)
         AS order_id,
       w.customer_id, {TS} AS order_date, '{NEW}' AS status,
       CAST(COALESCE(t.t, 0) AS DECIMAL(12,2)) AS total_amount
FROM (SELECT c_custkey AS customer_id, min(c_custkey) AS seq FROM customer
      WHERE c_nationkey < 10 AND c_custkey IN (SELECT customer_id FROM v_customers)
      GROUP BY c_custkey) w
LEFT JOIN (SELECT customer_id, sum(qty * price) AS t FROM r_cart_lines GROUP BY customer_id) t
  ON w.customer_id = t.customer_id
""", extra_ctes=_CART_REQ_SQL)
def place_orders(d: Domain):
    """customers of nations 0–9 place their carts; new orders."""
    cart = ops.add_to_cart(d.books, cart_requests(d)).added
    req = d.raw("customer").filter(F.col("c_nationkey") < 10).select(
        F.col("c_custkey").alias("seq"), F.col("c_custkey").alias("customer_id"))
    return ops.place_orders(d.orders, d.customers, cart, req, as_of()).added


@register("place_orders_lines", """
SELECT l.seq, l.customer_id, l.book_id, l.qty, l.price, o.order_id
FROM r_cart_lines l LEFT JOIN (
  SELECT customer_id, (SELECT max(order_id) FROM v_orders) + row_number() OVER (ORDER BY customer_id) AS order_id
  FROM (SELECT DISTINCT c_custkey AS customer_id FROM customer WHERE c_nationkey < 10) w) o
  ON l.customer_id = o.customer_id
""", extra_ctes=_CART_REQ_SQL)
def place_orders_lines(d: Domain):
    """the whole line table after placing: moved lines carry their order,
    lines of other customers stay in the cart."""
    cart = ops.add_to_cart(d.books, cart_requests(d)).added
    req = d.raw("customer").filter(F.col("c_nationkey") < 10).select(
        F.col("c_custkey").alias("seq"), F.col("c_custkey").alias("customer_id"))
    return ops.place_orders(d.orders, d.customers, cart, req, as_of()).order_items


@register("order_create", f"""
SELECT (SELECT max(order_id) FROM v_orders) + row_number() OVER (ORDER BY c.customer_id)
         AS order_id,
       c.customer_id, {TS} AS order_date, '{NEW}' AS status,
       CAST(0 AS DECIMAL(12,2)) AS total_amount
FROM v_customers c
WHERE NOT EXISTS (SELECT 1 FROM v_orders o WHERE o.customer_id = c.customer_id
                  AND o.status = '{NEW}')
""")
def order_create(d: Domain):
    """An empty open order for every customer that has none."""
    open_c = d.orders.filter(F.col("status") == NEW).select("customer_id")
    req = (d.customers.join(open_c, "customer_id", "left_anti")
           .select(F.col("customer_id").alias("seq"), "customer_id"))
    return ops.order_create(d.orders, d.customers, req, as_of()).added


_ADD_ITEMS_SQL = f"""
r_additem AS (
  SELECT o_orderkey AS seq, o_orderkey AS order_id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey ELSE -1 END AS book_id,
         CAST(1 AS BIGINT) AS qty
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  UNION ALL
  SELECT s_suppkey + {SEQ_EXISTING}, -(s_suppkey + 1), 1, CAST(1 AS BIGINT) FROM supplier
),
r_add_ok AS (
  SELECT r.order_id, r.book_id, r.qty, b.price
  FROM r_additem r JOIN v_orders o ON r.order_id = o.order_id AND o.status = '{NEW}'
  JOIN v_books b ON r.book_id = b.book_id
),
r_touched AS (SELECT DISTINCT order_id FROM r_add_ok),
r_items AS (
  SELECT order_id, qty, price FROM v_order_items WHERE order_id IN (SELECT order_id FROM r_touched)
  UNION ALL SELECT order_id, qty, price FROM r_add_ok
)"""


def add_item_requests(d: Domain):
    """Urgent orders get their customer's number as a book, high-priority
    ones an unknown book; suppliers name unknown orders."""
    o = d.raw("orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    a = o.select(F.col("o_orderkey").alias("seq"), F.col("o_orderkey").alias("order_id"),
                 F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey"))
                  .otherwise(F.lit(-1)).cast("long").alias("book_id"),
                 F.lit(1).cast("long").alias("qty"))
    s = d.raw("supplier")
    b = s.select((F.col("s_suppkey") + SEQ_EXISTING).alias("seq"),
                 (-(F.col("s_suppkey") + 1)).alias("order_id"),
                 F.lit(1).cast("long").alias("book_id"), F.lit(1).cast("long").alias("qty"))
    return a.unionByName(b)


@register("order_add_items", """
SELECT o.order_id, o.customer_id, o.status, CAST(COALESCE(t.t, 0) AS DECIMAL(12,2)) AS total_amount
FROM v_orders o JOIN r_touched x ON o.order_id = x.order_id
LEFT JOIN (SELECT order_id, sum(qty * price) AS t FROM r_items GROUP BY order_id) t
  ON o.order_id = t.order_id
""", extra_ctes=_ADD_ITEMS_SQL)
def order_add_items(d: Domain):
    """Lines added to open orders only; touched orders with new totals."""
    return ops.order_add_items(d.orders, d.books, d.order_items, add_item_requests(d)).touched


_REMOVE_SQL = f"""
r_rem AS (
  SELECT l_orderkey AS order_id, l_partkey AS book_id, CAST(10 AS BIGINT) AS qty
  FROM lineitem WHERE l_returnflag = 'R'
),
r_rem_ok AS (
  SELECT q.order_id, q.book_id, q.minus
  FROM (SELECT order_id, book_id, sum(qty) AS minus FROM r_rem GROUP BY order_id, book_id) q
  JOIN v_orders o ON q.order_id = o.order_id AND o.status = '{NEW}'
),
r_upto AS (
  SELECT i.order_id, i.book_id, i.qty, i.price, k.minus,
         sum(i.qty) OVER (PARTITION BY i.order_id, i.book_id ORDER BY i.price, i.qty
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM v_order_items i LEFT JOIN r_rem_ok k ON i.order_id = k.order_id AND i.book_id = k.book_id
  WHERE i.order_id IN (SELECT order_id FROM r_rem_ok)
),
r_kept AS (
  -- what all lines up to this one keep together, at most this line's own quantity
  SELECT order_id, CASE WHEN minus IS NULL THEN qty ELSE least(qty, upto - minus) END AS qty, price FROM r_upto
)"""


def remove_item_requests(d: Domain):
    """Every returned line (flag R) asks to take 10 units off its book."""
    li = d.raw("lineitem").filter(F.col("l_returnflag") == "R")
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("book_id"),
                     F.lit(10).cast("long").alias("qty"))


@register("order_remove_items", """
SELECT o.order_id, o.customer_id, o.status, CAST(COALESCE(t.t, 0) AS DECIMAL(12,2)) AS total_amount
FROM v_orders o JOIN (SELECT DISTINCT order_id FROM r_rem_ok) x ON o.order_id = x.order_id
LEFT JOIN (SELECT order_id, sum(qty * price) AS t FROM r_kept WHERE qty IS NULL OR qty > 0
           GROUP BY order_id) t ON o.order_id = t.order_id
""", extra_ctes=_REMOVE_SQL)
def order_remove_items(d: Domain):
    """Quantities lowered, empty lines dropped, totals refreshed."""
    return ops.order_remove_items(d.orders, d.order_items, remove_item_requests(d)).touched


_BUY_SQL = f"""
r_buy AS (
  SELECT c_custkey AS seq, c_name AS username, c_custkey * 3 AS book_id,
         CAST(1 + c_nationkey % 3 AS BIGINT) AS qty FROM customer WHERE c_nationkey < 8
  UNION ALL
  SELECT s_suppkey + {SEQ_EXISTING}, s_name, 1, CAST(1 AS BIGINT) FROM supplier
),
r_buy2 AS (
  SELECT r.*, w.customer_id, op.open_order
  FROM r_buy r
  JOIN (SELECT u.username, c.customer_id FROM v_users u JOIN v_customers c
        ON u.user_id = c.user_id) w ON r.username = w.username
  LEFT JOIN (SELECT customer_id, min(order_id) AS open_order FROM v_orders
             WHERE status = '{NEW}' GROUP BY customer_id) op ON w.customer_id = op.customer_id
),
r_opened AS (
  SELECT customer_id, (SELECT max(order_id) FROM v_orders) + row_number() OVER (ORDER BY seq)
           AS new_order
  FROM (SELECT customer_id, min(seq) AS seq FROM r_buy2 WHERE open_order IS NULL
        GROUP BY customer_id) n
)"""


def buy_requests(d: Domain):
    """Customers of nations 0–7 buy book (3 × own key), some unknown;
    suppliers (no customer profile) try too."""
    c = d.raw("customer").filter(F.col("c_nationkey") < 8)
    a = c.select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("username"),
                 (F.col("c_custkey") * 3).alias("book_id"),
                 (F.col("c_nationkey") % 3 + 1).cast("long").alias("qty"))
    s = d.raw("supplier")
    b = s.select((F.col("s_suppkey") + SEQ_EXISTING).alias("seq"),
                 F.col("s_name").alias("username"),
                 F.lit(1).cast("long").alias("book_id"), F.lit(1).cast("long").alias("qty"))
    return a.unionByName(b)


@register("buy_auto", """
SELECT r.seq, r.username, r.customer_id, COALESCE(r.open_order, n.new_order) AS order_id,
       r.book_id, r.qty, b.price, n.new_order IS NOT NULL AS new_order
FROM r_buy2 r LEFT JOIN r_opened n ON r.customer_id = n.customer_id
JOIN v_books b ON r.book_id = b.book_id
""", extra_ctes=_BUY_SQL)
def buy_auto(d: Domain):
    """I16: login → open order or a new one → line with the current price."""
    return ops.buy_auto(d.users, d.customers, d.orders, d.books, d.order_items, buy_requests(d), as_of()).added


# ---------------------------------------------------------------------------
# Account changes
# ---------------------------------------------------------------------------
_TOGGLE_SQL = f"""
r_toggle AS (
  SELECT c_custkey AS seq, c_custkey AS user_id, '{S.STATUS_BLOCKED}' AS new_status,
         'fraud review' AS reason FROM customer WHERE c_nationkey = 3
  UNION ALL
  SELECT c_custkey + {SEQ_SECOND}, c_custkey, '{S.STATUS_ACTIVE}', 'review passed'
  FROM customer WHERE c_nationkey = 3 AND c_acctbal > 5000
  UNION ALL
  SELECT s_suppkey + {SEQ_EXISTING}, -(s_suppkey + 1), '{S.STATUS_BLOCKED}', 'unknown'
  FROM supplier
),
r_toggle_ok AS (
  SELECT w.*, u.status AS old_status
  FROM ({_first('r_toggle', 'user_id')}) w JOIN v_users u ON w.user_id = u.user_id
)"""


def toggle_requests(d: Domain):
    """Users of nation 3 are blocked for review; the rich ones among them
    send a later re-activation (a duplicate); suppliers name unknown users."""
    c = d.raw("customer").filter(F.col("c_nationkey") == 3)
    a = c.select(F.col("c_custkey").alias("seq"), F.col("c_custkey").alias("user_id"),
                 F.lit(S.STATUS_BLOCKED).alias("new_status"), F.lit("fraud review").alias("reason"))
    b = c.filter(F.col("c_acctbal") > 5000).select(
        (F.col("c_custkey") + SEQ_SECOND).alias("seq"), F.col("c_custkey").alias("user_id"),
        F.lit(S.STATUS_ACTIVE).alias("new_status"), F.lit("review passed").alias("reason"))
    s = d.raw("supplier")
    e = s.select((F.col("s_suppkey") + SEQ_EXISTING).alias("seq"),
                 (-(F.col("s_suppkey") + 1)).alias("user_id"),
                 F.lit(S.STATUS_BLOCKED).alias("new_status"), F.lit("unknown").alias("reason"))
    return a.unionByName(b).unionByName(e)


@register("toggle_status", f"""
SELECT (SELECT max(log_id) FROM v_audit_log) + row_number() OVER (ORDER BY seq) AS log_id,
       'admin' AS who, 'users' AS what_table, 'STATUS_CHANGE' AS action,
       to_json({{'user_id': user_id, 'old_status': old_status, 'new_status': new_status,
                 'reason': reason}}) AS details_json,
       {TS} AS ts
FROM r_toggle_ok
""", extra_ctes=_TOGGLE_SQL)
def toggle_status(d: Domain):
    """Status changes with a reason; returns the audit rows written."""
    return ops.toggle_status(d.users, d.audit_log, toggle_requests(d), as_of()).added


_CONTACT_SQL = """
r_contact AS (
  SELECT c_custkey AS seq, c_name AS username,
         'Moved to nation ' || CAST(c_nationkey + 1 AS VARCHAR) AS new_address,
         CASE WHEN c_acctbal > 0 THEN '+7-' || CAST(c_custkey AS VARCHAR) END AS new_phone,
         CAST(NULL AS VARCHAR) AS new_full_name, CAST(NULL AS VARCHAR) AS new_email
  FROM customer WHERE c_nationkey = 5
)"""


def contact_requests(d: Domain):
    """Users of nation 5 move (new address) and, with a positive balance,
    get a new phone; other fields NULL (kept)."""
    c = d.raw("customer").filter(F.col("c_nationkey") == 5)
    return c.select(
        F.col("c_custkey").alias("seq"), F.col("c_name").alias("username"),
        F.concat(F.lit("Moved to nation "), (F.col("c_nationkey") + 1).cast("string"))
         .alias("new_address"),
        F.when(F.col("c_acctbal") > 0,
               F.concat(F.lit("+7-"), F.col("c_custkey").cast("string"))).alias("new_phone"),
        F.lit(None).cast("string").alias("new_full_name"),
        F.lit(None).cast("string").alias("new_email"))


@register("contact_update", """
SELECT c.customer_id, c.user_id, COALESCE(r.new_full_name, c.full_name) AS full_name,
       COALESCE(r.new_email, c.email) AS email, COALESCE(r.new_phone, c.phone) AS phone,
       COALESCE(r.new_address, c.address) AS address, c.status, c.created_at
FROM v_customers c
LEFT JOIN (SELECT r.*, u.user_id FROM r_contact r JOIN v_users u ON r.username = u.username) r
  ON c.user_id = r.user_id
""", extra_ctes=_CONTACT_SQL)
def contact_update(d: Domain):
    """Profile update by login (NULL keeps); new profiles snapshot."""
    return ops.contact_update(d.users, d.customers, contact_requests(d)).snapshot


_SECURITY_SQL = f"""
r_sec AS (
  SELECT c_custkey AS seq, c_name AS viewer, c_name AS username,
         upper(sha256(c_name || '!')) AS new_password_hash, CAST(NULL AS VARCHAR) AS new_status
  FROM customer WHERE c_nationkey = 6
  UNION ALL
  SELECT b.c_custkey + {SEQ_SECOND}, a.c_name, b.c_name, CAST(NULL AS VARCHAR), '{S.STATUS_BLOCKED}'
  FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1 WHERE b.c_nationkey = 7
),
r_sec_able AS (
  SELECT r.* FROM r_sec r
  LEFT JOIN (SELECT u.username, ro.role_name = '{S.ROLE_ADMIN}' AS is_admin
             FROM v_users u JOIN v_roles ro ON u.role_id = ro.role_id) v ON r.viewer = v.username
  WHERE (COALESCE(v.is_admin, false) OR r.viewer IS NOT DISTINCT FROM r.username)
    AND r.username IN (SELECT username FROM v_users)
),
r_sec_ok AS ({_first('r_sec_able', 'username')})"""


def security_requests(d: Domain):
    """Users of nation 6 change their own password; users of nation 7 are
    blocked by the previous user (allowed only when that user is an Admin)."""
    c = d.raw("customer")
    a = c.filter(F.col("c_nationkey") == 6).select(
        F.col("c_custkey").alias("seq"), F.col("c_name").alias("viewer"),
        F.col("c_name").alias("username"),
        password_hash(F.concat(F.col("c_name"), F.lit("!"))).alias("new_password_hash"),
        F.lit(None).cast("string").alias("new_status"))
    prev = c.select((F.col("c_custkey") + 1).alias("c_custkey"), F.col("c_name").alias("viewer"))
    b = (c.filter(F.col("c_nationkey") == 7).join(prev, "c_custkey")
         .select((F.col("c_custkey") + SEQ_SECOND).alias("seq"), "viewer",
                 F.col("c_name").alias("username"),
                 F.lit(None).cast("string").alias("new_password_hash"),
                 F.lit(S.STATUS_BLOCKED).alias("new_status")))
    return a.unionByName(b)


@register("security_update", """
SELECT u.user_id, u.username, COALESCE(r.new_password_hash, u.password_hash) AS password_hash,
       u.role_id, COALESCE(r.new_status, u.status) AS status, u.created_at
FROM v_users u LEFT JOIN r_sec_ok r ON u.username = r.username
""", extra_ctes=_SECURITY_SQL)
def security_update(d: Domain):
    """Password / status changes by the user or an Admin."""
    return ops.security_update(d.users, d.roles, security_requests(d)).snapshot
