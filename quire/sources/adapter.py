"""Domain views (roles, users, customers, books, orders, order_items,
audit_log) derived from the driver's test tables.

Every view is a narrow projection of one scan, so Catalyst prunes the columns
a query does not use and pushes filters on mapped columns into the Parquet
reader.  ``ADAPTER_SQL`` is the same mapping written for DuckDB; the oracle
queries start with it as a CTE prefix.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from .tables import read_table

# Fixed mapping values (part of the data model, mirrored in ADAPTER_SQL).
STAFF_PREFIX = "Staff "              # logins without a customer profile, one per nation
ISBN_PREFIX = "978-3-"
ISBN_DIGITS = 6
DISCOUNT_CYCLE = 31                 # discount_percent = book_id mod 31
# books: created FIRST_DAY + size days, unknown above DATED_SIZE; one size is archived
FIRST_DAY = "2020-01-01"
DATED_SIZE = 45
ARCHIVED_SIZE = 50
PAGES_PER_SIZE = 10
EMAIL_DOMAIN = "@example.org"
ORDER_STATUS_CODES = {"O": S.ORDER_NEW, "F": S.ORDER_PAID, "P": S.ORDER_SHIPPED}


def padded_isbn(book_id: Column) -> Column:
    """'978-3-' + zero padded id; ids longer than the pad are kept whole (no
    truncation, so isbns never collide because of the width)."""
    s = book_id.cast("string")
    return F.concat(F.lit(ISBN_PREFIX),
                    F.lpad(s, F.greatest(F.lit(ISBN_DIGITS), F.length(s)), F.lit("0")))


def discounted(price: Column, discount_percent: Column) -> Column:
    """price × (100 − d) × 0.01, rounded half-up to cents."""
    return (price * (F.lit(100) - discount_percent) * F.lit(0.01).cast("decimal(2,2)")
            ).cast(S.PRICE)


def order_status_of(code: Column) -> Column:
    expr = F.when(code == "O", S.ORDER_NEW).when(code == "F", S.ORDER_PAID)
    return expr.when(code == "P", S.ORDER_SHIPPED)


class Domain:
    """Lazily built domain views over one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def roles(self) -> DataFrame:
        # Three fixed rows: the application's initial roles.
        return self.spark.createDataFrame(S.ROLES, S.ROLES_SCHEMA)

    @cached_property
    def users(self) -> DataFrame:
        """A login per customer, and a staff login (no profile) per nation.
        Staff ids are below zero, so they meet no customer key at any size."""
        c, n = self.raw("customer"), self.raw("nation")
        logins = c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal").unionByName(n.select(
            (-F.col("n_nationkey") - 1).cast("long").alias("c_custkey"),
            F.concat(F.lit(STAFF_PREFIX), F.col("n_name")).alias("c_name"),
            F.col("n_nationkey").alias("c_nationkey"), F.lit(0.0).alias("c_acctbal")))
        return logins.select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("username"),
            F.upper(F.sha2(F.col("c_name"), 256)).alias("password_hash"),
            (F.col("c_nationkey") % 3 + 1).cast("long").alias("role_id"),
            F.when(F.col("c_acctbal") < 0, S.STATUS_BLOCKED)
             .otherwise(S.STATUS_ACTIVE).alias("status"),
            F.lit(None).cast(S.TS).alias("created_at"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        c = self.raw("customer")
        return c.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lower(F.col("c_name")), F.lit(EMAIL_DOMAIN)).alias("email"),
            F.concat(F.lit("+"), (F.col("c_nationkey") + 10).cast("string"), F.lit("-"),
                     F.col("c_custkey").cast("string")).alias("phone"),
            F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string"), F.lit(", "),
                     F.col("c_mktsegment")).alias("address"),
            F.when(F.col("c_acctbal") < 0, S.STATUS_BLOCKED)
             .otherwise(S.STATUS_ACTIVE).alias("status"),
            F.lit(None).cast(S.TS).alias("created_at"),
        )

    @cached_property
    def books(self) -> DataFrame:
        p = self.raw("part")
        price = F.col("p_retailprice").cast(S.PRICE)
        disc = (F.col("p_partkey") % DISCOUNT_CYCLE).cast(S.DISCOUNT)
        return p.select(
            F.col("p_partkey").alias("book_id"),
            padded_isbn(F.col("p_partkey")).alias("isbn"),
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("author"),
            price.alias("price"),
            F.col("p_size").cast("long").alias("stock"),
            F.col("p_type").alias("category"),
            F.concat(F.lit('{"pages": '), (F.col("p_size") * PAGES_PER_SIZE).cast("string"),
                     F.lit("}")).alias("attributes_json"),
            # known for books of up to DATED_SIZE only, so NULLs occur
            F.when(F.col("p_size") <= DATED_SIZE, F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("p_size").cast("int")))
             .cast(S.TS).alias("created_at"),
            F.lit(None).cast("string").alias("image_url"),
            disc.alias("discount_percent"),
            discounted(price, disc).alias("price_after_discount"),
            F.when(F.col("p_size") == ARCHIVED_SIZE, 1).otherwise(0).alias("is_archived"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        o = self.raw("orders")
        return o.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            order_status_of(F.col("o_orderstatus")).alias("status"),
            F.col("o_totalprice").cast(S.TOTAL).alias("total_amount"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        # (l_orderkey, l_linenumber) is not unique in the test data, so the
        # lines carry no item id; jobs that need one assign it (F2).
        li = self.raw("lineitem")
        return li.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("book_id"),
            F.col("l_quantity").cast("long").alias("qty"),
            F.col("l_extendedprice").cast(S.PRICE).alias("price"),
        )

    @cached_property
    def audit_log(self) -> DataFrame:
        e = self.raw("events")
        return e.select(
            F.col("event_id").alias("log_id"),
            F.col("user_id").cast("string").alias("who"),
            F.lit("events").alias("what_table"),
            F.col("event_type").alias("action"),
            F.col("props").alias("details_json"),
            F.col("ts"),
        )


class StoredDomain(Domain):
    """Domain tables read from published snapshots instead of the test
    tables: ``sources`` maps a table name (roles, users, customers, books,
    orders, order_items, audit_log) to a Parquet path or a catalog table
    name.  The operators take these DataFrames as they take the adapter's."""

    TABLES = ("roles", "users", "customers", "books", "orders", "order_items", "audit_log")

    def __init__(self, spark: SparkSession, sources: dict[str, str]):
        super().__init__(spark, "")
        unknown = set(sources) - set(self.TABLES)
        if unknown:
            raise ValueError(f"unknown domain tables {sorted(unknown)}")
        self.sources = dict(sources)

    def _load(self, name: str) -> DataFrame:
        if name not in self.sources:
            raise KeyError(f"no source given for {name!r}")
        src = self.sources[name]
        is_path = "/" in src or ":" in src
        return self.spark.read.parquet(src) if is_path else self.spark.table(src)

    def raw(self, name: str) -> DataFrame:
        raise KeyError("a stored domain has no raw test tables")

    roles = cached_property(lambda self: self._load("roles"))
    users = cached_property(lambda self: self._load("users"))
    customers = cached_property(lambda self: self._load("customers"))
    books = cached_property(lambda self: self._load("books"))
    orders = cached_property(lambda self: self._load("orders"))
    order_items = cached_property(lambda self: self._load("order_items"))
    audit_log = cached_property(lambda self: self._load("audit_log"))


# ---------------------------------------------------------------------------
# The same views for DuckDB (oracle side).  Names carry a v_ prefix because
# the raw table "orders" is registered under its own name.
# ---------------------------------------------------------------------------
ADAPTER_SQL = f"""
v_roles AS (
  SELECT * FROM (VALUES (1::BIGINT, '{S.ROLE_CUSTOMER}'), (2::BIGINT, '{S.ROLE_SELLER}'),
                        (3::BIGINT, '{S.ROLE_ADMIN}')) t(role_id, role_name)
),
v_users AS (
  SELECT c_custkey AS user_id, c_name AS username, upper(sha256(c_name)) AS password_hash,
         CAST(c_nationkey % 3 + 1 AS BIGINT) AS role_id,
         CASE WHEN c_acctbal < 0 THEN '{S.STATUS_BLOCKED}' ELSE '{S.STATUS_ACTIVE}' END AS status,
         CAST(NULL AS TIMESTAMP) AS created_at
  FROM (SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer UNION ALL
        SELECT -n_nationkey - 1, '{STAFF_PREFIX}' || n_name, n_nationkey, 0.0 FROM nation) logins
),
v_customers AS (
  SELECT c_custkey AS customer_id, c_custkey AS user_id, c_name AS full_name,
         lower(c_name) || '{EMAIL_DOMAIN}' AS email,
         '+' || CAST(c_nationkey + 10 AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS phone,
         'Nation ' || CAST(c_nationkey AS VARCHAR) || ', ' || c_mktsegment AS address,
         CASE WHEN c_acctbal < 0 THEN '{S.STATUS_BLOCKED}' ELSE '{S.STATUS_ACTIVE}' END AS status,
         CAST(NULL AS TIMESTAMP) AS created_at
  FROM customer
),
v_books AS (
  SELECT p_partkey AS book_id,
         '{ISBN_PREFIX}' || lpad(CAST(p_partkey AS VARCHAR),
              CAST(greatest({ISBN_DIGITS}, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS isbn,
         p_name AS title, p_brand AS author,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         CAST(p_size AS BIGINT) AS stock, p_type AS category,
         '{{"pages": ' || CAST(p_size * {PAGES_PER_SIZE} AS VARCHAR) || '}}' AS attributes_json,
         CASE WHEN p_size <= {DATED_SIZE} THEN CAST(DATE '{FIRST_DAY}' + CAST(p_size AS INTEGER) AS TIMESTAMP) END
           AS created_at, CAST(NULL AS VARCHAR) AS image_url,
         CAST(p_partkey % {DISCOUNT_CYCLE} AS DECIMAL(5,2)) AS discount_percent,
         CAST(CAST(p_retailprice AS DECIMAL(10,2))
              * (100 - CAST(p_partkey % {DISCOUNT_CYCLE} AS DECIMAL(5,2))) * 0.01
              AS DECIMAL(10,2)) AS price_after_discount,
         CASE WHEN p_size = {ARCHIVED_SIZE} THEN 1 ELSE 0 END AS is_archived
  FROM part
),
v_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
         CASE o_orderstatus WHEN 'O' THEN '{S.ORDER_NEW}' WHEN 'F' THEN '{S.ORDER_PAID}'
                            WHEN 'P' THEN '{S.ORDER_SHIPPED}' END AS status,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount
  FROM orders
),
v_order_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS book_id, CAST(l_quantity AS BIGINT) AS qty,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS price
  FROM lineitem
),
v_audit_log AS (
  SELECT event_id AS log_id, CAST(user_id AS VARCHAR) AS who, 'events' AS what_table,
         event_type AS action, props AS details_json, ts
  FROM events
)"""


def with_adapter(sql_body: str, extra_ctes: str = "") -> str:
    """Prefix a DuckDB query with the adapter views (and optional extra CTEs)."""
    ctes = ADAPTER_SQL
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip().rstrip(",")
    return f"WITH {ctes}\n{sql_body}"
