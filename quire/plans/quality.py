"""Quality keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import quality as ops
from ..sources.adapter import Domain, padded_isbn
from . import register
from . import requests as R

JUNK_PER_SIZE = 9        # incoming titles get p_size × 9 filler characters
BAD_JSON_EVERY = 7       # sizes divisible by this arrive with a cut-off JSON text


# A staged load with dangling references, all derived from the tables: blocked users ask for a role that
# does not exist, profiles of blocked customers, paid orders and lines of one quantity each point at keys
# beyond the parent's.
UNKNOWN_SHIFT = 1_000_000_000_000
BAD_ORDER_QTY, BAD_BOOK_QTY = 49, 50

_STAGED_SQL = f"""
s_users AS (SELECT user_id, CASE WHEN status = '{S.STATUS_BLOCKED}' THEN role_id + {UNKNOWN_SHIFT}
                                 ELSE role_id END AS role_id FROM v_users),
s_customers AS (SELECT customer_id, CASE WHEN status = '{S.STATUS_BLOCKED}' THEN user_id + {UNKNOWN_SHIFT}
                                         ELSE user_id END AS user_id FROM v_customers),
s_orders AS (SELECT order_id, CASE WHEN status = '{S.ORDER_PAID}' THEN customer_id + {UNKNOWN_SHIFT}
                                   ELSE customer_id END AS customer_id FROM v_orders),
s_items AS (SELECT CASE WHEN qty = {BAD_ORDER_QTY} THEN order_id + {UNKNOWN_SHIFT} ELSE order_id END AS order_id,
                   CASE WHEN qty = {BAD_BOOK_QTY} THEN book_id + {UNKNOWN_SHIFT} ELSE book_id END AS book_id
            FROM v_order_items)"""


def _shifted(df, col: str, bad):
    return df.withColumn(col, F.when(bad, F.col(col) + UNKNOWN_SHIFT).otherwise(F.col(col)))


@register("fk_violations", """
SELECT 'users.role_id->roles' AS fk_name, role_id AS key, count(*) AS n_rows FROM s_users x
WHERE role_id IS NOT NULL AND role_id NOT IN (SELECT role_id FROM v_roles) GROUP BY role_id
UNION ALL
SELECT 'customers.user_id->users', user_id, count(*) FROM s_customers x
WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM v_users p WHERE p.user_id = x.user_id)
GROUP BY user_id
UNION ALL
SELECT 'orders.customer_id->customers', customer_id, count(*) FROM s_orders x
WHERE customer_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM v_customers p WHERE p.customer_id = x.customer_id)
GROUP BY customer_id
UNION ALL
SELECT 'order_items.order_id->orders', order_id, count(*) FROM s_items x
WHERE order_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM v_orders p WHERE p.order_id = x.order_id)
GROUP BY order_id
UNION ALL
SELECT 'order_items.book_id->books', book_id, count(*) FROM s_items x
WHERE book_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM v_books p WHERE p.book_id = x.book_id)
GROUP BY book_id
""", extra_ctes=_STAGED_SQL)
def fk_violations(d: Domain):
    """Dangling foreign keys of a staged load over the five references."""
    blocked = F.col("status") == S.STATUS_BLOCKED
    items = _shifted(d.order_items, "order_id", F.col("qty") == BAD_ORDER_QTY)
    return ops.fk_violations(ops.domain_fk_edges(
        d.roles, _shifted(d.users, "role_id", blocked), _shifted(d.customers, "user_id", blocked), d.books,
        _shifted(d.orders, "customer_id", F.col("status") == S.ORDER_PAID),
        _shifted(items, "book_id", F.col("qty") == BAD_BOOK_QTY)))


_RESERVED_REQ_SQL = f"""
r_names AS (
  SELECT c_custkey AS seq,
         CASE c_nationkey WHEN 0 THEN '{S.RESERVED_USERNAME}' WHEN 1 THEN 'Admin' ELSE c_name END
           AS username
  FROM customer
)"""


def reserved_requests(d: Domain):
    """User inserts where nation 0 asks for the reserved name and nation 1
    for its capitalised form (which is allowed)."""
    c = d.raw("customer")
    name = (F.when(F.col("c_nationkey") == 0, F.lit(S.RESERVED_USERNAME))
            .when(F.col("c_nationkey") == 1, F.lit("Admin")).otherwise(F.col("c_name")))
    return c.select(F.col("c_custkey").alias("seq"), name.alias("username"))


@register("reject_reserved_user", f"""
SELECT seq, username, NOT (username IS NOT DISTINCT FROM '{S.RESERVED_USERNAME}') AS accepted,
       CASE WHEN username IS NOT DISTINCT FROM '{S.RESERVED_USERNAME}'
            THEN 'reserved username' END AS reason
FROM r_names
""", extra_ctes=_RESERVED_REQ_SQL)
def reject_reserved_user(d: Domain):
    """G1: the reserved login is rejected (case-sensitive)."""
    return ops.reserved_user_report(reserved_requests(d))


def incoming_books(d: Domain):
    """A catalogue batch derived from part with over-long titles and
    cut-off JSON texts for some rows."""
    p = d.raw("part")
    pages = F.concat(F.lit('{"pages": '), F.col("p_size").cast("string"))
    return p.select(
        F.col("p_partkey").alias("book_id"), padded_isbn(F.col("p_partkey")).alias("isbn"),
        F.concat(F.col("p_name"), F.lit(" "),
                 F.repeat(F.lit("x"), F.col("p_size") * JUNK_PER_SIZE)).alias("title"),
        F.col("p_brand").alias("author"), F.col("p_type").alias("category"),
        F.when(F.col("p_size") % BAD_JSON_EVERY == 0, pages)
         .otherwise(F.concat(pages, F.lit("}"))).alias("attributes_json"))


_INCOMING_SQL = f"""
r_incoming AS (
  SELECT p_partkey AS book_id, p_name || ' ' || repeat('x', p_size * {JUNK_PER_SIZE}) AS title,
         p_brand AS author, p_type AS category,
         '978-3-' || lpad(CAST(p_partkey AS VARCHAR),
              CAST(greatest(6, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS isbn,
         CASE WHEN p_size % {BAD_JSON_EVERY} = 0 THEN '{{"pages": ' || CAST(p_size AS VARCHAR)
              ELSE '{{"pages": ' || CAST(p_size AS VARCHAR) || '}}' END AS attributes_json
  FROM part
)"""


def _rules_sql(table: str, src: str, key: str) -> list[str]:
    """The G2 rules of one table as DuckDB SELECTs (same rule table as the
    Spark side)."""
    out = []
    for c in S.NOT_NULL.get(table, []):
        out.append(f"SELECT '{table}' AS table_name, CAST({key} AS BIGINT) AS key, "
                   f"'{c}_null' AS rule FROM {src} WHERE {c} IS NULL")
    for c, n in S.MAX_LEN.get(table, {}).items():
        out.append(f"SELECT '{table}' AS table_name, CAST({key} AS BIGINT) AS key, "
                   f"'{c}_too_long' AS rule FROM {src} "
                   f"WHERE length({c}) > {n}")
    jc = S.JSON_COLUMNS.get(table)
    if jc:
        out.append(f"SELECT '{table}' AS table_name, CAST({key} AS BIGINT) AS key, "
                   f"'{jc}_not_json' AS rule FROM {src} "
                   f"WHERE {jc} IS NOT NULL AND NOT json_valid({jc})")
    return out


_RULE_SOURCES = {"roles": "v_roles", "users": "v_users", "customers": "v_customers", "books": "r_incoming",
                 "orders": "v_orders", "audit_log": "v_audit_log"}
_CV_SQL = "\nUNION ALL\n".join(
    rule for table, src in _RULE_SOURCES.items() for rule in _rules_sql(table, src, S.PRIMARY_KEYS[table]))


@register("constraint_violations", _CV_SQL, extra_ctes=_INCOMING_SQL)
def constraint_violations(d: Domain):
    """NOT NULL, length and JSON rules of every table that has rules; the
    books are an incoming catalogue batch."""
    tables = {t: getattr(d, t) for t in _RULE_SOURCES} | {"books": incoming_books(d)}
    return ops.union_all([ops.constraint_violations(t, df, S.PRIMARY_KEYS[t]) for t, df in tables.items()])


def _duplicates_sql(table: str, key: str, source: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{key}' AS key_name, CAST({key} AS VARCHAR) AS key_value, "
            f"count(*) AS n FROM {source} x WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1")


_STAGED_KEYS_SQL = {
    ("users", "username"): "(SELECT username FROM v_users UNION ALL SELECT username FROM r_signups)",
    ("customers", "email"): "(SELECT email FROM v_customers UNION ALL SELECT email FROM r_signups)",
    ("roles", "role_name"): "(SELECT role_name FROM v_roles UNION ALL SELECT DISTINCT role_name FROM r_signups)",
}


@register("duplicate_keys", "\nUNION ALL\n".join(
    [_duplicates_sql(t, k, _STAGED_KEYS_SQL[t, k]) for t, keys in S.UNIQUE_KEYS.items() for k in keys]
    + [_duplicates_sql(t, k, f"v_{t}") for t, k in S.PRIMARY_KEYS.items()]), extra_ctes=R.USER_SIGNUPS_SQL)
def duplicate_keys(d: Domain):
    """Unique keys that would break if the sign-ups and the roles they
    name were loaded as they are, plus every table's primary key."""
    signups = R.user_signups(d)
    staged = {
        ("users", "username"): d.users.select("username").unionByName(signups.select("username")),
        ("customers", "email"): d.customers.select("email").unionByName(signups.select("email")),
        ("roles", "role_name"): d.roles.select("role_name").unionByName(signups.select("role_name").distinct()),
    }
    return ops.union_all(
        [ops.duplicate_keys(t, staged[t, k], k) for t, keys in S.UNIQUE_KEYS.items() for k in keys]
        + [ops.duplicate_keys(t, getattr(d, t), k) for t, k in S.PRIMARY_KEYS.items()])
