"""Account keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import accounts as ops
from ..sources.adapter import Domain
from . import register
from . import requests as R

CHECK_STATUS = S.STATUS_BLOCKED
CHECK_NAME = "staff FRANCE"


@register("orders_of_customer", f"""
SELECT o.order_id, o.customer_id, o.order_date, o.status, o.total_amount
FROM v_orders o
WHERE o.customer_id IN (SELECT customer_id FROM v_customers WHERE status = '{S.STATUS_BLOCKED}')
""")
def orders_of_customer(d: Domain):
    """ViewOrders for every blocked customer."""
    req = d.customers.filter(F.col("status") == S.STATUS_BLOCKED).select("customer_id")
    return ops.orders_of_customers(d.orders, req)


@register("lookup_user_ci", """
SELECT r.login, u.user_id, u.username
FROM r_logins r LEFT JOIN v_users u ON upper(r.login) = upper(u.username)
""", extra_ctes=R.LOGINS_SQL)
def lookup_user_ci(d: Domain):
    """Case-insensitive username lookup for a batch of logins."""
    return ops.lookup_user_ci(d.users, R.logins(d))


@register("masked_profile", f"""
SELECT r.viewer, r.target, t.full_name,
       CASE WHEN (COALESCE(v.viewer_is_admin, false) OR r.viewer = r.target) THEN t.email END AS email,
       CASE WHEN (COALESCE(v.viewer_is_admin, false) OR r.viewer = r.target) THEN t.phone END AS phone,
       CASE WHEN (COALESCE(v.viewer_is_admin, false) OR r.viewer = r.target) THEN t.address END AS address,
       COALESCE(COALESCE(v.viewer_is_admin, false) OR r.viewer = r.target, false) AS contacts_visible
FROM r_views r
LEFT JOIN (SELECT u.username AS viewer, ro.role_name = '{S.ROLE_ADMIN}' AS viewer_is_admin
           FROM v_users u JOIN v_roles ro ON u.role_id = ro.role_id) v ON r.viewer = v.viewer
LEFT JOIN (SELECT u.username AS target, c.full_name, c.email, c.phone, c.address
           FROM v_users u LEFT JOIN v_customers c ON u.user_id = c.user_id) t ON r.target = t.target
""", extra_ctes=R.PROFILE_VIEWS_SQL)
def masked_profile(d: Domain):
    """Contact columns only for Admin viewers or the user themself."""
    return ops.masked_profile(R.profile_views(d), d.users, d.roles, d.customers)


@register("user_customer", """
SELECT u.username, c.customer_id, c.full_name, c.email
FROM v_customers c JOIN v_users u ON c.user_id = u.user_id
""")
def user_customer(d: Domain):
    """User to customer profile."""
    return ops.user_customer(d.users, d.customers)


@register("open_carts_by_login", f"""
SELECT u.username, c.customer_id, o.order_id
FROM v_orders o JOIN v_customers c ON o.customer_id = c.customer_id
JOIN v_users u ON c.user_id = u.user_id
WHERE o.status = '{S.ORDER_NEW}'
""")
def open_carts_by_login(d: Domain):
    """C4: open orders of each login."""
    return ops.open_carts_by_login(d.users, d.customers, d.orders)


@register("user_profile_left", """
SELECT u.user_id, u.username, c.customer_id, c.full_name
FROM v_users u LEFT JOIN v_customers c ON u.user_id = c.user_id
""")
def user_profile_left(d: Domain):
    """Users with or without a profile."""
    return ops.user_profile_left(d.users, d.customers)


@register("resolve_role", """
SELECT r.seq, r.username, r.role_name, ro.role_id, ro.role_id IS NOT NULL AS resolved
FROM r_signups r LEFT JOIN v_roles ro ON r.role_name = ro.role_name
""", extra_ctes=R.USER_SIGNUPS_SQL)
def resolve_role(d: Domain):
    """Role name to role id, unresolved kept with NULL."""
    req = R.user_signups(d).select("seq", "username", "role_name")
    return ops.resolve_role(req, d.roles).select("seq", "username", "role_name", "role_id",
                                                 "resolved")


_BOOK_LOOKUPS_SQL = """
r_lookups AS (
  SELECT book_id AS seq,
         CASE WHEN stock <= 40 THEN isbn ELSE 'missing-' || CAST(book_id AS VARCHAR) END AS isbn,
         CASE WHEN stock <= 45 THEN title ELSE 'no such title' END AS title
  FROM v_books
)"""


def book_lookups(d: Domain):
    """Lookups by isbn (stock ≤ 40), by title only (41–45), or neither."""
    b = d.books
    return b.select(F.col("book_id").alias("seq"),
                    F.when(F.col("stock") <= 40, F.col("isbn"))
                     .otherwise(F.concat(F.lit("missing-"), F.col("book_id").cast("string")))
                     .alias("isbn"),
                    F.when(F.col("stock") <= 45, F.col("title"))
                     .otherwise(F.lit("no such title")).alias("title"))


@register("resolve_book", """
SELECT r.seq, r.isbn, r.title, COALESCE(i.id_by_isbn, t.id_by_title) AS book_id,
       CASE WHEN i.id_by_isbn IS NOT NULL THEN 'isbn'
            WHEN t.id_by_title IS NOT NULL THEN 'title' END AS matched_by
FROM r_lookups r
LEFT JOIN (SELECT isbn, min(book_id) AS id_by_isbn FROM v_books GROUP BY isbn) i ON r.isbn = i.isbn
LEFT JOIN (SELECT title, min(book_id) AS id_by_title FROM v_books GROUP BY title) t
  ON r.title = t.title
""", extra_ctes=_BOOK_LOOKUPS_SQL)
def resolve_book(d: Domain):
    """Isbn first, then title, else rejected (book_id NULL)."""
    return ops.resolve_book(book_lookups(d), d.books)


@register("match_credentials", """
SELECT a.seq, a.username, u.user_id
FROM r_attempts a LEFT JOIN v_users u
  ON a.username = u.username AND a.password_hash = u.password_hash
""", extra_ctes=R.CREDENTIALS_SQL)
def match_credentials(d: Domain):
    """Login(username, hash) for a batch of attempts."""
    return ops.match_credentials(R.credential_attempts(d), d.users)


@register("match_login", f"""
SELECT a.seq, a.login, u.user_id
FROM r_login a LEFT JOIN v_users u
  ON a.login = u.username AND upper(sha256(a.password)) = u.password_hash
 AND u.status IS DISTINCT FROM '{S.STATUS_BLOCKED}'
""", extra_ctes=R.LOGIN_ATTEMPTS_SQL)
def match_login(d: Domain):
    """Login with a plain password; blocked users do not match."""
    return ops.match_login(R.login_attempts(d), d.users)


@register("check_accounts", f"""
SELECT u.user_id, u.username, ro.role_name, u.status
FROM v_users u LEFT JOIN v_roles ro ON u.role_id = ro.role_id
WHERE u.status = '{CHECK_STATUS}'
""")
def check_accounts(d: Domain):
    """Accounts filtered by the optional status (no username given)."""
    return ops.check_accounts(d.users, d.roles, status=CHECK_STATUS)


@register("check_account_by_name", f"""
SELECT u.user_id, u.username, ro.role_name, u.status
FROM v_users u LEFT JOIN v_roles ro ON u.role_id = ro.role_id
WHERE lower(u.username) = lower('{CHECK_NAME}')
""")
def check_account_by_name(d: Domain):
    """Accounts of one username, in any case."""
    return ops.check_accounts(d.users, d.roles, username=CHECK_NAME)


@register("check_account_by_name_status", f"""
SELECT u.user_id, u.username, ro.role_name, u.status
FROM v_users u LEFT JOIN v_roles ro ON u.role_id = ro.role_id
WHERE lower(u.username) = lower('{CHECK_NAME}') AND u.status = '{S.STATUS_ACTIVE}'
""")
def check_account_by_name_status(d: Domain):
    """Both filters."""
    return ops.check_accounts(d.users, d.roles, username=CHECK_NAME, status=S.STATUS_ACTIVE)


@register("resolve_role_ci", """
SELECT r.seq, r.username, lower(r.role_name) AS role_name, ro.role_id
FROM r_signups r LEFT JOIN v_roles ro ON upper(r.role_name) = upper(ro.role_name)
""", extra_ctes=R.USER_SIGNUPS_SQL)
def resolve_role_ci(d: Domain):
    """Role name to role id in any case; the requests send lower case."""
    req = R.user_signups(d).select("seq", "username", F.lower("role_name").alias("role_name"))
    return ops.resolve_role_ci(req, d.roles).select("seq", "username", "role_name", "role_id")


@register("users_report", """
SELECT u.user_id, u.username, ro.role_name, u.status, c.customer_id, c.full_name, c.email, c.phone
FROM v_users u JOIN v_roles ro ON u.role_id = ro.role_id
LEFT JOIN v_customers c ON u.user_id = c.user_id
""")
def users_report(d: Domain):
    """Users with role and optional profile."""
    return ops.users_report(d.users, d.roles, d.customers)
