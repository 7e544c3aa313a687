"""Users, roles and customer profiles: lookups, joins, visibility rules and
login matching (B6–B8, B11, C3–C9, I6, I7, I25).

All lookups are batch joins of a request table against the snapshot.  No side
is broadcast by hint; AQE broadcasts only below its measured size threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.joins import restrict_to
from ..functions.text import equals_ci, is_open_order, password_hash


REPEATS_PER_ARRAY = 4096


def first_by_seq(requests: DataFrame, key: str | list[str], seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Split requests into the first per key and the others.

    Exactly one row per key wins: the lowest ``seq``, a NULL ``seq`` after all
    numbers, ties by the remaining columns.  Rows that are equal in every column
    count as one winner and n - 1 losers.  Both steps are map-side reduced
    aggregates without a window, so a key repeated a million times costs no
    task all its rows; repeats come back in short arrays."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = requests.columns
    rank = F.struct(F.col(seq).isNull().alias("no_seq"), F.col(seq),
                    *[F.col(c) for c in cols if c != seq and c not in keys])
    tally = requests.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    firsts = tally.groupBy(*keys).agg(F.min(rank).alias("_first"))
    winners = firsts.select(*[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in cols])
    rest = (tally.join(firsts, keys)
            .withColumn("_n", F.col("_n") - F.when(rank.eqNullSafe(F.col("_first")), 1).otherwise(0))
            .filter(F.col("_n") > 0).select(*cols, "_n"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {REPEATS_PER_ARRAY}")))
    losers = (rest.withColumn("_chunk", chunk)
              .withColumn("_copy", F.explode(F.expr(
                  f"sequence(1L, least({REPEATS_PER_ARRAY}L, _n - _chunk * {REPEATS_PER_ARRAY}L))")))
              .select(*cols))
    return winners, losers


def roles_dim(roles: DataFrame) -> DataFrame:
    """The role columns; no broadcast hint, the table grows with add_roles and
    its size decides at run time."""
    return roles.select("role_id", "role_name")


# B6 --------------------------------------------------------------------------
def orders_of_customers(orders: DataFrame, requests: DataFrame) -> DataFrame:
    """ViewOrders for a set of customer ids."""
    return (orders.join(requests.select("customer_id").distinct(), "customer_id", "left_semi")
            .select("order_id", "customer_id", "order_date", "status", "total_amount"))


# B7 --------------------------------------------------------------------------
def lookup_user_ci(users: DataFrame, logins: DataFrame) -> DataFrame:
    """UPPER(username) = UPPER(login); unmatched logins get NULL."""
    req = logins.select("login", F.upper("login").alias("_k"))
    u = restrict_to(users.select(F.upper("username").alias("_k"), "user_id", "username"), req, "_k")
    return req.join(u, "_k", "left").select("login", "user_id", "username")


# B11 -------------------------------------------------------------------------
def masked_profile(requests: DataFrame, users: DataFrame, roles: DataFrame,
                   customers: DataFrame) -> DataFrame:
    """Contact columns are visible to an Admin viewer or to the target
    themself, NULL otherwise."""
    r = requests.select("viewer", "target")
    viewer = (restrict_to(users.select(F.col("username").alias("viewer"), "role_id"), r, "viewer")
              .join(roles_dim(roles), "role_id")
              .select("viewer", (F.col("role_name") == S.ROLE_ADMIN).alias("viewer_is_admin")))
    target = restrict_to(users.select(F.col("username").alias("target"), "user_id"), r, "target")
    target = target.join(customers.select("user_id", "full_name", "email", "phone", "address"),
                         "user_id", "left")
    r = r.join(viewer, "viewer", "left").join(target, "target", "left")
    allowed = F.coalesce(F.col("viewer_is_admin"), F.lit(False)) | (F.col("viewer") == F.col("target"))
    return r.select("viewer", "target", "full_name",
                    *[F.when(allowed, F.col(c)).alias(c) for c in ("email", "phone", "address")],
                    F.coalesce(allowed, F.lit(False)).alias("contacts_visible"))


# C3 / C4 / C5 -----------------------------------------------------------------
def user_customer(users: DataFrame, customers: DataFrame) -> DataFrame:
    return (customers.select("customer_id", "user_id", "full_name", "email")
            .join(users.select("user_id", "username"), "user_id")
            .select("username", "customer_id", "full_name", "email"))


def open_carts_by_login(users: DataFrame, customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Open orders per login.  The two profile tables meet first, so the
    order table is shuffled once (by customer) when nothing is broadcast."""
    logins = (customers.select("customer_id", "user_id")
              .join(users.select("user_id", "username"), "user_id"))
    return (orders.filter(is_open_order(F.col("status"))).select("order_id", "customer_id")
            .join(logins, "customer_id")
            .select("username", "customer_id", "order_id"))


def user_profile_left(users: DataFrame, customers: DataFrame) -> DataFrame:
    return (users.select("user_id", "username")
            .join(customers.select("user_id", "customer_id", "full_name"), "user_id", "left")
            .select("user_id", "username", "customer_id", "full_name"))


# C7 --------------------------------------------------------------------------
def resolve_role_ci(requests: DataFrame, roles: DataFrame) -> DataFrame:
    """UPPER(role_name) = UPPER(asked name); unresolved names keep NULL."""
    r = roles_dim(roles).select(F.upper("role_name").alias("_k"), "role_id")
    return (requests.withColumn("_k", F.upper("role_name")).join(r, "_k", "left").drop("_k"))


def resolve_role(requests: DataFrame, roles: DataFrame) -> DataFrame:
    """Role name → role_id; unresolved names keep role_id NULL."""
    return (requests.join(roles_dim(roles), "role_name", "left")
            .withColumn("resolved", F.col("role_id").isNotNull()))


# C8 --------------------------------------------------------------------------
def resolve_book(requests: DataFrame, books: DataFrame) -> DataFrame:
    """Book by isbn, else by exact title, else rejected.  Several books with
    one isbn or title resolve to the lowest book id."""
    by_isbn = (restrict_to(books.select("isbn", "book_id"), requests, "isbn")
               .groupBy("isbn").agg(F.min("book_id").alias("id_by_isbn")))
    by_title = (restrict_to(books.select("title", "book_id"), requests, "title")
                .groupBy("title").agg(F.min("book_id").alias("id_by_title")))
    r = requests.join(by_isbn, "isbn", "left").join(by_title, "title", "left")
    return r.select(
        "seq", "isbn", "title",
        F.coalesce("id_by_isbn", "id_by_title").alias("book_id"),
        F.when(F.col("id_by_isbn").isNotNull(), "isbn")
         .when(F.col("id_by_title").isNotNull(), "title").alias("matched_by"))


# C9 / I25 --------------------------------------------------------------------
def match_credentials(attempts: DataFrame, users: DataFrame) -> DataFrame:
    """Login(username, hash) for a batch: user_id or NULL."""
    u = restrict_to(users.select("username", "password_hash", "user_id"), attempts,
                    ["username", "password_hash"])
    return (attempts.join(u, ["username", "password_hash"], "left")
            .select("seq", "username", "user_id"))


def match_login(attempts: DataFrame, users: DataFrame) -> DataFrame:
    """Login with the plain password: compared through its SHA-256 hash;
    blocked users never match."""
    u = (users.filter(~F.col("status").eqNullSafe(S.STATUS_BLOCKED))
         .select(F.col("username").alias("login"), "password_hash", "user_id"))
    a = attempts.select("seq", "login", password_hash(F.col("password")).alias("password_hash"))
    u = restrict_to(u, a, ["login", "password_hash"])
    return a.join(u, ["login", "password_hash"], "left").select("seq", "login", "user_id")


# I6 / I7 ---------------------------------------------------------------------
def check_accounts(users: DataFrame, roles: DataFrame, username=None, status=None) -> DataFrame:
    """Optional filters: case-insensitive username equality and status."""
    cond: Column = F.lit(True)
    if username is not None:
        cond = cond & equals_ci(F.col("username"), username)
    if status is not None:
        cond = cond & (F.col("status") == status)
    return (users.filter(cond).join(roles_dim(roles), "role_id", "left")
            .select("user_id", "username", "role_name", "status"))


def users_report(users: DataFrame, roles: DataFrame, customers: DataFrame) -> DataFrame:
    return (users.join(roles_dim(roles), "role_id")
            .join(customers.select("user_id", "customer_id", "full_name", "email", "phone"),
                  "user_id", "left")
            .select("user_id", "username", "role_name", "status", "customer_id",
                    "full_name", "email", "phone"))
