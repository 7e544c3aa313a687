"""Request tables for the batch jobs, derived from the input tables so that
their size grows with the data.  Each derivation has a Spark form and the
same rule as a DuckDB CTE; both must stay in step.

Rules in words:
* new accounts come from the supplier table (one sign-up per supplier);
  suppliers of nations 0–4 send a second, later request for the same name;
* existing names are re-requested by the customers of nation 0;
* the role asked for cycles with the supplier's nation: Seller, Admin,
  Customer, and an unknown role "Courier";
* hash logins (C9): every user tries with the stored hash, except sellers
  (role 2) who send a wrong one, plus unknown supplier names;
* plain-password logins (I25): every customer, with a wrong password when
  the nation is a multiple of 4;
* profile views: every user views themself and the next user by key.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import password_hash
from ..sources.adapter import Domain

# Job timestamp: "now" is a parameter so that runs repeat.
AS_OF = datetime(2025, 1, 1, 0, 0, 0)
AS_OF_SQL = "TIMESTAMP '2025-01-01 00:00:00'"
UNKNOWN_ROLE = "Courier"
SECOND_REQUEST_NATIONS = 5   # suppliers of nations below this send a duplicate
SEQ_SECOND = 1_000_000_000_000
SEQ_EXISTING = 2_000_000_000_000


def as_of() -> Column:
    return F.lit(AS_OF.strftime("%Y-%m-%d %H:%M:%S")).cast(S.TS)


def role_for_nation(n: Column) -> Column:
    m = n % 4
    return (F.when(m == 0, S.ROLE_SELLER).when(m == 1, S.ROLE_ADMIN)
            .when(m == 2, S.ROLE_CUSTOMER).otherwise(UNKNOWN_ROLE))


_ROLE_FOR_NATION_SQL = (f"CASE s_nationkey % 4 WHEN 0 THEN '{S.ROLE_SELLER}' "
                        f"WHEN 1 THEN '{S.ROLE_ADMIN}' WHEN 2 THEN '{S.ROLE_CUSTOMER}' "
                        f"ELSE '{UNKNOWN_ROLE}' END")


def user_signups(d: Domain) -> DataFrame:
    """(seq, username, password_hash, role_name, full_name, email)."""
    s = d.raw("supplier")
    first = s.select(F.col("s_suppkey").alias("seq"), F.col("s_name").alias("username"),
                     role_for_nation(F.col("s_nationkey")).alias("role_name"))
    second = (s.filter(F.col("s_nationkey") < SECOND_REQUEST_NATIONS)
              .select((F.col("s_suppkey") + SEQ_SECOND).alias("seq"),
                      F.col("s_name").alias("username"),
                      F.lit(S.ROLE_CUSTOMER).alias("role_name")))
    c = d.raw("customer")
    existing = (c.filter(F.col("c_nationkey") == 0)
                .select((F.col("c_custkey") + SEQ_EXISTING).alias("seq"),
                        F.col("c_name").alias("username"),
                        F.lit(S.ROLE_CUSTOMER).alias("role_name")))
    r = first.unionByName(second).unionByName(existing)
    return r.select("seq", "username", password_hash(F.col("username")).alias("password_hash"),
                    "role_name",
                    F.concat(F.lit("Owner of "), F.col("username")).alias("full_name"),
                    F.concat(F.lower(F.col("username")), F.lit("@suppliers.example.org"))
                     .alias("email"))


USER_SIGNUPS_SQL = f"""
r_signups AS (
  SELECT seq, username, upper(sha256(username)) AS password_hash, role_name,
         'Owner of ' || username AS full_name,
         lower(username) || '@suppliers.example.org' AS email
  FROM (
    SELECT s_suppkey AS seq, s_name AS username, {_ROLE_FOR_NATION_SQL} AS role_name FROM supplier
    UNION ALL
    SELECT s_suppkey + {SEQ_SECOND}, s_name, '{S.ROLE_CUSTOMER}' FROM supplier
    WHERE s_nationkey < {SECOND_REQUEST_NATIONS}
    UNION ALL
    SELECT c_custkey + {SEQ_EXISTING}, c_name, '{S.ROLE_CUSTOMER}' FROM customer WHERE c_nationkey = 0
  ) x
)"""


def logins(d: Domain) -> DataFrame:
    c = d.raw("customer").select(F.lower("c_name").alias("login"))
    s = d.raw("supplier").select(F.col("s_name").alias("login"))
    return c.unionByName(s)


LOGINS_SQL = """
r_logins AS (
  SELECT lower(c_name) AS login FROM customer UNION ALL SELECT s_name FROM supplier
)"""


def credential_attempts(d: Domain) -> DataFrame:
    u = d.users.select(F.col("user_id").alias("seq"), "username",
                       F.when(F.col("role_id") == 2, F.lit("WRONG"))
                        .otherwise(F.col("password_hash")).alias("password_hash"))
    s = d.raw("supplier").select((-(F.col("s_suppkey") + 1)).alias("seq"),
                                 F.col("s_name").alias("username"),
                                 password_hash(F.col("s_name")).alias("password_hash"))
    return u.unionByName(s)


CREDENTIALS_SQL = """
r_attempts AS (
  SELECT user_id AS seq, username,
         CASE WHEN role_id = 2 THEN 'WRONG' ELSE password_hash END AS password_hash
  FROM v_users
  UNION ALL
  SELECT -(s_suppkey + 1), s_name, upper(sha256(s_name)) FROM supplier
)"""


def login_attempts(d: Domain) -> DataFrame:
    c = d.raw("customer")
    return c.select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("login"),
                    F.when(F.col("c_nationkey") % 4 == 0, F.lit("wrong password"))
                     .otherwise(F.col("c_name")).alias("password"))


LOGIN_ATTEMPTS_SQL = """
r_login AS (
  SELECT c_custkey AS seq, c_name AS login,
         CASE WHEN c_nationkey % 4 = 0 THEN 'wrong password' ELSE c_name END AS password
  FROM customer
)"""


def profile_views(d: Domain) -> DataFrame:
    c = d.raw("customer").select("c_custkey", "c_name")
    self_views = c.select(F.col("c_name").alias("viewer"), F.col("c_name").alias("target"))
    nxt = c.select((F.col("c_custkey") - 1).alias("c_custkey"), F.col("c_name").alias("target"))
    next_views = (c.join(nxt, "c_custkey")
                  .select(F.col("c_name").alias("viewer"), "target"))
    return self_views.unionByName(next_views)


PROFILE_VIEWS_SQL = """
r_views AS (
  SELECT c_name AS viewer, c_name AS target FROM customer
  UNION ALL
  SELECT a.c_name, b.c_name FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1
)"""
