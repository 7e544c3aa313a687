"""Keys of the identity columns: numbers are never handed out twice (F2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import snapshots as ops
from ..session import scratch_dir
from ..sources import identity
from ..sources import snapshot_store as store
from ..sources.adapter import Domain
from . import register
from .requests import AS_OF_SQL, as_of

# The nation of the newest customer closes its accounts, the newest one with
# them; then every staff login without a profile gets one.
_CLOSED_SQL = f"""
r_closed AS (
  SELECT c_custkey AS customer_id FROM customer
  WHERE c_nationkey = (SELECT c_nationkey FROM customer ORDER BY c_custkey DESC LIMIT 1)
),
r_joined AS (
  SELECT (SELECT max(customer_id) FROM v_customers) + row_number() OVER (ORDER BY u.user_id DESC) AS customer_id, u.user_id,
         u.username AS full_name, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone,
         CAST(NULL AS VARCHAR) AS address, '{S.STATUS_ACTIVE}' AS status, {AS_OF_SQL} AS created_at
  FROM v_users u WHERE NOT EXISTS (SELECT 1 FROM v_customers c WHERE c.user_id = u.user_id)
)"""


def _versions(d: Domain, root: str):
    """Customers after accounts closed (version 2) and the profiles that join
    then (version 3), numbered by the identity."""
    first = identity.publish_first(d.customers, root, ["customer_id"])
    newest = d.raw("customer").orderBy(F.desc("c_custkey")).limit(1).select("c_nationkey")
    closed = d.raw("customer").join(newest, "c_nationkey").select(F.col("c_custkey").alias("customer_id"))
    left = ops.cascade_delete(first, d.orders, d.order_items, closed).customers
    second = d.spark.read.parquet(store.publish(left, root, 2))
    logins = d.users.join(d.customers.select("user_id"), "user_id", "left_anti")
    new = identity.take_ids(logins.select("user_id", "username"), [F.col("user_id").desc()], root, 3, "customer_id")
    added = ops.conform(ops.apply_defaults(new.select("customer_id", "user_id", F.col("username").alias("full_name")),
                                           "customers", as_of()), S.CUSTOMERS_SCHEMA)
    return second, added


@register("identity_after_delete", """
SELECT * FROM v_customers WHERE customer_id NOT IN (SELECT customer_id FROM r_closed)
UNION ALL
SELECT * FROM r_joined
""", extra_ctes=_CLOSED_SQL)
def identity_after_delete(d: Domain):
    """the whole customer table after the newest customers were deleted
    and new ones added: no number of a deleted customer comes back."""
    root = scratch_dir(d.spark, "customers-identity")
    second, added = _versions(d, root)
    return d.spark.read.parquet(store.publish(second.unionByName(added), root, 3))
