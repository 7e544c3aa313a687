"""Keys of the sales sums kept over versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rollups
from ..operators import snapshots as ops
from ..session import scratch_dir
from ..sources import snapshot_store as store
from ..sources.adapter import Domain
from . import register
from .snapshots import _ADD_ITEMS_SQL, _REMOVE_SQL, add_item_requests, remove_item_requests

# The three jobs on the line table: units returned, lines added, and the
# accounts of one nation deleted with their orders.
CLOSED_NATION = 4

_FINAL_SQL = _REMOVE_SQL + "," + _ADD_ITEMS_SQL + f""",
r_final AS (
  SELECT * FROM (
    SELECT order_id, book_id, qty, price FROM v_order_items WHERE order_id NOT IN (SELECT order_id FROM r_rem_ok)
    UNION ALL
    SELECT order_id, book_id, q, price FROM (
      SELECT order_id, book_id, CASE WHEN minus IS NULL THEN qty ELSE least(qty, upto - minus) END AS q, price FROM r_upto) u
    WHERE q IS NULL OR q > 0
    UNION ALL
    SELECT order_id, book_id, qty, price FROM r_add_ok) l
  WHERE order_id NOT IN (SELECT order_id FROM v_orders WHERE customer_id IN
    (SELECT c_custkey FROM customer WHERE c_nationkey = {CLOSED_NATION}))
)"""


def _covered(d: Domain):
    """Sums that cover the line table after the three jobs, from the full sums
    of the first version and three deltas."""
    root = scratch_dir(d.spark, "sales")
    rollups.publish(rollups.book_sums(d.order_items), root, 1)

    def version(n: int, lines):
        return d.spark.read.parquet(store.publish(lines, f"{root}/lines", n))

    cut = ops.order_remove_items(d.orders, d.order_items, remove_item_requests(d))
    second = version(2, cut.order_items)
    rollups.publish(rollups.delta(cut.lowered, cut.removed), root, 2)
    more = ops.order_add_items(d.orders, d.books, second, add_item_requests(d))
    third = version(3, more.order_items)
    rollups.publish(rollups.delta(more.added, None), root, 3)
    gone = d.raw("customer").filter(F.col("c_nationkey") == CLOSED_NATION).select(F.col("c_custkey").alias("customer_id"))
    left = ops.cascade_delete(d.customers, d.orders, third, gone)
    orders = d.orders.join(gone, "customer_id", "left_semi").select("order_id")
    version(4, left.order_items)
    rollups.publish(rollups.delta(None, third.join(orders, "order_id", "left_semi")), root, 4)
    return rollups.current(d.spark, root, range(1, 5))


@register("book_sales_rollup", """
SELECT book_id, count(*) AS n_lines, CAST(sum(qty) AS BIGINT) AS qty, CAST(sum(qty * price) AS DECIMAL(38,2)) AS amount,
       CAST(sum(CASE WHEN order_id IS NOT NULL THEN qty ELSE 0 END) AS BIGINT) AS sold_qty
FROM r_final GROUP BY book_id
""", extra_ctes=_FINAL_SQL)
def book_sales_rollup(d: Domain):
    """Sums per book after three jobs, from deltas: equal to the full aggregate."""
    return _covered(d).select("book_id", "n_lines", "qty", "amount", "sold_qty")


@register("sales_by_title_rollup", """
SELECT b.title, CAST(SUM(i.qty) AS BIGINT) AS qty, CAST(SUM(i.qty * i.price) AS DECIMAL(38,2)) AS revenue
FROM r_final i JOIN v_books b ON i.book_id = b.book_id
GROUP BY b.title ORDER BY qty DESC NULLS FIRST
""", extra_ctes=_FINAL_SQL)
def sales_by_title_rollup(d: Domain):
    """D4 from the kept sums."""
    return rollups.sales_by_title(_covered(d), d.books)


@register("popular_products_rollup", """
SELECT s.book_id, b.title, b.author, s.qty, s.revenue
FROM (SELECT book_id, CAST(SUM(qty) AS BIGINT) AS qty, CAST(SUM(qty * price) AS DECIMAL(38,2)) AS revenue
      FROM r_final WHERE order_id IS NOT NULL GROUP BY book_id) s
JOIN v_books b ON b.book_id = s.book_id
ORDER BY s.qty DESC NULLS LAST, s.revenue DESC NULLS LAST, s.book_id LIMIT 10
""", extra_ctes=_FINAL_SQL)
def popular_products_rollup(d: Domain):
    """I1 from the kept sums."""
    return rollups.popular_products(_covered(d), d.books, 10)
