"""Change-log and audit keys (I22, I23) and the password-hash column (2H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import password_hash
from ..operators import audit
from ..operators import changes as ops
from ..operators import snapshots as snap_ops
from ..session import scratch_dir
from ..sources import reconcile
from ..sources import snapshot_store as store
from ..sources.adapter import Domain
from . import register
from .requests import AS_OF_SQL, as_of
from .snapshots import (_EDIT_REQ_SQL, _NEW_BOOKS_SQL, add_books_sql, delete_requests,
                        edit_requests, new_book_requests, product_delete_sql, product_edit_sql)

_COMPARED = ["isbn", "title", "author", "price", "stock", "category", "attributes_json",
             "created_at", "image_url", "discount_percent", "price_after_discount", "is_archived"]

_CHANGE_CTES = (_EDIT_REQ_SQL + "," + _NEW_BOOKS_SQL + f""",
s1 AS ({product_edit_sql('v_books')}),
s2 AS ({product_delete_sql('s1')}),
s3 AS ({add_books_sql('s2', 'r_newbooks')})""")

_CHANGED = ", ".join(f"CASE WHEN b_{c} IS DISTINCT FROM a_{c} THEN '{c}' END" for c in _COMPARED)
_DETAILS = ", ".join(
    f"CASE WHEN change <> 'UPDATE' OR b_{c} IS DISTINCT FROM a_{c} THEN "
    f"{{'k': '{c}', 'v': CAST(CASE WHEN change = 'DELETE' THEN b_{c} ELSE a_{c} END AS VARCHAR)}} END"
    for c in _COMPARED)
_SIDES = ", ".join(f"b.{c} AS b_{c}, a.{c} AS a_{c}" for c in _COMPARED)


@register("snapshot_changes", f"""
SELECT book_id, change, changed_columns, details_json FROM (
  SELECT book_id, change,
         CASE WHEN change = 'UPDATE' THEN concat_ws(',', {_CHANGED}) END AS changed_columns,
         to_json(map_from_entries(list_filter([{_DETAILS}], lambda e: e IS NOT NULL)))
           AS details_json
  FROM (
    SELECT COALESCE(b.book_id, a.book_id) AS book_id,
           CASE WHEN b.book_id IS NULL THEN 'INSERT' WHEN a.book_id IS NULL THEN 'DELETE'
                ELSE 'UPDATE' END AS change,
           {_SIDES}
    FROM v_books b FULL OUTER JOIN s3 a ON b.book_id = a.book_id
  ) x
) y WHERE change <> 'UPDATE' OR changed_columns <> ''
""", extra_ctes=_CHANGE_CTES)
def snapshot_changes(d: Domain):
    """Change log of the catalogue across edit (I10), delete (I11) and
    add (F4) jobs run one after another.  Each job starts from the version
    the job before published, so plans do not pile up."""
    root = scratch_dir(d.spark, "books-versions")

    def published(snapshot, version: int):
        store.publish(snapshot, root, version)
        return store.read_version(d.spark, root, version)

    s1 = published(snap_ops.product_edit(d.books, edit_requests(d)).snapshot, 1)
    s2 = published(snap_ops.product_delete(s1, d.order_items, delete_requests(s1)).snapshot, 2)
    s3 = published(snap_ops.add_books(s2, new_book_requests(d), as_of()).snapshot, 3)
    return ops.snapshot_changes(d.books, s3, "book_id", _COMPARED)


def _step_sql(step: int, before: str, after: str) -> str:
    return f"""
  SELECT {step} AS step, book_id, change AS action,
         '{{"book_id":' || CAST(book_id AS VARCHAR) || ',"values":'
           || CAST(to_json(map_from_entries(list_filter([{_DETAILS}], lambda e: e IS NOT NULL))) AS VARCHAR) || '}}' AS details_json
  FROM (
    SELECT COALESCE(b.book_id, a.book_id) AS book_id,
           CASE WHEN b.book_id IS NULL THEN 'INSERT' WHEN a.book_id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS change, {_SIDES}
    FROM {before} b FULL OUTER JOIN {after} a ON b.book_id = a.book_id
  ) x WHERE change <> 'UPDATE' OR concat_ws(',', {_CHANGED}) <> ''"""


@register("log_action", f"""
SELECT log_id, who, what_table, action, details_json, ts FROM v_audit_log
UNION ALL
SELECT (SELECT max(log_id) FROM v_audit_log) + row_number() OVER (ORDER BY step, book_id, action) AS log_id,
       'seller' AS who, 'books' AS what_table, action, details_json, {AS_OF_SQL} AS ts
FROM ({_step_sql(1, 'v_books', 's1')} UNION ALL {_step_sql(2, 's1', 's2')} UNION ALL {_step_sql(3, 's2', 's3')}) c
""", extra_ctes=_CHANGE_CTES)
def log_action(d: Domain):
    """The whole audit log after an edit, a delete and an add job on the
    catalogue, each of which appends its rows."""
    root, log = scratch_dir(d.spark, "books-audited"), d.audit_log

    def done(before, job, version: int, log):
        after = d.spark.read.parquet(store.publish(job.snapshot, root, version))
        return after, audit.log_action(log, before, after, "book_id", "books", as_of(), who="seller").log

    s1, log = done(d.books, snap_ops.product_edit(d.books, edit_requests(d)), 1, log)
    s2, log = done(s1, snap_ops.product_delete(s1, d.order_items, delete_requests(s1)), 2, log)
    _, log = done(s2, snap_ops.add_books(s2, new_book_requests(d), as_of()), 3, log)
    return log


_DIFF_BUCKETS = 32


@register("version_diff", """
SELECT 'before' AS side, x.*, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM v_books EXCEPT ALL SELECT * FROM s3) x
UNION ALL
SELECT 'after', x.*, CAST(1 AS BIGINT) FROM (SELECT * FROM s3 EXCEPT ALL SELECT * FROM v_books) x
""", extra_ctes=_CHANGE_CTES)
def version_diff(d: Domain):
    """Rows in which the catalogue after edit, delete and add differs from
    the one before, found through bucket digests."""
    root = scratch_dir(d.spark, "books-digested")
    first = reconcile.publish_digested(d.books, root, 1, "book_id", _DIFF_BUCKETS)
    edited = d.spark.read.parquet(store.publish(snap_ops.product_edit(first, edit_requests(d)).snapshot, root + "-steps", 1))
    cut = snap_ops.product_delete(edited, d.order_items, delete_requests(edited)).snapshot
    cut = d.spark.read.parquet(store.publish(cut, root + "-steps", 2))
    reconcile.publish_digested(snap_ops.add_books(cut, new_book_requests(d), as_of()).snapshot, root, 2, "book_id", _DIFF_BUCKETS)
    return reconcile.differing_rows(d.spark, root, 1, 2)


@register("view_logs", "SELECT * FROM v_audit_log ORDER BY ts DESC NULLS LAST, log_id DESC")
def view_logs(d: Domain):
    """The whole audit listing, newest first."""
    return ops.view_logs(d.audit_log)


@register("hash_column", """
SELECT user_id, username, upper(sha256(username)) AS name_hash,
       upper(sha256(username)) = password_hash AS hash_matches
FROM v_users
""")
def hash_column(d: Domain):
    """2H: upper-case hex SHA-256 of a text column, compared with the
    stored hash."""
    h = password_hash(F.col("username"))
    return d.users.select("user_id", "username", h.alias("name_hash"),
                          (h == F.col("password_hash")).alias("hash_matches"))
