"""Layout and statistics keys."""

from __future__ import annotations

import uuid

from ..operators import in_turn
from ..operators import layout as ops
from ..session import scratch_dir
from ..sources import partitioned
from ..sources.adapter import Domain
from . import register
from .in_turn import _LINE_REQ_SQL, line_requests

LOOKUP_CATEGORY = "ECONOMY"
PROFILE_COLUMNS = ["book_id", "isbn", "title", "author", "price", "stock", "category",
                   "attributes_json", "created_at", "image_url", "discount_percent",
                   "price_after_discount", "is_archived"]


@register("category_layout_lookup",
          f"SELECT title FROM v_books WHERE category = '{LOOKUP_CATEGORY}'")
def category_layout_lookup(d: Domain):
    """Catalogue laid out by category; the lookup reads one folder."""
    path = scratch_dir(d.spark, "layout")
    ops.write_category_layout(d.books, path)
    return ops.lookup_category(d.spark, path, LOOKUP_CATEGORY)


LOOKUP_AUTHOR = "Brand#13"
LOOKUP_ISBNS = ("978-3-000017", "978-3-000150", "978-3-999999")


@register("author_layout_lookup", f"SELECT * FROM v_books WHERE author = '{LOOKUP_AUTHOR}'")
def author_layout_lookup(d: Domain):
    """Books of an author from the layout sorted by author."""
    path = scratch_dir(d.spark, "lookup")
    ops.write_lookup_layout(d.books, path)
    return ops.lookup_value(d.spark, path, "author", LOOKUP_AUTHOR)


@register("isbn_layout_lookup", "SELECT * FROM v_books WHERE isbn IN (" + ", ".join(f"'{i}'" for i in LOOKUP_ISBNS) + ")")
def isbn_layout_lookup(d: Domain):
    """Books of some isbns (one unknown) through the Bloom filters
    of that layout."""
    path = scratch_dir(d.spark, "lookup")
    ops.write_lookup_layout(d.books, path)
    found = [ops.lookup_value(d.spark, path, "isbn", i) for i in LOOKUP_ISBNS]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _profile_sql() -> str:
    parts = []
    for c in PROFILE_COLUMNS:
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
            f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, "
            f"count(DISTINCT {c}) AS n_distinct FROM v_books")
    return "\nUNION ALL\n".join(parts)


@register("column_profile", _profile_sql())
def column_profile(d: Domain):
    """Per-column rows, NULLs, min, max and distinct count of books."""
    return ops.column_profile(d.books.select(*PROFILE_COLUMNS), exact=True)


RENAMED = {"ECONOMY": "PROMO", "STANDARD": "Учебная литература"}
_RENAME_CASE = " ".join(f"WHEN '{o}' THEN '{n}'" for o, n in RENAMED.items())


def _catalogue(d: Domain) -> str:
    """The catalogue as a table partitioned by category; its name."""
    name = f"catalogue_{uuid.uuid4().hex[:12]}"
    partitioned.publish_partitioned(d.books, name, scratch_dir(d.spark, "catalogue"), "category")
    return name


@register("recategorise_touched", f"""
SELECT b.* REPLACE (CASE category {_RENAME_CASE} ELSE category END AS category) FROM v_books b
""")
def recategorise_touched(d: Domain):
    """two categories renamed (one into another, one anew), only their
    partitions rewritten; the whole catalogue after."""
    return partitioned.rename_values(d.spark, _catalogue(d), "category", RENAMED)


@register("update_books_touched", """
SELECT b.* REPLACE (CASE WHEN w.book_id IS NULL THEN b.price ELSE w.price END AS price,
                    CASE WHEN w.book_id IS NULL THEN b.stock ELSE w.stock END AS stock)
FROM v_books b LEFT JOIN (SELECT * FROM r_line_last WHERE book_id IN
  (SELECT book_id FROM v_books WHERE category IN ('PROMO', 'SMALL'))) w ON b.book_id = w.book_id
""", extra_ctes=_LINE_REQ_SQL)
def update_books_touched(d: Domain):
    """price and stock requests for the books of two categories, applied
    in turn; only the partitions of these are rewritten."""
    wanted = d.books.filter(d.books.category.isin("PROMO", "SMALL")).select("book_id")
    requests = line_requests(d).join(wanted, "book_id", "left_semi")
    return partitioned.update_rows(d.spark, _catalogue(d), "category", "book_id", requests,
                                   lambda rows, changes: in_turn.update_books(rows, changes).snapshot)
