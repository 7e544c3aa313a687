"""Catalogue keys."""

from __future__ import annotations

from ..operators import catalog as ops
from ..operators import trigrams
from ..session import scratch_dir
from ..sources.adapter import Domain
from . import register

# Search parameters (the application takes them as procedure arguments).
AUTHOR_TERM = "brand#1"
CATEGORY_TERM = "Ar"
AUTHOR_EQ = "Brand#10"
CATEGORY_EQ = "ECONOMY"
SEARCH_KEYWORD, SEARCH_CATEGORY, SEARCH_MAX_PRICE = "ring", "m", 950

_SEARCH_COLS = "book_id, title, author, category, price"


@register("scan_books", "SELECT * FROM v_books")
def scan_books(d: Domain):
    """A1: full scan, all columns."""
    return ops.scan_books(d.books)


@register("browse_catalog", "SELECT book_id, title, author, price, stock, category FROM v_books")
def browse_catalog(d: Domain):
    """B1: catalogue projection."""
    return ops.browse_catalog(d.books)


@register("search_author", f"""
SELECT {_SEARCH_COLS} FROM v_books WHERE lower(author) LIKE lower('%' || '{AUTHOR_TERM}' || '%')
""")
def search_author(d: Domain):
    """B2: case-insensitive author substring."""
    return ops.search_author(d.books, AUTHOR_TERM)


@register("search_category", f"""
SELECT {_SEARCH_COLS} FROM v_books WHERE lower(category) LIKE lower('%' || '{CATEGORY_TERM}' || '%')
""")
def search_category(d: Domain):
    """Case-insensitive category substring."""
    return ops.search_category(d.books, CATEGORY_TERM)


@register("filter_author", f"SELECT * FROM v_books WHERE author = '{AUTHOR_EQ}'")
def filter_author(d: Domain):
    """Equality filter, all columns."""
    return ops.filter_author(d.books, AUTHOR_EQ)


@register("filter_category_title", f"SELECT title FROM v_books WHERE category = '{CATEGORY_EQ}'")
def filter_category_title(d: Domain):
    """Equality filter, one column."""
    return ops.filter_category_title(d.books, CATEGORY_EQ)


@register("key_exists", """
SELECT r.customer_id, CAST(COALESCE(t.n, 0) AS BIGINT) AS n_matches
FROM (SELECT DISTINCT customer_id FROM v_orders) r
LEFT JOIN (SELECT customer_id, count(*) AS n FROM v_customers GROUP BY customer_id) t
  ON r.customer_id = t.customer_id
""")
def key_exists(d: Domain):
    """Existence count of every customer id named by an order."""
    return ops.key_exists(d.orders.select("customer_id"), d.customers, "customer_id")


@register("search_books", f"""
SELECT {_SEARCH_COLS} FROM v_books
WHERE COALESCE(is_archived, 0) <> 1
  AND (lower(title) LIKE '%{SEARCH_KEYWORD}%' OR lower(author) LIKE '%{SEARCH_KEYWORD}%')
  AND lower(category) LIKE '%{SEARCH_CATEGORY}%'
  AND price <= CAST({SEARCH_MAX_PRICE} AS DECIMAL(10,2))
""")
def search_books(d: Domain):
    """Optional keyword / category / max price, archived excluded."""
    return ops.search_books(d.books, SEARCH_KEYWORD, SEARCH_CATEGORY, SEARCH_MAX_PRICE)


@register("search_books_all", f"""
SELECT {_SEARCH_COLS} FROM v_books WHERE COALESCE(is_archived, 0) <> 1
""")
def search_books_all(d: Domain):
    """I5 without arguments: every book that is not archived."""
    return ops.search_books(d.books)


@register("search_books_keyword", f"""
SELECT {_SEARCH_COLS} FROM v_books
WHERE COALESCE(is_archived, 0) <> 1
  AND (lower(title) LIKE '%{SEARCH_KEYWORD}%' OR lower(author) LIKE '%{SEARCH_KEYWORD}%')
""")
def search_books_keyword(d: Domain):
    """I5 by keyword alone."""
    return ops.search_books(d.books, SEARCH_KEYWORD)


# -- the same searches through the trigram postings -------------------------------------------

NAME_TERM = "001_"           # an underscore stays a wildcard


def _postings(d: Domain, books, key: str = "book_id", columns=("title", "author", "category")) -> str:
    path = scratch_dir(d.spark, "postings")
    trigrams.write_postings(books, path, columns, key)
    return path


@register("search_author_indexed", f"""
SELECT {_SEARCH_COLS} FROM v_books WHERE lower(author) LIKE lower('%' || 'D#1_' || '%')
""")
def search_author_indexed(d: Domain):
    """B2 by trigrams: author substring with a wildcard."""
    return trigrams.search_author(d.books, _postings(d, d.books), "D#1_")


@register("search_books_indexed", f"""
SELECT {_SEARCH_COLS} FROM v_books
WHERE COALESCE(is_archived, 0) <> 1
  AND (lower(title) LIKE '%{SEARCH_KEYWORD}%' OR lower(author) LIKE '%{SEARCH_KEYWORD}%')
  AND lower(category) LIKE '%pro%' AND price <= CAST({SEARCH_MAX_PRICE} AS DECIMAL(10,2))
""")
def search_books_indexed(d: Domain):
    """I5 by trigrams: keyword, category and price."""
    return trigrams.search_books(d.books, _postings(d, d.books), SEARCH_KEYWORD, "PRO", SEARCH_MAX_PRICE)


@register("search_profiles_indexed", f"SELECT customer_id, full_name FROM v_customers WHERE lower(full_name) LIKE '%{NAME_TERM}%'")
def search_profiles_indexed(d: Domain):
    """The same index over customers' names, where terms are selective."""
    path = _postings(d, d.customers, "customer_id", ("full_name",))
    return trigrams.matching(d.customers, path, ("full_name",), NAME_TERM, "customer_id").select("customer_id", "full_name")
