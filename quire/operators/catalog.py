"""Catalogue scans, projections and searches.

Searches are predicates over the whole catalogue.  Equality predicates on
plain columns reach the Parquet scan as pushed filters; ``lower(x) LIKE``
cannot be pushed down, so those are a full column scan with codegen'd
filtering (the same work a B-tree-less database does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.joins import restrict_to
from ..functions.text import contains_ci, starts_with

CATALOG_COLUMNS = ["book_id", "title", "author", "price", "stock", "category"]
SEARCH_COLUMNS = ["book_id", "title", "author", "category", "price"]


def scan_books(books: DataFrame) -> DataFrame:
    """A1: SELECT * FROM books."""
    return books


def browse_catalog(books: DataFrame) -> DataFrame:
    """B1: the six catalogue columns."""
    return books.select(*CATALOG_COLUMNS)


def search_author(books: DataFrame, term) -> DataFrame:
    """B2: case-insensitive substring match on author (`%`/`_` in the term
    stay wildcards, `\\` is literal, NULL term matches every non-NULL author)."""
    return books.filter(contains_ci(F.col("author"), term)).select(*SEARCH_COLUMNS)


def search_category(books: DataFrame, term) -> DataFrame:
    """As B2 on category."""
    return books.filter(contains_ci(F.col("category"), term)).select(*SEARCH_COLUMNS)


def filter_author(books: DataFrame, author: str) -> DataFrame:
    """All columns of the books by one author (pushed to the scan)."""
    return books.filter(F.col("author") == author)


def filter_category_title(books: DataFrame, category: str) -> DataFrame:
    """Titles of one category (pushed to the scan, one column read)."""
    return books.filter(F.col("category") == category).select("title")


def is_archived_book():
    """archived = title starts with the archive prefix, stock 0, flag 1."""
    return (starts_with(F.col("title"), S.ARCHIVE_PREFIX) & (F.col("stock") == 0)
            & (F.col("is_archived") == 1))


def archived_check(books: DataFrame) -> DataFrame:
    return books.select("book_id", "title",
                        F.coalesce(is_archived_book(), F.lit(False)).alias("archived"))


def key_exists(requests: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """B10 batch form: for each requested key, how many target rows carry
    it (0 = absent).  Target keys are counted first (one row per key), so the
    join never multiplies rows."""
    req = requests.select(key).distinct()
    counts = (restrict_to(target.select(key), req, key)
              .groupBy(key).agg(F.count(F.lit(1)).alias("n_matches")))
    return (req.join(counts, key, "left")
            .select(key, F.coalesce(F.col("n_matches"), F.lit(0)).cast("long").alias("n_matches")))


def search_books(books: DataFrame, keyword=None, category=None, max_price=None) -> DataFrame:
    """Optional AND-ed filters: keyword in title or author, category
    substring, price ceiling; archived books are never returned."""
    cond = F.coalesce(F.col("is_archived"), F.lit(0)) != 1
    if keyword is not None:
        cond = cond & (contains_ci(F.col("title"), keyword) | contains_ci(F.col("author"), keyword))
    if category is not None:
        cond = cond & contains_ci(F.col("category"), category)
    if max_price is not None:
        cond = cond & (F.col("price") <= F.lit(max_price).cast(S.PRICE))
    return books.filter(cond).select(*SEARCH_COLUMNS)
