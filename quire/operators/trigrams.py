"""Substring search through a table of trigrams.

``lower(x) LIKE '%term%'`` reads the whole column.  Beside the catalogue a
posting table is published: one row for each trigram (three neighbouring
characters of the lower-cased text) that a book's column holds, sorted by
(column, trigram), and the number of books per trigram.  A search

1. cuts the term at its wildcards (``%`` and ``_`` stay wildcards) and takes the
   trigrams of the pieces: a matching text holds them all;
2. looks their counts up and intersects the postings of the ``RAREST`` ones,
   which the sort keeps in a few row groups;
3. tests the books found with LIKE, which settles order and the wildcards.

A term without a piece of three characters, or whose rarest trigram is in more
than ``SCAN_SHARE`` of the books, is answered by the scan: postings would not
save anything.  The result is the same either way.  A trigram that a third of
all books hold is split over tasks by the book id in the sort key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import restrict_to
from ..functions.text import contains_ci
from . import catalog

RAREST, SCAN_SHARE = 3, 0.1


def grams_of(text: Column) -> Column:
    """Distinct trigrams of the lower-cased text; none for NULL or less than
    three characters."""
    low = F.lower(text)
    places = F.when(F.length(low) >= 3, F.sequence(F.lit(1), F.length(low) - 2))
    cut = F.transform(places, lambda i: F.substring(low, i, F.lit(3)))
    return F.array_distinct(F.coalesce(cut, F.array().cast("array<string>")))


def write_postings(books: DataFrame, path: str, columns: tuple[str, ...] = ("title", "author", "category"),
                   key: str = "book_id") -> None:
    """Publish the postings and their counts under ``path``."""
    def named(c: str) -> Column:
        return F.transform(grams_of(F.col(c)), lambda g: F.struct(F.lit(c).alias("column_name"), g.alias("gram")))
    pairs = F.explode(F.flatten(F.array(*[named(c) for c in columns])))
    rows = books.select(key, pairs.alias("p")).select("p.column_name", "p.gram", key)
    (rows.repartitionByRange("column_name", "gram", key).sortWithinPartitions("column_name", "gram", key)
     .write.mode("errorifexists").parquet(f"{path}/postings"))
    spark = books.sparkSession
    counts = spark.read.parquet(f"{path}/postings").groupBy("column_name", "gram").agg(F.count(F.lit(1)).alias("n"))
    total = books.agg(F.count(F.lit(1)).alias("n")).select(F.lit("").alias("column_name"), F.lit("").alias("gram"), "n")
    (counts.unionByName(total).repartitionByRange("column_name", "gram").sortWithinPartitions("column_name", "gram")
     .write.mode("errorifexists").parquet(f"{path}/counts"))


def term_grams(spark: SparkSession, term: str | None) -> list[str]:
    """Trigrams that every text matching the term holds (one row, lower-cased
    by Spark as the texts are)."""
    if term is None:
        return []
    pieces = F.split(F.lit(term), "[%_]")
    return sorted(spark.range(1).select(F.array_distinct(F.flatten(F.transform(pieces, grams_of))).alias("g")).first().g)


def candidates(spark: SparkSession, path: str, column: str, term: str | None, key: str = "book_id") -> DataFrame | None:
    """Keys of the books that hold the rarest trigrams of the term; None if the
    scan is the better way."""
    grams = term_grams(spark, term)
    if not grams:
        return None
    counts = spark.read.parquet(f"{path}/counts").filter(
        ((F.col("column_name") == column) & F.col("gram").isin(grams)) | ((F.col("column_name") == "") & (F.col("gram") == "")))
    have = {r.gram: r.n for r in counts.collect()}                 # at most one row per trigram of the term
    books = have.pop("", 0)
    rare = sorted(grams, key=lambda g: (have.get(g, 0), g))[:RAREST]
    if have.get(rare[0], 0) > SCAN_SHARE * books:
        return None
    found = spark.read.parquet(f"{path}/postings").filter((F.col("column_name") == column) & F.col("gram").isin(rare))
    return found.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(rare)).select(key)


def matching(books: DataFrame, path: str, columns: tuple[str, ...], term: str | None, key: str = "book_id") -> DataFrame:
    """Books with the term in one of the columns."""
    test: Column = contains_ci(F.col(columns[0]), term)
    for c in columns[1:]:
        test = test | contains_ci(F.col(c), term)
    found = [candidates(books.sparkSession, path, c, term, key) for c in columns]
    if any(f is None for f in found):
        return books.filter(test)
    keys = found[0]
    for f in found[1:]:
        keys = keys.unionByName(f)
    return restrict_to(books, keys, key).filter(test)


def search_author(books: DataFrame, path: str, term: str | None) -> DataFrame:
    """B2 through the postings."""
    return matching(books, path, ("author",), term).select(*catalog.SEARCH_COLUMNS)


def search_category(books: DataFrame, path: str, term: str | None) -> DataFrame:
    """B3 through the postings."""
    return matching(books, path, ("category",), term).select(*catalog.SEARCH_COLUMNS)


def search_books(books: DataFrame, path: str, keyword: str | None = None, category: str | None = None,
                 max_price=None) -> DataFrame:
    """I5 through the postings: the keyword's candidates, then the category's,
    then every test of ``catalog.search_books``."""
    found = books
    if keyword is not None:
        found = matching(found, path, ("title", "author"), keyword)
    if category is not None:
        found = matching(found, path, ("category",), category)
    return catalog.search_books(found, keyword, category, max_price)
