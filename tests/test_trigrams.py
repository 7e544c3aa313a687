"""Searches through trigram postings give the rows of the scan."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quire import schemas as S
from quire.operators import catalog, trigrams
from quire.session import scratch_dir


@pytest.fixture(scope="module")
def shelf(spark):
    r = random.Random(3)
    syllables = ["ka", "lo", "mi", "ne", "ru", "ш", "Ё", "%", "_", "\\", "İ", " "]

    def name():
        return "".join(r.choice(syllables) for _ in range(r.randrange(9)))
    rows = [(i, None, r.choice([None, "", name()]) if i % 4 else "common " + name(), name(), Decimal(i % 30), i, name(),
             None, None, None, None, None, i % 2) for i in range(600)]
    books = spark.createDataFrame(rows, S.BOOKS_SCHEMA).repartition(4).persist()
    path = scratch_dir(spark, "t-postings")
    trigrams.write_postings(books, path)
    yield books, path
    books.unpersist()


def ids(df):
    return sorted(r.book_id for r in df.collect())


@pytest.mark.parametrize("term", ["kalo", "KALOm", "ЁШка", "ka%ru", "mi_lo", "a\\k", "İka", "lo", "", None, "zzz", "common", "neruneru",
                                  "%%%", "mon ka%ne"])
def test_same_rows_as_the_scan(shelf, term):
    books, path = shelf
    assert ids(trigrams.search_author(books, path, term)) == ids(catalog.search_author(books, term))
    assert ids(trigrams.search_category(books, path, term)) == ids(catalog.search_category(books, term))
    assert ids(trigrams.search_books(books, path, term, term, 20)) == ids(catalog.search_books(books, term, term, 20))


def test_ways(spark, shelf):
    _, path = shelf
    assert trigrams.term_grams(spark, "ab%cde_FGHI") == ["cde", "fgh", "ghi"]
    assert trigrams.candidates(spark, path, "title", "ka") is None                   # no piece of three characters
    assert trigrams.candidates(spark, path, "title", "common") is None               # in a quarter of the books
    rare = trigrams.candidates(spark, path, "title", "common kalomine")
    assert rare is not None and rare.count() < 20
    assert trigrams.candidates(spark, path, "title", "zzz").count() == 0


def test_postings_are_pruned(spark, shelf):
    _, path = shelf
    found = trigrams.candidates(spark, path, "title", "mon kalo")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(column_name), EqualTo(column_name,title), In(gram" in plan


def test_empty_catalogue(spark):
    books = spark.createDataFrame([], S.BOOKS_SCHEMA)
    path = scratch_dir(spark, "t-postings")
    trigrams.write_postings(books, path)
    assert trigrams.search_books(books, path, "abc").count() == 0


def test_grams(spark):
    df = spark.createDataFrame([("AbCabc",), ("ab",), (None,), ("ЁЖИК",)], "s string").select(trigrams.grams_of(F.col("s")).alias("g"))
    assert [r.g for r in df.collect()] == [["abc", "bca", "cab"], [], [], ["ёжи", "жик"]]
