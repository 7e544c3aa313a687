"""Generator properties: formats, ranges, repeatability under any
partitioning, and the 5-digit isbn collision of the original script."""

import re

from pyspark.sql import functions as F

from quire.sources import generate as gen


def ids(spark, n, parts):
    return spark.range(1, n + 1, numPartitions=parts).select(F.col("id").alias("i"))


def test_words_catalog_properties(spark):
    rows = gen.words_catalog(ids(spark, 3000, 4)).collect()
    assert len(rows) == 3000
    for r in rows[:500]:
        adj, noun, suffix = r.title.split(" ")
        assert adj in gen.ADJECTIVES and noun in gen.NOUNS and suffix in gen.SUFFIXES
        first, last = r.author.split(" ")
        assert first in gen.FIRST_NAMES and last in gen.LAST_NAMES
        assert r.category in gen.CATEGORIES
        assert re.fullmatch(r"978-0-[1-9][0-9]-\d{6}", r.isbn)
        assert 10 <= int(r.isbn[6:8]) <= 98
        assert 300 <= r.price <= 3000 and 0 <= r.stock <= 100
        assert 0 <= r.discount_percent <= 30
        assert r.image_url.endswith(r.title.replace(" ", "+"))
    # every word is used (uniform picks)
    assert {r.title.split(" ")[0] for r in rows} == set(gen.ADJECTIVES)
    assert {r.title.split(" ")[2] for r in rows} == set(gen.SUFFIXES)


def test_generation_repeats_under_other_partitioning(spark):
    a = gen.words_catalog(ids(spark, 500, 1)).collect()
    b = gen.words_catalog(ids(spark, 500, 7)).collect()
    assert sorted(a) == sorted(b)


def test_basic_catalog_ranges_and_isbn_collision(spark):
    rows = gen.basic_catalog(ids(spark, 2000, 3)).collect()
    assert all(100 <= r.price <= 1000 and 0 <= r.stock <= 50 for r in rows)
    assert rows[0].isbn == "978-3-000001" and rows[0].author == "Author 1"
    five = gen.basic_catalog(spark.createDataFrame([(10000,), (100000,)], "i long"), cut_isbn_digits=5)
    isbns = [r.isbn for r in five.collect()]
    assert isbns[0] == isbns[1] == "978-3-10000"
    wide = gen.basic_catalog(spark.createDataFrame([(100000,), (1000000,)], "i long")).collect()
    assert [r.isbn for r in wide] == ["978-3-100000", "978-3-1000000"]


def test_generated_catalogue_is_published_by_category(spark):
    from quire.operators import layout
    from quire.session import scratch_dir
    path = scratch_dir(spark, "gen-publish")
    gen.write_generated(gen.words_catalog(ids(spark, 1200, 3)), path)
    back = spark.read.parquet(path)
    assert back.count() == 1200
    one = layout.lookup_category(spark, path, gen.CATEGORIES[0], ("book_id",))
    assert one.count() == back.filter(F.col("category") == gen.CATEGORIES[0]).count()
