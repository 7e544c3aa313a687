"""File keys (A2–A5, A8, A9, G5).  Files go to a fresh folder beside the
session's checkpoint folder (shared storage on a cluster) and are read
back; each run uses a new folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.combine import count_of, one_row
from ..session import scratch_dir
from ..sources import files as io
from ..sources import generate as gen
from ..sources import snapshot_store as store
from ..sources.adapter import Domain
from ..operators.quality import split_by_rules
from . import register

#: Books per array of the compact layout, about.
COMPACT_ROWS = 10_000
COMPARE_COLS = ["book_id", "isbn", "title", "author", "price", "stock", "category",
                "discount_percent", "price_after_discount"]


def _export(d: Domain, as_array: bool) -> str:
    path = scratch_dir(d.spark, "export")
    io.export_books_json(d.books, path, as_array=as_array)
    return path


def _compact(d: Domain) -> str:
    """The export as arrays on one line each."""
    path = scratch_dir(d.spark, "compact")
    arrays = d.books.count() // COMPACT_ROWS + 1
    (io.export_objects(d.books).groupBy(F.pmod(F.xxhash64("value"), F.lit(arrays)).alias("part"))
     .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("value")), F.lit("]")).alias("value"))
     .select("value").write.option("maxRecordsPerFile", 1).text(path))
    return path


@register("csv_import", "SELECT isbn, title, author, price, stock, category FROM v_books")
def csv_import(d: Domain):
    """A2: catalogue written as headerless CSV and read back with a schema."""
    path = scratch_dir(d.spark, "csv")
    io.write_catalog_csv(d.books, path)
    return io.read_catalog_csv(d.spark, path)


@register("json_import_typed", """
SELECT book_id, isbn, title, author, price, stock, category,
       CAST(json(attributes_json) AS VARCHAR) AS attributes_json,
       date_trunc('second', created_at) AS created_at, discount_percent, price_after_discount
FROM v_books
""")
def json_import_typed(d: Domain):
    """A3: export as JSON arrays, import with the typed 11-field schema."""
    return io.read_books_json(d.spark, _export(d, as_array=True), multiline=True, one_element_per_line=True)


@register("json_import_compact", """
SELECT book_id, isbn, title, author, price, stock, category,
       CAST(json(attributes_json) AS VARCHAR) AS attributes_json,
       date_trunc('second', created_at) AS created_at, discount_percent, price_after_discount
FROM v_books
""")
def json_import_compact(d: Domain):
    """A3: arrays without line breaks, as other tools write them; about
    ``COMPACT_ROWS`` books per array, so files stay small as the table grows."""
    return io.read_books_json(d.spark, _compact(d), multiline=True)


@register("json_import_rejects", f"""
SELECT isbn, CASE WHEN stock < 3 THEN '{io.MALFORMED}' WHEN stock = 3 THEN 'book_id_null' ELSE 'loaded' END AS outcome,
       CASE WHEN stock > 3 THEN price END AS price
FROM v_books
""")
def json_import_rejects(d: Domain):
    """An export with cut-off elements, wrong types and missing keys;
    where every element went."""
    value, size = F.col("value"), F.col("stock")
    damaged = (F.when(size == 1, F.regexp_replace(value, r'"price":[0-9.]+', '"price":"n/a"'))
               .when(size == 2, F.expr("substring(value, 1, length(value) - 1)"))
               .when(size == 3, F.regexp_replace(value, r'"book_id":[0-9]+', '"book_id":null')).otherwise(value))
    path = scratch_dir(d.spark, "damaged")
    (io.export_objects(d.books).withColumn("stock", F.get_json_object("value", "$.stock").cast("long"))
     .select(damaged.alias("value")).write.text(path))
    rows, unread = io.read_books_json_checked(d.spark, path)
    valid, broken = split_by_rules("books", rows)
    return (valid.select("isbn", F.lit("loaded").alias("outcome"), "price")
            .unionByName(broken.select("isbn", F.concat_ws(",", "broken_rules").alias("outcome")),
                         allowMissingColumns=True)
            .unionByName(unread.select(F.regexp_extract("raw", '"isbn":"([^"]*)"', 1).alias("isbn"),
                                       F.col("reason").alias("outcome")), allowMissingColumns=True))


@register("csv_import_rejects", f"""
SELECT isbn, CASE WHEN stock < 4 THEN '{io.MALFORMED}' ELSE 'loaded' END AS outcome,
       CASE WHEN stock > 3 THEN title END AS title, CASE WHEN stock > 3 THEN price END AS price
FROM v_books
""")
def csv_import_rejects(d: Domain):
    """A2: a catalogue file with unreadable prices and stocks and short lines;
    where every line went."""
    b, size = d.books, F.col("stock")
    line = F.concat_ws(",", "isbn", "title", "author",
                       F.when(size == 1, F.lit("n/a")).otherwise(F.col("price").cast("string")),
                       F.when(size == 2, F.lit("xx")).otherwise(size.cast("string")),
                       F.when(size == 3, F.lit(None)).otherwise(F.col("category")))
    path = scratch_dir(d.spark, "damaged-csv")
    b.select(line.alias("value")).write.text(path)
    rows, unread = io.read_catalog_csv_checked(d.spark, path)
    return (rows.select("isbn", F.lit("loaded").alias("outcome"), "title", "price")
            .unionByName(unread.select(F.regexp_extract("raw", "^[^,]*", 0).alias("isbn"),
                                       F.col("reason").alias("outcome")), allowMissingColumns=True))


@register("json_import_split", """
SELECT book_id, isbn, title, author, price, stock, category,
       CAST(json(attributes_json) AS VARCHAR) AS attributes_json,
       date_trunc('second', created_at) AS created_at, discount_percent, price_after_discount
FROM v_books
""")
def json_import_split(d: Domain):
    """A3: arrays written without line breaks, files read in byte ranges."""
    rows, _ = io.read_books_json_split(d.spark, _compact(d))
    return rows


@register("json_import_raw", """
SELECT isbn, title, author, price, stock, category, book_id AS raw_book_id,
       CAST(json_extract_string(attributes_json, '$.pages') AS BIGINT) AS raw_pages
FROM v_books
""")
def json_import_raw(d: Domain):
    """A4: import that keeps each whole array element; fields are checked
    against what the kept text contains."""
    df = io.read_books_json_raw(d.spark, _export(d, as_array=True), arrays=True, one_element_per_line=True)
    raw = F.col("attributes_json")
    return df.select(*io.CSV_COLUMNS,
                     F.get_json_object(raw, "$.book_id").cast("long").alias("raw_book_id"),
                     F.get_json_object(raw, "$.attributes_json.pages").cast("long")
                      .alias("raw_pages"))


@register("json_export_array", """
SELECT book_id, isbn, title, author, price, stock, category, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
       discount_percent, price_after_discount, CAST(json_extract_string(attributes_json, '$.pages') AS BIGINT) AS pages
FROM v_books
""")
def json_export_array(d: Domain):
    """A5: all 11 fields of the export as JSON arrays, each file read back as
    one array."""
    path = scratch_dir(d.spark, "export-arrays")
    io.export_books_json(d.books, path, as_array=True)
    element = F.explode(F.from_json("value", "array<string>")).alias("v")
    v = d.spark.read.text(path, wholetext=True).select(element)
    types = {"book_id": "long", "stock": "long", "price": S.PRICE, "discount_percent": S.DISCOUNT, "price_after_discount": S.PRICE}
    return v.select(*[F.get_json_object("v", f"$.{c}").cast(types.get(c, "string")).alias(c)
                      for c in io.EXPORT_COLUMNS if c != "attributes_json"],
                    F.get_json_object("v", "$.attributes_json.pages").cast("long").alias("pages"))


@register("json_export", """
SELECT book_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
       CAST(json_extract_string(attributes_json, '$.pages') AS BIGINT) AS pages, price,
       created_at IS NULL AS keeps_nulls
FROM v_books
""")
def json_export(d: Domain):
    """A5: exported JSON Lines read back as text; nested attributes are an
    object, NULL fields are present."""
    lines = d.spark.read.text(_export(d, as_array=False))
    v = F.col("value")
    return lines.select(
        F.get_json_object(v, "$.book_id").cast("long").alias("book_id"),
        F.get_json_object(v, "$.created_at").alias("created_at"),
        F.get_json_object(v, "$.attributes_json.pages").cast("long").alias("pages"),
        F.get_json_object(v, "$.price").cast(S.PRICE).alias("price"),
        v.contains('"created_at":null').alias("keeps_nulls"))


@register("reload_reconcile", """
SELECT count(*) AS n_before, count(*) AS n_after, CAST(0 AS BIGINT) AS n_missing,
       CAST(0 AS BIGINT) AS n_extra
FROM v_books
""")
def reload_reconcile(d: Domain):
    """Publish the catalogue, export it, publish an emptied
    version, load the export into a new version and reconcile counts and
    rows both ways."""
    spark = d.spark
    root = scratch_dir(spark, "books-table")
    store.publish(d.books.select(*COMPARE_COLS), root, 1)            # current snapshot
    exported = _export(d, as_array=True)
    emptied = store.truncate(store.read_version(spark, root, 1))   # F10: DELETE FROM books
    store.publish(emptied, root, 2)
    loaded = io.read_books_json(spark, exported, multiline=True, one_element_per_line=True).select(*COMPARE_COLS)
    store.publish(store.read_version(spark, root, 2).unionByName(loaded), root, 3)
    before = store.read_version(spark, root, 1)
    after = store.read_version(spark, root, 3)
    return one_row({"n_before": count_of(before, "n_before"),
                    "n_after": count_of(after, "n_after"),
                    "n_missing": count_of(before.exceptAll(after), "n_missing"),
                    "n_extra": count_of(after.exceptAll(before), "n_extra")})


def _gen_ids(d: Domain):
    """One generated row per input part row."""
    return d.raw("part").select((F.col("p_partkey") + 1).alias("i"))


SEED = 42


def _hash_sql(salt: int) -> str:
    return f"CAST('0x' || substr(md5('{SEED}:' || CAST(i AS VARCHAR) || ':{salt}'), 1, 8) AS BIGINT)"


def _between_sql(salt: int, lo: int, hi: int, scale: int = 1, nearest: bool = True) -> str:
    """floor((lo + (hi - lo) * hash / 2^32) * scale + 1/2) in whole numbers."""
    half = 2147483648 if nearest else 0
    return f"(({lo * scale} * 4294967296 + {(hi - lo) * scale} * {_hash_sql(salt)} + {half}) // 4294967296)"


def _pick_sql(words: list[str], salt: int) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + f"][1 + {_hash_sql(salt)} % {len(words)}]"


_PADDED_SQL = "lpad(CAST(i AS VARCHAR), CAST(greatest(6, length(CAST(i AS VARCHAR))) AS INTEGER), '0')"


@register("gen_catalog_basic", f"""
SELECT i AS book_id, '978-3-' || {_PADDED_SQL} AS isbn,
       'Book Title ' || CAST(i AS VARCHAR) AS title,
       'Author ' || CAST(i % 100 AS VARCHAR) AS author,
       CAST(CAST({_between_sql(1, 100, 1000, 100)} AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,2)) AS price,
       {_between_sql(2, 0, 50)} AS stock,
       'Category ' || CAST(i % 10 AS VARCHAR) AS category,
       '{{"pages": ' || CAST({_between_sql(3, 100, 1000)} AS VARCHAR) || ', "format":"paperback"}}' AS attributes_json
FROM (SELECT p_partkey + 1 AS i FROM part)
""")
def gen_catalog_basic(d: Domain):
    """Basic generator, every column compared."""
    return gen.basic_catalog(_gen_ids(d), SEED)


@register("gen_catalog_words", f"""
SELECT book_id, isbn, title, author, price, stock, category, attributes_json,
       '{gen.IMAGE_URL_PREFIX}' || replace(title, ' ', '+') AS image_url, discount_percent,
       CAST(price * (100 - discount_percent) * 0.01 AS DECIMAL(10,2)) AS price_after_discount
FROM (
  SELECT i AS book_id,
         '978-0-' || CAST({_between_sql(16, 10, 99, nearest=False)} AS VARCHAR) || '-' || {_PADDED_SQL} AS isbn,
         {_pick_sql(gen.ADJECTIVES, 11)} || ' ' || {_pick_sql(gen.NOUNS, 12)} || ' '
           || {_pick_sql(gen.SUFFIXES, 13)} AS title,
         {_pick_sql(gen.FIRST_NAMES, 14)} || ' ' || {_pick_sql(gen.LAST_NAMES, 15)} AS author,
         CAST({_between_sql(17, 300, 3000)} AS DECIMAL(10,2)) AS price,
         {_between_sql(18, 0, 100)} AS stock,
         {_pick_sql(gen.CATEGORIES, 19)} AS category,
         '{{"pages": ' || CAST({_between_sql(21, 100, 900)} AS VARCHAR) || '}}' AS attributes_json,
         CAST({_between_sql(20, 0, 30)} AS DECIMAL(5,2)) AS discount_percent
  FROM (SELECT p_partkey + 1 AS i FROM part)
) g
""")
def gen_catalog_words(d: Domain):
    """Word-list generator, every column compared."""
    return gen.words_catalog(_gen_ids(d), SEED)
