"""Catalogue files: CSV, JSON export, typed and raw-keeping JSON import
(A2–A5, F10).

Formats:
* CSV: six fields ``isbn,title,author,price,stock,category``, no header;
  a UTF-8 BOM and CRLF line ends are accepted on read.
* JSON export: one object per book with the timestamp formatted
  ``yyyy-MM-dd HH:mm:ss``, NULL fields kept and ``attributes_json``
  embedded as an object.  Written as JSON Lines (the scalable form) or, for
  compatibility with the application's file, as JSON arrays — one array per
  part file, so writing and reading stay parallel (one task per file).

All reads take an explicit schema (no inference pass over the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.text import empty_as_null
from .json_ranges import array_elements

CSV_SCHEMA = T.StructType([
    T.StructField("isbn", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()), T.StructField("price", S.PRICE),
    T.StructField("stock", T.LongType()), T.StructField("category", T.StringType()),
])
CSV_COLUMNS = [f.name for f in CSV_SCHEMA.fields]

EXPORT_COLUMNS = ["book_id", "isbn", "title", "author", "price", "stock", "category",
                  "created_at", "discount_percent", "price_after_discount", "attributes_json"]

# Typed import (A3): the 11 exported fields; the object-valued
# attributes_json is read as a string, which keeps its raw JSON text.
IMPORT_SCHEMA = T.StructType([
    T.StructField("book_id", T.LongType()), T.StructField("isbn", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("author", T.StringType()),
    T.StructField("price", S.PRICE), T.StructField("stock", T.LongType()),
    T.StructField("category", T.StringType()), T.StructField("attributes_json", T.StringType()),
    T.StructField("created_at", T.StringType()), T.StructField("discount_percent", S.DISCOUNT),
    T.StructField("price_after_discount", S.PRICE),
])

# Raw-keeping import (A4): six typed fields plus the whole element.
RAW_FIELDS_SCHEMA = T.StructType([
    T.StructField("isbn", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("author", T.StringType()), T.StructField("price", S.PRICE),
    T.StructField("stock", T.LongType()), T.StructField("category", T.StringType()),
])


#: Line separator that no JSON text holds (control characters are escaped in
#: strings): a file read with it is one record.
WHOLE_FILE = "\x01\x02\x03\x04"

#: Column that holds a record the parser could not read, and its reject reason.
BAD = "_malformed"
MALFORMED = "malformed"


# ---------------------------------------------------------------------------
# CSV (A2)
# ---------------------------------------------------------------------------
def write_catalog_csv(books: DataFrame, path: str) -> None:
    books.select(*CSV_COLUMNS).write.mode("errorifexists").option("header", False).csv(path)


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless six-field catalogue CSV.  The reader skips a UTF-8 BOM and
    treats CRLF as a line end."""
    return (spark.read.schema(CSV_SCHEMA).option("header", False).option("encoding", "UTF-8")
            .option("mode", "PERMISSIVE").csv(path))


def read_catalog_csv_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): lines with a field that does not parse or without
    exactly six fields go to rejects (raw, reason) instead of becoming NULLs."""
    schema = T.StructType([*CSV_SCHEMA.fields, T.StructField(BAD, T.StringType())])
    line = F.regexp_replace(F.col("value"), "^\ufeff|\r$", "")
    parsed = (spark.read.text(path).select(line.alias("raw")).filter(F.trim(F.col("raw")) != "")
              .withColumn("r", F.from_csv("raw", schema.simpleString()[7:-1].replace(":", " "),
                                          {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})))
    bad = F.col(f"r.{BAD}").isNotNull()
    return (parsed.filter(~bad).select(*[f"r.{c}" for c in CSV_COLUMNS]),
            parsed.filter(bad).select("raw", F.lit(MALFORMED).alias("reason")))


# ---------------------------------------------------------------------------
# JSON export (A5)
# ---------------------------------------------------------------------------
def export_objects(books: DataFrame) -> DataFrame:
    """One JSON text per book (column ``value``)."""
    attrs = F.try_parse_json(F.col("attributes_json"))
    obj = F.struct(*[
        F.date_format("created_at", S.JSON_TS_FORMAT).alias("created_at") if c == "created_at"
        else attrs.alias("attributes_json") if c == "attributes_json"
        else F.col(c)
        for c in EXPORT_COLUMNS])
    return books.select(F.to_json(obj, {"ignoreNullFields": "false"}).alias("value"))


def export_books_json(books: DataFrame, path: str, as_array: bool = False,
                      max_records_per_file: int | None = None) -> None:
    """Write the export.  ``as_array`` makes each part file one array in the
    application's layout, ``[`` before the first object, ``,`` before every other
    and ``]`` after the last, each on a line of its own; such a file is one
    partition, so a limit of records per file is refused."""
    if as_array and max_records_per_file is not None:
        raise ValueError("as_array writes one array per partition: repartition instead of max_records_per_file")
    lines = array_lines(export_objects(books)) if as_array else export_objects(books)
    limit = 0 if as_array else 1_000_000 if max_records_per_file is None else max_records_per_file
    lines.write.mode("errorifexists").option("maxRecordsPerFile", limit).text(path)


def array_lines(objects: DataFrame, files: int | None = None) -> DataFrame:
    """Lines (value) of ``files`` JSON arrays, one per partition.  Objects are
    dealt by a hash of their text; every partition has two rows of its own for its
    brackets, which a sort within partitions puts first and last, and a row's
    place in its partition says whether a comma goes before it.  A partition
    without objects is a valid empty array."""
    n = files or int(objects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("value"), F.lit(n)).cast("int")
    brackets = objects.sparkSession.range(n).select(
        F.col("id").cast("int").alias("part"),
        F.inline(F.array(*[F.struct(F.lit(k).alias("rank"), F.lit(c).alias("value")) for k, c in ((0, "["), (2, "]"))])))
    rows = (objects.select(part.alias("part"), F.lit(1).alias("rank"), "value").unionByName(brackets)
            .repartitionById(n, F.col("part")).sortWithinPartitions("part", "rank", "value")
            .withColumn("place", F.monotonically_increasing_id() % F.lit(1 << 33)))
    after_another = (F.col("rank") == 1) & (F.col("place") > 1)
    return rows.select(F.explode(F.when(after_another, F.array(F.lit(","), F.col("value")))
                                 .otherwise(F.array("value"))).alias("value"))


# ---------------------------------------------------------------------------
# JSON import (A3 typed, A4 raw-keeping)
# ---------------------------------------------------------------------------
def read_books_json(spark: SparkSession, path: str, multiline: bool = False,
                    one_element_per_line: bool = False) -> DataFrame:
    """Typed import: explicit schema, created_at text to timestamp (seconds
    precision, as exported); a field that cannot be read is NULL (loads use the
    checked forms, which send such elements to rejects).  JSON Lines split
    freely.  ``multiline`` reads JSON-array files of any layout, one task per
    file (``read_books_json_split``: several).  The file is one record of the
    line reader: Spark's multiLine reader goes back to the file for the text of
    every object kept as a string (``attributes_json``), 4 KB and more per
    element.  Large exports in the
    application's layout can be read with ``one_element_per_line=True``: line
    by line, so they split; any other line stops the job."""
    if multiline and one_element_per_line:
        df = (_element_lines(spark, path)
              .select(F.from_json("raw", IMPORT_SCHEMA, {"mode": "PERMISSIVE"}).alias("r"))
              .select("r.*"))
    else:
        reader = spark.read.schema(IMPORT_SCHEMA).option("mode", "PERMISSIVE")
        df = (reader.option("lineSep", WHOLE_FILE) if multiline else reader).json(path)
    return _typed(df)


def _typed(df: DataFrame, *more: str) -> DataFrame:
    """Imported fields as the catalogue's columns (and ``more`` untouched)."""
    df = _empty_text_as_null(df, ["isbn", "title", "author", "category", "attributes_json"])
    return df.select(
        "book_id", "isbn", "title", "author", "price", "stock", "category", "attributes_json",
        F.try_to_timestamp(F.col("created_at"), F.lit(S.JSON_TS_FORMAT)).cast(S.TS)
         .alias("created_at"),
        "discount_percent", "price_after_discount", *more)


def read_books_json_checked(spark: SparkSession, path: str, multiline: bool = False,
                            one_element_per_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): as ``read_books_json``, but an element that is cut off,
    is no object or has a field of a wrong type goes to rejects (raw, reason),
    and so does a whole file that is not a JSON array."""
    if multiline and one_element_per_line:
        elements = _element_lines(spark, path).withColumn("reason", F.lit(None).cast("string"))
    elif multiline:
        # one task per file; an unreadable file is one reject with its whole text
        files = (spark.read.text(path, wholetext=True)
                 .select(F.regexp_replace("value", "^\ufeff", "").alias("value"))
                 .withColumn("n", F.expr("json_array_length(value)")))
        elements = files.select(
            F.explode(F.when(F.col("n").isNull(), F.array("value"))
                      .otherwise(F.from_json("value", "array<string>"))).alias("raw"),
            F.when(F.col("n").isNull(), F.lit("not a JSON array")).alias("reason"))
    else:
        elements = (spark.read.text(path).select(F.trim(F.regexp_replace("value", "^\ufeff", "")).alias("raw"))
                    .filter(F.col("raw") != "").withColumn("reason", F.lit(None).cast("string")))
    schema = T.StructType([*IMPORT_SCHEMA.fields, T.StructField(BAD, T.StringType())])
    parsed = elements.withColumn("r", F.from_json(
        "raw", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}))
    bad = F.col("raw").isNull() | F.col("r").isNull() | F.col(f"r.{BAD}").isNotNull()
    tagged = parsed.withColumn("reason", F.coalesce("reason", F.when(bad, F.lit(MALFORMED))))
    return (_typed(tagged.filter(F.col("reason").isNull()).select(*[f"r.{f.name}" for f in IMPORT_SCHEMA.fields])),
            tagged.filter(F.col("reason").isNotNull()).select("raw", "reason"))


def read_books_json_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of array files of any layout and size, each read by as
    many tasks as it has byte ranges (``json_ranges``).  An element that is no
    object or has a field of a wrong type goes to rejects (raw, reason); a file
    that is not one array gives one reject with its path as ``raw``."""
    elements, files = array_elements(spark, path)
    schema = T.StructType([*IMPORT_SCHEMA.fields, T.StructField(BAD, T.StringType())])
    parsed = elements.withColumn("r", F.from_json(
        "raw", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}))
    bad = F.col("r").isNull() | F.col(f"r.{BAD}").isNotNull()
    rejects = (parsed.filter(bad).select("raw", F.lit(MALFORMED).alias("reason"))
               .unionByName(files.select(F.col("file").alias("raw"), "reason")))
    return _typed(parsed.filter(~bad).select(*[f"r.{f.name}" for f in IMPORT_SCHEMA.fields])), rejects


def _element_lines(spark: SparkSession, path: str) -> DataFrame:
    """Elements of arrays written one per line; a line that is neither an
    element nor ``[``, ``]``, ``,`` or blank raises an error."""
    line = F.regexp_replace(F.trim(F.col("value")), r",$", "")
    whole = F.col("raw").startswith("{") & F.col("raw").endswith("}")
    wrong = F.raise_error(F.concat(F.lit("not one element per line: "), F.substring("raw", 1, 80))).cast("boolean")
    return (spark.read.text(path).select(line.alias("raw"))
            .filter(F.when(whole, F.lit(True)).when(F.col("raw").isin("[", "]", ""), F.lit(False)).otherwise(wrong)))


def read_books_json_raw(spark: SparkSession, path: str, arrays: bool = False,
                        one_element_per_line: bool = False) -> DataFrame:
    """Raw-keeping import: six typed fields plus ``attributes_json`` = the
    whole element text.

    JSON Lines are read as text lines: the files split like any text file.
    ``arrays`` reads JSON arrays of any layout: each file is read whole, one
    task per file, and split into its elements, so a file must fit a task's
    memory.  ``one_element_per_line=True`` reads arrays in the application's
    layout (``[``, ``,`` and ``]`` on lines of their own) line by line; any
    other line stops the job."""
    if arrays and not one_element_per_line:
        files = spark.read.text(path, wholetext=True)
        elems = files.select(F.explode(F.from_json("value", "array<string>")).alias("raw"))
    else:
        elems = (_element_lines(spark, path) if arrays else
                 spark.read.text(path).select(F.trim(F.col("value")).alias("raw")).filter(F.col("raw") != ""))
    parsed = F.from_json("raw", RAW_FIELDS_SCHEMA)
    out = elems.select(parsed.alias("f"), "raw").select("f.*", F.col("raw").alias("attributes_json"))
    return _empty_text_as_null(out, ["isbn", "title", "author", "category"])


def _empty_text_as_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """The application stores '' as NULL; apply that on ingest."""
    return df.select(*[empty_as_null(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def import_books_checked(spark: SparkSession, json_path: str, table_root: str, version: int,
                         multiline: bool = True) -> tuple[str, DataFrame]:
    """The reload job end to end: read the export with its schema, split rows
    by the catalogue's constraint rules (keys, lengths, JSON validity), publish
    the valid rows as a new version of the table (the previous version is left
    as it was: a reload replaces, it never appends into a live path) and
    return the new path with the rejected rows; elements that cannot be read
    are rejects too, with their text in ``raw``."""
    from ..operators.quality import split_by_rules
    from .snapshot_store import publish

    books, unread = read_books_json_checked(spark, json_path, multiline=multiline)
    valid, rejects = split_by_rules("books", books)
    rejects = rejects.unionByName(unread.select("raw", F.array("reason").alias("broken_rules")),
                                  allowMissingColumns=True)
    return publish(valid, table_root, version), rejects
