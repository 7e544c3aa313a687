"""Token ids as Parquet list columns.

Documents are range-partitioned and sorted by id, tokenised in an Arrow pass
and written: ``part``, ``before`` (ids before the document in its part),
``n_tokens``, the id and the list of ids.  The layout is set by write options:

* the list elements are dictionary-encoded (a vocabulary of 50,000 ids fits
  one dictionary page, so an id takes two bytes before compression);
* id and counters are plain integers in ascending order: their dictionary is
  off, and the version-2 writer then packs their deltas;
* row groups of ``ROW_GROUP`` bytes and pages of at most ``PAGE_ROWS`` rows;
  Parquet writes column and offset indexes for every page.

So a reader of ``read_metadata`` touches the counters only, and ``read_tokens``
for an id range skips row groups and pages by their indexes.

Defined results: a null or empty text is the end id alone; null ids come after
all others; rows of one id (repeated rows) are ordered by a hash of their
text; an empty table gives an empty file set and result; other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from .common import byte_view, text_slices, utf8
from .tokens import piece_table, with_end

END_ID = 0
ROW_GROUP = 32 << 20
PAGE_BYTES = 1 << 20
PAGE_ROWS = 5000

WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(ROW_GROUP),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#before": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID) -> None:
    """Write every document's ids under ``path`` in ascending id order."""
    whole = isinstance(docs.schema[id_col].dataType, T.IntegralType)
    src = docs.select((F.col(id_col).cast("long") if whole else F.col(id_col)).alias("doc_id"), utf8(text_col).alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    ordered = (src.repartitionByRange(*order).sortWithinPartitions(*order)
               .select("doc_id", "text", F.spark_partition_id().alias("part")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, before = piece_table(tokenizer, "byte"), 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, count = table.encode(*byte_view(part.column("text")))
                ids, count = with_end(ids, count, end_id)
                ends = np.cumsum(count)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                                 pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("part"), pa.array(before + ends - count), part.column("doc_id"), pa.array(count),
                     lists], names=["part", "before", "doc_id", "n_tokens", "ids"])
                before += int(ends[-1])

    (ordered.mapInArrow(run, f"part int, before long, doc_id {id_type}, n_tokens long, ids array<int>")
     .write.options(**WRITE_OPTIONS).parquet(path))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(part, doc_id, start, n_tokens) without touching the ids."""
    rows = spark.read.parquet(path).select("part", "before", "doc_id", "n_tokens")
    return _starts(rows, path).select("part", "doc_id", "start", "n_tokens")


def read_tokens(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """(doc_id, ids) of an id range; the filter reaches the scan."""
    return spark.read.parquet(path).where(F.col("doc_id").between(low, high)).select("doc_id", "ids")


def _starts(rows: DataFrame, path: str) -> DataFrame:
    """Add ``start``: ids of all documents before, over all parts."""
    spark = rows.sparkSession
    totals = (spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
              .orderBy("part").collect())                      # one row per part file
    at, base = 0, []
    for r in totals:
        base.append((r["part"], at))
        at += r["n"]
    bases = spark.createDataFrame(base, "part int, base long")
    return rows.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("before"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("ids")
            off = np.asarray(lists.offsets, dtype=np.int64)
            flat = np.asarray(lists.values).astype("<u4")
            data, lo = memoryview(flat.tobytes()), off[:-1]
            crc = [zlib.crc32(data[4 * x:4 * y]) for x, y in zip(lo.tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("part"), b.column("before"), b.column("doc_id"), pa.array(off[1:] - lo),
                 pa.array(crc, pa.int64())], names=["part", "before", "doc_id", "n_tokens", "ids_crc32"])

    stored = spark.read.parquet(path).select("part", "before", "doc_id", "ids")
    rows = stored.mapInArrow(run, f"part int, before long, doc_id {stored.schema['doc_id'].dataType.simpleString()}, "
                                  "n_tokens long, ids_crc32 long")
    return _starts(rows, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def token_round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids to the shared folder and read their digests back."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "tokens")
    write_tokens(docs, path, tokenizer, id_col, text_col)
    return digests(spark, path).withColumnRenamed("doc_id", id_col)
