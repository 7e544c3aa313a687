"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .words import covered, number, strong_hashes

#: White space of the text contracts: space, tab, LF, VT, FF, CR.
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text worked on at once inside a task; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20

U64 = np.uint64


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's shared folder (see
    ``session.scratch_dir``) and read it back: the lineage is cut, and a lost
    executor costs a re-read only."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of ``df`` has (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def numbered_table(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` written once with a row number column; later steps name rows
    by it, so null or repeated document ids stay apart."""
    row = free_name(docs, "__row")
    return shared_table(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def utf8(col: str | Column) -> Column:
    """Text as UTF-8 bytes, null as no bytes."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def rows_first(id_col: Column, row: Column) -> Column:
    """Order key of rows: smallest id first, null ids last, then the row."""
    return F.struct(id_col.isNull().alias("no_id"), id_col.alias("id"), row.alias("row"))


def text_slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``size`` bytes of ``column``."""
    n = batch.num_rows
    if not n:
        return
    offsets = byte_offsets(batch.column(column))
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield batch.slice(at, end - at)
        at = end


def byte_offsets(values: pa.Array) -> np.ndarray:
    """Where each value's bytes start, one more at the end."""
    kind = np.int64 if pa.types.is_large_binary(values.type) or pa.types.is_large_string(values.type) else np.int32
    raw = np.frombuffer(values.buffers()[1], dtype=kind)
    return raw[values.offset: values.offset + len(values) + 1].astype(np.int64)


def byte_view(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without copying, and each value's offsets
    into them."""
    off = byte_offsets(values)
    buf = values.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def column_or(batch: pa.RecordBatch, column: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift rounds), the same everywhere."""
    with np.errstate(over="ignore"):
        x = x + U64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word and the document it is in."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    word = ~space
    first = word.copy()
    first[1:] &= space[:-1]
    last = word.copy()
    last[:-1] &= space[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return start, end, doc


def word_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(number of every word within ``data``, the distinct words): exact."""
    return number(start, end, data[covered(data, start, end)])


def word_names(data: np.ndarray, start: np.ndarray, end: np.ndarray, width: int = 1) -> np.ndarray:
    """Each word's name, the same in every task: ``width`` columns of 64 bits
    of the BLAKE2 digest of its bytes."""
    code, distinct = word_codes(data, start, end)
    return strong_hashes(distinct, width)[code]


def gram_hashes(names: np.ndarray, at: np.ndarray, n: int, kind: int = 0) -> np.ndarray:
    """64 bits from the names of the n words from each position in ``at``, one
    word after the other; ``kind`` 0 and 1 are independent."""
    out = np.full(len(at), U64(kind + 1))
    for k in range(n):
        out = mix(out ^ names[at + k], 3 + kind)
    return out


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], .. start[0]+count[0]-1, start[1], .. as one array."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(count) - count
    return np.repeat(start - before, count) + np.arange(total)
