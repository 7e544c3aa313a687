"""Best-fit-decreasing packing of tokenised documents.

Pieces are taken in decreasing length and each goes into the open sequence
with the least remaining capacity that still holds it; a segment tree over the
remaining capacities finds it in logarithmic time.  Pieces of one length are
alike, and so are open sequences with the same remaining capacity, so the
decisions only need the histogram of lengths (at most ``capacity`` numbers):
``best_fit_plan`` makes them for runs of equal pieces at once and gives the
same packing as piece by piece.  The plan's lines say which ranks of a length
go into which sequences.

Spark does the rest for all pieces: tokenise and cut (Arrow pass), rank the
pieces within their length (a count per task and length, then prefix sums),
and look the rank up in the plan.  The plan is broadcast up to ``PLAN_ROWS``
lines, beyond that it is joined on the length.

Defined results: a null or empty text is one piece with the end id only;
repeated rows and null ids are documents each; a document longer than the
capacity is cut into pieces of exactly the capacity, the last may be shorter;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_view, ranges, shared_table, text_slices, utf8
from .tokens import piece_table, with_end

CAPACITY = 4096
END_ID = 1
#: Lines of a plan that may be broadcast (48 bytes each).
PLAN_ROWS = 100_000

_PLAN = "length int, lo long, hi long, first long, each long, at long"


class CapacityTree:
    """Which remaining capacities have open sequences; smallest one from a
    bound up, in logarithmic time."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.leaves)

    def put(self, capacity: int, there: bool) -> None:
        i = capacity + self.leaves
        self.any[i] = there
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        i = least + self.leaves
        if self.any[i]:
            return i - self.leaves
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """(lines, sequences).  A line (length, lo, hi, first, each, at): the pieces
    of that length with rank lo..hi-1 go into the sequences from ``first`` on,
    ``each`` of them per sequence, the first one at offset ``at``."""
    tree = CapacityTree(capacity)
    open_runs: dict[int, list[tuple[int, int]]] = {}
    lines, sequences = [], 0

    def put(room: int, lo: int, hi: int) -> None:
        if room > 0 and hi > lo:
            if not open_runs.get(room):
                open_runs[room] = []
                tree.put(room, True)
            open_runs[room].append((lo, hi))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, lo = capacity, sequences
                each = room // length
                sequences += -(-left // each)
                hi = sequences
            else:
                lo, hi = open_runs[room].pop()
                if not open_runs[room]:
                    tree.put(room, False)
                each = room // length
            full = min(hi - lo, left // each)
            if full:
                lines.append((length, rank, rank + full * each, lo, each, capacity - room))
                put(room - each * length, lo, lo + full)
                rank, left, lo = rank + full * each, left - full * each, lo + full
            if left and left < each and lo < hi:              # the last sequence is not filled up
                lines.append((length, rank, rank + left, lo, left, capacity - room))
                put(room - left * length, lo, lo + 1)
                rank, left, lo = rank + left, 0, lo + 1
            put(room, lo, hi)
    return lines, sequences


def cut_pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int = CAPACITY,
               end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, chunk, nth[, ids]) of every piece,
    written once; nth numbers the pieces of a length within their chunk."""
    src = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"), F.spark_partition_id().alias("chunk"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = piece_table(tokenizer, "word"), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, count = table.encode(*byte_view(part.column("text")))
                ids, count = with_end(ids, count, end_id)
                pieces = -(-count // capacity)
                doc = np.repeat(np.arange(len(count)), pieces)
                number = ranges(np.zeros(len(count), np.int64), pieces)
                start = number * capacity
                length = np.minimum(count[doc] - start, capacity)
                at = (np.cumsum(count) - count)[doc] + start
                data = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
                order = np.argsort(length, kind="stable")
                first = np.searchsorted(length[order], length[order], side="left")
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - first
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                cols = [part.column("id").take(pa.array(doc)), pa.array(number.astype(np.int32)), pa.array(start),
                        pa.array(length), pa.array(crc, pa.int64()), part.column("chunk").take(pa.array(doc)),
                        pa.array(nth)]
                names = ["id", "piece", "start", "length", "ids_crc32", "chunk", "nth"]
                if keep_ids:
                    cols.append(pa.array([bytes(data[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())],
                                         pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = (f"id {id_type}, piece int, start long, length long, ids_crc32 long, chunk int, nth long"
              + ", ids binary" * keep_ids)
    return shared_table(src.mapInArrow(run, schema), "pieces")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their sequence_id and offset."""
    counts = pieces.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()     # at most `capacity` rows
    lines, _ = best_fit_plan({r["length"]: r["n"] for r in sizes}, capacity)
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    plan = pieces.sparkSession.createDataFrame(lines, _PLAN)
    if len(lines) <= PLAN_ROWS:
        plan = F.broadcast(plan)
    ranked = pieces.join(base, ["chunk", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    p = plan.withColumnRenamed("length", "of_length")
    met = ranked.join(p, (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("lo"))
                      & (F.col("rank") < F.col("hi")))
    turn = F.col("rank") - F.col("lo")
    kept = [c for c in pieces.columns if c not in ("chunk", "nth")]
    return met.select(*kept, (F.col("first") + F.floor(turn / F.col("each"))).cast("long").alias("sequence_id"),
                      (F.col("at") + F.pmod(turn, F.col("each")) * F.col("length")).alias("offset"))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id,
    offset (and the ids as little-endian 32-bit numbers if ``keep_ids``)."""
    placed = place(cut_pieces(docs, tokenizer, id_col, text_col, capacity, end_id, keep_ids), capacity)
    return placed.withColumnRenamed("id", id_col)
