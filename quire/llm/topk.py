"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code is its sign bits.  Equal codes are one entry (with its k
smallest ids), so a vector that a third of all rows share costs one entry.
Entries are dealt by a hash into blocks of about ``BLOCK_CODES``, queries into
blocks of ``BLOCK_QUERIES``; every pair of blocks is one bounded group.

Inside a group the codes are indexed by their bit segments.  A query grows
the search radius one step at a time in all segments: after radius r each code
within distance ``m * (r + 1) - 1`` has been met (m segments: a code further
than r in every segment is at least m * (r + 1) away).  It stops only when the
distance of the k-th verified code is covered, so ties at that distance are
all known and the result is exact.  The k best per group merge to the k best
per query, and entries open into rows.

Defined results: the query row itself counts as a row; equal distances are
ordered by id; a null vector has no code and is neither query nor answer; a
null or NaN component, or a missing one in a short vector, is a 0 bit;
a code is as long as the longest vector, or ``n_bits`` if given (components
beyond are then not part of it); repeated rows (the same
id twice) are rows each; null ids answer last and never query; fewer than k
rows give fewer answers; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table

K = 10
#: Entries and queries of one group.
BLOCK_CODES = 65_536
BLOCK_QUERIES = 256


def sign_codes(vectors: DataFrame, id_col: str, vec_col: str, n_bits: int) -> DataFrame:
    """(id, code binary) of every row with a vector."""
    id_type = vectors.schema[id_col].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(1)
            off = np.asarray(v.offsets, dtype=np.int64)
            flat = np.asarray(v.values.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False))
            size = np.minimum(off[1:] - off[:-1], n_bits)
            bits = np.zeros((len(v), n_bits), np.uint8)
            row = np.repeat(np.arange(len(v)), size)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            bits[row, pos] = flat[off[:-1][row] + pos] > 0
            packed = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x.tobytes() for x in packed], pa.binary())], names=["id", "code"])

    return (vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
            .where(F.col("v").isNotNull()).mapInArrow(code, f"id {id_type}, code binary"))


def longest(vectors: DataFrame, queries: DataFrame, vec_col: str) -> int:
    """Components of the longest vector, at least 1."""
    sizes = [t.where(F.col(vec_col).isNotNull()).select(F.size(vec_col).alias("n")) for t in (vectors, queries)]
    return max(1, sizes[0].unionAll(sizes[1]).agg(F.max("n")).first()[0] or 1)


class CodeIndex:
    """Multi-index over one block of codes."""

    def __init__(self, codes: np.ndarray, n_bits: int):
        n = len(codes)
        self.n, self.codes = n, codes
        width = min(max(round(math.log2(n)) if n > 1 else 4, 4), 16, n_bits)
        cuts = np.linspace(0, n_bits, math.ceil(n_bits / width) + 1).round().astype(int)
        self.segments = [(int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:])]
        self.tables = []
        for (a, b), v in zip(self.segments, self.values(codes)):
            order = np.argsort(v, kind="stable")
            starts = np.zeros((1 << (b - a)) + 1, np.int64)
            np.cumsum(np.bincount(v, minlength=1 << (b - a)), out=starts[1:])
            self.tables.append((order, starts))
        self.masks: dict[tuple[int, int], np.ndarray] = {}
        self.seen = np.zeros(n, bool)

    def values(self, codes: np.ndarray) -> list[np.ndarray]:
        bits = np.unpackbits(codes, axis=1)
        return [bits[:, a:b].astype(np.int64) @ (1 << np.arange(b - a - 1, -1, -1)) for a, b in self.segments]

    def flips(self, width: int, radius: int) -> np.ndarray:
        if (width, radius) not in self.masks:
            self.masks[width, radius] = np.array(
                [sum(1 << i for i in c) for c in combinations(range(width), radius)], np.int64)
        return self.masks[width, radius]

    def search(self, code: np.ndarray, values: list[int], rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of the k nearest codes, ties by ``rank``."""
        found, dist = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radius in range(max(b - a for a, b in self.segments) + 1):
            fresh = []
            for (a, b), (order, starts), v in zip(self.segments, self.tables, values):
                if radius > b - a:
                    continue
                probe = v ^ self.flips(b - a, radius)
                lo, size = starts[probe], starts[probe + 1] - starts[probe]
                probe_rows = np.flatnonzero(size)
                if not len(probe_rows):
                    continue
                lo, size = lo[probe_rows], size[probe_rows]
                at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                rows = order[at]
                rows = rows[~self.seen[rows]]
                self.seen[rows] = True          # a row is in one bucket of a segment, so rows are distinct
                fresh.append(rows)
            if fresh:
                rows = np.concatenate(fresh)
                d = np.bitwise_count(self.codes[rows] ^ code).sum(axis=1).astype(np.int64)
                found, dist = np.concatenate([found, rows]), np.concatenate([dist, d])
            covered = len(self.segments) * (radius + 1) - 1
            if len(found) >= k and np.partition(dist, k - 1)[k - 1] <= covered:
                break
        self.seen[found] = False
        best = np.lexsort((rank[found], dist))[:k]
        return found[best], dist[best]


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
          k: int = K, n_bits: int | None = None) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest rows of each query row."""
    n_bits = n_bits or longest(vectors, queries, vec_col)
    rows = shared_table(sign_codes(vectors, id_col, vec_col, n_bits), "codes")
    asked = shared_table(sign_codes(queries.where(F.col(id_col).isNotNull()), id_col, vec_col, n_bits), "queries")
    id_type = rows.schema["id"].dataType.simpleString()
    # k smallest ids per code: the rank limit is applied before the shuffle
    nth = F.row_number().over(Window.partitionBy("code").orderBy(F.col("id").asc_nulls_last()))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= k)
    entries = shared_table(
        few.groupBy("code").agg(F.sort_array(F.collect_list(F.struct("nth", "id"))).alias("ids"))
        .select("code", F.col("ids.id").alias("ids"), F.col("ids")[0]["id"].alias("first_id")), "entries")
    codes_asked = asked.select("code").distinct()
    n_code = max(1, math.ceil(entries.count() / BLOCK_CODES))
    n_query = max(1, math.ceil(codes_asked.count() / BLOCK_QUERIES))
    width = (n_bits + 7) // 8

    block = lambda n: F.pmod(F.xxhash64("code"), F.lit(n)).cast("int")        # noqa: E731
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))            # noqa: E731
    left = entries.select("code", "first_id", block(n_code).alias("c"), each(n_query).alias("q"))
    right = codes_asked.select("code", block(n_query).alias("q"), each(n_code).alias("c"))

    def unpack(s: pd.Series) -> np.ndarray:
        return np.frombuffer(b"".join(s), np.uint8).reshape(-1, width)

    def best(codes: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"asked": [], "code": [], "distance": []}
        if len(codes) and len(wanted):
            packed, q = unpack(codes["code"]), unpack(wanted["code"])
            index = CodeIndex(packed, n_bits)
            rank = codes["first_id"].rank(method="first", na_option="bottom").to_numpy()
            values = index.values(q)
            for i in range(len(q)):
                at, d = index.search(q[i], [int(v[i]) for v in values], rank, k)
                out["asked"] += [q[i].tobytes()] * len(at)
                out["code"] += [packed[j].tobytes() for j in at]
                out["distance"] += d.tolist()
        return pd.DataFrame(out)

    local = (left.groupBy("c", "q").cogroup(right.groupBy("c", "q"))
             .applyInPandas(best, "asked binary, code binary, distance int"))
    # k best entries per query over all blocks, opened into rows
    opened = local.join(entries.select("code", "ids"), "code").select(
        "asked", "distance", F.explode("ids").alias("id"))
    place = Window.partitionBy("asked").orderBy("distance", F.col("id").asc_nulls_last())
    ranked = (opened.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
              .withColumn("id", F.col("id").cast(id_type)))
    return (asked.select(F.col("id").alias("query_id"), F.col("code").alias("asked")).join(ranked, "asked")
            .select("query_id", "rank", F.col("id").alias(id_col), "distance"))
