"""Exact ranks by parallel sorting with regular sampling (PSRS).

1. Runs: the table is cut into at most ``RUNS`` runs, each sorted locally.
2. Every run gives regular samples: each stands for the same number of rows of
   its run.  Splitters are taken at regular places of all samples in order; the
   samples are a bounded table (``RUNS`` times twice ``SAMPLES`` rows at most).
3. Each row goes to the segment that its key falls into, one exchange by
   segment number; a segment's part of every run is merged by a local sort.
4. The rows of each segment are counted, and a row's rank is what lies in the
   segments before plus its place in its own: no task sees more than a segment.

Keys are (score, id, row): the row number settles ties of repeated rows, so no
two keys are equal and a score shared by many rows is split like any other.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column_or, free_name

#: Most runs, and regular samples of a run (up to twice as many are sent).
RUNS, SAMPLES = 512, 64


def _key(score: int, id_: object, row: int) -> tuple:
    """Higher scores first, then smaller ids, null ids last."""
    return (-score, id_ is None, 0 if id_ is None else id_, row)


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every 2**k-th row of a sorted run, k grown as the run goes on."""
    step, held, seen, schema = 1, [], 0, None
    for batch in batches:
        schema = batch.schema
        at = np.arange(-seen % step, batch.num_rows, step)
        held.append(batch.take(pa.array(at)))
        seen += batch.num_rows
        while sum(b.num_rows for b in held) > 2 * SAMPLES:
            step *= 2
            held = [pa.concat_batches(held)]
            held = [held[0].take(pa.array(np.arange(0, held[0].num_rows, 2)))]
    for b in held:
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, step, np.int64))],
                                         names=[*schema.names, "stands_for"])


def _splitters(samples: list[tuple], ranges: int) -> list[tuple]:
    """ranges - 1 keys at regular places of the samples, by the rows that they
    stand for."""
    ordered = sorted((_key(s, i, r), n) for s, i, r, n in samples)
    total, passed, out = sum(n for _, n in ordered), 0, []
    for key, n in ordered:
        if len(out) < ranges - 1 and passed >= total * (len(out) + 1) / ranges:
            out.append(key)
        passed += n
    return out


def _order(score: str, id_col: str, row: str) -> list[Column]:
    return [F.col(score).desc(), F.col(id_col).asc_nulls_last(), F.col(row).asc()]


def ranked(table: DataFrame, score: str, id_col: str, row: str, rank: str, ranges: int | None = None) -> DataFrame:
    """``table`` with a ``rank`` column (1, 2, ..): higher ``score`` (long)
    first, then smaller ``id_col`` (null last), then ``row`` (distinct longs).

    ``table`` is read several times and must give the same rows each time (a
    written table).  ``ranges``: number of segments, by default one per shuffle
    partition, ``RUNS`` at most."""
    spark = table.sparkSession
    ranges = min(ranges or int(spark.conf.get("spark.sql.shuffle.partitions")), RUNS)
    keys = table.select(F.col(score).alias("score"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    runs = keys.coalesce(RUNS).sortWithinPartitions(*_order("score", "id", "row"))
    taken = runs.mapInArrow(_samples, f"score long, id {keys.schema['id'].dataType.simpleString()}, row long, "
                                      "stands_for long").collect()
    splitters = _splitters([tuple(r) for r in taken], ranges)
    firsts = np.array([s[0] for s in splitters], np.int64)

    segment, columns = free_name(table, "__segment"), table.columns

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            have = -column_or(batch, score).to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(firsts, have, "left"), np.searchsorted(firsts, have, "right")
            tied = np.flatnonzero(low < high)             # a splitter has this score: its id and row decide
            if len(tied):
                some = batch.take(pa.array(tied))
                low[tied] = [bisect_right(splitters, _key(*k)) for k in zip(
                    *(column_or(some, c).to_pylist() for c in (score, id_col, row)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low.astype(np.int32))],
                                             names=[*batch.schema.names, segment])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    dealt = table.mapInArrow(deal, f"{fields}, `{segment}` int")
    counts = {r[0]: r[1] for r in dealt.groupBy(segment).count().collect()}       # at most RUNS rows
    before = np.concatenate([[0], np.cumsum([counts.get(k, 0) for k in range(ranges)])])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, passed = -1, 0                               # segment at hand, its rows so far
        for batch in batches:
            seg = column_or(batch, segment).to_numpy()
            starts = np.flatnonzero(np.diff(seg, prepend=now))
            first = np.zeros(len(seg), np.int64)
            first[starts] = starts
            first = np.maximum.accumulate(first)
            at = np.arange(len(seg)) - first
            carried = seg == now
            at[carried] += passed
            if len(seg):
                passed, now = int(at[-1]) + 1, int(seg[-1])
            yield pa.RecordBatch.from_arrays([*(column_or(batch, c) for c in columns), pa.array(before[seg] + at + 1)],
                                             names=[*columns, rank])

    merged = dealt.repartitionById(ranges, F.col(segment)).sortWithinPartitions(
        F.col(segment), *_order(score, id_col, row))
    return merged.mapInArrow(place, f"{fields}, `{rank}` long")
