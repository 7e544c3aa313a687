"""SimHash near-dedup with the generalised pigeonhole principle.

A document's fingerprint is the bitwise majority of the XXH64 values (seed 42)
of its word shingles.  Equal fingerprints are one entry.  To find all entries
within ``radius`` bits, the 64 bits are cut into partitions with a threshold
each: if the thresholds t satisfy sum(t + 1) = radius + 1, two entries within
the radius agree within t bits in one partition at least (a threshold of -1
leaves a partition out).

* Correlated bits go into the same partition: the bit correlations of all
  entries are summed in one aggregation (64 x 64 numbers), and bits are
  gathered greedily by them.
* Thresholds are allocated by dynamic programming over the partitions.  The
  cost of (partition, t) is the number of probes plus the number of candidate
  pairs, estimated from the distances of a bounded set of entries
  (``SAMPLE`` of them in hash order).  The estimate steers the cost only: any
  allocation finds every link.  The number of partitions is chosen by the same cost.
* Every entry is put under its own value in each partition used and probes
  the values within t bits.  Rows are sorted by bucket; a streaming pass
  compares bucket by bucket and emits links that form a forest, never all
  pairs.  A bucket of more than ``BLOCK`` entries is cut into blocks and every
  pair of blocks is a bucket of its own, so a task's work is bounded.

Links become components in Spark rounds, and components go back to rows.

Defined results: null and empty texts (no words) have the fingerprint zero and
link like any other; repeated rows and equal texts have equal fingerprints; a
null id counts as larger than all others and its component id is null only if
no row of the component has an id; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, numbered_table, rows_first, shared_table, text_slices, utf8
from .components import connected_components

SHINGLE = 3
RADIUS = 3
SEED = 42
SAMPLE = 2000
BLOCK = 4096
#: Shingles whose bits are counted at once.
CHUNK = 1 << 18


def _bit_sums(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many hashes of each document have each bit (bit 63 first)."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def fingerprints_of(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints (unsigned) of UTF-8 texts."""
    digest, join = xxhash.xxh64_intdigest, b" ".join
    out = np.zeros(len(texts), np.uint64)
    pend: list[int] = []
    owner: list[int] = []
    size: list[int] = []
    weights = U64(1) << np.arange(63, -1, -1, dtype=np.uint64)

    def flush() -> None:
        if not owner:
            return
        starts = np.cumsum([0, *size[:-1]])
        sums = _bit_sums(np.array(pend, dtype=np.uint64), starts)
        big = np.array(owner)
        np.add.at(total, big, sums)
        pend.clear(), owner.clear(), size.clear()

    total = np.zeros((len(texts), 64), np.int64)
    n = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        w = text.lower().split()
        if not w:
            continue
        if len(w) < shingle:
            h = [digest(join(w), SEED)]
        else:
            h = [digest(x, SEED) for x in map(join, zip(*(w[k:] for k in range(shingle))))]
        n[i] = len(h)
        for at in range(0, len(h), CHUNK):                 # a very long text comes in pieces
            piece = h[at:at + CHUNK]
            pend.extend(piece)
            owner.append(i)
            size.append(len(piece))
            if len(pend) >= CHUNK:
                flush()
    flush()
    out[:] = ((total * 2 > n[:, None]) * weights).sum(axis=1, dtype=np.uint64)
    return out


def fingerprint_rows(docs: DataFrame, id_col: str, text_col: str, row_col: str | None = None,
                     shingle: int = SHINGLE) -> DataFrame:
    """(id, row, fp) of every row, written once; fp as a signed long."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    src = docs.select(F.col(id_col).alias("id"), row.alias("row"), utf8(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                fp = fingerprints_of(part.column("text").to_pylist(), shingle)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("row"), pa.array(fp.view(np.int64))], names=["id", "row", "fp"])

    return shared_table(src.mapInArrow(run, f"id {id_type}, row long, fp long"), "fingerprints")


# -- partitions and thresholds --------------------------------------------------------------

def _bits_of(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)


def bit_correlations(entries: DataFrame) -> np.ndarray:
    """|correlation| of all bit pairs over all entries, from summed counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, one, two = 0, np.zeros(64), np.zeros((64, 64))
        for b in batches:
            x = _bits_of(b.column("fp").to_numpy()).astype(np.float32)
            n, one, two = n + len(x), one + x.sum(axis=0), two + (x.T @ x)
        if n:
            flat = np.concatenate([[n], one, two.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "v"])

    parts = entries.select("fp").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v"))
    got = {r["at"]: r["v"] for r in parts.collect()}           # 1 + 64 + 64 * 64 numbers
    if not got:
        return np.zeros((64, 64))
    flat = np.array([got[i] for i in range(len(got))])
    n, p = flat[0], flat[1:65] / flat[0]
    cov = flat[65:].reshape(64, 64) / n - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    return np.abs(cov / np.outer(sd, sd))


def group_bits(corr: np.ndarray, m: int) -> list[list[int]]:
    """m sets of bits of about the same size, correlated bits together."""
    left, out = set(range(64)), []
    for i in range(m):
        size = 64 // m + (i < 64 % m)
        rest = sorted(left)
        seed = max(rest, key=lambda b: (round(float(corr[b, rest].sum()), 9), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < size:
            b = max(sorted(left), key=lambda b: (round(float(corr[b, group].mean()), 9), -b))
            group.append(b)
            left.remove(b)
        out.append(sorted(group))
    return out


def allocate(cost: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds with sum(t + 1) = budget and the least total cost;
    cost[i][t] for t >= 0, leaving a partition out costs nothing."""
    best = {0: (0.0, [])}
    for row in cost:
        new: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in range(-1, min(len(row), budget - used)):
                at, total = used + t + 1, c + (row[t] if t >= 0 else 0.0)
                if at not in new or total < new[at][0]:
                    new[at] = (total, [*ts, t])
        best = new
    return best[budget]


def plan(entries: DataFrame, n: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """(bits, threshold) of every partition in use."""
    corr = bit_correlations(entries)
    some = entries.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    bits = _bits_of(np.array([r["fp"] for r in some], np.int64)).astype(np.int16)
    pairs = max(1, len(bits) * (len(bits) - 1) / 2)
    choice = None
    for m in range(2, radius + 2):
        groups = group_bits(corr, m)
        cost = []
        for g in groups:
            x = bits[:, g]
            d = x @ (1 - x).T
            d = (d + d.T)[np.triu_indices(len(bits), 1)]
            near = [float((d <= t).sum()) / pairs * n * (n - 1) / 2 for t in range(radius + 1)]
            cost.append([n * sum(comb(len(g), k) for k in range(t + 1)) * 20 + near[t] for t in range(radius + 1)])
        total, ts = allocate(cost, radius + 1)
        if choice is None or total < choice[0]:
            choice = (total, [(g, t) for g, t in zip(groups, ts) if t >= 0])
    return choice[1]


# -- probe and verify -----------------------------------------------------------------------

def bucket_rows(entries: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """(part, value, fp, home): each entry under its own value (home) and, in
    partitions with a threshold over 0, under the values near it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy()
            bits = _bits_of(fp).astype(np.int64)
            for i, (g, t) in enumerate(parts):
                own = bits[:, g] @ (1 << np.arange(len(g) - 1, -1, -1, dtype=np.int64))
                for r in range(t + 1):
                    for flip in combinations(range(len(g)), r):
                        value = own ^ sum(1 << k for k in flip)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(fp), i, np.int32)), pa.array(value), pa.array(fp),
                             pa.array(np.full(len(fp), r == 0))], names=["part", "value", "fp", "home"])

    return entries.select("fp").mapInArrow(run, "part int, value long, fp long, home boolean")


def split_hot(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Buckets over ``block`` entries are cut: a row meets every block of its
    bucket once, as (left, right) block pair."""
    hot = (rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
           .select("part", "value", F.ceil(F.col("n") / block).cast("int").alias("cuts")))
    met = rows.join(hot, ["part", "value"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
    met = met.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    return met.select("part", "value", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                      "fp", "home")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions over links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _bucket_links(fp: np.ndarray, home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the entries of one large bucket, compared row by row."""
    n = len(fp)
    a, b = [], []
    for i in range(n - 1):
        near = np.bitwise_count(fp[i + 1:] ^ fp[i]) <= radius
        if not home[i]:
            near &= home[i + 1:]
        hit = np.flatnonzero(near)
        if len(hit):
            a.append(np.full(len(hit), i))
            b.append(hit + i + 1)
        if sum(map(len, a[-64:])) > 200_000 or i == n - 2:      # contract now and then: links stay few
            x, y = np.concatenate([*a, []]).astype(np.int64), np.concatenate([*b, []]).astype(np.int64)
            root = _roots(n, x, y)
            far = np.flatnonzero(root != np.arange(n))
            a, b = [far], [root[far]]
    x = np.concatenate([*a, []]).astype(np.int64)
    y = np.concatenate([*b, []]).astype(np.int64)
    return x, y


def bucket_links(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) of entries within the radius, a forest per bucket."""
    keys = ["part", "value", "lo", "hi"]

    def links(key: np.ndarray, fp: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
        u, v = [], []
        first = np.ones(len(fp), bool)
        first[1:] = (key[1:] != key[:-1]).any(axis=1)
        group = np.cumsum(first) - 1
        size = np.bincount(group)
        small = np.flatnonzero(size[group] <= 64)
        if len(small):
            f, g, h = fp[small], group[small], home[small]
            for step in range(1, 64):                    # all buckets at once, neighbour by neighbour
                same = np.flatnonzero(g[step:] == g[:-step])
                if not len(same):
                    break
                near = np.bitwise_count(f[same] ^ f[same + step]) <= radius
                near &= h[same] | h[same + step]
                hit = same[near]
                u.append(f[hit])
                v.append(f[hit + step])
        starts = np.flatnonzero(first)
        for gi in np.flatnonzero(size > 64):
            part = slice(starts[gi], starts[gi] + size[gi])
            x, y = _bucket_links(fp[part], home[part], radius)
            u.append(fp[part][x])
            v.append(fp[part][y])
        a = np.concatenate([*u, np.zeros(0, np.uint64)]).astype(np.uint64)
        b = np.concatenate([*v, np.zeros(0, np.uint64)]).astype(np.uint64)
        # a forest of what this run of buckets linked
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = _roots(len(nodes), at[:len(a)], at[len(a):])
        far = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes[far].view(np.int64)), pa.array(nodes[root[far]].view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                                      # rows of the last bucket, which may go on
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in keys], axis=1)
            fp = batch.column("fp").to_numpy().view(np.uint64)
            home = batch.column("home").to_numpy(zero_copy_only=False)
            if held:
                key, fp, home = (np.concatenate([x, y]) for x, y in zip(held, (key, fp, home)))
            if not len(fp):
                continue
            cut = int(np.flatnonzero((key == key[-1]).all(axis=1))[0])
            if cut:
                yield links(key[:cut], fp[:cut], home[:cut])
            held = (key[cut:], fp[cut:], home[cut:])
        if held:
            yield links(*held)

    return (rows.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(run, "a long, b long").distinct())


def component_roots(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """rows (id, row, fp) -> (fp, best): the component's first row as a struct."""
    entries = shared_table(
        rows.groupBy("fp").agg(F.min(rows_first(F.col("id"), F.col("row"))).alias("best")), "entries")
    parts = plan(entries, entries.count(), radius)
    buckets = shared_table(bucket_rows(entries, parts), "buckets")
    comp = connected_components(bucket_links(split_hot(buckets), radius))
    known = shared_table(
        entries.join(comp, entries.fp == comp.node, "left")
        .select("fp", F.coalesce("root", "fp").alias("root"), "best"), "roots")
    least = known.groupBy("root").agg(F.min("best").alias("best"))
    return known.select("fp", "root").join(least, "root").select("fp", "best")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS) -> DataFrame:
    """One row per document: id, fingerprint (hex), component_id."""
    rows = fingerprint_rows(docs, id_col, text_col, shingle=shingle)
    met = rows.join(component_roots(rows, radius), "fp")
    return met.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("best.id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                     radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row (the first by id) of each component."""
    base, row = numbered_table(docs, "near-docs")
    rows = fingerprint_rows(base, id_col, text_col, row, shingle)
    first = component_roots(rows, radius).select(F.col("best.row").alias(row)).distinct()
    return base.join(first, row, "left_semi").select(*docs.columns)
