"""Hard negatives of anchor vectors by Fagin's threshold algorithm (op11).

A row's score is its integer inner product with the anchor.  An anchor's
positives are its best other rows of the same label; each positive opens a
window of scores, and the best rows of other labels in that window are its hard
negatives.

Method, within a block of candidates:

1. Per dimension the candidates are listed in order of that component.
2. Sorted access goes down all lists together, from the large end where the
   anchor's component is positive, from the small end where it is negative
   (a zero component needs no list).  Every row met is scored at once from all
   its components (random access).
3. The threshold is the anchor's product with the components last read: no row
   not yet met scores more.  The scan ends when the threshold lies strictly
   below every window's kth score so far, or below the window itself; equal
   scores are read on, since ties go to the smaller id.
4. Thresholds fall with depth and need no row, so they are known at ``_STEPS``
   depths beforehand: the scan first goes to where some window can be settled
   (below its highest score), then to where all must be.  Where the lists read
   hold ``_ENOUGH`` times the block's rows nearly all rows have been met, and the
   whole block is scored at once, several anchors in one product.

Spark deals the candidates into blocks of bounded size (by row number, so a
label or a vector that a third of the rows share is spread evenly) and streams
all anchors past each block: ``blocks`` rows per anchor, one row's memory.  A
block's best of each window meet in one ranking per window.  Two rounds: the
windows of the second follow from the positives of the first.

Rows with a null label or vector, or a null or non-finite component, take no
part.  Components become floor(scale * x) and are held to +-2**24, far beyond
unit vectors, so that scores are exact in 64 bits (up to 2**14 components).
Shorter vectors count as padded with zeros.  A null id is never an anchor and
loses ties.  Repeated rows are rows of their own: they are each other's
positives, and repeated anchors give repeated results.  An anchor whose
components are all zero reads every row.  Empty tables give no rows.  Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column_or, shared_table

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: A negative scores between these percentages of its positive's score.
LOW, HIGH = 50, 95
#: Rows of a block: fewest worth a task of their own, and most.
LEAST_ROWS, MOST_ROWS = 8192, 65_536
NO_ID = (1 << 63) - 1
_BOUND = 1 << 24
_STEPS, _ENOUGH = 64, 4
#: Anchors scored in one product.
_TOGETHER = 32


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, anchors: Column,
                  scale: int) -> DataFrame:
    """(row, id, label, vec, anchor) of the rows that take part."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    whole = F.transform(x, lambda v: F.greatest(F.lit(-_BOUND), F.least(F.lit(_BOUND), F.floor(
        F.lit(float(scale)) * v.cast("double")))).cast("int"))
    part = vectors.where(F.col(label_col).isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)))
    return part.select(F.monotonically_increasing_id().alias("row"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                       F.col(label_col).cast("string").alias("label"), whole.alias("vec"),
                       F.coalesce(anchors & F.col(id_col).isNotNull(), F.lit(False)).alias("anchor"))


class Block:
    """Candidates in order of (id, row), and a list of them per dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        at = np.lexsort((rows, ids))
        self.ids, self.rows, self.x = ids[at], rows[at], vectors[at]
        self.codes: dict[str, int] = {}
        self.labels = np.array([self.codes.setdefault(v, len(self.codes)) for v in labels[at]], np.int64)
        self.lists = np.argsort(self.x, axis=0, kind="stable").T.astype(np.int32)
        n = len(rows)
        self.depths = np.unique(np.concatenate([[min(n, 8)], -(-n * np.arange(1, _STEPS + 1) // _STEPS)]))
        ordered = np.sort(self.x, axis=0)
        self.tops, self.bottoms = ordered[n - self.depths], ordered[self.depths - 1]
        self.real = self.x.astype(float)
        self.largest = int(np.abs(self.x).max(initial=0))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Scores of all candidates for some anchors, one row per anchor."""
        if self.largest * int(np.abs(anchors).max(initial=0)) * self.x.shape[1] < 1 << 53:
            return (anchors.astype(float) @ self.real.T).astype(np.int64)       # exact in doubles
        return anchors @ self.x.T

    def _best(self, score: np.ndarray, fits: np.ndarray, k: int) -> np.ndarray:
        """The k best of the candidates ``fits``, ties in candidate order."""
        at = np.flatnonzero(fits)
        if len(at) > k:
            kth = np.partition(score[at], len(at) - k)[len(at) - k]
            above, level = at[score[at] > kth], at[score[at] == kth]
            at = np.concatenate([above, level[:k - len(above)]])
        return at[np.lexsort((at, -score[at]))]

    def search(self, a: np.ndarray, windows: list[tuple[int, int]], fits: np.ndarray, k: int,
               everything: Callable[[], np.ndarray]) -> list[np.ndarray]:
        """For every window (lowest, highest score) the k best candidates
        among ``fits`` as (place, score) columns.  ``everything`` gives the
        scores of all candidates."""
        n = len(self.rows)
        up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        lists = len(up) + len(down)
        threshold = self.tops[:, up] @ a[up] + self.bottoms[:, down] @ a[down]     # falls with depth

        def below(bound: int) -> int:
            return min(int(np.searchsorted(-threshold, -bound, side="right")), len(threshold) - 1)

        score, met = np.zeros(n, np.int64), np.zeros(n, bool)
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(windows)
        open_ = [w for w, (low, high) in enumerate(windows) if low <= high]
        highest = max((windows[w][1] for w in open_), default=0)
        step = 0 if highest == NO_ID else below(highest)
        while open_:
            depth = int(self.depths[step])
            if depth * lists >= _ENOUGH * n or not lists or depth == n:
                score, met = everything(), np.ones(n, bool)
            else:
                reached = np.zeros(n, bool)
                reached[self.lists[up, n - depth:]] = True
                reached[self.lists[down, :depth]] = True
                new = np.flatnonzero(reached & ~met)
                score[new] = self.x[new] @ a
                met[new] = True
            if met.all():
                fit, last = fits, True
            else:
                fit, last = fits & met, False
            need = []
            for w in list(open_):
                low, high = windows[w]
                found[w] = self._best(score, fit & (score >= low) & (score <= high), k)
                bound = int(score[found[w][-1]]) if len(found[w]) == k else low
                if last or threshold[step] < bound:
                    open_.remove(w)
                else:
                    need.append(bound)
            if open_:
                step = below(min(need))
        return [np.stack([f, score[f]], axis=1) for f in found]


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    lists = column_or(batch, "vec")
    out = np.zeros((batch.num_rows, dims), np.int64)
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(size)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = \
        lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _labels(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(column_or(batch, "label").to_pylist(), dtype=object)


def _searched(vectors: DataFrame, anchors: DataFrame, blocks: int, dims: int, same_label: bool, k: int) -> DataFrame:
    """(a_row, window, row, id, score): the k best of each block for every
    window of ``anchors`` (row, id, label, vec, lows, highs)."""
    none = F.array().cast("array<long>")
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    candidates = vectors.select(block.alias("block"), F.lit(0).alias("kind"), "row", "id", "label", "vec",
                                none.alias("lows"), none.alias("highs"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"),
                           "row", "id", "label", "vec", "lows", "highs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, block_at = None, [], None
        for batch in batches:
            numbers, kinds = column_or(batch, "block").to_numpy(), column_or(batch, "kind").to_numpy()
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if numbers[lo] != number:
                    number, parts, block_at = numbers[lo], [], None
                if kinds[lo] == 0:
                    parts.append((column_or(part, "id").to_numpy(), column_or(part, "row").to_numpy(), _labels(part),
                                  _vectors(part, dims)))
                    continue
                if block_at is None and parts:
                    block_at, parts = Block(*(np.concatenate(c) for c in zip(*parts))), []
                if block_at is not None:
                    yield from answers(block_at, part)

    def answers(b: Block, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own, label, vec = column_or(part, "row").to_numpy(), _labels(part), _vectors(part, dims)
        whole: dict[int, np.ndarray] = {}                # scores of the anchors at hand

        def everything(i: int) -> np.ndarray:
            if i // _TOGETHER not in whole:
                whole.clear()
                at = i // _TOGETHER * _TOGETHER
                whole[i // _TOGETHER] = b.scores(vec[at:at + _TOGETHER])
            return whole[i // _TOGETHER][i % _TOGETHER]

        lows, highs = column_or(part, "lows").to_pylist(), column_or(part, "highs").to_pylist()
        a_rows, windows, places = [], [], []
        for i in range(part.num_rows):
            fits = (b.labels == b.codes.get(label[i], -1)) == same_label
            fits &= b.rows != own[i]
            for w, f in enumerate(b.search(vec[i], list(zip(lows[i], highs[i])), fits, k,
                                              lambda: everything(i))):
                a_rows.append(np.full(len(f), own[i]))
                windows.append(np.full(len(f), w, np.int32))
                places.append(f)
        if a_rows:
            at = np.concatenate(places).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(a_rows)), pa.array(np.concatenate(windows)), pa.array(b.rows[at[:, 0]]),
                 pa.array(b.ids[at[:, 0]]), pa.array(at[:, 1])], names=["a_row", "window", "row", "id", "score"])

    both = candidates.unionByName(asked).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind")
    return both.mapInArrow(run, "a_row long, window int, row long, id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The k best of every window over all blocks, ranked from 1."""
    best = Window.partitionBy("a_row", "window").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, blocks: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for every row of the condition ``anchors`` and each of its
    first ``positives`` the first ``negatives`` rows of other labels that score
    from ``low`` to ``high`` percent of the positive."""
    spark = vectors.sparkSession
    part = shared_table(whole_vectors(vectors, id_col, vector_col, label_col, anchors, scale), "vectors")
    n, dims = part.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    dims = max(dims or 0, 1)
    if blocks is None:
        fewest, most = -(-n // MOST_ROWS), max(1, n // LEAST_ROWS)
        blocks = max(1, fewest, min(most, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    asked = part.where("anchor").select("row", "id", "label", "vec")
    bound = F.lit(NO_ID)
    every = asked.withColumns({"lows": F.array(-bound), "highs": F.array(bound)})
    first = _first(_searched(part, every, blocks, dims, True, positives), positives)
    of = shared_table(first.groupBy("a_row").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("of")),
                      "positives")
    score = F.col("of.score")
    windows = asked.join(of, asked["row"] == of["a_row"]).select(
        "row", "id", "label", "vec", F.transform(score, lambda s: F.ceil(s * low / F.lit(100).cast("decimal(3,0)")).cast("long")).alias("lows"),
        F.transform(score, lambda s: F.floor(s * high / F.lit(100).cast("decimal(3,0)")).cast("long")).alias("highs"))
    found = _first(_searched(part, windows, blocks, dims, False, negatives), negatives)
    p = F.element_at("of", F.col("window") + 1)
    met = found.join(of, "a_row").join(asked.select(F.col("row").alias("a_row"), F.col("id").alias("anchor_id")), "a_row")

    def shown(c: Column) -> Column:
        return F.when(c != NO_ID, c)
    return met.select("anchor_id", shown(p["id"]).alias("positive_id"), "rank", shown(F.col("id")).alias("negative_id"),
                      p["score"].alias("positive_score"), F.col("score").alias("negative_score"))
