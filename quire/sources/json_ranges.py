"""JSON array files of any layout, read by several tasks per file (A3, A4).

A JSON array without line breaks cannot be cut at lines, and whether a brace or a
comma in the middle of a file separates elements depends on all text before it.
That dependence is small: whether the place is outside a string, inside one or
just after a backslash in one, and how deep it is nested.

1. Spark's text source reads the file in byte ranges with ``}`` as the line
   separator (a range takes the pieces that start in it).  Each range is
   summarised as a function of where it starts: for each of the three string
   states the state at its end and the change of depth.
2. Functions compose, so a walk over a file's summaries (one small row per range,
   file by file) gives every range the state and depth that it starts with.
3. Each range then cuts its own elements, at commas one level deep.  The pieces at
   a range's ends (two per range at most) are put together by file and order.

A task holds a batch of pieces and one element; a file may be any size.  A file
that is not one JSON array is told by the walk (where it ends) and by text outside
the brackets: it gives one reject and no element.  A byte order mark is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

NOT_ARRAY = "not a JSON array"
#: Ranges up to this many are sent to all tasks (under 10 MB); more are joined.
SENT_RANGES = 50_000
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
_BLANK = b" \t\r\n"


def scan(data: np.ndarray, state: int, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(inside a string before each byte, depth before each byte and at the
    end, state at the end) of JSON text that starts in ``state`` and ``depth``."""
    n = len(data)
    back = np.concatenate([[state == ESCAPED], data == 92])
    place = np.arange(n + 1)
    plain = np.maximum.accumulate(np.where(back, -1, place))              # last byte that is no backslash
    odd = (place - plain) % 2 == 1                                        # ends an odd run of backslashes
    quote = (data == 34) & ~odd[:-1]
    inside = np.empty(n + 1, bool)
    inside[0] = state != OUTSIDE
    inside[1:] = inside[0] ^ (np.cumsum(quote) % 2 == 1)
    step = np.zeros(n, np.int64)
    step[((data == 123) | (data == 91)) & ~inside[:-1]] = 1
    step[((data == 125) | (data == 93)) & ~inside[:-1]] = -1
    deep = np.concatenate([[depth], depth + np.cumsum(step)])
    end = OUTSIDE if not inside[-1] else ESCAPED if odd[-1] else INSIDE
    return inside[:-1], deep, end


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, bytes, int]]:
    """(file, range, bytes, first row) of neighbouring pieces of one range."""
    files, starts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    values, at = batch.column(2).to_pylist(), 0
    while at < len(files):
        end = at
        while end < len(files) and files[end] == files[at] and starts[end] == starts[at]:
            end += 1
        yield files[at], starts[at], b"}".join(values[at:end]) + b"}", at
        at = end


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, value) in file order within each task."""
    return (spark.read.option("lineSep", "}").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
                    F.col("value").cast("binary").alias("value")))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, ends = None, []

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([now[0]]), pa.array([now[1]], pa.int64()), pa.array([[e[0] for e in ends]], pa.list_(pa.int32())),
             pa.array([[e[1] for e in ends]], pa.list_(pa.int64()))], names=["file", "range", "state", "depth"])
    for batch in batches:
        for file, start, raw, _ in _runs(batch):
            if (file, start) != now:
                if now is not None:
                    yield told()
                now, ends = (file, start), [(s, 0) for s in (OUTSIDE, INSIDE, ESCAPED)]
            data = np.frombuffer(raw, np.uint8)
            by_state = {s: scan(data, s, 0) for s in {e[0] for e in ends}}
            ends = [(by_state[s][2], d + int(by_state[s][1][-1])) for s, d in ends]
    if now is not None:
        yield told()


def _walk(ranges: pa.Table) -> pa.Table:
    """State and depth at the start of each range of a file; ``ends`` is the
    depth after the last one (-1 for an array: the separator put back there is
    one brace too many)."""
    rows = sorted(ranges.to_pylist(), key=lambda r: r["range"])
    state, depth, out = OUTSIDE, 0, []
    for r in rows:
        out.append((state, depth))
        state, depth = r["state"][state], depth + r["depth"][state]
    closed = state == OUTSIDE and depth == -1
    return pa.table({"file": pa.array([r["file"] for r in rows]), "range": pa.array([r["range"] for r in rows], pa.int64()),
                     "state": pa.array([o[0] for o in out], pa.int32()), "depth": pa.array([o[1] for o in out], pa.int64()),
                     "closed": pa.array([closed] * len(rows))})


def starts_of(pieces: DataFrame) -> DataFrame:
    """(file, range, state, depth, closed) of every range."""
    told = pieces.mapInArrow(_summaries, "file string, range long, state array<int>, depth array<long>")
    return told.groupBy("file").applyInArrow(_walk, "file string, range long, state int, depth long, closed boolean")


_PIECES = "file string, range long, kind string, opened string, closed string, raw binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of each range.  kind: whole; open (its end lies in a later
    range), more (goes on from an earlier one); start (an array's bracket); stray
    (text outside of an array)."""
    now, state, depth, held, opened, out = None, OUTSIDE, 0, [], None, []

    def put(kind: str, text: bytes, first: str | None, last: str | None) -> None:
        out.append((*now, kind, first, last, text))

    def close_range() -> None:
        if now is None:
            return
        text = b"".join(held)
        if depth >= 1 or opened is None:
            kind = "more" if opened is None else "open"
            if depth >= 1 or text.strip(_BLANK + b"}"):
                put(kind if depth >= 1 else "stray", text, opened, None)
        elif text.strip(_BLANK).removesuffix(b"}").strip(_BLANK):            # after the closing bracket
            put("stray", text, opened, None)

    def emitted() -> pa.RecordBatch:
        cols = list(zip(*out))
        out.clear()
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=["file", "range", "kind", "opened", "closed", "raw"])

    for batch in batches:
        first_state = batch.column(3).to_pylist()
        first_depth = batch.column(4).to_pylist()
        for file, start, raw, row in _runs(batch):
            if (file, start) != now:
                close_range()
                now, held, opened = (file, start), [], None
                state, depth = first_state[row], first_depth[row]
                if start == 0 and raw.startswith(b"\xef\xbb\xbf"):
                    raw = b"   " + raw[3:]
            data = np.frombuffer(raw, np.uint8)
            inside, deep, state = scan(data, state, depth)
            before, after = deep[:-1], deep[1:]
            mark = ~inside & (((data == 44) & (before == 1)) | ((data == 91) & (before == 0) & (after == 1))
                              | ((before == 1) & (after == 0)))
            at = 0
            for m in np.flatnonzero(mark).tolist():
                text, sign = b"".join(held) + raw[at:m], chr(raw[m])
                held, at = [], m + 1
                if sign == "[":
                    put("stray" if text.strip(_BLANK) else "start", b"", opened, sign)
                elif sign == "}":                                            # an object that is no element
                    put("stray", b"", opened, sign)
                elif opened is None:
                    put("more", text, None, sign)
                elif opened == "[" and sign != "," and not text.strip(_BLANK):
                    pass                                                     # an empty array
                else:
                    put("whole", text, opened, sign)
                opened = sign
            held.append(raw[at:])
            depth = int(deep[-1])
            if opened in ("]", "}"):
                depth = min(depth, 0)
        if out:
            yield emitted()
    close_range()
    if out:
        yield emitted()


def array_elements(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """((raw), (file, reason)): the text of every element of the array files at
    ``path``, and the files that are no JSON arrays."""
    pieces = _pieces(spark, path)
    kept = scratch_dir(spark, "json-ranges")
    starts_of(pieces).write.parquet(kept)                # one row per range, read by the cutting pass and the checks
    starts = spark.read.parquet(kept)
    if starts.count() <= SENT_RANGES:
        met = pieces.join(F.broadcast(starts.drop("closed")), ["file", "range"])
    else:
        numbered = pieces.withColumn("_pos", F.monotonically_increasing_id())
        met = (numbered.join(starts.drop("closed"), ["file", "range"])
               .repartition("file", "range").sortWithinPartitions("file", "range", "_pos"))
    cut = met.select("file", "range", "value", "state", "depth").mapInArrow(_cut, _PIECES)
    stored = scratch_dir(spark, "json-pieces")
    cut.write.parquet(stored)
    cut = spark.read.schema(_PIECES).parquet(stored)
    order = Window.partitionBy("file").orderBy("range", F.when(F.col("kind") == "more", 0).otherwise(1))
    ends = (cut.filter(F.col("kind").isin("open", "more"))
            .withColumn("_element", F.sum(F.when(F.col("kind") == "open", 1).otherwise(0)).over(order)))
    joined = (ends.groupBy("file", "_element")
              .agg(F.array_sort(F.collect_list(F.struct("range", F.when(F.col("kind") == "more", 0).otherwise(1).alias("o"),
                                                        "opened", "closed", "raw"))).alias("p"))
              .select("file", F.expr("p[0].opened").alias("opened"), F.expr("element_at(p, -1).closed").alias("closed"),
                      F.expr("array_join(transform(p, x -> cast(x.raw AS string)), '')").alias("raw")))
    joined = joined.filter(~((F.col("opened") == "[") & (F.col("closed") == "]") & (F.trim("raw") == "")))
    whole = cut.filter(F.col("kind") == "whole").select("file", F.col("raw").cast("string").alias("raw"))
    outside = cut.filter(F.col("kind").isin("start", "stray")).groupBy("file").agg(
        F.count_if(F.col("kind") == "start").alias("_starts"), F.count_if(F.col("kind") == "stray").alias("_strays"))
    one_array = (F.col("_starts") == 1) & (F.col("_strays") == 0)
    files = (starts.groupBy("file").agg(F.first("closed").alias("closed")).join(outside, "file", "left")
             .withColumn("good", F.col("closed") & F.coalesce(one_array, F.lit(False))))
    elements = whole.unionByName(joined.select("file", "raw"))
    good = files.filter("good").select("file")
    bad = files.filter(~F.col("good")).select("file", F.lit(NOT_ARRAY).alias("reason"))
    return elements.join(good, "file", "left_semi").select(F.trim(F.col("raw")).alias("raw")), bad
