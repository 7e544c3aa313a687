"""Mixing sources to target weights by iterative proportional fitting.

Every document has a token count and three traits: source, language and topic.
The tokens are summed per cell (source, lang, topic); raking then scales the
cells until the marginal token shares of all three traits are within
``TOLERANCE`` of their targets (relative).  Targets that no scaling of the cells
there are can meet (say a source that is alone in a language) have no such end:
raking then stops when a round changes no cell's factor any more (``STILL``), or
after ``MAX_ROUNDS``, and logs the largest deviation that remains.
A document's weight is ``scale * factor`` of its cell, where the scale makes the
weighted tokens ``volume`` times the tokens there are (``VOLUME``: as many).  The
weight is the expected number of copies: its whole part is drawn for certain,
one more with the probability of its fraction.  So the expected tokens have both
the volume and the shares that raking reached, and a rare cell is repeated
itself instead of lowering the draw of all others.  The draw compares the
fraction with a hash of the document's id and text: a document is drawn alike in
every run and partition.

Targets default to tempered shares (share ** ``TEMPER``, normalised), which
lift small sources; any {value: weight} can be given.

Cells are summed by Spark.  Up to ``LOCAL_CELLS`` of them are raked with numpy
on the driver (a proven bound on what is fetched); more are raked in Spark
rounds with the same steps and the same end, each round written to the shared
folder.

A table without a topic column gets a lexical stand-in: the class of initial
bytes that begins most of the document's words (``TOPICS`` classes).

Defined results: tokens are white-space separated words; null and empty texts
have none, topic 0, and are drawn by their cell's factor (a cell without any
tokens has factor 1 before scaling); null sources and languages are values of
their own; repeated rows share their draw; an empty table gives an empty
result; other columns pass through untouched.  ``probability`` is that of one
copy or more, ``sampled`` says that there is one.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_view, free_name, shared_table, text_slices, utf8, word_bounds

TOPICS = 8
TEMPER = 0.9
VOLUME = 1.0
LOCAL_CELLS = 100_000
MAX_ROUNDS = 1000
TOLERANCE = 1e-9
#: Largest relative change of a factor in a round that counts as none.
STILL = 1e-12
SEED = 20_241

TRAITS = ("source", "lang", "topic")

log = logging.getLogger(__name__)


def tokens_and_topics(data: np.ndarray, offsets: np.ndarray, topics: int = TOPICS) -> tuple[np.ndarray, np.ndarray]:
    """Words and topic class of each text."""
    n = len(offsets) - 1
    start, _, doc = word_bounds(data, offsets)
    words = np.bincount(doc, minlength=n).astype(np.int64)
    lead = np.zeros(n * topics, np.int64)
    if len(start):
        first = data[start].astype(np.int64)
        lead = np.bincount(doc * topics + (first | 32) % topics, minlength=n * topics)
    return words, lead.reshape(n, topics).argmax(axis=1).astype(np.int32)


def with_traits(docs: DataFrame, names: dict[str, str], text_col: str = "text") -> DataFrame:
    """``docs`` with the columns names["tokens"] and names["topic"]."""
    text = free_name(docs, "__text")
    schema = docs.withColumn(names["tokens"], F.lit(0).cast("long")).withColumn(
        names["topic"], F.lit(0).cast("int")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                words, topic = tokens_and_topics(*byte_view(part.column(text)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(words), pa.array(topic)],
                                                 names=[*part.schema.names[:-1], names["tokens"], names["topic"]])

    return docs.withColumn(text, utf8(text_col)).mapInArrow(run, schema)


def _label(c: Column) -> Column:
    """A trait's value as text; null is a value of its own."""
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), c.cast("string")))


def cell_tokens(table: DataFrame, source: str, lang: str, topic: str, tokens: str) -> DataFrame:
    """(source, lang, topic, tokens) per cell, written once."""
    return shared_table(table.select(_label(F.col(source)).alias("source"), _label(F.col(lang)).alias("lang"),
                                     _label(F.col(topic)).alias("topic"), F.col(tokens).alias("n"))
                        .groupBy(*TRAITS).agg(F.sum("n").alias("tokens")), "cells")


def tempered(shares: dict[str, float], temper: float = TEMPER) -> dict[str, float]:
    raised = {k: v ** temper for k, v in shares.items() if v > 0}
    total = sum(raised.values())
    return {k: v / total for k, v in raised.items()} if total else {}


def _ended(off: float, change: float, left: int) -> bool:
    """Whether raking ends with a round whose largest deviation was ``off`` and
    that changed factors by ``change``; logs an end before the targets are met."""
    if off < TOLERANCE:
        return True
    if change < STILL or not left:
        log.warning("raking ended with a marginal share off its target by %.3g of it (%s)", off,
                    "the targets cannot all be met" if change < STILL else "last round")
    return change < STILL


def rake_local(cells: list[tuple[str, str, str, float]], targets: dict[str, dict[str, float]] | None = None,
               temper: float = TEMPER) -> np.ndarray:
    """Factor of each cell, in the order given."""
    w = np.array([c[3] for c in cells], dtype=float)
    if not w.sum():
        return np.ones(len(cells))
    f = np.ones(len(cells))
    marks = []
    for i, trait in enumerate(TRAITS):
        values, code = np.unique([c[i] for c in cells], return_inverse=True)
        share = np.bincount(code, w, minlength=len(values)) / w.sum()
        goal = (targets or {}).get(trait) or tempered(dict(zip(values.tolist(), share.tolist())), temper)
        total = sum(goal.get(v, 0.0) for v in values.tolist())
        marks.append((code, len(values), np.array([goal.get(v, 0.0) for v in values.tolist()]) / (total or 1)))
    for left in reversed(range(MAX_ROUNDS)):
        off, was = 0.0, f
        for code, k, goal in marks:
            have = np.bincount(code, w * f, minlength=k)
            have /= have.sum() or 1
            step = np.where(have > 0, goal / np.maximum(have, 1e-300), 1.0)
            off = max(off, float(np.abs(step[have > 0] - 1).max(initial=0)))
            f = f * step[code]
        some = (w > 0) & (was > 0)
        if _ended(off, float(np.abs(f[some] / was[some] - 1).max(initial=0)), left):
            break
    return f


def rake_spark(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER,
               rounds: int = MAX_ROUNDS) -> DataFrame:
    """The same for any number of cells: (source, lang, topic, tokens, factor)."""
    spark = cells.sparkSession
    goals = {}
    for trait in TRAITS:
        if targets and targets.get(trait):
            g = spark.createDataFrame(list(targets[trait].items()), "value string, goal double")
            g = g.join(cells.select(F.col(trait).alias("value")).distinct(), "value")
        else:
            g = (cells.groupBy(F.col(trait).alias("value")).agg(F.sum("tokens").alias("n")).where("n > 0")
                 .select("value", F.pow(F.col("n").cast("double"), F.lit(temper)).alias("goal")))
        total = g.agg(F.sum("goal")).first()[0] or 1.0
        goals[trait] = shared_table(g.select("value", (F.col("goal") / total).alias("goal")), "goals")
    level = cells.withColumn("factor", F.lit(1.0))
    for left in reversed(range(rounds)):
        level = level.withColumn("was", F.col("factor"))
        deviation = F.lit(0.0)
        for trait in TRAITS:
            have = level.groupBy(trait).agg(F.sum(F.col("tokens") * F.col("factor")).alias("have"))
            total = level.agg(F.sum(F.col("tokens") * F.col("factor"))).first()[0] or 1.0
            step = (have.join(goals[trait].withColumnRenamed("value", trait), trait, "left")
                    .select(trait, F.when(F.col("have") > 0, F.coalesce("goal", F.lit(0.0)) * total / F.col("have"))
                            .otherwise(1.0).alias("step"), (F.col("have") > 0).alias("some")))
            level = level.join(step, trait).withColumn("factor", F.col("factor") * F.col("step"))
            deviation = F.greatest(deviation, F.when(F.col("some"), F.abs(F.col("step") - 1)).otherwise(0.0))
            level = level.withColumn("off", deviation if trait == TRAITS[0] else F.greatest("off", deviation))
            level = shared_table(level.drop("step", "some"), "raked")
            deviation = F.lit(0.0)
        moved = F.when((F.col("tokens") > 0) & (F.col("was") > 0), F.abs(F.col("factor") / F.col("was") - 1))
        off, change = level.agg(F.max("off"), F.max(moved)).first()
        if _ended(off or 0.0, change or 0.0, left):
            break
        level = level.drop("off", "was")
    return level.select(*TRAITS, "tokens", "factor")


def draw(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None,
         temper: float = TEMPER, local_cells: int = LOCAL_CELLS,
         volume: float = VOLUME) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with tokens, topic, weight, probability, sampled and copies
    columns; the second result names them."""
    names = {k: free_name(docs, k) for k in ("tokens", "topic", "weight", "probability", "sampled", "copies")}
    table = shared_table(with_traits(docs, names, text_col), "traits")
    topic = topic_col or names["topic"]
    cells = cell_tokens(table, source_col, lang_col, topic, names["tokens"])
    spark = docs.sparkSession
    n = cells.count()
    if n <= local_cells:
        got = sorted((r["source"], r["lang"], r["topic"], float(r["tokens"])) for r in cells.collect())
        f = rake_local(got, targets, temper)
        raked = spark.createDataFrame([(*c, float(x)) for c, x in zip(got, f)],
                                      "source string, lang string, topic string, tokens double, factor double")
        have, raw = sum(c[3] * x for c, x in zip(got, f)), sum(c[3] for c in got)
        raked = F.broadcast(raked)
    else:
        raked = rake_spark(cells, targets, temper)
        have, raw = raked.agg(F.sum(F.col("tokens") * F.col("factor")), F.sum("tokens")).first()
    scale = volume * float(raw) / float(have) if have else volume
    own = {c: free_name(table, "__" + c) for c in (*TRAITS, "factor")}
    keyed = raked.select(*(F.col(c).alias(n) for c, n in own.items()))
    met = table.join(keyed, (_label(F.col(source_col)) == F.col(own["source"])) & (_label(F.col(lang_col)) == F.col(own["lang"]))
                     & (_label(F.col(topic)) == F.col(own["topic"])))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(id_col), F.col(text_col)), 11) / F.lit(float(1 << 53))
    weight = F.col(names["weight"])
    out = met.withColumn(names["weight"], F.col(own["factor"]) * F.lit(scale))
    out = out.withColumn(names["probability"], F.least(F.lit(1.0), weight)).withColumn(
        names["copies"], F.floor(weight) + (u < weight - F.floor(weight)).cast("long"))
    out = out.withColumn(names["sampled"], F.col(names["copies"]) > 0)
    return out.drop(*own.values()), names


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id", **more) -> DataFrame:
    """One row per document: id, source, lang, topic, tokens, weight,
    probability, sampled, copies."""
    out, names = draw(docs, targets, id_col, **more)
    source, lang = more.get("source_col", "source"), more.get("lang_col", "lang")
    return out.select(F.col(id_col), F.col(source).alias("source"), F.col(lang).alias("lang"),
                      F.col(more.get("topic_col") or names["topic"]).alias("topic"),
                      *(F.col(names[k]).alias(k) for k in ("tokens", "weight", "probability", "sampled", "copies")))


def sample_mixture(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id",
                   **more) -> DataFrame:
    """The drawn documents, all their columns, a row per copy."""
    out, names = draw(docs, targets, id_col, **more)
    copy = free_name(out, "__copy")
    return (out.where(F.col(names["sampled"]))
            .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(names["copies"])))).select(*docs.columns))
