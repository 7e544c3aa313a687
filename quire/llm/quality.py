"""Quality classifier: document evidence with hierarchical empirical Bayes.

1. Document classifier: a logistic regression on text statistics of the whole
   text (repetition, letter case, symbols, word lengths), fitted with numpy on
   at most ``MAX_LABELLED`` labelled rows (in hash order of the id).  It gives
   each document a probability of good quality.
2. Site posteriors: grouped aggregation sums the evidence per host and per
   (host, path).  The share of good documents has a beta prior: the global
   mean with a concentration estimated from the spread between hosts (method
   of moments), and a path's prior is its host's posterior.  A site with few
   documents keeps close to the global prior, a large one speaks for itself.
3. A document's score combines its own log odds with the shift of its path's
   posterior against the global mean.

Tables without URLs use their own two levels: ``source`` as host and
``lang`` under it as path.

Defined results: null and empty texts have all statistics zero; null hosts or
paths are sites of their own; repeated rows are judged each; without labelled
rows of both classes every document is kept; an empty table gives an empty
result; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_view, free_name, shared_table, text_slices, utf8, word_bounds, word_codes

MAX_LABELLED = 4000
KEEP_FROM = 0.5
#: Weight of the site shift beside the document's own log odds.
SITE_WEIGHT = 0.5
#: Site tables of up to this many rows are broadcast (under 10 MB).
SITE_ROWS = 100_000

_CLASS = np.zeros(256, np.int64)                    # 0 other, 1 upper case, 2 digit, 3 symbol, 4 lower case, 5 not ASCII
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[ord(c) for c in "!\"#$%&*+/<=>@[\\]^_`{|}~"]] = 3
_CLASS[ord("a"):ord("z") + 1] = 4
_CLASS[128:] = 5
N_FEATURES = 11


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Statistics of each text; shares lie in 0..1."""
    n = len(offsets) - 1
    out = np.zeros((n, N_FEATURES))
    start, end, doc = word_bounds(data, offsets)
    words = np.bincount(doc, minlength=n)
    some = np.maximum(words, 1)
    counts = np.zeros((n, 6))
    owner = np.repeat(np.arange(n), np.diff(offsets))
    if len(owner):
        counts = np.bincount(owner * 6 + _CLASS[data], minlength=6 * n).reshape(n, 6).astype(float)
    letters = np.maximum(counts[:, 1] + counts[:, 4] + counts[:, 5], 1)
    size = np.maximum(counts.sum(axis=1), 1)
    out[:, 0] = counts[:, 1] / letters
    out[:, 1] = counts[:, 2] / size
    out[:, 2] = counts[:, 3] / size
    out[:, 3] = counts[:, 3] / some / 2
    if len(start):
        length = end - start
        out[:, 4] = np.bincount(doc, length, minlength=n) / some / 20
        out[:, 5] = np.bincount(doc, length == 1, minlength=n) / some
        names, _ = word_codes(data, start, end)
        for k, column in ((1, 6), (2, 7)):                       # the word again, one or two words on
            again = (names[k:] == names[:-k]) & (doc[k:] == doc[:-k])
            out[:, column] = np.bincount(doc[k:], again, minlength=n) / some
        order = np.lexsort((names, doc))
        new = np.ones(len(order), bool)
        new[1:] = (names[order][1:] != names[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        out[:, 8] = np.bincount(doc[order], new, minlength=n) / some
        only = _CLASS[data[start]] == 3
        out[:, 9] = np.bincount(doc, only & (length == 1), minlength=n) / some
    out[:, 10] = np.log1p(words) / 10
    return out


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(_expand((x - self.mean) / self.scale) @ self.weights + self.bias, -12, 12)


def _expand(z: np.ndarray) -> np.ndarray:
    z = np.clip(z, -6, 6)
    return np.concatenate([z, z * z], axis=1)


def fit(x: np.ndarray, y: np.ndarray, steps: int = 600, rate: float = 0.3, l2: float = 1e-3) -> QualityModel:
    if not len(y) or y.min() == y.max():
        return QualityModel(np.zeros(2 * N_FEATURES), 12.0, np.zeros(N_FEATURES), np.ones(N_FEATURES))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    f = _expand((x - mean) / scale)
    w, b, vw, vb = np.zeros(f.shape[1]), 0.0, np.zeros(f.shape[1]), 0.0
    for _ in range(steps):
        g = (1 / (1 + np.exp(-np.clip(f @ w + b, -30, 30))) - y) / len(y)
        vw, vb = 0.9 * vw - rate * (f.T @ g + l2 * w), 0.9 * vb - rate * g.sum()
        w, b = w + vw, b + vb
    return QualityModel(w, float(b), mean, scale)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_LABELLED) -> QualityModel:
    """Fit on at most ``max_rows`` labelled documents."""
    some = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
            .where(F.col("id").isNotNull() & F.col("y").isNotNull())
            .orderBy(F.xxhash64("id"), "id", "y").limit(max_rows))
    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text")).join(F.broadcast(some), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                x = text_features(*byte_view(part.column("text")))
                yield pa.RecordBatch.from_arrays([pa.array(list(x)), part.column("y")], names=["x", "y"])

    # repeated rows of an id could be many: the fit takes max_rows of them at most
    got = rows.select("text", "y").mapInArrow(run, "x array<double>, y double").limit(max_rows).collect()
    got.sort(key=lambda r: (r["y"], r["x"]))
    x = np.array([r["x"] for r in got]).reshape(-1, N_FEATURES)
    return fit(x, np.array([r["y"] for r in got]))


def with_evidence(docs: DataFrame, model: QualityModel, out_col: str, text_col: str = "text") -> DataFrame:
    """``docs`` and the document classifier's log odds of good quality."""
    text = free_name(docs, "__text")
    src = docs.withColumn(text, utf8(text_col))
    schema = docs.withColumn(out_col, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                x = text_features(*byte_view(part.column(text)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(model.log_odds(x))], names=[*part.schema.names[:-1], out_col])

    return src.mapInArrow(run, schema)


def _chance(log_odds: str | Column) -> Column:
    return 1 / (1 + F.exp(-(F.col(log_odds) if isinstance(log_odds, str) else log_odds)))


def _log_odds(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def concentration(groups: DataFrame) -> float:
    """Prior strength from the spread of the group means (method of moments):
    the weight of a prior in documents, between 1 and 10000."""
    r = groups.agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.count(F.lit(1)).alias("g"),
                   F.sum(F.col("n") * F.pow(F.col("good") / F.col("n"), F.lit(2))).alias("sq"),
                   F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    if not r["n"] or r["g"] < 2:
        return 10_000.0
    mean = r["good"] / r["n"]
    within = mean * (1 - mean)
    between = (r["sq"] - r["n"] * mean * mean - (r["g"] - 1) * within) / max(r["n"] - r["nn"] / r["n"], 1e-9)
    return float(np.clip(within / between - 1 if between > 1e-9 else 10_000.0, 1.0, 10_000.0))


def site_posteriors(scored: DataFrame, evidence: str, host: Column, path: Column) -> tuple[DataFrame, float]:
    """((host, path) -> shift, global mean): posterior log odds of a site
    against the global mean's."""
    rows = scored.select(host.alias("h"), path.alias("p"), _chance(evidence).alias("c"))
    paths = shared_table(rows.groupBy("h", "p").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("good")), "sites")
    hosts = paths.groupBy("h").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mean = total["good"] / total["n"] if total["n"] else 0.5
    k_host, k_path = concentration(hosts), concentration(paths)
    host_post = hosts.select(F.col("h").alias("hh"), ((F.lit(k_host * mean) + F.col("good"))
                                                      / (F.lit(k_host) + F.col("n"))).alias("host_post"))
    met = paths.join(host_post, paths.h.eqNullSafe(F.col("hh")))
    post = (F.lit(k_path) * F.col("host_post") + F.col("good")) / (F.lit(k_path) + F.col("n"))
    return met.select("h", "p", (_log_odds(post) - _log_odds(F.lit(mean))).alias("shift")), mean


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", path_col: str = "lang") -> tuple[DataFrame, str]:
    """``docs`` with a score column (its name is returned): the probability of
    good quality."""
    evidence, name = free_name(docs, "evidence"), free_name(docs, "quality_score")
    model = train(docs, labels, id_col, text_col)
    table = shared_table(with_evidence(docs, model, evidence, text_col), "evidence")
    return _combined(table, evidence, name, host_col, path_col), name


def _combined(table: DataFrame, evidence: str, name: str, host_col: str, path_col: str) -> DataFrame:
    sites, _ = site_posteriors(table, evidence, F.col(host_col), F.col(path_col))
    h, p, s = (free_name(table, c) for c in ("__h", "__p", "__s"))
    sites = shared_table(sites.select(F.col("h").alias(h), F.col("p").alias(p), F.col("shift").alias(s)), "shifts")
    if sites.count() <= SITE_ROWS:
        sites = F.broadcast(sites)
    met = table.join(sites, table[host_col].eqNullSafe(F.col(h)) & table[path_col].eqNullSafe(F.col(p)), "left")
    total = F.col(evidence) + F.lit(SITE_WEIGHT) * F.coalesce(s, F.lit(0.0))
    return met.withColumn(name, _chance(total)).drop(h, p, s)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """One row per document: id, host, path, doc_log_odds, score, keep."""
    model = train(docs, labels, id_col, text_col)
    few = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(path_col).alias("path"),
                      F.col(text_col).alias("text"))
    table = shared_table(with_evidence(few, model, "doc_log_odds").drop("text"), "evidence")
    out = _combined(table, "doc_log_odds", "score", "host", "path")
    return out.select(F.col("id").alias(id_col), "host", "path", "doc_log_odds", "score",
                      (F.col("score") >= KEEP_FROM).alias("keep"))


def drop_poor(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    scored, name = score(docs, labels, id_col, text_col, host_col, path_col)
    return scored.where(F.col(name) >= KEEP_FROM).select(*docs.columns)
