"""URL filter: rules first, then logistic regression on hashed character n-grams.

Host and path are cut out with SQL expressions; a fixed, short rule list
decides what it fits (the longest rule wins).  Every other URL is judged by a
logistic regression over hashed character n-grams of host and path (two
namespaces), trained with numpy from a small labelled URL table: at most
``MAX_LABELLED`` rows, taken in the order of a hash of the URL.  The model is
a vector of ``2**HASH_BITS`` weights, a fixed size, and travels in the closure
of the scoring step; scoring is one Arrow pass without a shuffle.

Defined results: a null URL or one without ``://`` has an empty host and path,
fits no rule and is judged by the model on no n-grams (its intercept);
repeated rows are judged each; an empty page table gives an empty result;
without labelled rows of both classes the model answers ``allow``, or the one
class there is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, rule) pairs; a rule is a host and a path prefix.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
#: Bound on the labelled rows that the model is fitted on.
MAX_LABELLED = 4000
NGRAMS = (3, 4, 5)
HASH_BITS = 14

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, path


def apply_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, text in sorted(rules, key=lambda r: len(r[1])):      # the longest is put outermost
        r_host, _, r_path = text.partition("/")
        fits = ((host == r_host) | host.endswith("." + r_host)) & path.startswith("/" + r_path)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def features(host: str, path: str, bits: int = HASH_BITS) -> np.ndarray:
    """Distinct hashed n-grams of host and path."""
    out = set()
    for space, part in ((b"h", host), (b"p", path)):
        if not part:
            continue
        b = b"^" + part.encode() + b"$"
        for n in NGRAMS:
            out.update(zlib.crc32(space + b[i:i + n]) for i in range(len(b) - n + 1))
    mask = (1 << bits) - 1
    return np.fromiter({x & mask for x in out}, dtype=np.int64)


class UrlModel:
    """Logistic regression; probability that a URL is to be blocked."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, host: str, path: str) -> float:
        f = features(host, path)
        z = self.bias + (float(self.weights[f].sum()) / np.sqrt(len(f)) if len(f) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[str, str, bool]], steps: int = 300, rate: float = 1.0, l2: float = 1e-4) -> UrlModel:
    """Full-batch gradient steps with momentum; classes weigh the same."""
    dim = 1 << HASH_BITS
    y = np.array([b for _, _, b in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return UrlModel(np.zeros(dim), 5.0 if len(y) and y[0] else -5.0)
    feats = [features(h, p) for h, p, _ in rows]
    cols = np.concatenate(feats)
    sizes = np.array([len(f) for f in feats])
    at = np.repeat(np.arange(len(rows)), sizes)
    value = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    w, b, vw, vb = np.zeros(dim), 0.0, np.zeros(dim), 0.0
    for _ in range(steps):
        z = np.bincount(at, w[cols] * value, minlength=len(rows)) + b
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        gw = np.bincount(cols, g[at] * value, minlength=dim) + l2 * w
        vw, vb = 0.9 * vw - rate * gw, 0.9 * vb - rate * g.sum()
        w, b = w + vw, b + vb
    return UrlModel(w, float(b))


def labelled_sample(labelled: DataFrame, max_rows: int = MAX_LABELLED) -> list[tuple[str, str, bool]]:
    """At most ``max_rows`` distinct (host, path, block) rows, in hash order."""
    some = (labelled.select("host", "path", "block").dropDuplicates(["host", "path"])
            .orderBy(F.xxhash64("host", "path"), "host", "path").limit(max_rows))
    return [(r["host"], r["path"], bool(r["block"])) for r in some.collect()]


def rule_labels(pages: DataFrame, url_col: str = "url", rules=RULES) -> DataFrame:
    """The labelled URL table that the rules give: (host, path, block)."""
    host, path = host_and_path(F.col(url_col))
    p = pages.select(host.alias("host"), path.alias("path"))
    _, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    return (p.withColumn("verdict", verdict).where(F.col("verdict").isNotNull())
            .select("host", "path", (F.col("verdict") == "block").alias("block")))


def judge(pages: DataFrame, model: UrlModel, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """page id, host, path, rule, verdict and the model's block_score."""
    host, path = host_and_path(F.col(url_col))
    p = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    ruled = p.withColumn("rule", rule).withColumn("ruled", verdict)
    id_type = ruled.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            said = cols.pop("ruled")
            s = [model.score(h, q) for h, q in zip(cols["host"].to_pylist(), cols["path"].to_pylist())]
            cols["verdict"] = pa.array([r if r is not None else "block" if x >= 0.5 else "allow"
                                        for r, x in zip(said.to_pylist(), s)], pa.string())
            cols["block_score"] = pa.array(s, pa.float64())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return ruled.mapInArrow(score, f"`{id_col}` {id_type}, host string, path string, rule string, "
                                   "verdict string, block_score double")


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, id_col: str = "page_id",
                url_col: str = "url", rules=RULES) -> DataFrame:
    """Fit on the labelled table (by default the rules' own) and judge all."""
    labelled = labelled if labelled is not None else rule_labels(pages, url_col, rules)
    return judge(pages, fit(labelled_sample(labelled)), id_col, url_col, rules)
