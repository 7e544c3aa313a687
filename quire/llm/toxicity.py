"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Model (numpy, forward and backward written out below):

* character level: a word's characters run through a bidirectional GRU and are
  pooled by attention into a word vector, beside a hashed word embedding;
* word level: the words of a window run through a second bidirectional GRU,
  pooled by attention into one logit;
* document: the largest logit over all overlapping windows (``WINDOW`` words,
  every ``STRIDE`` words) through a fitted slope and offset.

Training is one task over a bounded sample of labelled documents (``MAX_TOXIC``
and ``MAX_CLEAN``, in hash order).  A document's label says that some window is
toxic, so windows are relabelled: after a first pass over all windows of toxic documents
only those near the largest logit of their document count as toxic.

Scoring is one Arrow pass.  A word's vector depends on the word alone, so each
task's worker keeps a bounded table of word vectors, already multiplied with
the word level's input weights.  The model (under 1 MB, a fixed size) travels
in the closure.

Defined results: null and empty texts are one empty window, which pools to a
zero vector, and get the score of its logit; words over ``MAX_CHARS``
characters count as several words, so whole texts are read; repeated rows get
equal scores; without labelled documents of both classes all scores are 0 (or
1, if all are toxic); an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, utf8

WINDOW, STRIDE = 32, 16
MAX_TOXIC, MAX_CLEAN = 600, 1000
MAX_CHARS = 20
CHAR_DIM, WORD_DIM = 10, 8
EMBED_DIM, EMBED_ROWS, CHAR_ROWS = 6, 4096, 512
#: Gradient steps before the first and after every relabelling, windows of a step.
STEPS, BATCH = (100, 70, 70, 70, 70), 192
#: Share of words whose embedding a step leaves out, so that characters count.
DROP = 0.5
#: Word vectors kept by a worker.
TABLE_ROWS = 400_000

f32 = np.float32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


# -- gated recurrent unit -------------------------------------------------------------------
# x: (T, N, 3h) input terms of update gate, reset gate and candidate; mask: (T, N, 1)

def gru(x: np.ndarray, u: np.ndarray, mask: np.ndarray | None, back: bool, keep: list | None = None) -> np.ndarray:
    steps, n, h3 = x.shape
    h = h3 // 3
    state, out = np.zeros((n, h), f32), np.empty((steps, n, h), f32)
    for t in range(steps - 1, -1, -1) if back else range(steps):
        g = state @ u
        zr = x[t, :, :2 * h] + g[:, :2 * h]
        np.clip(zr, -30, 30, out=zr)
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r = zr[:, :h], zr[:, h:]
        c = np.tanh(x[t, :, 2 * h:] + r * g[:, 2 * h:])
        new = c + z * (state - c)
        if mask is not None:
            new = state + mask[t] * (new - state)
        if keep is not None:
            keep.append((t, state, zr, c, g[:, 2 * h:]))
        state = out[t] = new
    return out


def gru_grad(d_out: np.ndarray, u: np.ndarray, mask: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input terms and of the recurrent weights."""
    _, n, h = d_out.shape
    dx, du, carry = np.zeros((*d_out.shape[:2], 3 * h), f32), np.zeros_like(u), np.zeros((n, h), f32)
    for t, state, zr, c, gc in reversed(kept):
        d = (carry + d_out[t])
        new, m = d * mask[t], mask[t]
        z, r = zr[:, :h], zr[:, h:]
        dc = new * (1 - z) * (1 - c * c)
        dz = new * (state - c) * z * (1 - z)
        dr = dc * gc * r * (1 - r)
        dg = np.concatenate([dz, dr, dc * r], axis=1)
        dx[t] = np.concatenate([dz, dr, dc], axis=1)
        du += state.T @ dg
        carry = d * (1 - m) + new * z + dg @ u.T
    return dx, du


def attend(hidden: np.ndarray, v: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Attention pooling over time: pooled vectors and the weights."""
    s = np.where(mask[..., 0] > 0, hidden @ v, f32(-1e9))
    s = np.exp(s - s.max(axis=0)) * mask[..., 0]
    a = (s / np.maximum(s.sum(axis=0), 1e-9)).astype(f32)
    return (a[..., None] * hidden).sum(axis=0), a


def attend_grad(d: np.ndarray, hidden: np.ndarray, v: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    da = (hidden * d).sum(axis=2)
    ds = a * (da - (a * da).sum(axis=0))
    return a[..., None] * d + ds[..., None] * v, (ds[..., None] * hidden).sum(axis=(0, 1))


class BiLayer:
    """Both directions over the same sequences and the pooling."""

    def __init__(self, p: dict[str, np.ndarray], name: str):
        self.p, self.name = p, name

    def forward(self, xf, xb, mask, kept=None):
        kf, kb = ([], []) if kept is not None else (None, None)
        p, n = self.p, self.name
        m = mask if mask is None or not mask.all() else None
        hidden = np.concatenate([gru(xf, p[n + "uf"], m, False, kf), gru(xb, p[n + "ub"], m, True, kb)], axis=2)
        full = np.ones((*hidden.shape[:2], 1), f32) if mask is None else mask
        pooled, a = attend(hidden, p[n + "v"], full)
        if kept is not None:
            kept.append((kf, kb, hidden, a, full))
        return pooled

    def backward(self, d, kept, g):
        kf, kb, hidden, a, mask = kept[-1]
        p, n = self.p, self.name
        dh, g[n + "v"] = attend_grad(d, hidden, p[n + "v"], a)
        h = hidden.shape[2] // 2
        dxf, g[n + "uf"] = gru_grad(dh[..., :h], p[n + "uf"], mask, kf)
        dxb, g[n + "ub"] = gru_grad(dh[..., h:], p[n + "ub"], mask, kb)
        return dxf, dxb


# -- the model ------------------------------------------------------------------------------

def split_words(text: str) -> list[str]:
    words = text.lower().split()
    if any(len(w) > MAX_CHARS for w in words):
        words = [w[i:i + MAX_CHARS] for w in words for i in range(0, len(w), MAX_CHARS)]
    return words


def char_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(characters x words) codes and mask."""
    size = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    flat = np.where(flat < 256, flat, 256 + flat % (CHAR_ROWS - 256))
    codes = np.zeros((int(size.max()), len(words)), np.int64)
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    codes[place, word] = flat
    mask = (np.arange(len(codes))[:, None] < size).astype(f32)[..., None]
    return codes, mask


def embed_rows(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.int64, len(words)) % EMBED_ROWS


class ToxicModel:
    def __init__(self, params: dict[str, np.ndarray], slope: float = 1.0, offset: float = 0.0,
                 constant: float | None = None):
        self.p, self.slope, self.offset, self.constant = params, slope, offset, constant
        self.chars, self.words = BiLayer(params, "c"), BiLayer(params, "w")

    @classmethod
    def fresh(cls, seed: int = 7) -> "ToxicModel":
        r = np.random.default_rng(seed)
        c, w, e = CHAR_DIM, WORD_DIM, EMBED_DIM
        n = lambda *s, k=0.3: (r.standard_normal(s) * k).astype(f32)      # noqa: E731
        return cls({"cf": n(CHAR_ROWS, 3 * c, k=0.5), "cb": n(CHAR_ROWS, 3 * c, k=0.5), "cuf": n(c, 3 * c),
                    "cub": n(c, 3 * c), "cv": n(2 * c), "emb": n(EMBED_ROWS, e, k=0.05),
                    "wf": n(2 * c + e, 3 * w), "wb": n(2 * c + e, 3 * w), "bf": n(3 * w, k=0.0), "bb": n(3 * w, k=0.0),
                    "wuf": n(w, 3 * w), "wub": n(w, 3 * w), "wv": n(2 * w), "o": n(2 * w), "ob": n(1, k=0.0)})

    def word_vectors(self, words: list[str], kept: list | None = None, use: np.ndarray | None = None) -> np.ndarray:
        codes, mask = char_matrix(words)
        pooled = self.chars.forward(self.p["cf"][codes], self.p["cb"][codes], mask, kept)
        rows = embed_rows(words)
        if kept is not None:
            kept.append((codes, rows))
        emb = self.p["emb"][rows]
        return np.concatenate([pooled, emb if use is None else emb * use[:, None]], axis=1)

    def inputs(self, vectors: np.ndarray) -> np.ndarray:
        """Input terms of both directions of the word level."""
        return np.concatenate([vectors @ self.p["wf"] + self.p["bf"], vectors @ self.p["wb"] + self.p["bb"]], axis=1)

    def logits(self, x: np.ndarray, mask: np.ndarray | None, kept: list | None = None) -> np.ndarray:
        h = 3 * WORD_DIM
        pooled = self.words.forward(x[..., :h], x[..., h:], mask, kept)
        if kept is not None:
            kept.append(pooled)
        return pooled @ self.p["o"] + self.p["ob"][0]

    def gradient(self, words: list[str], index: np.ndarray, mask: np.ndarray, y: np.ndarray,
                 weight: np.ndarray, use: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients for windows: ``index`` (T, N) into ``words``;
        ``use`` scales the words' embeddings."""
        p, g, kc, kw = self.p, {}, [], []
        vec = self.word_vectors(words, kc, use)
        z = self.logits(self.inputs(vec)[index], mask, kw)
        q = _sigmoid(np.clip(z, -30, 30))
        total = float(weight.sum())
        loss = float(-(weight * (y * np.log(q + 1e-7) + (1 - y) * np.log(1 - q + 1e-7))).sum() / total)
        dz = (weight * (q - y) / total).astype(f32)
        pooled = kw[1]
        g["o"], g["ob"] = pooled.T @ dz, np.array([dz.sum()], f32)
        dxf, dxb = self.words.backward(dz[:, None] * p["o"], kw[:1], g)
        m = mask
        flat = index.ravel()
        df = np.zeros((len(words), 3 * WORD_DIM), f32)
        db = np.zeros_like(df)
        np.add.at(df, flat, (dxf * m).reshape(-1, df.shape[1]))
        np.add.at(db, flat, (dxb * m).reshape(-1, db.shape[1]))
        g["wf"], g["wb"], g["bf"], g["bb"] = vec.T @ df, vec.T @ db, df.sum(axis=0), db.sum(axis=0)
        dv = df @ p["wf"].T + db @ p["wb"].T
        codes, rows = kc[1]
        c2 = 2 * CHAR_DIM
        g["emb"] = np.zeros_like(p["emb"])
        np.add.at(g["emb"], rows, dv[:, c2:] if use is None else dv[:, c2:] * use[:, None])
        cxf, cxb = self.chars.backward(dv[:, :c2], kc[:1], g)
        cm = kc[0][4]
        for name, d in (("cf", cxf), ("cb", cxb)):
            d = (d * cm).reshape(-1, d.shape[2])
            g[name] = np.stack([np.bincount(codes.ravel(), d[:, k], minlength=CHAR_ROWS) for k in range(d.shape[1])],
                               axis=1).astype(f32)
        return loss, g

    # -- scoring -----------------------------------------------------------------------

    def best_logits(self, texts: list[str], table: "WordTable") -> np.ndarray:
        """Largest window logit of each text."""
        words = [split_words(t) for t in texts]
        numbers = table.numbers([w for ws in words for w in ws])
        size = np.array([len(w) for w in words], np.int64)
        start, owner, length = windows(size)
        out = np.empty(len(start), f32)
        order = np.argsort(-length, kind="stable")
        begin = (np.cumsum(size) - size)[owner] + start
        for at in range(0, len(order), 4096):
            some = order[at:at + 4096]
            n = length[some]
            steps = max(int(n.max()), 1)
            place = np.arange(steps)[:, None]
            inside = place < n
            rows = np.where(inside, begin[some] + place, 0)
            x = table.rows[numbers[rows]] if len(numbers) else np.zeros((steps, len(some), 6 * WORD_DIM), f32)
            out[some] = self.logits(x, None if inside.all() else inside.astype(f32)[..., None])
        firsts = np.searchsorted(owner, np.arange(len(texts)))
        return np.maximum.reduceat(out, firsts) if len(texts) else out

    def score(self, texts: list[str], table: "WordTable") -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        z = self.best_logits(texts, table).astype(float)
        return _sigmoid(np.clip(self.slope * z + self.offset, -30, 30))


def windows(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, text, words) of all overlapping windows; an empty text has one."""
    count = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
    owner = np.repeat(np.arange(len(size)), count)
    start = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    return start, owner, np.minimum(size[owner] - start, WINDOW)


class WordTable:
    """Input terms of the words met so far (bounded)."""

    def __init__(self, model: ToxicModel):
        self.model = model
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, 6 * WORD_DIM), f32)

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self.index) > TABLE_ROWS:
            self.index.clear()
        found = list(map(self.index.get, words))
        if None in found:
            new = sorted({w for w, n in zip(words, found) if n is None}, key=len)
            base = len(self.index)
            if base + len(new) > len(self.rows):
                grown = np.zeros((2 * (base + len(new)), self.rows.shape[1]), f32)
                grown[:base] = self.rows[:base]
                self.rows = grown
            for at in range(0, len(new), 4096):                  # of about the same length
                part = new[at:at + 4096]
                self.rows[base + at: base + at + len(part)] = self.model.inputs(self.model.word_vectors(part))
            self.index.update(zip(new, range(base, base + len(new))))
            found = list(map(self.index.__getitem__, words))
        return np.array(found, dtype=np.int64)


# -- training -------------------------------------------------------------------------------

def train(texts: list[str], labels: list[int], seed: int = 7) -> ToxicModel:
    y = np.array(labels, dtype=f32)
    if not len(y) or y.min() == y.max():
        return ToxicModel({}, constant=float(y[0]) if len(y) else 0.0)
    model, r = ToxicModel.fresh(seed), np.random.default_rng(seed)
    words = [split_words(t) for t in texts]
    size = np.array([len(w) for w in words], np.int64)
    start, owner, length = windows(size)
    target = y[owner]
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    done = 0

    def batch(some: np.ndarray) -> None:
        nonlocal done
        lists = [words[owner[i]][start[i]:start[i] + length[i]] for i in some]
        vocabulary = sorted({w for ws in lists for w in ws} or {"_"}, key=lambda w: (len(w), w))
        number = {w: i for i, w in enumerate(vocabulary)}
        index, mask = np.zeros((WINDOW, len(some)), np.int64), np.zeros((WINDOW, len(some), 1), f32)
        for k, ws in enumerate(lists):
            index[:len(ws), k] = [number[w] for w in ws]
            mask[:len(ws), k] = 1
        t = target[some]
        use = (r.random(len(vocabulary)) >= DROP).astype(f32)
        _, g = model.gradient(vocabulary, index, mask, t, np.ones(len(some), f32), use)
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        done += 1
        rate = 0.012 * min(1.0, done / 20)
        for k, v in g.items():
            v = v * min(1.0, 1.0 / (norm + 1e-9))
            m, s = moment[k]
            m += 0.1 * (v - m)
            s += 0.01 * (v * v - s)
            model.p[k] -= rate * (m / (1 - 0.9 ** done)) / (np.sqrt(s / (1 - 0.99 ** done)) + 1e-6)

    clean = np.flatnonzero(target == 0)
    pools = [np.flatnonzero(target == 1), clean]
    for stage, steps in enumerate(STEPS):
        if stage:
            # toxic windows are those near the largest logit of a toxic text;
            # among the clean ones, those that look most toxic come up as often as the rest
            z = _all_logits(model, words, start, owner, length)
            best = np.full(len(texts), -1e9, f32)
            np.maximum.at(best, owner, z)
            hard = clean[np.argsort(-z[clean], kind="stable")[:max(256, len(clean) // 20)]]
            pools = [np.flatnonzero((target == 1) & (z >= best[owner] - 0.5)), clean, hard]
        for _ in range(steps):
            batch(np.concatenate([r.choice(pool, BATCH // len(pools)) for pool in pools]))
    z = _all_logits(model, words, start, owner, length)
    best = np.full(len(texts), -1e9, f32)
    np.maximum.at(best, owner, z)
    model.slope, model.offset = _calibrate(best.astype(float), y.astype(float))
    return model


def _all_logits(model: ToxicModel, words: list[list[str]], start, owner, length) -> np.ndarray:
    table = WordTable(model)
    numbers = table.numbers([w for ws in words for w in ws])
    size = np.array([len(w) for w in words], np.int64)
    begin = (np.cumsum(size) - size)[owner] + start
    out = np.empty(len(start), f32)
    for at in range(0, len(start), 4096):
        some = np.arange(at, min(at + 4096, len(start)))
        inside = np.arange(WINDOW)[:, None] < length[some]
        rows = np.where(inside, begin[some] + np.arange(WINDOW)[:, None], 0)
        x = table.rows[numbers[rows]] if len(numbers) else np.zeros((WINDOW, len(some), 6 * WORD_DIM), f32)
        out[some] = model.logits(x, inside.astype(f32)[..., None])
    return out


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a one-variable logistic regression."""
    mean, sd = z.mean(), z.std() + 1e-6
    x, a, b = (z - mean) / sd, 1.0, 0.0
    for _ in range(400):
        q = _sigmoid(np.clip(a * x + b, -30, 30))
        a, b = a - 0.5 * (((q - y) * x).mean() + 1e-3 * a), b - 0.5 * (q - y).mean()
    a = max(a, 1e-3)
    return float(a / sd), float(b - a * mean / sd)


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", max_toxic: int = MAX_TOXIC,
                   max_clean: int = MAX_CLEAN) -> DataFrame:
    """(t, y): at most ``max_toxic`` and ``max_clean`` labelled texts that are not held
    out, in hash order of their id."""
    rows = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
            .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"))))
    some = None
    for y, most in ((0, max_clean), (1, max_toxic)):
        part = rows.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(most)
        some = part if some is None else some.union(part)
    met = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("t")).join(F.broadcast(some), "id")
    return met.select("t", "y").limit(max_toxic + max_clean)


def train_in_task(sample: DataFrame) -> ToxicModel:
    """Fit in one task on the bounded sample; a lost executor repeats it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((t.decode("utf-8", "replace"), y) for b in batches
                      for t, y in zip(b.column("t").to_pylist(), b.column("y").to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([pickle.dumps(train([t for t, _ in rows], [y for _, y in rows]))], pa.binary())], names=["model"])

    got = sample.coalesce(1).mapInArrow(run, "model binary").collect()      # no row without a partition
    return pickle.loads(got[0]["model"]) if got else train([], [])


def held_out(id_col) -> "F.Column":
    """Rows kept from training: crc32 of the id as text, modulo 5, is 0."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


_WORKER: dict[int, tuple[bytes, WordTable]] = {}


def score_documents(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    src = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    mark = zlib.crc32(b"".join(v.tobytes() for v in model.p.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quire.llm import toxicity as here                    # the worker's table outlives a task
        if mark not in here._WORKER:
            here._WORKER.clear()
            here._WORKER[mark] = WordTable(model)
        table = here._WORKER[mark]
        for batch in batches:
            for part in text_slices(batch, "text", 2 << 20):
                texts = [t.decode("utf-8", "replace") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(model.score(texts, table).astype(np.float64))], names=["id", "score"])

    return src.mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    model = train_in_task(labelled_texts(docs, labels, id_col, text_col))
    s = score_documents(docs, model, id_col, text_col)
    return s.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                    F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
