"""Language-model scores by deleted interpolation (op13).

A text is its words (A-Z lower-cased, split at ASCII white space) and one end
token; the end also stands before the first word.  The model mixes two
maximum-likelihood estimates, of a word after its left neighbour and of the word
alone (the latter with 0.1 added per type, which leaves room for new words):

    P(w | u) = m * c(u w) / c(u)  +  (1 - m) * (c(w) + 0.1) / (N + 0.1 (V + 1))

where the weight m depends on the bucket of the context's frequency,
floor(log2 c(u)) + 1; unseen contexts have m = 0.

Learning uses the training documents only.  One fold of them is held out of the
counts; its own counts, over buckets and ratios of the two estimates, are what
expectation-maximisation learns the weights from.  Scores then use the counts of
all training documents.

How it runs:

1. Texts become blocks of about ``BLOCK_BYTES``, written once: the block's words
   and its token numbers.  A long text is cut between words into blocks of its
   own that overlap by a word, so memory follows the block, not the text.
2. Every block asks for the words and word pairs that it holds, each once, with
   its own counts: one exchange by hash, groups of bounded size.  A word or
   passage that a third of the corpus shares is one entry per block, so nothing
   is hot.  Each group adds up and answers with the corpus counts, in the order
   asked.  What is gathered grows with the corpus.
3. The blocks of the held-out fold meet their answers and give a histogram of
   bounded size (bucket by ratio bin, bins of 1/32 in the logarithm); the
   weights are learned from it.
4. All blocks meet their answers; a document's score is the sum over its pieces.

Words are compared by their bytes.  Pairs are named by 64 bits mixed from the
BLAKE2 digests of both words: two pairs of a corpus of n pairs share a name with
a chance below n*n / 2**65, which would add up their two counts in ``score``;
n_known, train_tokens and base_score never depend on a hash.

A null text counts as empty: one end token.  A null id counts as the empty text
for its fold.  Repeated rows are documents of their own.  With no training
documents nothing is known, every base probability is 1 and so is the score's.
An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, byte_view, column_or, mix, shared_table, text_slices, utf8
from .words import LOWER, NOT_SPACE, counts_per_text, number, split, strong_hashes

FOLDS, TEST_FOLD, DELETED_FOLD = 10, 0, 1
ADDED = 0.1
#: Text of a block, and tokens of the corpus per group of the exchange.
BLOCK_BYTES, GROUP_TOKENS = 1 << 22, 1 << 21
#: Ratio bins: 1 / _WIDE in ln(pair estimate / word estimate), and their range.
_WIDE, _LOW, _HIGH = 32, -48, 64
_BINS = (_HIGH - _LOW) * _WIDE + 1
BUCKETS = 64
ROUNDS, STILL = 500, 1e-9
_PAIR, _SPACE = U64(0x9E3779B97F4A7C15), np.array([32], np.uint8)


# -- blobs -------------------------------------------------------------------------------------

def packed(x: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of all of them, compressed."""
    return zlib.compress(x.view(np.uint8).reshape(len(x), -1).T.tobytes(), 1)


def unpacked(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


# -- blocks ------------------------------------------------------------------------------------

def _cuts(data: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, bool, bool]]:
    """A long text in pieces of about ``size`` bytes, cut at white space:
    (bytes, whether they start with the last word of what lies before, whether
    they are the last)."""
    at, word = 0, data[:0]
    while True:
        end = at + size
        while end < len(data) and NOT_SPACE[data[end]]:
            step = np.flatnonzero(~NOT_SPACE[data[end:end + size]])
            end = end + int(step[0]) if len(step) else end + size
        end = min(end, len(data))
        yield np.concatenate([word, _SPACE, data[at:end]]), len(word) > 0, end == len(data)
        if end == len(data):
            return
        start, stop, _ = split(data[at:end], np.array([0, end - at]))
        if len(start):
            word = data[at + start[-1]:at + stop[-1]]
        at = end


def _tokens(data: np.ndarray, offsets: np.ndarray, lead: bool, last: bool
            ) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words of the block, numbers of its tokens, how many each text has).  A
    text's first number is the left neighbour of its first token: the end token
    (number 0), or with ``lead`` its first word."""
    data = LOWER[data]
    start, end, joined = split(data, offsets)
    n = counts_per_text(start, offsets)
    code, distinct = number(start, end, joined)
    often = np.argsort(-np.bincount(code, minlength=len(distinct)), kind="stable")
    place = np.empty(len(often), np.int64)
    place[often] = np.arange(1, len(often) + 1)
    seq = place[code]
    ends = np.cumsum(n)
    heads, tails = int(not lead), int(last)
    seq = np.insert(seq, np.concatenate([ends[:0]] + [ends - n] * heads + [ends] * tails), 0)
    return [b"", *distinct.take(pa.array(often)).to_pylist()], seq, n + heads + tails


def token_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """The corpus as blocks: (block, held, ids, rows, folds, sizes, words, tokens, train)."""
    text_of = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"),
                      (F.crc32(text_of.cast("binary")) % FOLDS).cast("int").alias("fold"), utf8(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, waiting, waits = 0, {True: [], False: []}, {True: 0, False: 0}

        def block(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, held: bool, lead: bool = False,
                  last: bool = True) -> pa.RecordBatch:
            nonlocal made
            words, seq, sizes = _tokens(data, offsets, lead, last)
            folds = column_or(part, "fold").to_numpy()
            train = int((sizes - 1)[folds != TEST_FOLD].sum())
            rows = column_or(part, "row")
            made += 1
            one = [pa.array([(rows[0].as_py() >> 33 << 33) + made]), pa.array([held])]
            for col in (column_or(part, "id"), rows, column_or(part, "fold"), pa.array(sizes.astype(np.int32))):
                one.append(pa.ListArray.from_arrays(pa.array([0, len(col)], pa.int32()), col))
            one += [pa.array([zlib.compress(b" ".join(words), 1)], pa.binary()),
                    pa.array([packed(seq.astype(np.uint32))], pa.binary()), pa.array([train])]
            return pa.RecordBatch.from_arrays(one, names=["block", "held", "ids", "rows", "folds", "sizes", "words",
                                                          "tokens", "train"])

        def blocks(batch: pa.RecordBatch, held: bool) -> Iterator[pa.RecordBatch]:
            for part in text_slices(batch, "text", block_bytes):
                data, offsets = byte_view(column_or(part, "text"))
                if len(data) <= 2 * block_bytes or part.num_rows > 1:
                    yield block(part, data, offsets, held)
                    continue
                for piece, lead, last in _cuts(data, block_bytes):
                    yield block(part, piece, np.array([0, len(piece)]), held, lead, last)

        for batch in batches:
            fold = column_or(batch, "fold").to_numpy()
            for held in (True, False):
                some = batch.filter(pa.array((fold == DELETED_FOLD) == held))
                if some.num_rows:
                    waiting[held].append(some)
                    waits[held] += len(byte_view(column_or(some, "text"))[0])
                if waits[held] >= block_bytes:
                    yield from blocks(pa.concat_batches(waiting[held]), held)
                    waiting[held], waits[held] = [], 0
        for held in (True, False):
            if waiting[held]:
                yield from blocks(pa.concat_batches(waiting[held]), held)

    return shared_table(src.mapInArrow(run, f"block long, held boolean, ids array<{kind}>, rows array<long>, "
                                            "folds array<int>, sizes array<int>, words binary, tokens binary, train long"),
                        "blocks")


class Events:
    """A block's words and pairs, in the order in which counts are asked for."""

    def __init__(self, words: bytes, tokens: bytes, sizes: np.ndarray):
        self.words = zlib.decompress(words).split(b" ")
        self.seq, self.sizes = unpacked(tokens, np.uint32).astype(np.int64), sizes
        self.scored = np.ones(len(self.seq), bool)
        self.scored[np.cumsum(sizes) - sizes] = False
        at = np.flatnonzero(self.scored)
        name = strong_hashes(pa.array(self.words, pa.binary()))[:, 0]
        n = len(self.words)
        pairs, self.pair = np.unique(self.seq[at - 1] * n + self.seq[at], return_inverse=True)
        self.left, self.right = pairs // n, pairs % n
        pair_name = mix(name[self.left] * _PAIR + name[self.right])
        self.order = {0: np.argsort(name, kind="stable"), 1: np.argsort(pair_name, kind="stable")}
        self.name = {k: x[self.order[k]] for k, x in enumerate((name, pair_name))}


def _group(name: np.ndarray, groups: int) -> np.ndarray:
    """Group of each name; ascending names have ascending groups."""
    return ((name >> U64(32)) * U64(groups) >> U64(32)).astype(np.int64)


def asked(blocks: DataFrame, groups: int) -> DataFrame:
    """(kind, part, block, held, names, counts): what every block asks each
    group; kind 0 names words by their bytes, kind 1 pairs by 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                one = {c: batch.column(i)[r] for i, c in enumerate(batch.schema.names)}
                sizes = np.array(one["sizes"].as_py(), np.int64)
                e = Events(one["words"].as_py(), one["tokens"].as_py(), sizes)
                taught = np.repeat(np.array(one["folds"].as_py()) != TEST_FOLD, sizes)[e.scored]
                own = {0: np.bincount(e.seq[e.scored], taught, len(e.words)),
                       1: np.bincount(e.pair, taught, len(e.left))}
                out = []
                for kind in (0, 1):
                    part = _group(e.name[kind], groups)
                    count = own[kind][e.order[kind]].astype(np.uint32)
                    starts = np.flatnonzero(np.diff(part, prepend=-1))
                    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
                        names = (zlib.compress(b" ".join([e.words[i] for i in e.order[0][lo:hi].tolist()]), 1) if kind == 0
                                 else packed(np.diff(e.name[1][lo:hi], prepend=U64(0))))
                        out.append((kind, int(part[lo]), names, packed(count[lo:hi])))
                n = len(out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()),
                     pa.array([one["block"].as_py()] * n, pa.int64()), pa.array([one["held"].as_py()] * n, pa.bool_()),
                     pa.array([o[2] for o in out], pa.binary()), pa.array([o[3] for o in out], pa.binary())],
                    names=["kind", "part", "block", "held", "names", "counts"])

    return blocks.select("block", "held", "folds", "sizes", "words", "tokens").mapInArrow(
        run, "kind int, part long, block long, held boolean, names binary, counts binary")


def _answer(group: pa.Table) -> pa.Table:
    """Corpus counts of what each block of a group asked for."""
    kind = group.column("kind")[0].as_py()
    held = np.array(group.column("held").to_pylist())
    counts = [unpacked(b, np.uint32) for b in group.column("counts").to_pylist()]
    size = np.array([len(c) for c in counts])
    if kind == 0:
        words = [w for b in group.column("names").to_pylist() for w in zlib.decompress(b).split(b" ")]
        code = pa.array(words, pa.large_binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    else:
        names = np.concatenate([np.cumsum(unpacked(b, np.uint64)) for b in group.column("names").to_pylist()])
        _, code = np.unique(names, return_inverse=True)
    n = int(code.max()) + 1
    count, by_held = np.concatenate(counts), np.repeat(held, size)
    kept = np.bincount(code, np.where(by_held, 0, count), n).astype(np.uint64)
    deleted = np.bincount(code, np.where(by_held, count, 0), n).astype(np.uint64)
    known = [int(((kept + deleted) > 0).sum()), int((kept > 0).sum())] if kind == 0 else [0, 0]
    ends = np.cumsum(size)
    spans = [code[a:b] for a, b in zip((ends - size).tolist(), ends.tolist())]
    first = [1] + [0] * (len(size) - 1)
    return pa.table({"kind": group.column("kind"), "part": group.column("part"), "block": group.column("block"),
                     "held": group.column("held"), "kept": pa.array([packed(kept[s]) for s in spans], pa.binary()),
                     "deleted": pa.array([packed(deleted[s]) for s in spans], pa.binary()),
                     "types": pa.array([f * known[0] for f in first]), "kept_types": pa.array([f * known[1] for f in first])})


def corpus_counts(blocks: DataFrame, groups: int) -> DataFrame:
    return shared_table(asked(blocks, groups).groupBy("kind", "part").applyInArrow(
        _answer, "kind int, part long, block long, held boolean, kept binary, deleted binary, types long, kept_types long"),
        "counts")


def _answered(block: pa.Table, answers: pa.Table) -> tuple[Events, dict[int, np.ndarray], dict[int, np.ndarray]]:
    """A block's events and, of its words (0) and pairs (1) in their own order,
    the kept and the deleted counts."""
    e = Events(block.column("words")[0].as_py(), block.column("tokens")[0].as_py(),
               np.array(block.column("sizes")[0].as_py(), np.int64))
    rows = sorted(answers.select(["kind", "part", "kept", "deleted"]).to_pylist(), key=lambda r: (r["kind"], r["part"]))
    out = []
    for what in ("kept", "deleted"):
        have = {}
        for kind in (0, 1):
            got = [unpacked(r[what], np.uint64) for r in rows if r["kind"] == kind]
            have[kind] = np.zeros(len(e.order[kind]), float)
            have[kind][e.order[kind]] = np.concatenate(got) if got else 0
        out.append(have)
    return e, out[0], out[1]


# -- the mixture -------------------------------------------------------------------------------

def buckets_of(context: np.ndarray) -> np.ndarray:
    """Bucket of a context's frequency; 0 if it was never seen."""
    return np.frexp(context)[1]


def word_estimate(count: np.ndarray, tokens: float, types: float) -> np.ndarray:
    return (count + ADDED) / (tokens + ADDED * (types + 1))


def learn(histogram: np.ndarray) -> np.ndarray:
    """Weight of the pair estimate per bucket, by expectation-maximisation on
    held-out counts (``BUCKETS`` x ``_BINS``, bin 0: pair never seen)."""
    ratio = np.exp((np.arange(_BINS) - 0.5) / _WIDE + _LOW)
    ratio[0] = 0

    def one(n: np.ndarray) -> float:
        m = 0.5
        for _ in range(ROUNDS):
            was, m = m, float((n * m * ratio / (m * ratio + 1 - m)).sum() / n.sum())
            m = min(m, 1 - 1e-9)
            if abs(m - was) < STILL:
                break
        return m

    seen = histogram[1:]
    pooled = one(seen.sum(axis=0)) if seen.sum() else 0.5
    return np.array([0.0] + [one(n) if n.sum() else pooled for n in seen])


def _histogram(blocks: DataFrame, counts: DataFrame, tokens: int, types: int) -> np.ndarray:
    """Held-out events by bucket and ratio bin, estimates from kept counts."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table({"bucket": pa.array([], pa.int32()), "bin": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
        e, kept, _ = _answered(block, answers)
        context = kept[0][e.left]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.log(kept[1] / context / word_estimate(kept[0][e.right], tokens, types))
        held = np.bincount(e.pair, minlength=len(context))
        at = np.clip(np.nan_to_num((ratio - _LOW) * _WIDE, nan=-1, neginf=-1), -1, _BINS - 2).astype(np.int64) + 1
        n = np.bincount(buckets_of(context) * _BINS + at, held, BUCKETS * _BINS).astype(np.int64)
        met = np.flatnonzero(n)
        return pa.table({"bucket": pa.array((met // _BINS).astype(np.int32)), "bin": pa.array((met % _BINS).astype(np.int32)),
                         "n": pa.array(n[met])})

    held = blocks.where("held").select("block", "sizes", "words", "tokens")
    met = held.groupBy("block").cogroup(counts.where("held").select("block", "kind", "part", "kept", "deleted")
                                        .groupBy("block")).applyInArrow(run, "bucket int, bin int, n long")
    out = np.zeros((BUCKETS, _BINS))
    for r in met.groupBy("bucket", "bin").agg(F.sum("n").alias("n")).collect():       # BUCKETS x _BINS rows at most
        out[r["bucket"], r["bin"]] = r["n"]
    return out


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
              group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities of the whole text)."""
    blocks = token_blocks(docs, id_col, text_col, block_bytes)
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)
    total, train, kept_train = (int(x or 0) for x in blocks.agg(
        F.sum(size), F.sum("train"), F.sum(F.when(~F.col("held"), F.col("train")))).first())
    counts = corpus_counts(blocks, 1 + total // group_tokens)
    types, kept_types = (int(x or 0) for x in counts.agg(F.sum("types"), F.sum("kept_types")).first())
    weight = learn(_histogram(blocks, counts, kept_train, kept_types))
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    schema = f"row long, id {kind}, fold int, n_tokens long, n_known long, base_score double, score double"

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        e, kept, deleted = _answered(block, answers)
        word, pair = kept[0] + deleted[0], kept[1] + deleted[1]
        alone = word_estimate(word, train, types)
        context = word[e.left]
        m = weight[buckets_of(context)]
        mixed = m * pair / np.maximum(context, 1) + (1 - m) * alone[e.right]
        at = np.repeat(np.arange(len(e.sizes)), e.sizes)[e.scored]
        said, n = e.seq[e.scored], len(e.sizes)
        return pa.table({
            "row": block.column("rows")[0].values, "id": block.column("ids")[0].values, "fold": block.column("folds")[0].values,
            "n_tokens": pa.array(e.sizes - 1), "n_known": pa.array(np.bincount(at, word[said] > 0, n).astype(np.int64)),
            "base_score": pa.array(np.bincount(at, np.log10(alone)[said], n)),
            "score": pa.array(np.bincount(at, np.log10(mixed)[e.pair], n))})

    pieces = blocks.drop("held", "train").groupBy("block").cogroup(
        counts.select("block", "kind", "part", "kept", "deleted").groupBy("block")).applyInArrow(run, schema)
    whole = pieces.groupBy("row").agg(F.first("id").alias("id"), F.first("fold").alias("fold"),
                                      *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    return whole.select(F.col("id").alias(id_col), (F.col("fold") == TEST_FOLD).alias("held_out"), "n_tokens", "n_known",
                        F.lit(train).cast("long").alias("train_tokens"), "base_score", "score")
