"""Hard negatives, importance resampling and language-model scores against
brute force, on edge cases and on planted structure."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import hard_negatives, interpolation, regular_sampling, resampling

CLASH = "doc_id long, text string, row long, id string, score double, rank int, kind int, block long, words string"


def make(spark, texts, ids=None, parts=3):
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame([(i, t, 1, "x", 0.5, 1, 1, 1, "w") for i, t in zip(ids, texts)], CLASH).repartition(parts)


def some_words(n, seed, size=60):
    r = random.Random(seed)
    return [f"w{int(size * r.random() ** 2)}" for _ in range(n)]


def edge_texts():
    base = " ".join(some_words(300, 2))
    return [None, "", "  \t", "a", "A b", base, base, base.upper(), "q " * 30, "Ünï\tcode\x0bWord Ünï " * 9, "long " * 20_000,
            "x" * 50_000, "\x1c odd \x1f", "a-b_c d.e", *(" ".join(some_words(50, k)) for k in range(8))]


# -- op11 -----------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, row long, block int, kind string, lows string, score int"


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, c, 7, 7, "k", "l", 3) for i, v, c in rows], VECTORS).repartition(parts)


def brute_negatives(rows):
    whole = [(i if i is not None else math.inf, k, np.floor(256 * np.array(v, np.float64)).astype(np.int64), c)
             for k, (i, v, c) in enumerate(rows)
             if c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]

    def dot(a, b):
        n = min(len(a), len(b))
        return int(a[:n] @ b[:n])

    out = []
    for a in whole:
        if a[0] == math.inf or a[0] % 50:
            continue
        ranked = sorted(((-dot(a[2], b[2]), b[0], b) for b in whole if b[1] != a[1]), key=lambda x: x[:2])
        for s, i, p in [x for x in ranked if x[2][3] == a[3]][:5]:
            hard = [(n, ni) for n, ni, b in ranked if b[3] != a[3] and 50 * -s <= 100 * -n <= 95 * -s][:3]
            out += [(a[0], i, r, ni, -s, -n) for r, (n, ni) in enumerate(hard, 1)]
    return sorted((tuple(None if x == math.inf else x for x in r) for r in out), key=str)


def mined(df, **more):
    got = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("blocks", [1, 4])
def test_hard_negatives(spark, blocks):
    r = np.random.default_rng(blocks)
    centres = r.normal(size=(4, 8))
    rows = [(k, [float(x) for x in centres[k % 3] / 3 + r.normal(size=8) / 4], k % 3) for k in range(240)]
    rows += [(300 + k, rows[0][1], k % 2) for k in range(40)]                      # a vector many rows share, ties
    rows += [(400, [0.0] * 8, 0), (450, [0.5], 1), (None, rows[1][1], 1), (350, [], 2), (402, None, 1), (403, rows[1][1], None),
             (500, [float("nan")] * 8, 1), (550, [1.0, None], 1), (600, [float("inf")] * 8, 0)]
    want = brute_negatives(rows)
    assert len(want) > 40 and mined(vectors(spark, rows), blocks=blocks) == want


def test_hard_negatives_repeated_rows_and_empty(spark):
    rows = [(k % 60, [float(k % 7 + 1), 1.0, float(k % 5)], k % 2) for k in range(120)]
    assert mined(vectors(spark, rows), blocks=3) == brute_negatives(rows)
    assert mined(vectors(spark, rows).limit(0)) == []


def test_threshold_stops_early():
    r = np.random.default_rng(1)
    x = np.floor(256 * r.normal(size=(5000, 3)) ** 3).astype(np.int64)
    b = hard_negatives.Block(np.arange(5000), np.arange(5000), np.array(["a"] * 5000, object), x)

    def everything():
        raise AssertionError("the threshold did not stop the scan")
    for i in np.argsort(-np.abs(x).max(axis=1))[:20].tolist():                    # vectors that stand out
        got = b.search(x[i], [(-hard_negatives.NO_ID, hard_negatives.NO_ID)], np.ones(5000, bool), 5, everything)[0]
        assert got[:, 0].tolist() == sorted(range(5000), key=lambda j: (-int(x[j] @ x[i]), j))[:5]


# -- op12 -----------------------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def runs(t, longest):
    w = WORD.findall(lowered(t))
    return len(w), [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute_resample(texts, ids, target, longest=1):
    def bucket(f):
        return zlib.crc32(f.encode()) % 10_000
    docs = [runs(t, longest) for t in texts]
    s, t = Counter(bucket(f) for _, d in docs for f in d), Counter(bucket(f) for x in target for f in runs(x, longest)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for k, (i, (n, d)) in enumerate(zip(ids, docs)):
        w = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
                for b in map(bucket, d))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(d), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[:len(able) * 10 // 100]
    return sorted(((*r[:4], next((p for p, d in enumerate(drawn, 1) if d is r), None)) for r in out), key=str)


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling(spark, longest):
    texts = edge_texts() + [" ".join(some_words(40, 50 + k)) for k in range(200)]
    ids = list(range(len(texts)))
    ids[7], ids[8] = None, 5
    target = [" ".join(some_words(30, 900 + k, 20)) for k in range(9)] + [None, ""]
    got = resampling.resample(make(spark, texts, ids), make(spark, target), longest=longest, ranges=7)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_resample(texts, ids, target, longest)


def test_resampling_empty_tables(spark):
    docs = make(spark, ["a b"] * 3)
    assert resampling.resample(docs.limit(0), docs).count() == 0
    assert {r["rank"] for r in resampling.resample(docs, docs.limit(0), least_words=1, percent=100).collect()} == {1, 2, 3}


def test_resampling_prefers_the_target(spark):
    near, far = [" ".join(some_words(40, k, 30)) for k in range(100)], [" ".join(f"z{w}" for w in some_words(40, k)) for k in range(300)]
    got = resampling.resample(make(spark, near + far), make(spark, [" ".join(some_words(60, 7_000 + k, 30)) for k in range(20)]))
    assert all(r["doc_id"] < 100 for r in got.where("rank is not null").collect())


@pytest.mark.parametrize("ranges", [1, 5, 64])
def test_ranks_by_regular_sampling(spark, ranges):
    r = random.Random(ranges)
    rows = [(r.choice([5, 5, 5, r.randrange(1000)]), r.choice([None, 1, 2, 3, k]), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "score long, id long, row long").repartition(6).persist()
    got = {x["row"]: x["place"] for x in regular_sampling.ranked(df, "score", "id", "row", "place", ranges).collect()}
    want = sorted(rows, key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
    assert got == {row: k for k, (_, _, row) in enumerate(want, 1)}
    df.unpersist()


def test_splitters_part_a_run_evenly():
    keys = [(s, 1, s) for s in range(10_000)]
    runs_ = [sorted(keys[k::4], key=lambda x: -x[0]) for k in range(4)]
    samples = [(*run[i], 32) for run in runs_ for i in range(0, len(run), 32)]
    firsts = [s[0] for s in regular_sampling._splitters(samples, 8)]
    sizes = np.bincount(np.searchsorted(firsts, [-k[0] for k in keys], "right"), minlength=8)
    assert len(firsts) == 7 and sizes.max() < 2 * 10_000 / 8


# -- op13 -----------------------------------------------------------------------------------

SPACE = re.compile(rb"[\x20\x09-\x0D]+")


def brute_scores(texts, ids):
    docs = [[w for w in SPACE.split(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) if w] + [b""] for t in texts]
    fold = [zlib.crc32(str("" if i is None else i).encode()) % 10 for i in ids]

    def counted(folds):
        one, two = Counter(), Counter()
        for d, f in zip(docs, fold):
            if f in folds:
                one.update(d)
                two.update(zip([b"", *d], d))
        return one, two

    def alone(one, w):
        return (one[w] + 0.1) / (sum(one.values()) + 0.1 * (len(one) + 1))

    kept, kept_pairs = counted(range(2, 10))
    events = Counter(e for d, f in zip(docs, fold) if f == 1 for e in zip([b"", *d], d))
    total = sum(kept.values())

    def ratio(u, w):                         # as the operator: in bins of 1/32 of its logarithm
        x = kept_pairs[u, w] / kept[u] / ((kept[w] + 0.1) / (total + 0.1 * (len(kept) + 1)))
        return math.exp((math.floor(math.log(x) * 32) + 0.5) / 32) if x else 0.0
    by = {}
    for (u, w), n in events.items():
        if kept[u]:
            by.setdefault(int(math.log2(kept[u])) + 1, []).append((ratio(u, w), n))

    def em(pairs):
        m = 0.5
        for _ in range(500):
            m = sum(n * m * r / (m * r + 1 - m) for r, n in pairs) / sum(n for _, n in pairs)
        return min(m, 1 - 1e-9)
    pooled = em([x for p in by.values() for x in p]) if by else 0.5
    weight = {b: em(p) for b, p in by.items()}
    one, two = counted(range(1, 10))
    n, out = sum(one.values()), []
    for i, d, f in zip(ids, docs, fold):
        base = sum(math.log10(alone(one, w)) for w in d)
        score = 0.0
        for u, w in zip([b"", *d], d):
            m = weight.get(int(math.log2(one[u])) + 1, pooled) if one[u] else 0.0
            score += math.log10((m * two[u, w] / one[u] if m else 0) + (1 - m) * alone(one, w))
        out.append((i, f == 0, len(d), sum(one[w] > 0 for w in d), n, base, score))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 22, 3000, 40])
def test_lm_scores(spark, block_bytes):
    texts = [t for t in edge_texts() if t is None or len(t) < 60_000] + [" ".join(some_words(80, 70 + k)) for k in range(60)]
    ids = list(range(len(texts)))
    ids[6], ids[9] = None, 4
    got = interpolation.lm_scores(make(spark, texts, ids, 2), block_bytes=block_bytes, group_tokens=2000).collect()
    want = brute_scores(texts, ids)
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[2])), sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[2]))):
        assert tuple(a)[:5] == b[:5]
        assert a["base_score"] == pytest.approx(b[5], rel=1e-9) and a["score"] == pytest.approx(b[6], rel=1e-5)


def test_long_text_is_cut_between_words():
    text = b" " * 2000 + b" ".join(b"w%d" % (k % 977) for k in range(3000)) + b" " + b"y" * 5000 + b" " * 3000 + b"\n end"
    data = np.frombuffer(text, np.uint8)
    seen, sizes = [], []
    for piece, lead, last in interpolation._cuts(data, 700):
        words, seq, _ = interpolation._tokens(piece, np.array([0, len(piece)]), lead, last)
        seen += [words[i] for i in seq[1:]]
        sizes.append(len(piece))
    assert seen == text.split() + [b""] and max(sizes) < 7000


def test_lm_without_training_documents_and_empty(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    got = interpolation.lm_scores(make(spark, ["a b", None, "c"], ids)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got} == {(0, 0, 0.0, 0.0)}
    assert interpolation.lm_scores(make(spark, ["a"]).limit(0)).count() == 0


def test_held_out_texts_gain_from_pairs(spark):
    """On texts with word order, the mixture explains held-out documents better
    than word counts alone, and better than half and half."""
    r = random.Random(5)
    after = {k: [r.randrange(200) for _ in range(4)] for k in range(200)}

    def text():
        w, out = r.randrange(200), []
        for _ in range(120):
            out.append(f"w{w}")
            w = r.choice(after[w]) if r.random() < 0.8 else r.randrange(200)
        return " ".join(out)
    got = interpolation.lm_scores(make(spark, [text() for _ in range(300)])).where("held_out").agg(
        F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert (got[1] - got[0]) / got[2] > 0.5


def test_weights_reach_their_optimum():
    h = np.zeros((interpolation.BUCKETS, interpolation._BINS))
    h[3, 0], h[3, (2 - interpolation._LOW) * interpolation._WIDE] = 30, 70
    ratio = math.exp(2 - 0.5 / interpolation._WIDE)
    m = interpolation.learn(h)[3]

    def likelihood(x):
        return 30 * math.log(1 - x) + 70 * math.log(x * ratio + 1 - x)
    assert likelihood(m) >= max(likelihood(m - 1e-4), likelihood(m + 1e-4))
    assert interpolation.learn(h)[0] == 0 and interpolation.learn(h)[9] == pytest.approx(m)


# -- words that linear hashes confuse (op2, op8, op10) ---------------------------------------

def thue_morse(n):
    """The Thue-Morse word of n letters and its complement: every polynomial
    hash modulo 2**64 gives both the same value from 1,024 letters on."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_are_told_apart_by_their_bytes(spark, n):
    import public_tokenizers
    from tokenizers import Tokenizer

    from quire.llm import packing, substring_dedup, token_files
    one, two = thue_morse(n)
    texts = [" ".join([one] * 13), " ".join([two] * 13), " ".join([one] * 13)]
    docs = make(spark, texts, parts=1)
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.substring_dedup(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 13}
    for path, run, end in ((public_tokenizers.path("word_bpe_49k.json"), packing.pack, 1),
                           (public_tokenizers.path("byte_bpe_50k.json"), token_files.token_round_trip, 0)):
        library = Tokenizer.from_file(path)
        want = {}
        for i, t in enumerate(texts):
            ids = np.array([*library.encode(t, add_special_tokens=False).ids, end], "<u4")
            want[i] = [zlib.crc32(ids[k:k + 4096].tobytes()) for k in range(0, len(ids), 4096)] if end else [zlib.crc32(ids.tobytes())]
        rows = run(docs, path).orderBy(*["doc_id", "piece"][:1 + end]).collect()
        assert [r["ids_crc32"] for r in rows] == [c for i in range(3) for c in want[i]]


# -- clashing names, text ids, empty and null tables -----------------------------------------

CLASHING = ["__source", "__lang", "__topic", "__factor", "__h", "__p", "__s", "__text", "__row", "__copy", "tokens", "weight",
            "score", "host", "path", "topic", "copies", "evidence", "quality_score", "row", "id", "rank"]


def test_stages_take_clashing_names(spark, small_dir):
    """Every filtering stage of the pipeline on documents with columns of the
    operators' internal names."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").limit(60)
    for c in CLASHING:
        docs = docs.withColumn(c, F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, small_dir)
        assert out.columns == docs.columns, name
        assert {r[c] for r in out.select(*CLASHING).collect() for c in CLASHING} <= {"x"}, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small_dir).count() >= 60


def test_stages_take_empty_and_null_tables(spark, small_dir):
    import corpus_pipeline
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    nulls = docs.limit(4).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields])
    for table in (docs.filter("doc_id < -5"), nulls):
        now = table
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, small_dir)
            assert now.count() <= table.count(), name


def test_text_ids(spark):
    import public_tokenizers

    from quire.llm import token_files
    docs = spark.createDataFrame([("b", "x y"), ("a", "x"), (None, "z")], "doc_id string, text string")
    got = token_files.token_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")).orderBy("start").collect()
    assert [(r["doc_id"], r["start"]) for r in got] == [("a", 0), ("b", 2), (None, 5)]
    assert interpolation.lm_scores(docs).count() == 3
    ranks = resampling.resample(docs, docs, least_words=1, percent=100)
    assert sorted(r["rank"] for r in ranks.collect()) == [1, 2, 3]
