"""Substring dedup by recompression.

Words get 64-bit names, from the BLAKE2 digest of their bytes; two recompression rounds then name pairs.  A round
splits all symbols into left and right ones by a bit of the name's hash and
replaces every (left, right) pair by one symbol named after both; equal
neighbours are in the same half, so a run of one token keeps its symbols and
is one name once the distinct keys of a document are taken.  Names are hashes,
so every task gives the same name to the same content without an exchange, and
whether a symbol ends at a place depends on the two words on either side
only: two equal windows have the same interior symbols.

Symbols of the second round cover at most 4 words, so a window of 13 words has
an interior symbol border at least in every 4 places.  Each window takes one
border as its anchor (of those at least 3 words from its ends, the one with
the smallest key), and an anchor's key is the hash of the 6 words around the
border.  Equal windows have equal anchors.  Hence three passes:

1. every document's distinct anchor keys are dealt into buckets; a key that
   two documents have is *shared*.  About two keys for nine words travel.
2. only windows whose anchor is shared are named by 96 bits, mixed from 128
   bits of the BLAKE2 digest of each of their 13 words, and dealt by anchor key;
   the smallest doc id of each window is found.  This verifies the repeats.
3. documents with windows that a smaller id has lose the words of them.

Hot content: a task merges its own slice first.  A key or window that occurs
many times in a slice is one record from there on, and what can be decided in
the slice is decided there.  A task also remembers, in a table of fixed size,
keys it has already told to be shared and the smallest id it has sent for a
window; later slices of the task settle these without a record.  So a passage
that a third of all rows share is about one record per task.  What the table
forgets is sent again, which costs a record and changes no result.  The number
of buckets grows with the input.

Defined results: words are compared unchanged; null and empty texts have no
words and the SHA-256 of the empty string; a null id counts as larger than all
others; equal ids are never smaller than each other, so repeated rows (or two
null ids) do not remove each other's words; windows are judged on the input;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (SPACE, U64, byte_offsets, byte_view, gram_hashes, mix, shared_table, text_slices, utf8,
                     word_bounds, word_names)

WINDOW = 13
#: Words in an anchor's key on each side of its border.
SIDE = 3
ROUNDS = 2
#: Bytes of text whose records make a bucket, about.
BUCKET_BYTES = 32 << 20
SLICE = (2 << 20) - (1 << 16)
#: Places of a task's table of keys or windows met in earlier slices.
MET = 1 << 18
NO_ID = (1 << 63) - 1


def recompress(names: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Word positions where a symbol of the last round starts."""
    start = np.arange(len(names))
    for r in range(rounds):
        if len(start) < 2:
            break
        right = (mix(names, 17 + r) & U64(1)).astype(bool)
        pair = ~right[:-1] & right[1:] & (doc[start[:-1]] == doc[start[1:]])
        with np.errstate(over="ignore"):
            both = mix(names[:-1] * U64(0xD6E8FEB86659FD93) + names[1:], 29 + r)
        names = names.copy()
        names[:-1][pair] = both[pair]
        keep = np.ones(len(start), bool)
        keep[1:] = ~pair
        start, names = start[keep], names[keep]
    return start


def window_anchors(names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window start, anchor key) of every window that lies in one document."""
    n = len(names)
    if n < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    border = recompress(names, doc)
    border = border[(border >= SIDE) & (border + SIDE <= n)]
    key = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    key[border] = gram_hashes(names, border - SIDE, 2 * SIDE) >> U64(1)
    m = n - WINDOW + 1
    best = key[SIDE: SIDE + m].copy()
    for at in range(SIDE + 1, WINDOW - SIDE + 1):
        np.minimum(best, key[at: at + m], out=best)
    whole = np.flatnonzero(doc[:m] == doc[WINDOW - 1:])
    return whole, best[whole]


def _bytes(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def _deal(bucket: np.ndarray, order_key: np.ndarray) -> list[np.ndarray]:
    """Positions of each bucket's records, sorted by key."""
    order = np.lexsort((order_key, bucket))
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    return np.split(order, cuts)


# -- pass 1: shared anchor keys -------------------------------------------------------------

KEY_ROWS = "bucket long, keys binary, refs binary, many binary"


def key_records(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met_key, met_ref, told = np.zeros(MET, np.uint64), np.zeros(MET, np.int64), np.zeros(MET, bool)
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                data, off = byte_view(part.column("text"))
                refs = part.column("ref").to_numpy(zero_copy_only=False).astype(np.int64)
                start, end, doc = word_bounds(data, off)
                at, key = window_anchors(word_names(data, start, end)[:, 0], doc)
                if not len(at):
                    continue
                ref = refs[doc[at]]
                new = np.ones(len(key), bool)          # neighbouring windows often share their anchor
                new[1:] = (key[1:] != key[:-1]) | (ref[1:] != ref[:-1])
                key, ref = key[new], ref[new]
                order = np.lexsort((ref, key))
                key, ref = key[order], ref[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (ref[1:] != ref[:-1])
                key, ref = key[new], ref[new]
                first = np.ones(len(key), bool)
                first[1:] = key[1:] != key[:-1]
                group = np.cumsum(first) - 1
                size = np.bincount(group)
                spot = (mix(key[first], 7) % U64(MET)).astype(np.int64)
                known = met_key[spot] == key[first]
                done = known & told[spot]              # an earlier slice has told that it is shared
                shared = (size > 1) | done | (known & (met_ref[spot] != ref[first]))
                met_key[spot], met_ref[spot], told[spot] = key[first], ref[first], shared
                many = shared[group]
                out = []
                if many.any():                         # shared within the task: known already
                    spread = n_buckets + int(mix(refs[:1].view(np.uint64))[0] % U64(n_buckets))
                    out.append((spread, key[many], ref[many], np.ones(int(many.sum()), np.uint8)))
                key, ref, many = key[first][~done], ref[first][~done], shared[~done]
                bucket = (mix(key, 5) % U64(n_buckets)).astype(np.int64)
                out += [(int(bucket[p[0]]), key[p], ref[p], many[p].astype(np.uint8)) for p in _deal(bucket, key)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), _bytes([o[1] for o in out]),
                     _bytes([o[2] for o in out]), _bytes([o[3] for o in out])],
                    names=["bucket", "keys", "refs", "many"])
    return run


def _joined(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def shared_keys(n_buckets: int):
    def run(table: pa.Table) -> pa.Table:
        key, ref = _joined(table, "keys", np.uint64), _joined(table, "refs", np.int64)
        if table.column("bucket")[0].as_py() < n_buckets:
            many = _joined(table, "many", np.uint8).astype(bool)
            order = np.lexsort((ref, key))
            key, ref, many = key[order], ref[order], many[order]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            group = np.cumsum(first) - 1
            other = np.zeros(len(key), bool)
            other[1:] = ~first[1:] & (ref[1:] != ref[:-1])
            hit = np.bincount(group, other | many) > 0
            # the documents of a "many" record were told in their task
            out = hit[group] & ~many
            key, ref = key[out], ref[out]
        return pa.table({"ref": pa.array(ref), "key": pa.array(key.view(np.int64))})
    return run


# -- pass 2: windows with a shared anchor ---------------------------------------------------

WINDOW_ROWS = "bucket long, names binary, more binary, owner binary, place binary, ids binary, refs binary"
PLACES = "id long, ref long, places binary"


def _places(doc: np.ndarray, place: np.ndarray, ids: np.ndarray, refs: np.ndarray) -> dict[str, list]:
    """Window places per document, as little-endian 32-bit numbers."""
    out: dict[str, list] = {"id": [], "ref": [], "places": []}
    if len(doc):
        order = np.lexsort((place, doc))
        doc, place = doc[order], place[order].astype("<u4")
        cuts = np.flatnonzero(np.diff(doc)) + 1
        firsts = np.concatenate([[0], cuts])
        out["id"], out["ref"] = ids[doc[firsts]].tolist(), refs[doc[firsts]].tolist()
        out["places"] = [p.tobytes() for p in np.split(place, cuts)]
    return out


def window_records(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met_name, met_more = np.zeros(MET, np.uint64), np.zeros(MET, np.uint32)
        met_least = np.full(MET, NO_ID)
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                data, off = byte_view(part.column("text"))
                ids = part.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
                refs = part.column("ref").to_numpy(zero_copy_only=False).astype(np.int64)
                wanted = part.column("keys")
                count = np.diff(np.asarray(wanted.offsets, dtype=np.int64))
                wanted = np.asarray(wanted.flatten()).view(np.uint64)
                start, end, doc = word_bounds(data, off)
                names, others = word_names(data, start, end, 2).T
                at, key = window_anchors(names, doc)
                tag = lambda k, d: mix(k ^ mix(d.astype(np.uint64), 41), 43)     # noqa: E731
                hit = np.isin(tag(key, doc[at]), tag(wanted, np.repeat(np.arange(len(count)), count)))
                at, key = at[hit], key[hit]
                if not len(at):
                    continue
                name = gram_hashes(names, at, WINDOW)
                more = gram_hashes(others, at, WINDOW, 1).astype(np.uint32)
                owner = doc[at]
                head = np.searchsorted(doc, owner, side="left")
                place = (at - head).astype(np.uint32)
                order = np.lexsort((place, ids[owner], more, name))
                name, more, owner, place, key = (x[order] for x in (name, more, owner, place, key))
                first = np.ones(len(name), bool)
                first[1:] = (name[1:] != name[:-1]) | (more[1:] != more[:-1])
                least = ids[owner[first]]
                spot = (mix(name[first], 7) % U64(MET)).astype(np.int64)
                known = (met_name[spot] == name[first]) & (met_more[spot] == more[first])
                least = np.where(known, np.minimum(least, met_least[spot]), least)
                met_name[spot], met_more[spot], met_least[spot] = name[first], more[first], least
                later = ids[owner] > least[np.cumsum(first) - 1]          # decided within the task
                out = []
                none = np.zeros(0)
                if later.any():
                    p = _places(owner[later], place[later], ids, refs)
                    spread = n_buckets + int(mix(refs[:1].view(np.uint64))[0] % U64(n_buckets))
                    out += [(spread, none, none, none, np.frombuffer(b, np.uint8), np.array([i]), np.array([r]))
                            for i, r, b in zip(p["id"], p["ref"], p["places"])]
                # of equal windows in documents of the smallest id, every one must be told later
                stay = np.flatnonzero(~later)
                bucket = (mix(key[stay], 5) % U64(n_buckets)).astype(np.int64)
                for p in _deal(bucket, name[stay]):
                    rows = stay[p]
                    owners, index = np.unique(owner[rows], return_inverse=True)
                    out.append((int(bucket[p[0]]), name[rows], more[rows], index.astype(np.uint32), place[rows],
                                ids[owners], refs[owners]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), *(_bytes([o[k] for o in out]) for k in range(1, 7))],
                    names=["bucket", "names", "more", "owner", "place", "ids", "refs"])
    return run


def later_windows(n_buckets: int):
    def run(table: pa.Table) -> pa.Table:
        ids, refs = _joined(table, "ids", np.int64), _joined(table, "refs", np.int64)
        if table.column("bucket")[0].as_py() >= n_buckets:
            out = {"id": ids.tolist(), "ref": refs.tolist(), "places": table.column("place").to_pylist()}
        else:
            name, more = _joined(table, "names", np.uint64), _joined(table, "more", np.uint32)
            place = _joined(table, "place", np.uint32)
            sizes = np.array([len(b) // 4 for b in table.column("owner").to_pylist()])
            docs = np.array([len(b) // 8 for b in table.column("ids").to_pylist()])
            owner = _joined(table, "owner", np.uint32).astype(np.int64) + np.repeat(np.cumsum(docs) - docs, sizes)
            order = np.lexsort((ids[owner], more, name))
            name, more, owner, place = name[order], more[order], owner[order], place[order]
            first = np.ones(len(name), bool)
            first[1:] = (name[1:] != name[:-1]) | (more[1:] != more[:-1])
            later = ids[owner] > ids[owner[first]][np.cumsum(first) - 1] if len(name) else first
            out = _places(owner[later], place[later], ids, refs)
        return pa.table({"id": pa.array(out["id"], pa.int64()), "ref": pa.array(out["ref"], pa.int64()),
                         "places": pa.array(out["places"], pa.binary())})
    return run


# -- pass 3: what stays ---------------------------------------------------------------------

def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words_n, removed_n, kept = [], [], []
        places = batch.column("places").to_pylist()
        for text, lists in zip(batch.column("text").to_pylist(), places):
            words = text.split()
            at = np.frombuffer(b"".join(lists), "<u4").astype(np.int64)
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, np.minimum(at + WINDOW, len(words)), -1)
            stays = np.cumsum(edge[:-1]) == 0
            words_n.append(len(words))
            removed_n.append(int(len(words) - stays.sum()))
            kept.append(b" ".join(compress(words, stays.tolist())))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("ref"), pa.array(words_n, pa.int64()), pa.array(removed_n, pa.int64()),
             pa.array(kept, pa.binary())], names=["id", "ref", "n_words", "n_removed", "kept_text"])


def source_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ref, text): ids with null last, the row's content as its name."""
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), utf8(text_col).alias("text"))
    return d.select("id", F.xxhash64("id", "text").alias("ref"), "text")


def changed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ref, n_words, n_removed, kept_text) of the documents that lose words."""
    src = source_rows(docs, id_col, text_col)
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0          # one scalar
    n = max(8, -(-int(size) // BUCKET_BYTES))
    keys = src.select("ref", "text").mapInArrow(key_records(n), KEY_ROWS)
    shared = keys.groupBy("bucket").applyInArrow(shared_keys(n), "ref long, key long")
    wanted = shared.groupBy("ref").agg(F.collect_set("key").alias("keys"))
    # the texts with a shared anchor, once, for passes 2 and 3
    some = shared_table(src.join(wanted, "ref"), "shared-texts")
    found = (some.select("id", "ref", "text", "keys").mapInArrow(window_records(n), WINDOW_ROWS)
             .groupBy("bucket").applyInArrow(later_windows(n), PLACES))
    lists = found.groupBy("id", "ref").agg(F.collect_list("places").alias("places"))
    return (some.select("id", "ref", "text").join(lists, ["id", "ref"])
            .mapInArrow(_kept, "id long, ref long, n_words long, n_removed long, kept_text binary"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256."""
    changed = (changed_documents(docs, id_col, text_col)
               .select("id", "ref", F.col("n_removed").alias("gone"), F.sha2("kept_text", 256).alias("sha"))
               .dropDuplicates(["id", "ref"]))
    text = F.trim(F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), SPACE, " "))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    whole = docs.select(F.col(id_col).alias("doc"), key.alias("id"), F.xxhash64(key, utf8(text_col)).alias("ref"),
                        text.alias("t"))
    whole = whole.select(
        "doc", "id", "ref", F.sha2("t", 256).alias("all_sha"),
        F.when(F.col("t") == "", F.lit(0)).otherwise(
            F.length("t") - F.length(F.replace(F.col("t"), F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"))
    return whole.join(changed, ["id", "ref"], "left").select(
        F.col("doc").alias(id_col), "n_words", F.coalesce("gone", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("sha", "all_sha").alias("kept_sha256"))
