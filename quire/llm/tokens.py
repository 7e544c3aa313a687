"""Token ids of whole texts, fast: the tokenizer runs once per distinct piece.

Both vocabularies split a text into pre-tokens before any merge, so a text may
be cut wherever a pre-token is sure to end, and its ids are those of its
pieces in order:

* ``word``: white space is dropped and letter case too, pieces are the words;
* ``byte``: a word takes the one space before it.  A text is cut before a
  single space, and around a single line end, between two characters that are
  surely no white space.  Other white space stays inside a piece.
* both: a text is cut between a Latin letter and an ASCII mark after it.

Pieces are cut with numpy over a whole slice of texts, told apart by their
bytes and looked up in a bounded table per Python worker; the library encodes
the new ones.  Pieces of up to 15 bytes are 128-bit keys as they stand (bytes
and length); longer ones are numbered by an exact dictionary of the slice.
Tests compare with the library's ``encode`` of whole texts.
"""

from __future__ import annotations

import os

import numpy as np
from tokenizers import Tokenizer

from .common import U64, ranges
from .words import covered, number as numbered

# one thread per task; Spark runs the tasks side by side
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bounds of the table of pieces: their number, ids and bytes.  A full table
#: stays as it is, pieces it lacks are encoded for their slice only; after as many
#: of those as it holds it starts anew.
MAX_PIECES, MAX_IDS, MAX_BYTES = 600_000, 5_000_000, 32_000_000
#: Plain words encoded in one text, and such texts in one call.
TOGETHER, AT_ONCE = 500, 16
#: Places of the table of short pieces, and their longest length.
_SLOTS, _SHORT = 1 << 20, 15
NEVER = 1 << 62
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

_BYTE = np.arange(256)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
_LETTER = ((_BYTE | 32) >= 97) & ((_BYTE | 32) <= 122) & (_BYTE < 128)
# no apostrophe (contractions), nothing that the special tokens hold
_MARK = np.isin(_BYTE, [ord(c) for c in "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"])
_SPACE = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
# white space beyond ASCII starts with one of these bytes
_MAYBE = np.isin(_BYTE, [0xC2, 0xE1, 0xE2, 0xE3])
_SURE = ((_BYTE > 32) & (_BYTE < 127)) | (_BYTE >= 128)


def _slots(key: np.ndarray) -> np.ndarray:
    return (key * U64(0x9E3779B97F4A7C15) >> U64(64 - _SLOTS.bit_length() + 1)).astype(np.int64)


class PieceTable:
    """Distinct pieces and their ids."""

    def __init__(self, path: str, kind: str):
        self.tokenizer, self.kind = Tokenizer.from_file(path), kind
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.n, self.used, self.held, self.passing = 0, 0, 0, 0
        self.size, self.at = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        # a direct-mapped front of the dictionary, for short pieces
        self.slot_key, self.slot_number = np.zeros((_SLOTS, 2), np.uint64), np.full(_SLOTS, -1, np.int32)

    # -- cutting -----------------------------------------------------------------------

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every piece."""
        inner = offsets[:-1][np.diff(offsets) > 0]                 # first bytes of texts
        mark = np.zeros(len(data), bool)
        letter = _LETTER[data]
        # two-byte letters from U+00C0 to U+00FF
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        mark[1:] = _MARK[data[1:]] & letter[:-1]
        if self.kind == "word":
            word = ~_SPACE[data]
            first = word.copy()
            first[1:] &= ~word[:-1] | mark[1:]
            first[inner] = word[inner]
            last = word.copy()
            last[:-1] &= ~word[1:] | first[1:]
            return np.flatnonzero(first), np.flatnonzero(last) + 1
        sure = _SURE[data]
        maybe = np.flatnonzero(_MAYBE[data])
        for k in range(3):
            sure[np.minimum(maybe + k, len(data) - 1)] = False
        between = np.zeros(len(data), bool)
        between[1:-1] = sure[:-2] & sure[2:]
        between[inner] = False
        between[offsets[1:][np.diff(offsets) > 0] - 1] = False
        line = between & (data == 10)
        cut = mark | line | (between & (data == 32))
        cut[1:] |= line[:-1]
        cut[inner] = True
        start = np.flatnonzero(cut)
        return start, np.append(start[1:], len(data))

    # -- the table ---------------------------------------------------------------------

    def _encode(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces; plain words go through the library side by side in
        one text, where each is one pre-token and so tells its own ids."""
        out: list[list[int] | None] = [None] * len(pieces)
        if self.kind == "word":
            kinds = [(" ", 1, [i for i, p in enumerate(pieces) if p.isalpha()])]
        else:                                            # a line end between words is a pre-token of its own
            kinds = [("", 1, [i for i, p in enumerate(pieces) if p[0] == " " and p[1:].isalpha()]),
                     ("\n", 2, [i for i, p in enumerate(pieces) if p.isalpha()])]
        for glue, step, plain in kinds:
            groups = [plain[k:k + TOGETHER] for k in range(0, len(plain), TOGETHER)]
            for k in range(0, len(groups), AT_ONCE):
                # not the fast call, which tells no words apart
                encoded = self.tokenizer.encode_batch([glue.join([pieces[i] for i in g]) for g in groups[k:k + AT_ONCE]],
                                                      add_special_tokens=False)
                for g, e in zip(groups[k:k + AT_ONCE], encoded):
                    ids, words = e.ids, np.array(e.word_ids)
                    ends = (np.flatnonzero(words[1:] != words[:-1]) + 1).tolist()
                    if len(ends) + 1 == step * (len(g) - 1) + 1:     # else some word was more than one pre-token
                        for i, lo, hi in zip(g, [0, *ends][::step], [*ends, len(ids)][::step]):
                            out[i] = ids[lo:hi]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def _room(self, name: str, need: int) -> np.ndarray:
        have = getattr(self, name)
        if len(have) < need:
            grown = np.zeros(max(need, 2 * len(have)), have.dtype)
            grown[:len(have)] = have
            setattr(self, name, grown)
        return getattr(self, name)

    def _add(self, pieces: list[bytes]) -> None:
        lists = self._encode([p.decode("utf-8", "replace") for p in pieces])
        sizes = np.array([len(x) for x in lists], np.int64)
        total = int(sizes.sum())
        n = len(pieces)
        self._room("size", self.n + n)[self.n:self.n + n] = sizes
        self._room("at", self.n + n)[self.n:self.n + n] = self.used + np.cumsum(sizes) - sizes
        self._room("ids", self.used + total)[self.used:self.used + total] = np.fromiter(
            (i for x in lists for i in x), np.uint32, total)
        self.numbers.update(zip(pieces, range(self.n, self.n + n)))
        self.n, self.used, self.held = self.n + n, self.used + total, self.held + sum(map(len, pieces))

    def _numbers_of(self, pieces: list[bytes]) -> np.ndarray:
        """Numbers of distinct pieces."""
        new = [p for p in pieces if p not in self.numbers]
        if new:
            self._add(new)
        return np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))

    def _lookup(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, keep: int) -> np.ndarray:
        """Number of every piece; those from ``keep`` on are not to stay."""
        size, number = end - start, np.empty(len(start), np.int64)
        at = np.flatnonzero(size > _SHORT)
        if len(at):
            code, distinct = numbered(start[at], end[at], data[covered(data, start[at], end[at])])
            number[at] = self._numbers_of(distinct.to_pylist())[code]
        at = np.flatnonzero(size <= _SHORT)
        if len(at):
            padded = np.concatenate([data, np.zeros(16, np.uint8)])
            eight = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))       # 8 bytes from any place
            first, n = start[at], size[at]
            low = eight[first] & _MASK[np.minimum(n, 8)]
            high = eight[first + 8] & _MASK[np.maximum(n - 8, 0)] | n.astype(np.uint64) << U64(56)
            slot = _slots(low ^ high * U64(0xC2B2AE3D27D4EB4F))
            held = self.slot_key[slot]
            short = np.where((held[:, 0] == low) & (held[:, 1] == high), self.slot_number[slot], -1).astype(np.int64)
            open_ = np.flatnonzero(short < 0)
            if len(open_):
                order = np.lexsort((low[open_], high[open_]))
                keys = np.stack([low[open_], high[open_]], axis=1)[order]
                new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])
                keys, raw = keys[new], keys[new].astype("<u8").tobytes()
                lengths = (keys[:, 1] >> U64(56)).tolist()
                found = self._numbers_of([raw[16 * i:16 * i + k] for i, k in enumerate(lengths)])
                short[open_[order]] = found[np.cumsum(new) - 1]
                into = slot[open_[order]][new]
                free = np.flatnonzero((self.slot_number[into] < 0) & (found < keep))
                into, one = np.unique(into[free], return_index=True)             # of two keys for one place one stays
                self.slot_key[into], self.slot_number[into] = keys[free[one]], found[free[one]]
            number[at] = short
        return number

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids as unsigned 32-bit, number of ids of each text) of UTF-8
        texts that lie one after the other."""
        full = self.n > MAX_PIECES or self.used > MAX_IDS or self.held > MAX_BYTES
        if full and self.passing > self.n:
            self.clear()
            full = False
        before = self.n, self.used, self.held
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        if self.kind == "word":
            data = _LOWER[data]
        start, end = self._pieces(data, offsets)
        number = self._lookup(data, start, end, before[0] if full else NEVER)
        count = self.size[number]
        ids = self.ids[ranges(self.at[number], count)]
        if full:
            self.passing += self.n - before[0]
            for _ in range(self.n - before[0]):
                self.numbers.popitem()                    # the last ones added
            self.n, self.used, self.held = before
        ends = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(start, offsets, side="left")]
        return ids, np.diff(ends)


_TABLES: dict[tuple[str, str], PieceTable] = {}


def piece_table(path: str, kind: str) -> PieceTable:
    """This worker's table of a vocabulary file; ``kind`` is word or byte."""
    if (path, kind) not in _TABLES:
        _TABLES[path, kind] = PieceTable(path, kind)
    return _TABLES[path, kind]


def with_end(ids: np.ndarray, count: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to every text's ids."""
    out = np.insert(ids, np.cumsum(count), end_id) if len(count) else ids
    return out.astype(np.uint32), count + 1
