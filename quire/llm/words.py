"""Words of a batch of texts, told apart by their bytes.

Texts lie one after the other as UTF-8; a byte class says which bytes belong to
words (every class here holds all bytes from 0x80 on or none, so characters are
never cut).  Words are numbered within a batch by an exact dictionary, and what
costs time per word (hashes, checksums, library calls) is done per distinct
word.  Memory follows the batch: a batch of one very long text needs about 30
bytes for each of its words besides a few bytes for each of its bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

_BYTE = np.arange(256)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_LETTER = ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122))
#: ``[^\x20\x09-\x0D]``
NOT_SPACE = ~((_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13)))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after A-Z are lower-cased
ALPHANUMERIC = _DIGIT | _LETTER | (_BYTE >= 128)
#: Bytes with A-Z lower-cased.
LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)


def split(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = NOT_SPACE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the bytes of all words without
    what lies between them.  A word ends with its text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), data
    word = member[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1, data[word]


def covered(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which bytes lie in one of the words (in order, none of them empty)."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    return np.cumsum(edge[:-1], dtype=np.int8).view(bool)


def number(start: np.ndarray, end: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(number of every word, the distinct words as binary) of words whose
    bytes lie one after the other in ``packed``."""
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=off[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start),
                                             [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(packed))])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def strong_hashes(distinct: pa.Array, width: int = 1) -> np.ndarray:
    """The first ``width`` (1 or 2) 64-bit columns of the 16-byte BLAKE2 digest
    of each distinct word."""
    digest = b"".join([hashlib.blake2b(w, digest_size=16).digest() for w in distinct.to_pylist()])
    return np.frombuffer(digest, "<u8").reshape(-1, 2)[:, :width]


def counts_per_text(start: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of words of each text."""
    return np.diff(np.searchsorted(start, offsets, side="left"))
