"""Words of Arrow string columns as numpy arrays: spans and 64-bit hashes, no Python strings.

A word is a maximal run of bytes that a byte class admits; both classes used here only
separate at ASCII bytes, so UTF-8 text needs no decoding. Hashes are 64-bit polynomials over
a random byte table, finished by a mixer: equal words always hash alike, different words
collide with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
BLOCK = 1 << 18
CHUNK_BYTES = 1 << 19


def _letters() -> np.ndarray:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return lower


LOWER = _letters()
SPACED = np.ones(256, bool)  # [^\x20\x09-\x0D]+
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=4)
def _powers(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE**i (or its inverse) modulo 2**64 for i < n."""
    size = BLOCK
    while size < n:
        size *= 2
    return _powers(size, pow(BASE, -1, 2**64) if inverse else BASE)[:n]


def spans(data: np.ndarray, docs: np.ndarray, admitted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the first word's number (one more at
    the end). ``docs``: the texts' byte offsets in ``data``; no word crosses a text's end."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(docs), np.int64)
    inside = admitted[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = docs[(docs > 0) & (docs < len(data))]
    first[cut] |= inside[cut]
    last[cut - 1] |= inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, docs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, in blocks of bounded memory."""
    out = np.empty(len(starts), np.uint64)
    codes = BYTE_CODES[LOWER] if lower else BYTE_CODES
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + BLOCK, "right")))
        total = np.zeros(ends[j - 1] - lo + 1, np.uint64)
        np.cumsum(codes[data[lo:ends[j - 1]]] * powers(ends[j - 1] - lo), out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((total[e] - total[s]) * powers(len(total), inverse=True)[s] + (e - s).astype(np.uint64))
        i = j
    return out


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` consecutive word hashes (one for each start)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * U(BASE) + words[k:len(words) - n + 1 + k]
    return mix(out)


def long_run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """As run_hashes, in time that does not grow with ``n``."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(len(words)), out=total[1:])
    return mix((total[n:] - total[:-n]) * powers(len(words) + 1, inverse=True)[:len(words) - n + 1])


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of rows of about ``limit``
    bytes; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of every run, one run after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


def list_array(values: pa.Array, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
