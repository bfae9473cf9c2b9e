"""Vectorised text kernels over Arrow batches.

A batch of texts is held as one byte array and an offsets array. Words are the
runs of bytes outside ``[\\x20\\x09-\\x0D]``; every word becomes a 64-bit hash, so
later steps work on ragged integer arrays and never on one word at a time.
Null texts count as empty. Texts are cut into slabs that stay in a core's cache (a single
longer text is a slab of its own), so memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLAB_BYTES = 512 << 10
WHITE = b" \t\n\x0b\x0c\r"
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_held: dict[int, np.ndarray] = {}


def _powers_of(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; kept up to four slabs' length, made anew beyond."""
    held = _held.get(int(base), np.empty(0, np.uint64))
    if n > len(held):
        held = np.full(1 << max(12, int(n - 1).bit_length()), base, np.uint64)
        held[0] = 1
        np.cumprod(held, out=held)
        if len(held) <= 4 * SLAB_BYTES:
            _held[int(base)] = held
    return held


def powers(n: int) -> np.ndarray:
    """The first n powers of the hash base from the first on, modulo 2**64."""
    return _powers_of(_BASE, n + 1)[1 : n + 1]


def inverse_powers(n: int) -> np.ndarray:
    """The first n powers of the base's inverse, from one on."""
    return _powers_of(_INVERSE, n)[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64) on uint64 values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slabs(data: np.ndarray, offsets: np.ndarray, limit: int = SLAB_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, past the last, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets by text) of the words in the bytes."""
    if len(data) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    white = _IS_WHITE[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = white[:-1]
    edge[offsets[:-1]] = True
    starts = np.flatnonzero(edge[:-1] & ~white)
    edge[1:-1] = white[1:]
    edge[offsets] = True
    ends = np.flatnonzero(edge[1:] & ~white) + 1
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each non-empty span: differences of one running sum, brought back to the span's start."""
    if len(starts) == 0:
        return np.empty(0, np.uint64)
    values = data.astype(np.uint64)
    values += np.uint64(1)
    values *= powers(len(data))
    total = np.cumsum(values)
    held = total[ends - 1]
    after = starts > 0
    held[after] -= total[starts[after] - 1]
    held *= inverse_powers(len(data))[starts]
    return mix(held + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, word offsets by text); lower: A-Z count as a-z."""
    starts, ends, at = word_spans(data, offsets)
    return span_hashes(_LOWER[data] if lower else data, starts, ends), at


def owners(at: np.ndarray) -> np.ndarray:
    """The text of each item, from item offsets by text."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))


def shingle_hashes(words: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of k words within one text, its offsets by text); texts with fewer than k words have none."""
    count = np.maximum(np.diff(at) - k + 1, 0)
    out = np.concatenate(([0], np.cumsum(count)))
    if not out[-1]:
        return np.empty(0, np.uint64), out
    total = words[: len(words) - k + 1] * powers(k)[0]
    for i in range(1, k):
        total += words[i : len(words) - k + 1 + i] * powers(k)[i]
    short = count < np.diff(at)  # windows that would reach into the next text
    if short.any():
        whole = np.zeros(len(total) + 1, np.int64)
        np.add.at(whole, np.minimum(at[:-1][count > 0], len(total)), 1)
        np.add.at(whole, np.minimum((at[:-1] + count)[count > 0], len(total)), -1)
        total = total[np.cumsum(whole[:-1]) > 0]
    return mix(total), out


def to_planes(x: np.ndarray) -> bytes:
    """Whole numbers as byte planes, which compress where high bytes are alike."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    kind = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel()


def sorted_planes(x: np.ndarray) -> bytes:
    return to_planes(np.diff(x, prepend=x.dtype.type(0)))


def from_sorted_planes(data: bytes, kind: str) -> np.ndarray:
    return np.cumsum(from_planes(data, kind), dtype=kind)
