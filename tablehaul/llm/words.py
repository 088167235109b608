"""Words and shingles of many texts at once, as numpy arrays over Arrow buffers."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Longer spans are hashed by a library function, one by one.
_LONG = 256
_LOW = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything between runs of letters, digits and bytes beyond ASCII.
MARKS = np.ones(256, bool)
MARKS[48:58] = MARKS[65:91] = MARKS[97:123] = MARKS[128:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values, sorted."""
    values = np.sort(values)
    first = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        _powers[:] = [
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b), dtype=np.uint64)])
            for b in (_BASE, inverse)
        ]
    return _powers[0], _powers[1]


def slices(
    column: pa.Array, most: int = SLICE_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row offsets of runs of rows; a run has ``most`` bytes or one row.

    A null is an empty text.
    """
    if len(column) == 0:
        return
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, values = column.buffers()
    at = np.frombuffer(ends, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield row, data[at[row] : at[stop]], at[row : stop + 1] - at[row]
        row = stop


def word_bounds(
    data: np.ndarray, at: np.ndarray, space: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and at which word each text begins (and the last ends).

    ``space`` tells for each byte value whether it lies between words.
    """
    word = ~space[data]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    edges = at[(at > 0) & (at < len(data))]
    opens[edges] |= word[edges]
    closes[edges - 1] |= word[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, at)


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True
) -> np.ndarray:
    """64-bit hashes of the byte runs; with ``fold`` A-Z count as a-z.

    Eight bytes at a time are added and mixed in, so that no arithmetic relation between two runs
    survives: hashes of different runs agree by chance only.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    data = _LOWER[data] if fold else data
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) + _BASE)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))
    at = np.flatnonzero((sizes > 0) & (sizes <= _LONG))
    reached = 0
    while len(at):
        piece = eights[starts[at] + reached] & _LOW[np.minimum(sizes[at] - reached, 8)]
        out[at] = mix((out[at] + piece) * _STEP)
        reached += 8
        at = at[sizes[at] > reached]
    for i in np.flatnonzero(sizes > _LONG).tolist():
        out[i] = int.from_bytes(blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128 bits of a library hash of each run of bytes, as two numbers."""
    raw = memoryview(np.ascontiguousarray(data))
    spans = zip(starts.tolist(), ends.tolist(), strict=True)
    found = b"".join([blake2b(raw[s:e], digest_size=16).digest() for s, e in spans])
    return np.frombuffer(found, "<u8").reshape(-1, 2)


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every window of ``size`` bytes. Related windows may agree: good to choose by, not to tell apart by."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    starts = np.arange(max(0, len(data) - size + 1))
    return mix((total[starts + size] - total[starts]) * down[starts] + np.uint64(size))


def shingles(words: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted; a shorter text is one shingle of all its words.

    ``words`` are hashes, ``at`` where each text's words begin.
    """
    rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for i in range(size):
        rolled = mix(rolled * _STEP + words[i : i + len(rolled)])
    found = []
    for first, last in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if last - first >= size:
            found.append(distinct(rolled[first : last - size + 1]))
        elif last > first:
            whole = np.uint64(last - first)
            for w in words[first:last]:
                whole = _fold(whole, w)
            found.append(np.array([whole], np.uint64))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def _fold(whole: np.uint64, word: np.uint64) -> np.uint64:
    return mix(np.array([whole]) * _STEP + np.array([word]))[0]


def text_shingles(data: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    starts, ends, first = word_bounds(data, at)
    return shingles(span_hashes(data, starts, ends), first, size)
