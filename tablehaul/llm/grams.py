"""Runs of words as numpy arrays: exact numbers for equal runs, their bytes and their CRCs."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd

#: Longer runs are looked up one by one.
_LONG = 128
_LOW = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


def _crc_table() -> np.ndarray:
    """What each byte value adds to a CRC-32 of the reflected polynomial 0xEDB88320."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different key first stands, and for each key the number of its value, in that order."""
    number, values = pd.factorize(keys)
    first = np.empty(len(values), np.int64)
    first[number[::-1]] = np.arange(len(keys) - 1, -1, -1)
    return first, number


def number_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run of bytes a number, the same for equal runs, and for each number one such run.

    Bytes are compared eight at a time and nothing is hashed, so different runs differ.
    """
    numbers, members, base = np.zeros(len(starts), np.int64), [], 0
    sizes = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))
    parts = np.where(sizes > _LONG, -1, -(-sizes // 8))
    for count in np.unique(parts).tolist():
        at = np.flatnonzero(parts == count)
        if count < 0:
            known: dict[bytes, int] = {}
            spans = zip(starts[at].tolist(), ends[at].tolist(), strict=True)
            own = np.array([known.setdefault(data[s:e].tobytes(), len(known)) for s, e in spans])
        else:
            own = sizes[at]
            for part in range(count):
                left = np.minimum(sizes[at] - 8 * part, 8)
                _, piece = numbered(eights[starts[at] + 8 * part] & _LOW[left])
                _, own = numbered(own * (int(piece.max()) + 1) + piece)
        first, own = numbered(own)
        numbers[at] = base + own
        members.append(at[first])
        base += len(first)
    return numbers, np.concatenate(members) if members else np.zeros(0, np.int64)


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all bytes of the runs, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def joined(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of phrases joined by one space, and where each begins (and the last ends).

    A row of ``words`` has the places of a phrase's words among the runs.
    """
    sizes = (ends - starts)[words]
    whole = sizes.sum(1) + words.shape[1] - 1
    at = np.concatenate([[0], np.cumsum(whole)])
    out = np.full(at[-1], 32, np.uint8)
    begin = at[:-1].copy()
    for i in range(words.shape[1]):
        out[_places(begin, sizes[:, i])] = data[_places(starts[words[:, i]], sizes[:, i])]
        begin += sizes[:, i] + 1
    return out, at


def crc32s(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: bytes = b"") -> np.ndarray:
    """CRC-32 of each run, as if ``before`` stood in front of it.

    Runs of equal length make a matrix of bytes, and all its CRCs go on by one column at a time. A length
    that fewer than eight runs have, and only such a one, goes through the library run by run.
    """
    out = np.zeros(len(starts), np.uint32)
    sizes = ends - starts
    first = zlib.crc32(before)
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for at in np.split(order, cuts) if len(order) else []:
        length = int(sizes[at[0]])
        if len(at) < 8:
            out[at] = [zlib.crc32(data[s : s + length], first) for s in starts[at].tolist()]
            continue
        matrix = data[starts[at][:, None] + np.arange(length)]
        crc = np.full(len(at), ~np.uint32(first), np.uint32)
        for column in matrix.T:
            crc = _CRC[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
        out[at] = ~crc
    return out
