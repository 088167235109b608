"""Token ids of many texts at once, by a public tokenizer."""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Iterator
from itertools import chain

import numpy as np

from tablehaul.llm.words import span_hashes, word_bounds

#: White space beyond ASCII, and controls that some take for it: such texts are encoded whole.
_ODD_FIRST = np.zeros(256, bool)
_ODD_FIRST[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_ODD_SPACE = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
#: Pieces whose ids a worker process keeps; beyond that it begins anew.
_KNOWN = 1 << 21
_SOLID = np.zeros(256, bool)
_SOLID[48:58] = _SOLID[65:91] = _SOLID[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True


class Encoder:
    """Encodes texts piece by piece, each different piece once.

    A piece is a run of marks and letters with the ASCII white space before it; it ends before
    white space, and between an ASCII letter or digit and an ASCII mark. No match of the
    tokenizers' patterns goes across such a place, so the ids of the pieces, one after the other,
    are those of the text. ``spaced`` is false for tokenizers that drop white space and lower-case.
    Texts that hold the content of an added token are encoded whole, by the library's default.
    """

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in tokens]
        if any(t.normalized or not t.special for t in tokens):
            self.added = [b""]  # found in other spellings, or also in pieces: all texts are encoded whole
        self.odd = re.compile(b"|".join([_ODD_SPACE.pattern, *map(re.escape, self.added)]))
        self.spaced = spaced
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.filled = 0

    def _ids(self, texts: list[str], whole: bool = False) -> list[list[int]]:
        self.tokenizer.encode_special_tokens = not whole
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of the pieces, and at which of them each text begins."""
        starts, ends, first = word_bounds(data, at)
        inner = np.zeros(len(data) + 1, bool)
        inner[1:-1] = _SOLID[data[:-1]] & _MARK[data[1:]]
        inner[at] = False
        opens, closes = inner.copy(), inner
        opens[starts] = closes[ends] = True
        begin, stop = np.flatnonzero(opens), np.flatnonzero(closes)
        first = np.searchsorted(begin, at)
        if not self.spaced or not len(at):
            return begin, stop, first
        if len(stop):
            before = np.concatenate([[0], stop[:-1]])
            begin = np.maximum(before, np.repeat(at[:-1], np.diff(first)))
            reached = np.where(np.diff(first) > 0, stop[first[1:] - 1], at[:-1])
        else:
            reached = at[:-1]
        tail = np.flatnonzero(reached < at[1:])
        slot = first[1:][tail]
        begin, stop = np.insert(begin, slot, reached[tail]), np.insert(stop, slot, at[1:][tail])
        more = np.zeros(len(at), np.int64)
        more[tail + 1] = 1
        return begin, stop, first + np.cumsum(more)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts, ends) -> np.ndarray:
        """Which of the kept pieces these different ones are."""
        if len(self.known) > _KNOWN:
            self._clear()
        at = np.searchsorted(self.known, hashes)
        fresh = np.ones(len(hashes), bool)
        if len(self.known):
            fresh = self.known[np.minimum(at, len(self.known) - 1)] != hashes
        if fresh.any():
            raw = data.tobytes()
            spans = zip(starts[fresh].tolist(), ends[fresh].tolist(), strict=True)
            found = self._ids([raw[s:e].decode() for s, e in spans])
            sizes = np.array([len(f) for f in found], np.int32)
            total = self.filled + int(sizes.sum())
            if total > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(2 * total, np.uint32)])
            self.ids[self.filled : total] = list(chain.from_iterable(found))
            place = self.filled + np.cumsum(sizes) - sizes
            self.known = np.insert(self.known, at[fresh], hashes[fresh])
            self.place = np.insert(self.place, at[fresh], place)
            self.size = np.insert(self.size, at[fresh], sizes)
            self.filled = total
            at = np.searchsorted(self.known, hashes)
        return at

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin (and the last's end)."""
        starts, ends, first = self._pieces(data, at)
        if len(starts):
            hashes, seen, back = np.unique(
                span_hashes(data, starts, ends, fold=not self.spaced), return_index=True, return_inverse=True
            )
            piece = self._learn(hashes, data, starts[seen], ends[seen])[back]
            begin, size = self.place[piece], self.size[piece]
            reach = np.concatenate([[0], np.cumsum(size)])
            ids = self.ids[np.repeat(begin - reach[:-1], size) + np.arange(reach[-1])]
            edges = reach[first]
        else:
            ids, edges = np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        raw = data.tobytes()
        spaces = _ODD_FIRST[data].any() and _ODD_SPACE.search(raw)
        if not spaces and not any(content in raw for content in self.added):
            return ids, edges
        own = [ids[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            if self.odd.search(raw, a, b):
                own[i] = np.array(self._ids([raw[a:b].decode()], whole=True)[0], np.uint32)
        return np.concatenate(own), np.concatenate([[0], np.cumsum([len(o) for o in own])])


def encoder(path: str, spaced: bool) -> Encoder:
    """The worker process's own encoder, which later tasks find with what it has learnt."""
    kept = sys.modules.setdefault("_tablehaul_encoders", types.ModuleType("_tablehaul_encoders"))
    if (path, spaced) not in kept.__dict__:
        kept.__dict__[path, spaced] = Encoder(path, spaced)
    return kept.__dict__[path, spaced]


def with_end(ids: np.ndarray, edges: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with one more id after each text."""
    return (
        np.insert(ids, edges[1:], np.uint32(end_id)).astype(np.uint32),
        edges + np.arange(len(edges)),
    )


def split(ids: np.ndarray, edges: np.ndarray) -> Iterator[np.ndarray]:
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield ids[a:b]
