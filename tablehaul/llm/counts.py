"""Tokens of whole texts, counted without their ids."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.words import slices
from tablehaul.shared import stage

#: Text whose pre-tokens are counted together.
BLOCK_BYTES = 8 << 20
#: Characters that Unicode lists as white space.
_WHITE = " \t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
#: Before the name of an added token, which no other part of a text holds.
_ADDED = "\x00"
#: Most ranges of hashes that pre-tokens are dealt to, a power of two; a range has the terms of some blocks.
MOST_RANGES, BLOCKS_A_RANGE = 1 << 16, 8
_SHAPE = "block long, ids array<{kind}>, sizes array<long>, terms binary, ends binary, which binary, times binary"


class PreTokens:
    """Cuts texts into the library's pre-tokens, each different stretch of text once.

    A tokenizer file that only maps bytes and cuts by the usual pattern never joins a character that is not
    white space to white space behind it, so stretches of white space and what follows are cut by
    themselves. With any other file a stretch is all the text between added tokens.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        how = known.get("pre_tokenizer") or {}
        self.short = (
            how.get("type") == "ByteLevel" and how.get("use_regex", True)
            and not how.get("add_prefix_space") and not known.get("normalizer")
        )
        added = known.get("added_tokens") or []
        if not how or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path}: only files with a pre-tokenizer and plain added tokens")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    def stretches(self, text: str) -> list[str]:
        """The text in parts; an added token is a part of its own, behind its mark."""
        found: list[str] = []
        parts = self.added.split(text) if self.added else [text]
        for i, part in enumerate(parts):
            if i % 2:
                found.append(_ADDED + part)
            elif part:
                found.extend(_CHUNK.findall(part) if self.short else [part])
        return found

    def is_added(self, part: str) -> bool:
        return part.startswith(_ADDED) and self.added is not None and bool(self.added.fullmatch(part[1:]))

    def cut(self, stretch: str) -> list[str]:
        if self.is_added(stretch):
            return [stretch]
        if self.tokenizer.normalizer:
            stretch = self.tokenizer.normalizer.normalize_str(stretch)
        return [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(stretch)]

    def pieces(self, term: str) -> int:
        return 1 if self.is_added(term) else len(self.tokenizer.model.tokenize(term))


def _sums(values: np.ndarray, reach: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[reach])


def _hash(term: str) -> int:
    return zlib.crc32(term.encode())


def _frequencies(cutter: PreTokens, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The different pre-tokens by hash; each text's own, by number in rising order, and how often it has them."""
    known: dict[str, int] = {}
    held, sizes = [], []
    for text in texts:
        own = [known.setdefault(s, len(known)) for s in cutter.stretches(text)]
        held.append(np.array(own, np.int64))
        sizes.append(len(own))
    terms: dict[str, int] = {}
    inner, reach = [], [0]
    for stretch in known:
        inner.extend([terms.setdefault(p, len(terms)) for p in cutter.cut(stretch)])
        reach.append(len(inner))
    order = np.argsort(np.array([_hash(t) for t in terms], np.int64), kind="stable")
    rank = np.empty(len(terms), np.int64)
    rank[order] = np.arange(len(terms))
    inner, reach = rank[np.array(inner, np.int64)], np.array(reach)
    stretch = np.concatenate(held) if held else np.zeros(0, np.int64)
    count = np.diff(reach)[stretch]
    owner = np.repeat(np.repeat(np.arange(len(texts)), sizes), count)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    term = inner[np.repeat(reach[stretch], count) + within]
    pair, times = np.unique(owner * max(1, len(terms)) + term, return_counts=True)
    ends = np.cumsum(np.bincount(pair // max(1, len(terms)), minlength=len(texts)))
    names = list(terms)
    return [names[i] for i in order.tolist()], ends, pair % max(1, len(terms)), times


def _packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes; most are small."""
    values = values.astype("<u4")
    planes = values.view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = pa.decompress(raw[8:], 4 * n, "zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view("<u4")[:, 0].astype(np.int64)


def _packed_texts(texts: list[str]) -> bytes:
    raw = [t.encode() for t in texts]
    sizes = _packed(np.array([len(r) for r in raw], np.int64))
    whole = b"".join(raw)
    head = len(sizes).to_bytes(8, "little") + len(whole).to_bytes(8, "little")
    return head + sizes + pa.compress(whole, "zstd", asbytes=True)


def _unpacked_texts(raw: bytes) -> list[str]:
    head, size = int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:16], "little")
    ends = np.cumsum(_unpacked(raw[16 : 16 + head])).tolist()
    whole = pa.decompress(raw[16 + head :], size, "zstd", asbytes=True)
    return [whole[a:b].decode() for a, b in zip([0, *ends], ends)]


def _blocks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, n = PreTokens(path), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for row, data, at in slices(batch.column("text"), BLOCK_BYTES):
                raw = data.tobytes()
                texts = [raw[a:b].decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                terms, ends, which, times = _frequencies(cutter, texts)
                begin = np.concatenate([[0], ends[:-1]])
                steps = np.diff(which, prepend=0)
                steps[begin[begin < ends]] = which[begin[begin < ends]]
                ids = batch.column("id").slice(row, len(texts))
                packed = [_packed_texts(terms), _packed(ends), _packed(steps), _packed(times)]
                yield pa.record_batch(
                    [
                        pa.array([(part << 33) + n], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                        pa.array([np.diff(at)], pa.list_(pa.int64())),
                        *[pa.array([p], pa.binary()) for p in packed],
                    ],
                    names=["block", "ids", "sizes", "terms", "ends", "which", "times"],
                )
                n += 1

    return run


def _dealt(ranges: int):
    """The terms of each block, cut where the upper bits of their hashes change."""
    shift = 32 - (ranges.bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("terms"), strict=True):
                terms = _unpacked_texts(raw.as_py())
                part = np.array([_hash(t) >> shift for t in terms], np.int64)
                first = np.flatnonzero(np.diff(part, prepend=-1))
                cuts = [*first.tolist(), len(terms)]
                parts = [_packed_texts(terms[a:b]) for a, b in zip(cuts, cuts[1:])]
                yield pa.record_batch(
                    [pa.array(part[first]), pa.array([block] * len(parts), pa.int64()), pa.array(parts, pa.binary())],
                    names=["part", "block", "terms"],
                )

    return run


def _counted(path: str):
    """Pieces of the terms of each range and block. Ranges come one after the other, each term is counted once in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, last, known = PreTokens(path), -1, {}
        for batch in batches:
            counts = []
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("terms"), strict=True):
                if part != last:
                    last, known = part, {}
                own = []
                for term in _unpacked_texts(raw.as_py()):
                    n = known.get(term)
                    if n is None:
                        n = known[term] = cutter.pieces(term)
                    own.append(n)
                counts.append(_packed(np.array(own, np.int64)))
            yield pa.record_batch(
                [batch.column("block"), batch.column("part"), pa.array(counts, pa.binary())],
                names=["block", "part", "counts"],
            )

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            ids, sizes = (batch.column(c)[row].values for c in ("ids", "sizes"))
            ends, steps, times = (_unpacked(batch.column(c)[row].as_py()) for c in ("ends", "which", "times"))
            parts = sorted(batch.column("counts")[row].as_py(), key=lambda p: p["part"])
            pieces = np.concatenate([np.zeros(0, np.int64), *[_unpacked(p["counts"]) for p in parts]])
            reach = np.concatenate([[0], ends])
            which = np.cumsum(steps)
            first = reach[:-1][reach[:-1] < reach[1:]]
            before = np.concatenate([[0], which])[first]
            which -= np.repeat(before, np.diff(np.append(first, len(which))))
            n = _sums(pieces[which] * times, reach)
            yield pa.record_batch([ids, sizes, pa.array(n)], names=["id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens)`` of every document: bytes of UTF-8, and how many ids the library gives.

    ``path`` is a file of the tokenizers library. Ids of begin and end are not counted; an added token
    that a text spells out is one, as the library has it. Each task turns blocks of documents into how
    often each of them has which pre-token. The blocks' pre-tokens meet by ranges of their hashes, where pieces
    are counted once for each different one; the counts come back to the blocks by a join and are
    summed. No ids are made.

    A null or empty text has no bytes and no tokens. Every row is counted by itself, also with a
    null or repeated id; an empty table gives an empty one. Other columns of ``docs`` are not read. A very
    long text is a block of its own. The number of ranges follows that of the blocks, which hold a pre-token once
    however frequent it is.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    blocks = stage(texts.mapInArrow(_blocks(path), _SHAPE.format(kind=kind)), "pretokens")
    ranges = 64
    wanted = min(MOST_RANGES, blocks.count() // BLOCKS_A_RANGE)
    while ranges < wanted:
        ranges *= 2
    dealt = blocks.select("block", "terms").mapInArrow(_dealt(ranges), "part long, block long, terms binary")
    met = dealt.repartition("part").sortWithinPartitions("part")
    counted = met.mapInArrow(_counted(path), "block long, part long, counts binary")
    own = counted.groupBy("block").agg(F.collect_list(F.struct("part", "counts")).alias("counts"))
    nothing = F.array().cast("array<struct<part:bigint,counts:binary>>")
    whole = blocks.drop("terms").join(own, "block", "left").withColumn("counts", F.coalesce("counts", nothing))
    summed = whole.mapInArrow(_summed, f"id {kind}, n_bytes long, n_tokens long")
    return summed.withColumnRenamed("id", id_col)
