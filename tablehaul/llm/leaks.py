"""Benchmark passages in documents, by common words, latent semantic ranking and common subsequences."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.words import MARKS, mix, slices, span_hashes, word_bounds
from tablehaul.shared import stage

#: Passages searched for in one pass over the documents; dimensions of the latent space.
BLOCK_ITEMS, RANK, OVERSAMPLE, POWERS = 512, 128, 8, 2
#: Passages of fewer words are found where they stand word for word.
MIN_WORDS = 8
#: Words of passages, or of ranges, that are looked at together.
HITS = 1 << 19


def text_words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, word hashes, and at which word each text begins, for runs of rows."""
    for row, data, at in slices(column):
        starts, ends, first = word_bounds(data, at, MARKS)
        yield row, span_hashes(data, starts, ends), first


def _words_of(text: str) -> np.ndarray:
    return next(text_words(pa.array([text])))[1]


def _answer(text: str) -> np.ndarray:
    """The words of the last sentence, or the last five if it has fewer than three."""
    sentences = [s for s in re.split(r"[.!?]+(?:\s+|$)", text) if s.strip()]
    last = _words_of(sentences[-1]) if sentences else np.zeros(0, np.uint64)
    return last if len(last) >= 3 else _words_of(text)[-5:]


def common_subsequence(one: list[int], two: list[int]) -> int:
    """Length of the longest common subsequence, with a bit for each element of ``one``."""
    places: dict[int, int] = {}
    for i, w in enumerate(one):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(one)) - 1
    row = full
    for w in two:
        hit = row & places.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(one) - row.bit_count()


@dataclass
class Passages:
    """A block of benchmark passages: words, vocabulary, weights and latent vectors."""

    items: list[int]
    words: list[list[int]]
    answers: list[list[int]]
    vocabulary: np.ndarray
    short: list[tuple[int, np.ndarray]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    terms: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    latent: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where words stand in the vocabulary, -1 for others."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def window(self, item: int) -> int:
        """The least window size of at least the passage's words; sizes grow by half powers of 2."""
        return math.ceil(2 ** (math.ceil(2 * math.log2(len(self.words[item])) - 1e-9) / 2))


def _gather(rows: list) -> Passages | None:
    every = [(r.item, _words_of(r.text), _answer(r.text)) for r in rows]
    kept = [k for k in every if len(k[1]) >= MIN_WORDS]
    short = [k[:2] for k in every if 0 < len(k[1]) < MIN_WORDS]
    if not kept and not short:
        return None
    vocabulary = np.unique(np.concatenate([k[1] for k in kept])) if kept else np.zeros(0, np.uint64)
    return Passages(
        [k[0] for k in kept], [k[1].tolist() for k in kept], [k[2].tolist() for k in kept], vocabulary, short
    )


def _frequencies(block: Passages):
    """How many documents have each word of the vocabulary; at -1 the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(len(block.vocabulary), np.int64), 0
        for batch in batches:
            for _, hashes, first in text_words(batch.column("text")):
                n = len(first) - 1
                total += n
                place = block.places(hashes)
                key = np.repeat(np.arange(n), np.diff(first)) * len(seen) + place
                key = np.sort(key[place >= 0])
                once = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
                seen += np.bincount(once % len(seen), minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.record_batch(
            [pa.array(np.append(at, -1)), pa.array(np.append(seen[at], total))], names=["at", "n"]
        )

    return run


def _rows(block: Passages, column: pa.Array) -> np.ndarray:
    """TF-IDF of passages over the vocabulary, of length 1."""
    out = np.zeros((len(column), len(block.vocabulary)))
    for row, hashes, first in text_words(column):
        place = block.places(hashes)
        owner = row + np.repeat(np.arange(len(first) - 1), np.diff(first))
        np.add.at(out, (owner[place >= 0], place[place >= 0]), 1)
    out *= block.weights
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)


def _product(block: Passages, basis: np.ndarray, inner: bool):
    """A task's part of A' A basis, or of (A basis)' (A basis); A holds its TF-IDF passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((basis.shape[1] if inner else len(basis), basis.shape[1]))
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = _rows(block, batch.column("text").slice(at, 64))
                seen = rows @ basis
                total += (seen if inner else rows).T @ seen
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["part"])

    return run


def _summed(passages: DataFrame, block: Passages, basis: np.ndarray, inner: bool) -> np.ndarray:
    width = basis.shape[1]
    total = np.zeros((width if inner else len(basis), width))
    parts = passages.mapInArrow(_product(block, basis, inner), "part binary")
    for row in parts.toLocalIterator():
        total += np.frombuffer(row.part).reshape(total.shape)
    return total


def latent_space(passages: DataFrame, block: Passages, rank: int) -> np.ndarray:
    """Right singular vectors of the TF-IDF passages, by a randomised range and power iterations.

    The passages stay in their tasks; the driver gets sums of the size of the basis.
    """
    width = min(rank + OVERSAMPLE, len(block.vocabulary))
    basis = np.random.default_rng(7).standard_normal((len(block.vocabulary), width))
    for _ in range(POWERS):
        basis = np.linalg.qr(_summed(passages, block, basis, inner=False))[0]
    values, turn = np.linalg.eigh(_summed(passages, block, basis, inner=True))
    keep = np.argsort(values)[::-1][: min(rank, len(block.items))]
    return basis @ turn[:, keep[values[keep] > 1e-9]]


def _step(size):
    """How far windows of a size are apart."""
    return np.maximum(1, size // 8)


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """A number for every run of ``size`` words, equal for equal runs."""
    whole = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for i in range(size):
        whole = mix(whole * np.uint64(0xD6E8FEB86659FD93) + words[i : i + len(whole)])
    return whole


def _verbatim(short: list[tuple[int, np.ndarray]]):
    """Finds short passages: text, item and first word of the first place of each in each text."""
    by_size: dict[int, dict[int, list[tuple[int, np.ndarray]]]] = {}
    for item, words in short:
        key = int(_runs(words, len(words))[0])
        by_size.setdefault(len(words), {}).setdefault(key, []).append((item, words))
    keys = {size: np.array(sorted(held), np.uint64) for size, held in by_size.items()}

    def find(hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for size, held in by_size.items():
            whole = _runs(hashes, size)
            own = text[: len(whole)] == text[size - 1 :][: len(whole)]
            seen = set()
            for a in np.flatnonzero(own & np.isin(whole, keys[size])).tolist():
                for item, words in held[int(whole[a])]:
                    if (text[a], item) not in seen and (hashes[a : a + size] == words).all():
                        seen.add((text[a], item))
                        yield int(text[a]), item, int(a - first[text[a]]), size

    return find


def _search(block: Passages, least: float, least_with_answer: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verbatim = _verbatim(block.short)
        bounds = Bounds.of(block, min(least, least_with_answer)) if block.items else None
        terms = np.ascontiguousarray((block.terms * block.weights[:, None]).astype(np.float32)) if bounds else None
        for batch in batches:
            out: list[tuple] = []
            for row, hashes, first in text_words(batch.column("text")):
                out += [(row + t, item, 1.0, True, a, n) for t, item, a, n in verbatim(hashes, first)]
                if bounds is None:
                    continue
                place = block.places(hashes)
                best: dict[tuple[int, int], tuple] = {}
                for t, i, a, b, most in _ranked(block, terms, place, _held(bounds, place, first)):
                    if (t, i) in best and most < best[t, i][0]:
                        continue
                    words = hashes[a:b].tolist()
                    share = common_subsequence(block.words[i], words) / len(block.words[i])
                    answer = block.answers[i]
                    told = common_subsequence(answer, words) == len(answer)
                    if share >= least or share >= least_with_answer and told:
                        found = (share, told, int(a - first[t]), int(b - a))
                        best[t, i] = max(best.get((t, i), found), found)
                out += [(row + t, block.items[i], *f) for (t, i), f in best.items()]
            yield pa.record_batch(
                [
                    batch.column("id").take(pa.array([o[0] for o in out], pa.int64())),
                    pa.array([o[1] for o in out], pa.int64()),
                    pa.array([float(o[2]) for o in out], pa.float64()),
                    pa.array([bool(o[3]) for o in out], pa.bool_()),
                    pa.array([o[4] for o in out], pa.int64()),
                    pa.array([o[5] for o in out], pa.int64()),
                ],
                names=["id", "item", "share", "answered", "first_word", "n_words"],
            )

    return run


@dataclass
class Bounds:
    """What a range of words must hold at least for a passage to be leaked there.

    ``need`` is the least number of common words that the rule accepts. All but a quarter of them
    or more must be among a passage's rarer words, so ``rare`` of the positions of these are asked
    for first; ``heads`` and ``owners`` list the passages of a word that is rarer in them.
    """

    need: np.ndarray
    rare: np.ndarray
    size: np.ndarray
    heads: np.ndarray
    owners: np.ndarray
    pairs: np.ndarray
    times: np.ndarray
    width: int

    @classmethod
    def of(cls, block: Passages, share: float) -> Bounds:
        need, rare, words, owners, pairs, times = [], [], [], [], [], []
        for i, own in enumerate(block.words):
            length = len(own)
            need.append(next((n for n in range(1, length + 1) if n / length >= share), length + 1))
            place, n = np.unique(block.places(np.array(own, np.uint64)), return_counts=True)
            pairs.append(i * len(block.vocabulary) + place)
            times.append(n)
            order = np.argsort(-block.weights[place], kind="stable")
            spare = length - need[-1]
            kept = np.searchsorted(np.cumsum(n[order]), min(spare + -(-need[-1] // 2), length)) + 1
            words.append(place[order[:kept]])
            owners.append(np.full(len(words[-1]), i))
            rare.append(int(n[order[:kept]].sum()) - spare)
        words, owners = np.concatenate(words), np.concatenate(owners)
        order = np.argsort(words, kind="stable")
        heads = np.searchsorted(words[order], np.arange(len(block.vocabulary) + 1))
        size = np.array([block.window(i) for i in range(len(block.items))])
        return cls(
            np.array(need), np.array(rare), size, heads, owners[order].astype(np.uint16 if len(size) < 1 << 16 else int),
            np.concatenate(pairs), np.concatenate(times), len(block.vocabulary),
        )


def _held(bounds: Bounds, place: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Text, passage, start, end and number of common words of the ranges that hold enough of them.

    A range is a window widened by a quarter of its size on both sides. Common words are counted
    without their order, as often as both sides have them: no subsequence is longer, so no range
    is left out that the rule accepts.
    """
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    fan = np.append(np.diff(bounds.heads), 0)[place]
    reach = np.concatenate([[0], np.cumsum(fan)])
    longest, low = int((bounds.size + 2 * (bounds.size // 4)).max()), 0
    while low < len(place):
        high = max(low + 1, int(np.searchsorted(reach, reach[low] + HITS, "right")) - 1)
        stop = min(high + longest, len(place))
        n = fan[low:stop]
        at = np.repeat(np.arange(low, stop), n)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        item = bounds.owners[bounds.heads[place[at]] + nth]
        order = np.argsort(item, kind="stable")
        at, item = at[order], item[order].astype(np.int64)
        yield from _counted(bounds, place, first, *_spans(bounds, text, first, at, item, high))
        low = high


def _spans(bounds, text, first, at, item, high) -> tuple[np.ndarray, ...]:
    """Text, passage and number of the windows whose widened range has enough rare positions."""
    size = bounds.size[item]
    margin, step = size // 4, _step(size)
    far = np.arange(len(at)) + bounds.rare[item] - 1
    some = np.flatnonzero((far < len(at)) & (at < high))
    far = far[some]
    some, far = (x[(item[far] == item[some]) & (text[at[far]] == text[at[some]])] for x in (some, far))
    t, item, size, margin, step = text[at[some]], item[some], size[some], margin[some], step[some]
    begin, end = at[some] - first[t], at[far] - first[t]
    length = first[t + 1] - first[t]
    count = -(-np.maximum(length - size, 0) // step) + 1
    least = np.maximum((end - size - margin) // step + 1, 0)
    most = np.minimum((begin + margin) // step, count - 1)
    n = np.maximum(most - least + 1, 0)
    t, item, number = np.repeat(t, n), np.repeat(item, n), np.repeat(least - np.cumsum(n) + n, n) + np.arange(n.sum())
    order = np.lexsort((number, item, t))
    t, item, number = t[order], item[order], number[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (item[1:] != item[:-1]) | (number[1:] != number[:-1])
    return t[new], item[new], number[new]


def _counted(bounds, place, first, text, item, number) -> Iterator[tuple[np.ndarray, ...]]:
    """Those of these windows whose range has enough common words, as ``_held`` gives them."""
    size = bounds.size[item]
    start = first[text] + number * _step(size)
    a = np.maximum(first[text], start - size // 4)
    b = np.minimum(first[text + 1], start + size + size // 4)
    cut = np.concatenate([[0], np.cumsum(b - a)])
    low = 0
    while low < len(text):
        high = max(low + 1, int(np.searchsorted(cut, cut[low] + HITS, "right")) - 1)
        some, n = slice(low, high), (b - a)[low:high]
        word = place[np.repeat(a[some] - cut[low:high] + cut[low], n) + np.arange(n.sum())]
        owner = np.repeat(np.arange(high - low), n)[word >= 0]
        key, times = np.unique(owner * bounds.width + word[word >= 0], return_counts=True)
        owner, word = np.divmod(key, bounds.width)
        pair = item[some][owner] * bounds.width + word
        at = np.minimum(np.searchsorted(bounds.pairs, pair), len(bounds.pairs) - 1)
        times = np.where(bounds.pairs[at] == pair, np.minimum(times, bounds.times[at]), 0)
        common = np.bincount(owner, times, high - low).astype(np.int64)
        good = np.flatnonzero(common >= bounds.need[item[some]])
        yield tuple(x[some][good] for x in (text, item, a, b)) + (common[good],)
        low = high


def _ranked(block, terms, place, held) -> Iterator[tuple[int, int, int, int, float]]:
    """Ranges of each text and passage by falling latent cosine, and the most their share can be.

    The cosine decides on the order alone: a range is passed over only if its share cannot
    reach the one found before.
    """
    for texts, items, starts, ends, common in held:
        cosine = np.zeros(len(texts))
        for k, (i, a, b) in enumerate(zip(items, starts, ends, strict=True)):
            word = place[a:b]
            latent = terms[word[word >= 0]].sum(axis=0)
            cosine[k] = block.latent[i] @ latent / max(float(np.linalg.norm(latent)), 1e-6)
        for k in np.lexsort((-cosine, items, texts)):
            i = int(items[k])
            yield int(texts[k]), i, int(starts[k]), int(ends[k]), common[k] / len(block.words[i])


def _weigh(texts: DataFrame, part: DataFrame, block: Passages, rank: int) -> None:
    """Weights of the block's words over all documents, and the latent vectors of its passages."""
    counted = texts.mapInArrow(_frequencies(block), "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    seen, total = np.zeros(len(block.vocabulary)), 0
    for at, n in counted.collect():
        if at < 0:
            total = n
        else:
            seen[at] = n
    block.weights = np.log((total + 1) / (seen + 1)) + 1e-3
    block.terms = latent_space(part, block, rank)
    latent = _item_rows(block) @ block.terms
    block.latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-300)


def benchmark_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = 0.8,
    least_with_answer: float = 0.5,
    rank: int = RANK,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Which document holds which benchmark passage: id, item, share, answered, first_word, n_words.

    Words are runs of letters and digits, A-Z lower-cased. Weights are inverse document
    frequencies over all documents. The latent space is a randomised SVD of the TF-IDF
    passages. Windows of every document, of about the passage's length and an eighth of it apart,
    are widened by a quarter on both sides. Those that hold as many of its words, in any order, as
    the rule asks for are mapped into that space and compared with the passage exactly, the
    highest cosine first: it is leaked if ``least`` of its words occur there in order, or
    ``least_with_answer`` of them and all words of its last sentence, which stands for the answer.
    ``share`` is that part, and the best window is returned. Neither the cosine nor the weights
    leave out a window that the rule accepts.

    Passages are searched for in blocks of ``block_items``, each with two reads of the documents,
    so what tasks hold does not grow with the benchmark. A passage of fewer than 8 words is found where all its
    words stand one after the other. Passages without words or id are never found. A null or empty document has none. Documents with a
    null or repeated id are searched like others. Empty tables give no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    passages = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text"))
    passages = passages.where("item is not null and text is not null").distinct()
    blocks = max(1, math.ceil(passages.count() / block_items))
    passages = passages.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    passages = stage(passages, "passages")
    shape = f"{id_col} {kind}, {item_col} long, share double, answered boolean, first_word long, n_words long"
    found = docs.sparkSession.createDataFrame([], shape)
    for number in range(blocks):
        part = passages.where(F.col("block") == number)
        block = _gather(part.collect())
        if block is None:
            continue
        if block.items:
            _weigh(texts, part, block, rank)
        own = texts.mapInArrow(
            _search(block, least, least_with_answer),
            f"id {kind}, item long, share double, answered boolean, first_word long, n_words long",
        ).withColumnsRenamed({"id": id_col, "item": item_col})
        found = own if number == 0 else found.unionByName(own)
    return found


def _item_rows(block: Passages) -> np.ndarray:
    out = np.zeros((len(block.items), len(block.vocabulary)))
    for i, words in enumerate(block.words):
        np.add.at(out[i], block.places(np.array(words, np.uint64)), 1)
    out *= block.weights
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)
