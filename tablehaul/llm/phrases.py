"""Phrases whose words stand together far more often than their parts do."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehaul.llm.grams import crc32s, joined, number_runs, numbered
from tablehaul.llm.words import slices, word_bounds
from tablehaul.shared import stage

#: Bits of a filter of prefixes, a power of two: 4 MB, whatever the data.
FILTER_BITS = 1 << 25
#: The first frontier reaches as many pairs of each language as are asked for, times this; so does each next one.
WIDER = 4
#: Languages whose rows are sent to every task; with more of them their joins are shuffled.
FEW_LANGS = 10_000
SCALE = 1_000_000
_SLICE_BYTES = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STOP = np.zeros(256, bool)  # between pieces
_STOP[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _STOP.copy()
_GAP[[9, 32]] = True


def _head(lang: str) -> bytes:
    return lang.encode() + b" "


def _bits(raw: bytes, at: np.ndarray) -> np.ndarray:
    byte = np.frombuffer(raw, np.uint8)[at >> 3]
    return (byte >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _grams(size: int, filters: list[Broadcast]):
    """Counts of all phrases of ``size`` words that the filters let through, for each language and slice.

    A phrase counts if the first filter has both its parts of one word less, and, where there are
    three, the second its first part or the third its last part.
    """

    def of(lang: str, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        for _, data, at in slices(texts, _SLICE_BYTES):
            data = _LOWER[data]
            starts, ends, first = word_bounds(data, at, _GAP)
            if len(starts) < size:
                continue
            number, member = number_runs(data, starts, ends)
            piece = np.cumsum(_STOP[data], dtype=np.int32)[starts]
            owner = np.repeat(np.arange(len(at) - 1), np.diff(first))
            run, one = number, member
            for words in range(2, size + 1):
                together = np.ones(len(run) - 1, bool)
                back = words - 1
                together &= (piece[back:] == piece[:-back]) & (owner[back:] == owner[:-back])
                if filters and words == size:
                    text, edge = joined(data, starts, ends, one[:, None] + np.arange(back))
                    code = crc32s(text, edge[:-1], edge[1:], _head(lang)).astype(np.int64) & (FILTER_BITS - 1)
                    held = [_bits(f.value, code) for f in filters]
                    together &= held[0][run[:-1]] & held[0][run[1:]]
                    if len(held) == 3:
                        together &= held[1][run[:-1]] | held[2][run[1:]]
                key = np.where(together, run[:-1] * len(member) + number[back:], -1)
                one, run = numbered(key)
            times = np.bincount(run)
            if size > 1:
                kept = np.zeros(len(one), bool)
                kept[run[together]] = True
                one, times = one[kept], times[kept]
            text, edge = joined(data, starts, ends, one[:, None] + np.arange(size))
            if not len(one):
                continue
            phrase = pa.StringArray.from_buffers(len(one), pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(text))
            yield pa.record_batch(
                [pa.array([lang] * len(one)), phrase, pa.array(times)], names=["lang", "phrase", "f"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang")
            for lang in langs.unique().to_pylist():
                yield from of(lang, batch.column("text").filter(pc.equal(langs, lang)))

    return run


def _count(texts: DataFrame, size: int, filters: list[Broadcast]) -> DataFrame:
    parts = texts.mapInArrow(_grams(size, filters), "lang string, phrase string, f long")
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _filter(phrases: DataFrame) -> Broadcast:
    """A bit for the CRC of each ``(lang, phrase)``; others may share it, which costs counts, not results.

    The bits are put together in tasks, 4 KB at a time; the driver gets FILTER_BITS of them at most.
    """
    code = F.crc32(F.concat_ws(" ", "lang", "phrase").cast("binary")).bitwiseAND(F.lit(FILTER_BITS - 1))
    parts = (
        phrases.select((code + 1).alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    )
    whole = bytearray(FILTER_BITS // 8)
    for part, bits in parts.collect():
        whole[(part - 1) * len(bits) : part * len(bits)] = bits
    return phrases.sparkSession.sparkContext.broadcast(bytes(whole))


def _score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exactly, for counts below 10**15."""
    a, left, right = (f"cast({c} as decimal(16, 0))" for c in (a, left, right))
    return F.expr(f"{a} * {a} * {SCALE}BD div ({left} * {right})")


def _scored_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Each pair with the counts of its words, its score, and ``bound``, which no phrase it begins exceeds."""
    first = words.select("lang", F.col("phrase").alias("one"), F.col("f").alias("l"))
    last = words.select("lang", F.col("phrase").alias("two"), F.col("f").alias("r"))
    cut = pairs.select(
        "lang", "phrase", F.col("f").alias("a"), F.substring_index("phrase", " ", 1).alias("one"),
        F.substring_index("phrase", " ", -1).alias("two"),
    )
    met = cut.join(first, ["lang", "one"]).join(last, ["lang", "two"])
    return met.select("lang", "phrase", "a", "l", "r", _score("a", "l", "r").alias("score")).withColumn(
        "bound", F.expr(f"cast(a as decimal(16, 0)) * {SCALE}BD div l")
    )


def _scored_triples(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each triple with its two pairs and the parts, counts and score of its lowest cut."""
    cut = triples.select(
        "lang", "phrase", F.col("f").alias("a"), F.substring_index("phrase", " ", 2).alias("one"),
        F.substring_index("phrase", " ", -2).alias("two"),
    )
    first = pairs.select("lang", F.col("phrase").alias("one"), F.col("a").alias("one_a"), F.col("l").alias("one_l"))
    last = pairs.select("lang", F.col("phrase").alias("two"), F.col("a").alias("two_a"), F.col("r").alias("two_r"))
    met = cut.join(first, ["lang", "one"]).join(last, ["lang", "two"])
    met = met.withColumns({"s1": _score("a", "one_l", "two_a"), "s2": _score("a", "one_a", "two_r")})
    early = F.col("s1") <= F.col("s2")
    return met.select(
        "lang", "phrase", "a", "one", "two",
        F.when(early, F.col("one_l")).otherwise(F.col("one_a")).alias("l"),
        F.when(early, F.col("two_a")).otherwise(F.col("two_r")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )


def _least_scores(pairs: DataFrame, reach: int) -> DataFrame:
    """``(lang, least)``: the score of each language's ``reach``-th best pair, 0 where there are fewer.

    Pairs are counted by score first, so a language has at most SCALE + 1 rows in its window.
    """
    by_score = pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("lang").orderBy(F.desc("score"))
    met = by_score.withColumn("upto", F.sum("n").over(upto)).where(F.col("upto") >= reach)
    found = met.groupBy("lang").agg(F.max("score").alias("least"))
    return pairs.select("lang").distinct().join(found, "lang", "left").select(
        "lang", F.coalesce("least", F.lit(0)).alias("least")
    )


def _of_langs(df: DataFrame, langs: DataFrame, how: str = "inner") -> DataFrame:
    """Rows joined to a staged table of one row a language, which goes to all tasks while it is short."""
    return df.join(F.broadcast(langs) if langs.count() <= FEW_LANGS else langs, "lang", how)


def _surviving(pairs: DataFrame, triples: DataFrame, percent: int) -> DataFrame:
    """Phrases of at least their language's ``least`` score that no longer candidate stands in for."""
    inside = triples.select("lang", F.col("a").alias("longer"), F.explode(F.array("one", "two")).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    enough = F.col("score") >= F.col("least")
    whole = ["lang", "phrase", "a", "l", "r", "score", "least"]
    kept = pairs.where(enough).join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))
    )
    return kept.select(whole).unionByName(triples.where(enough).select(whole))


def mine_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = 10,
    top: int = 2000,
    percent: int = 50,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of two and three words of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and into words at spaces and
    tabs. A phrase found ``a`` >= ``min_count`` times scores a * a / (l * r) millionths, l and r being the counts of
    its two parts at the cut that scores lowest, the first of equal ones. A phrase within a longer one of
    at least ``percent`` of its count goes. ``n`` is all words of the language. Ranks follow
    score, count and phrase.

    Phrases grow from their prefixes. Words are counted first, then pairs of words that are frequent enough.
    No phrase that begins with a pair p of first word w can score more than f(p) / f(w). The
    frontier of a language is the pairs whose bound reaches the score of its ``top`` * WIDER-th pair: triples are
    counted if they begin with such a pair, or hold a pair of that score, whose fate they decide. If fewer than ``top``
    phrases of that score survive, the language's frontier is moved on to WIDER times as many
    pairs, and ends with all of them. Everything above the frontier is known, ties included.

    Tasks learn the frontier as filters of FILTER_BITS each; what these let through besides goes in
    exact joins. Every pass reads whole texts. A null text has no words, a null language is ``und``;
    repeated rows count each time; ids are not read. An empty table gives an empty one.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")
    )
    words = stage(_count(texts, 1, []), "words")
    frequent = F.col("f") >= min_count
    common = words.where(frequent)
    pairs = _count(texts, 2, [_filter(common)]).where(frequent)
    pairs = stage(_scored_pairs(pairs, common), "pairs")
    counted = _filter(pairs)
    found, left, reach = None, None, top
    while left is None or not left.isEmpty():
        reach *= WIDER
        own = pairs if left is None else _of_langs(pairs, left, "left_semi")
        least = stage(_least_scores(own, reach), "least")
        own = _of_langs(own, least)
        ahead = _filter(own.where("bound >= least"))
        strong = _filter(own.where("score >= least"))
        read = texts if left is None else _of_langs(texts, left, "left_semi")
        triples = _scored_triples(_count(read, 3, [counted, ahead, strong]).where(frequent), pairs)
        triples = stage(_of_langs(triples, least), "triples")
        alive = stage(_surviving(own, triples, percent), "alive")
        state = alive.groupBy("lang", "least").agg(F.count(F.lit(1)).alias("n"))
        short = state.where((F.col("n") < top) & (F.col("least") > 0)).select("lang")
        none = least.where("least > 0").join(state, "lang", "left_anti").select("lang")
        left = stage(short.unionByName(none), "left")
        alive = _of_langs(alive, left, "left_anti")
        found = alive if found is None else found.unionByName(alive)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
