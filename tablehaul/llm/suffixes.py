"""Long byte strings that occur more than once, by suffix arrays of what hashes leave open."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.rows import numbered
from tablehaul.llm.words import digests, mix, slices, window_hashes
from tablehaul.shared import stage, unstage

MIN_BYTES, GRAM = 400, 64
#: Starts that share a core; symbols that a suffix array is built over at a time.
PIECE, SYMBOLS = 32, 1 << 17
#: Strings around one core beyond which their windows are counted one by one, over all tasks.
MANY = 1024


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes in order, by grouping them by their Lyndon prefixes.

    Groups hold suffixes with equal prefixes found so far, in order of these. From the highest
    group down, each suffix of the group is hung on the nearest suffix before it in a lower group:
    its previous smaller one, whose prefix grows by the group's. Suffixes whose prefix
    grows alike leave their group together, for a new one right behind it. Then each suffix, in
    order, puts the suffixes whose prefix ends where it starts next in their groups.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n
    group, size = [0] * n, [0] * (n + 1)
    start = 0
    for at, i in enumerate(order):
        place[i] = at
        if at and text[i] != text[order[at - 1]]:
            start = at
        group[i] = start
        size[start] += 1
    before = [-1] * n
    end = n
    while end:
        start = group[order[end - 1]]
        times: dict[int, int] = {}
        for i in sorted(order[start:end]):
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        by_times: dict[int, list[int]] = {}
        for p, k in times.items():
            by_times.setdefault(k, []).append(p)
        for k in sorted(by_times, reverse=True):
            moved = by_times[k]
            for p in moved:
                own = group[p]
                size[own] -= 1
                last = own + size[own]
                other, at = order[last], place[p]
                order[at], order[last] = other, p
                place[other], place[p] = at, last
            starts = [group[p] + size[group[p]] for p in moved]
            for p, new in zip(moved, starts, strict=True):
                size[new] += 1
                group[p] = new
        end = start
    free, found = {}, [0] * n
    for q in _in_order(found, n):
        s = q - 1
        stop = before[q] if q < n else -1
        while s > stop:
            at = free.get(group[s], group[s])
            found[at] = s
            free[group[s]] = at + 1
            s = before[s]
    return found


def _in_order(found: list[int], n: int) -> Iterator[int]:
    yield n
    for at in range(n):
        yield found[at]


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """For each start, the longest prefix that its suffix shares with a neighbour in the order."""
    n = len(text)
    rank = [0] * n
    for at, i in enumerate(order):
        rank[i] = at
    longest, h = [0] * n, 0
    for i in range(n):
        if rank[i]:
            j = order[rank[i] - 1]
            stop = n - max(i, j)
            while h < stop and text[i + h] == text[j + h]:
                h += 1
            longest[i] = max(longest[i], h)
            longest[j] = max(longest[j], h)
            h = h - 1 if h else 0
        else:
            h = 0
    return longest


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[: len(keys) - (width - size)], keys[width - size :]) if width > size else keys


def _segments(length: int, gram: int):
    """Runs of starts whose windows have the same anchor: the least gram by hash, then leftmost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, at in slices(batch.column("text")):
                size = np.diff(at)
                if (size < length).all():
                    continue
                grams = np.arange(len(data) - gram + 1)
                hashes = window_hashes(data, gram)
                keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | grams.astype(np.uint64)
                anchor = (_least(keys, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
                count = np.maximum(size - length + 1, 0)
                owner = np.repeat(np.arange(len(size)), count)
                start = at[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                anchor = anchor[start]
                first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
                times = np.diff(np.append(first, len(start)))
                begin, own, held = start[first], owner[first], anchor[first]
                content = digests(data, begin, begin + times - 1 + length)
                yield pa.record_batch(
                    [
                        batch.column("id").take(pa.array(row + own)),
                        pa.array((begin - at[own]).astype(np.int64)),
                        pa.array(times.astype(np.int32)),
                        pa.array((held - begin).astype(np.int32)),
                        pa.array(hashes[held].view(np.int64)),
                        pa.array(content[:, 0].view(np.int64)),
                        pa.array(content[:, 1].view(np.int64)),
                    ],
                    names=["id", "start", "times", "ahead", "anchor", "c", "d"],
                )

    return run


def _pieces(length: int):
    """Cuts open segments so that all windows of a piece hold its core, whatever lies around it.

    Starts are cut into runs of 32, counted back from the anchor. So a piece has at most 31 bytes on
    either side of its core, each window takes 31 of them, and equal windows lie in pieces
    with equal cores.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("open")
            for row, data, at in slices(batch.column("text")):
                names, base, begin, times, anchor, copies = [], [], [], [], [], []
                ids = batch.column("id").slice(row, len(at) - 1).to_pylist()
                for k, segments in enumerate(every.slice(row, len(at) - 1).to_pylist()):
                    for s in segments:
                        names.append(ids[k])
                        base.append(at[k])
                        begin.append(at[k] + s["start"])
                        times.append(s["times"])
                        anchor.append(at[k] + s["start"] + s["ahead"])
                        copies.append(s["n"])
                times = np.array(times, np.int64)
                of = np.repeat(np.arange(len(times)), times)
                start = np.array(begin)[of] + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
                back = np.array(anchor)[of] - start
                cut = of * 4096 + back // PIECE
                first = np.flatnonzero(np.concatenate([[True], cut[1:] != cut[:-1]]))
                last = np.append(first[1:], len(start)) - 1
                of, salt = of[first], (back // PIECE)[first]
                core_from = np.array(anchor)[of] - PIECE * salt
                core_to = core_from - (PIECE - 1) + length
                one, two = start[first], start[last]
                salt = salt.astype(np.uint64)
                core = digests(data, core_from, core_to)
                raw = data.tobytes()
                left = [raw[a:b] for a, b in zip(one.tolist(), core_from.tolist(), strict=True)]
                right = [raw[a:b] for a, b in zip(core_to.tolist(), (two + length).tolist(), strict=True)]
                yield pa.record_batch(
                    [
                        pa.array([names[o] for o in of.tolist()], pa.int64()),
                        pa.array(one - np.array(base)[of]),
                        pa.array((two - one + 1).astype(np.int32)),
                        pa.array([copies[o] for o in of.tolist()], pa.int64()),
                        pa.array(mix(core[:, 0] + salt).view(np.int64)),
                        pa.array(mix(core[:, 1] + salt).view(np.int64)),
                        pa.array(left, pa.binary()),
                        pa.array(right, pa.binary()),
                    ],
                    names=["id", "start", "times", "n", "k", "l", "left", "right"],
                )

    return run


def _repeated(strings: list[tuple]) -> Iterator[tuple[int, int, bytes, bytes, int]]:
    """Of strings ``(k, l, left, right, times)``: bits of the starts that occur again.

    All strings become one text: the bytes around each core, the core as one symbol, and an end.
    """
    text: list[int] = []
    at, cores = [], {}
    for k, core, left, right, *_ in strings:
        at.append(len(text))
        symbol = cores.setdefault((k, core), 257 + len(cores))
        text += [*(b + 1 for b in left), symbol, *(b + 1 for b in right), 0]
    longest = common_prefixes(text, suffix_array(text))
    for start, (k, core, left, right, times) in zip(at, strings, strict=True):
        bits = 0
        for t in range(times):
            if longest[start + t] >= PIECE:
                bits |= 1 << t
        if bits:
            yield k, core, left, right, bits


def _sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over the strings of a task, some cores at a time, never less than a core's."""
    held: list[tuple] = []
    symbols = 0

    def made() -> pa.RecordBatch:
        rows = list(_repeated(held))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.record_batch(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
            names=["k", "l", "left", "right", "bits"],
        )

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("k", "l", "left", "right", "times")]
        for row in zip(*columns, strict=True):
            if symbols > SYMBOLS and row[:2] != held[-1][:2]:
                yield made()
                held, symbols = [], 0
            held.append(row)
            symbols += len(row[2]) + len(row[3]) + 2
    if held:
        yield made()


def _cut_out(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("id", "text", "found")]
            for name, text, found in zip(*columns, strict=True):
                raw = (text or "").encode()
                kept, spans, reached = [], [], 0
                for start, times in sorted((f["start"], f["times"]) for f in found or ()):
                    end = start + times - 1 + length
                    if spans and start <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], end)
                    else:
                        spans.append({"start": start, "end": end})
                for s in spans:
                    kept.append(raw[reached : s["start"]])
                    reached = s["end"]
                left = b"".join([*kept, raw[reached:]])
                rows.append((name, len(raw), spans, left, hashlib.sha256(left).hexdigest()))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [batch.column("id").type, pa.int64(), span, pa.binary(), pa.string()]
            names = ["id", "n_bytes", "spans", "kept", "kept_sha256"]
            yield pa.record_batch(
                [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)],
                names=names,
            )

    return run


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = MIN_BYTES, gram: int = GRAM
) -> DataFrame:
    """``(id, start, times)``: starts of strings of ``length`` bytes that also start elsewhere.

    Each window of ``length`` bytes has an anchor, chosen by its content alone. Runs of windows
    with the same anchor are segments. A segment of which there are two is repeated as a whole; one
    whose anchor occurs nowhere else has no repeated window. The others, at the ends of
    repeated passages and around changed bytes, are cut into pieces; equal pieces are repeated as
    a whole, and pieces with equal cores are told apart by suffix arrays of their edges, or where more than 1,024
    pieces have the same core, by counting their windows. Segments and cores are compared by 128
    bits of hash.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.where("id is not null")
    segments = stage(
        texts.mapInArrow(
            _segments(length, gram),
            "id long, start long, times int, ahead int, anchor long, c long, d long",
        ),
        "segments",
    )
    shared = segments.groupBy("anchor").agg(F.count("*").alias("held")).where("held > 1")
    shared = stage(shared.select("anchor"), "anchors")
    live = stage(segments.join(shared, "anchor", "left_semi"), "segments")
    unstage(segments)
    same = ["anchor", "c", "d"]
    kinds = stage(
        live.groupBy(*same).agg(
            F.count("*").alias("n"), F.min(F.struct("id", "start", "times", "ahead")).alias("one")
        ),
        "kinds",
    )
    whole = live.join(kinds.where("n > 1").select(*same), same, "left_semi").select("id", "start", "times")
    mixed = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    mixed = mixed.where("kinds > 1 and least = 1").select("anchor")
    open_ones = kinds.join(mixed, "anchor", "left_semi").select(
        "one.id", F.struct("one.start", "one.times", "one.ahead", "n").alias("segment")
    )
    by_doc = open_ones.groupBy("id").agg(F.collect_list("segment").alias("open"))
    pieces = stage(
        texts.join(by_doc, "id").mapInArrow(
            _pieces(length),
            "id long, start long, times int, n long, k long, l long, left binary, right binary",
        ),
        "pieces",
    )
    string = ["k", "l", "left", "right"]
    strings = stage(
        pieces.groupBy(*string).agg(
            F.sum("n").alias("n"), F.max("times").alias("times")
        ),
        "strings",
    )
    unclear = strings.groupBy("k", "l").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    rows = strings.join(unclear.where("kinds > 1 and least = 1"), ["k", "l"])
    few = rows.where(F.col("kinds") <= MANY).select(*string, "times")
    sorted_out = few.repartition("k", "l").sortWithinPartitions("k", "l").mapInArrow(
        _sorted_out, "k long, l long, left binary, right binary, bits long"
    )
    windows = rows.where(F.col("kinds") > MANY).select(
        *string, F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("t")
    )
    own = [
        F.substr("left", F.col("t") + 1).alias("x"),
        F.substr("right", F.lit(1), PIECE - 1 - F.length("left") + F.col("t")).alias("y"),
    ]
    windows = windows.select(*string, "t", *own)
    again = windows.groupBy("k", "l", "x", "y").agg(F.count("*").alias("held")).where("held > 1")
    counted = windows.join(again, ["k", "l", "x", "y"]).groupBy(*string).agg(
        F.sum(F.expr("shiftleft(1L, t)")).alias("bits")
    )
    alike = strings.where("n > 1").select(*string, F.lit(-1).cast("long").alias("bits"))
    told = strings.where("n = 1").select(*string).join(sorted_out.unionByName(counted), string)
    clear = told.select(*string, "bits")
    marked = pieces.where("n = 1").join(alike.unionByName(clear), string)
    parts = marked.select(
        "id", F.explode(
            F.expr(
                "transform(filter(sequence(0, times - 1), t -> bits = -1 or shiftright(bits, t) % 2 = 1), "
                "t -> start + t)"
            )
        ).alias("start"), F.lit(1).alias("times"),
    )
    return whole.unionByName(parts)


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = MIN_BYTES
) -> DataFrame:
    """Every document without the bytes of strings of ``length`` bytes that also start elsewhere.

    Strings are compared in all whole texts as UTF-8 bytes, in other documents or in the same,
    overlaps included, as they stand before anything is removed. Returns id, n_bytes, spans
    (removed runs, start and end in bytes), kept (what is left, as bytes, since a cut may split a
    character) and kept_sha256.

    A null text counts as an empty one; texts shorter than ``length`` stay whole. Every row is
    scanned and cut by itself, also with a null or repeated id, and ids may be of any type. No rows give
    none. Only the two columns are read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = numbered(texts, "id", "row")
    found = repeated_spans(rows, "row", "text", length)
    by_doc = found.groupBy(F.col("id").alias("row")).agg(F.collect_list(F.struct("start", "times")).alias("found"))
    return rows.join(by_doc, "row", "left").drop("row").mapInArrow(
        _cut_out(length),
        f"id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary, kept_sha256 string",
    ).withColumnRenamed("id", id_col)
