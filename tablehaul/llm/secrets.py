"""Secrets in texts: patterns of keys, and runs of characters with high entropy."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
#: Fixed-point units of entropy sums.
UNIT = 1_000_000


@dataclass(frozen=True)
class CharClass:
    """Candidates of a class are its longest runs of at least ``window`` characters.

    Candidates without a digit, which names and paths often are, need ``plain_bits``.
    """

    name: str
    pattern: str
    alphabet: str
    window: int
    bits: float
    plain_bits: float


DIGITS, LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("hex_entropy", "[0-9a-fA-F]{24,}", DIGITS + "abcdef", 24, 3.1, 3.1),
    CharClass("base64_entropy", "[A-Za-z0-9+/_=-]{24,}", DIGITS + LETTERS.upper() + LETTERS + "+/_=-", 24, 3.9, 4.1),
)
#: Candidates that are never secrets: numbers, and ids of a fixed form.
ALLOWED = (
    r"^[0-9-]*$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
)
#: Placeholders and counting runs; windows that touch one do not count, the rest of the candidate does.
ALLOWED_PARTS = r"(?i)example|placeholder|dummy|changeme|redacted|x{6,}|0{8,}|0123456789|1234567890|abcdefghij"
PLAIN = "^[A-Za-z_=/+-]*$"


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches in order: start and end in code points, and a group of the match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    own = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("match"), own.alias("own"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,own:string>>")

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["match"])
        span = F.struct(start.alias("start"), end.alias("end"), part["own"].alias("own"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    first = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))
    return F.aggregate(parts, first, add, lambda s: s["spans"])


def _unlisted(own: Column) -> Column:
    """The parts of a candidate around its placeholders: where each starts in it, and its text."""
    parts = F.arrays_zip(
        F.split(own, ALLOWED_PARTS, -1).alias("gap"),
        F.regexp_extract_all(own, F.lit(ALLOWED_PARTS), F.lit(0)).alias("part"),
    )
    none = F.array().cast("array<struct<start:int,own:string>>")

    def add(state: Column, z: Column) -> Column:
        after = state["at"] + F.length(z["gap"]) + F.coalesce(F.length(z["part"]), F.lit(0))
        piece = F.struct(state["at"].alias("start"), z["gap"].alias("own"))
        return F.struct(after.alias("at"), F.concat(state["pieces"], F.array(piece)).alias("pieces"))

    first = F.struct(F.lit(0).alias("at"), none.alias("pieces"))
    cut = F.aggregate(parts, first, add, lambda s: s["pieces"])
    return F.when(own.rlike(ALLOWED_PARTS), cut).otherwise(
        F.array(F.struct(F.lit(0).alias("start"), own.alias("own")))
    )


def _rich(text: Column, kind: CharClass) -> Column:
    """Runs of windows of a candidate whose entropy reaches the class's, as offsets in it.

    A window moves on by one character: one count goes up, one down, and the sum of n * log2 n
    follows from these two counts. The entropy is log2 of the window less that sum's share.
    """
    w = kind.window
    sums = F.array(*[F.lit(round(n * math.log2(n) * UNIT) if n else 0).cast("bigint") for n in range(w + 1)])
    most, plain = (math.floor(w * (math.log2(w) - b) * UNIT) for b in (kind.bits, kind.plain_bits))
    most = F.lit(most) if most == plain else F.when(text.rlike(PLAIN), plain).otherwise(most)
    fold = F.lower(text) if kind.alphabet == kind.alphabet.lower() else text
    places = F.transform(F.split(fold, ""), lambda c: F.instr(F.lit(kind.alphabet), c) - 1)
    spans = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, i: Column) -> Column:
        enter = F.get(state["places"], i)
        leave = F.when(i >= w, F.get(state["places"], i - w)).otherwise(F.lit(-1))
        up, down = F.get(state["counts"], enter), F.get(state["counts"], leave)
        moved = enter != leave
        total = state["sum"] + F.when(
            moved,
            F.get(sums, up + 1) - F.get(sums, up)
            + F.when(leave >= 0, F.get(sums, down - 1) - F.get(sums, down)).otherwise(F.lit(0)),
        ).otherwise(F.lit(0))
        counts = F.transform(
            state["counts"],
            lambda n, j: n + F.when(j == enter, 1).otherwise(0) - F.when(j == leave, 1).otherwise(0),
        )
        last = F.element_at(F.when(F.size(state["spans"]) > 0, state["spans"]), -1)
        grown = F.struct(
            F.when(last["end"] >= i - (w - 1), last["start"]).otherwise(i - (w - 1)).alias("start"),
            (i + 1).alias("end"),
        )
        kept = F.when(last["end"] >= i - (w - 1), F.slice(state["spans"], 1, F.size(state["spans"]) - 1))
        more = F.concat(F.coalesce(kept, state["spans"]), F.array(grown))
        return F.struct(
            state["places"].alias("places"),
            counts.alias("counts"),
            total.alias("sum"),
            state["most"].alias("most"),
            F.when((i >= w - 1) & (total <= state["most"]), more).otherwise(state["spans"]).alias("spans"),
        )

    first = F.struct(
        places.alias("places"),
        F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"),
        F.lit(0).cast("bigint").alias("sum"),
        most.cast("bigint").alias("most"),
        spans.alias("spans"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.length(text) - 1), first, step, lambda s: s["spans"])


def _named(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def _entropy(text: Column, kind: CharClass, rank: int) -> Column:
    allowed = "|".join(f"(?:{a})" for a in ALLOWED)
    candidates = F.filter(_matches(text, kind.pattern), lambda m: ~m["own"].rlike(allowed))
    pieces = F.flatten(
        F.transform(
            candidates,
            lambda m: F.transform(
                F.filter(_unlisted(m["own"]), lambda p: F.length(p["own"]) >= kind.window),
                lambda p: F.struct((m["start"] + p["start"]).alias("start"), p["own"].alias("own")),
            ),
        )
    )
    found = F.flatten(
        F.transform(
            pieces,
            lambda p: F.transform(
                _rich(p["own"], kind),
                lambda s: F.struct((p["start"] + s["start"]).alias("start"), (p["start"] + s["end"]).alias("end")),
            ),
        )
    )
    return _named(found, kind.name, rank)


def _listed(spans: Column) -> Column:
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, base, entropy)`` for every document: arrays of ``(start, rank, end, kind)``.

    Offsets count code points, ends are exclusive, arrays are ordered by start, then kind. ``base``
    has assignments of a value of 8 characters or more to a name such as password, access keys,
    and runs of 32 or more lower-case hex digits. ``entropy`` has the runs of characters of one
    class whose sliding windows reach the class's bits a character; windows that touch a placeholder of the
    allow list do not count, nor do candidates that are numbers or ids of a fixed form. Base spans are never
    suppressed.

    A null text counts as an empty one, without spans. Every row is kept, also with a null or
    repeated id. Only the two columns are read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")

    def where(hint: str, found: Column) -> Column:
        return F.when(text.rlike(hint), found).otherwise(none)

    assign = F.filter(_matches(text, ASSIGN, 2), lambda m: F.length(m["own"]) >= 8)
    base = F.concat(
        where(ASSIGN_HINT, _named(assign, "assign", 0)),
        where("AKIA", _named(_matches(text, ACCESS), "access", 1)),
        where(HEX, _named(_matches(text, HEX), "hex", 2)),
    )
    entropy = F.concat(
        *[where(kind.pattern, _entropy(text, kind, 3 + i)) for i, kind in enumerate(CLASSES)]
    )
    return docs.select(
        F.col(id_col), F.array_sort(base).alias("base"), F.array_sort(entropy).alias("entropy")
    )


def secret_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and lists of the spans of ``find_secrets``."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        id_col,
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(F.encode(_listed(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "entropy"))).alias("spans"),
    )
