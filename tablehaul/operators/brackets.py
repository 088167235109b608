"""Finding rows by their place in an order from mergeable sketches and exact counts.

A sketch of a column's values tells nearly where a place lies, in one pass and without a shuffle. A second
pass counts the rows below a few values around it, exactly. Only the rows between two of them
are left to sort. Where a frequent value holds the place, the next column is sketched inside it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.names import quoted
from tablehaul.operators.ordering import sortable

#: Size of a sketch, and rows that go into it at most; its ranks are off by less than a thousandth. Counts are
#: of all rows, so a sketch decides only how many are sorted.
SKETCH_K, SAMPLE = 4096, 2_000_000
_STEPS = 1000
_AROUND = 3
_BYTES, _DIGITS = 6, 4
_NULL = float("-inf")
_WHOLE = float(1 << 53)


@dataclass(frozen=True)
class Digit:
    """A number that rises with a column, though not strictly; NULL has the lowest.

    Values that agree in all digits of a column are equal if the last one is smaller than
    ``settles``. ``name`` is set for whole-number columns, which are their own digit, ``head`` for the first
    digit of texts, as their bytes.
    """

    code: Column
    settles: float = float("inf")
    name: str | None = None
    head: Column | None = None

    def tells(self, value: float) -> bool:
        return abs(value) < self.settles or (value == _NULL and self.settles > 0)

    def reaches(self, value: float) -> Column:
        """Whether the code is at least the value; of texts their first bytes say the same at less cost."""
        if self.head is None or value == _NULL:
            return self.code >= F.lit(value)
        first = int(value).to_bytes(_BYTES + 1, "big")
        if first[0]:
            return F.lit(False)
        return F.coalesce(self.head >= F.lit(bytearray(first[1:].rstrip(b"\0"))), F.lit(False))

    def exceeds(self, value: float) -> Column:
        """Whether the code is more than the value."""
        return self.reaches(value + 1) if self.head is not None and value != _NULL else self.code > F.lit(value)


@dataclass(frozen=True)
class Bracket:
    """``rows`` rows that hold places ``first`` to ``end`` of an order; ``before`` others are smaller than all of them."""

    inside: Column
    before: int
    rows: int
    first: int
    end: int


def column_digits(name: str, kind: T.DataType) -> list[Digit]:
    """The digits of a column, the most telling one first. Of texts they reach 24 bytes far."""
    value = F.col(quoted(name))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        found = [Digit(value.cast("double"), _WHOLE, name)]
    elif isinstance(kind, T.BooleanType):
        found = [Digit(value.cast("int").cast("double"))]
    elif isinstance(kind, T.DateType):
        found = [Digit(F.unix_date(value).cast("double"))]
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        found = [Digit(sortable(kind, value).cast("double"), _WHOLE)]
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        code, width = F.hex(value), 2 * _BYTES
        found = [
            Digit(F.conv(F.rpad(F.substring(code, width * i + 1, width), width, "0"), 16, 10).cast("double"))
            for i in range(_DIGITS)
        ]
        most = _BYTES * _DIGITS
        found.append(Digit(F.least(F.octet_length(value), F.lit(most + 1)).cast("double"), most + 1.0))
        found[0] = Digit(found[0].code, head=value.cast("binary"))
    elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        found = [Digit(F.nanvl(value.cast("double"), F.lit(float("inf"))), 0.0)]
    else:
        found = [Digit(F.lit(0.0), 0.0)]  # tells nothing: all rows are sorted
    return [replace(d, code=F.coalesce(d.code, F.lit(_NULL))) for d in found]


def _sketched(df: DataFrame, code: Column, parts: int = _STEPS) -> tuple[int, list[float]]:
    """How many rows there are, and about the code at each of so many equal parts of them."""
    steps = F.array(*[F.lit(i / parts) for i in range(parts + 1)])
    sketch = F.kll_sketch_agg_double("code", F.lit(SKETCH_K))
    n = F.count(F.lit(1))
    found = df.select(code.alias("code")).agg(
        n, F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, steps))
    ).first()
    return found[0], found[1] or []


def quantiles(df: DataFrame, code: Column, parts: int) -> list[float]:
    """Codes that cut the rows into about equal parts, with the lowest and the highest; empty without rows."""
    return _sketched(df, code, parts)[1]


def range_of(code: Column, edges: Sequence[float], first: int = 0) -> Column:
    """How many edges the code reaches, by halving."""
    if not edges:
        return F.lit(first)
    middle = len(edges) // 2
    below = range_of(code, edges[:middle], first)
    above = range_of(code, edges[middle + 1 :], first + middle + 1)
    return F.when(code < F.lit(edges[middle]), below).otherwise(above)


def _bound(digit: Digit, low: float | None, high: float | None) -> Column:
    """The rows between two codes; for a whole-number column in words a file scan understands."""
    holds = F.lit(True)
    plain = F.col(quoted(digit.name)) if digit.name else None
    if low is not None and low != _NULL:
        narrow = plain is not None and digit.tells(low)
        holds &= plain >= F.lit(int(low)) if narrow else digit.reaches(low)
    if high is not None:
        narrow = plain is not None and digit.tells(high) and high != _NULL
        holds &= plain.isNull() | (plain <= F.lit(int(high))) if narrow else ~digit.exceeds(high)
    return holds


def _split(
    df: DataFrame, digits: list[list[Digit]], at: tuple[int, int], wanted: Bracket, enough: int
) -> Iterator[Bracket]:
    digit, n = digits[at[0]][at[1]], wanted.rows
    first, end = wanted.first - wanted.before, min(wanted.end - wanted.before, n)
    if end <= first:
        return
    whole = replace(wanted, end=wanted.before + end)
    if n <= max(enough, 4 * (end - first)):
        yield whole
        return
    rows = df.where(wanted.inside)
    some = rows.sample(SAMPLE / n, seed=7) if n > 2 * SAMPLE else rows
    points = _sketched(some, digit.code)[1]
    near = {place * _STEPS // n + step for place in (first, end - 1) for step in range(-_AROUND, _AROUND + 2)}
    values = sorted({points[i] for i in near if 0 <= i <= _STEPS})
    counts = rows.agg(
        *[F.count_if(~digit.reaches(v)) for v in values], *[F.count_if(~digit.exceeds(v)) for v in values]
    ).first()
    below, upto = counts[: len(values)], counts[len(values) :]
    low = max((i for i, c in enumerate(below) if c <= first), default=None)
    high = min((i for i, c in enumerate(upto) if c >= end), default=None)
    start, stop = (0 if low is None else below[low]), (n if high is None else upto[high])
    lowest, highest = (None if low is None else values[low]), (None if high is None else values[high])
    inner = Bracket(
        wanted.inside & _bound(digit, lowest, highest), wanted.before + start, stop - start, whole.first, whole.end
    )
    if stop - start <= max(enough, 4 * (end - first)):
        yield inner
    elif low is not None and low == high:
        if at[1] + 1 < len(digits[at[0]]):
            yield from _split(df, digits, (at[0], at[1] + 1), inner, enough)
        elif at[0] + 1 < len(digits) and digit.tells(lowest):
            yield from _split(df, digits, (at[0] + 1, 0), inner, enough)
        else:
            yield inner
    elif stop - start <= n // 2:
        yield from _split(df, digits, at, inner, enough)
    elif low is not None and upto[low] > first:
        # The page begins inside a frequent value and ends behind it.
        edge, held = wanted.before + upto[low], upto[low] - below[low]
        same = wanted.inside & digit.reaches(lowest) & ~digit.exceeds(lowest)
        more = wanted.inside & digit.exceeds(lowest)
        yield from _split(df, digits, at, Bracket(same, inner.before, held, inner.first, edge), enough)
        yield from _split(df, digits, at, Bracket(more, edge, n - upto[low], edge, inner.end), enough)
    else:
        yield inner


def brackets(df: DataFrame, order_by: Sequence[str], first: int, end: int, enough: int) -> list[Bracket]:
    """Parts of the rows that hold places ``first`` to ``end`` of the ascending order, NULL first, in turn.

    A part has at most ``enough`` rows or four times as many as are wanted of it. It is larger only if
    values cannot be told apart: texts that agree in 24 bytes, fractions beyond 53 bits, equal rows.
    """
    digits = [column_digits(name, df.schema[name].dataType) for name in order_by]
    return list(_split(df, digits, (0, 0), Bracket(F.lit(True), 0, df.count(), first, end), enough))
