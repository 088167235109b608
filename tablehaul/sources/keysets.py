"""Ranges of a key of one or more columns, cut at keys that the database finds along its own order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TYPE_CHECKING, Any

if TYPE_CHECKING:
    from tablehaul.sources.jdbc import Dialect

Key = tuple[Any, ...]


def at_or_above(keys: Sequence[str], low: Key, dialect: Dialect) -> str:
    """``(keys) >= (low)`` in words that an index on the keys serves."""
    k, v = dialect.name(keys[0]), dialect.literal(low[0])
    if len(keys) == 1:
        return f"{k} >= {v}"
    return f"{k} >= {v} AND ({k} > {v} OR ({at_or_above(keys[1:], low[1:], dialect)}))"


def below(keys: Sequence[str], high: Key, dialect: Dialect) -> str:
    """``(keys) < (high)``."""
    k, v = dialect.name(keys[0]), dialect.literal(high[0])
    if len(keys) == 1:
        return f"{k} < {v}"
    return f"{k} <= {v} AND ({k} < {v} OR ({below(keys[1:], high[1:], dialect)}))"


def keyset_predicates(keys: Sequence[str], starts: Sequence[Key], dialect: Dialect) -> list[str]:
    """Half-open ranges that hold every row once; the first has no lower end and the last no upper end.

    A NULL in the only key column belongs to the first range; several columns must hold none, as those of
    a primary key. Equal starts make one range, and so does a start that holds a NULL.
    """
    edges = [s for s in dict.fromkeys(starts[1:]) if None not in s]
    if not edges:
        return ["1 = 1"]
    or_null = f" OR {dialect.name(keys[0])} IS NULL" if len(keys) == 1 else ""
    ranges = [below(keys, edges[0], dialect) + or_null]
    for low, high in zip(edges, edges[1:]):
        ranges.append(f"({at_or_above(keys, low, dialect)}) AND ({below(keys, high, dialect)})")
    return [*ranges, at_or_above(keys, edges[-1], dialect)]


def probe_sql(table: str, keys: Sequence[str], low: Key | None, skip: int, dialect: Dialect) -> str:
    """The key ``skip`` rows after ``low``, or after the first one. An index on the keys answers it alone."""
    named = ", ".join(dialect.name(k) for k in keys)
    where = f" WHERE {at_or_above(keys, low, dialect)}" if low is not None else ""
    return f"SELECT {named} FROM {dialect.name(table)}{where} ORDER BY {named} LIMIT 1 OFFSET {skip}"


def numbered_starts_sql(table: str, keys: Sequence[str], edges: Sequence[int], dialect: Dialect) -> str:
    """The keys at the given places, and the places, from a server that numbers rows itself."""
    named = ", ".join(dialect.name(k) for k in keys)
    places = ", ".join(str(e) for e in edges)
    return (
        f"SELECT {named}, place FROM (SELECT {named}, ROW_NUMBER() OVER (ORDER BY {named}) - 1 AS place "
        f"FROM {dialect.name(table)}) t WHERE place IN ({places})"
    )


def places(rows: int, shards: int) -> list[int]:
    """Where each of ``shards`` equal parts of the rows begins."""
    return [rows * i // shards for i in range(shards)]


def probed_starts(
    ask: Callable[[list[tuple[Key | None, int]]], list[Key | None]], rows: int, shards: int
) -> list[Key]:
    """The lowest key of each part, by halving: each probe starts from the nearest key known below it.

    ``ask`` answers a round of probes ``(low, skip)`` side by side. There are as many rounds as the number of
    shards has binary digits, and a round walks over half of the index at most. A key that is gone
    meanwhile joins its part to the one before.
    """
    at = places(rows, shards)
    found: dict[int, Key | None] = {0: None}
    spans = [(0, shards)]
    while spans:
        middles = [(a + b) // 2 for a, b in spans]
        work = [(a, m, b) for (a, b), m in zip(spans, middles) if m > a]
        answers = ask([(found[a], at[m] - at[a]) for a, m, _ in work])
        spans = []
        for (a, m, b), key in zip(work, answers, strict=True):
            if key is None:
                spans.append((a, m))
                continue
            found[m] = key
            spans += [(a, m), (m, b)]
    return [key for i, key in sorted(found.items()) if i and key is not None]
