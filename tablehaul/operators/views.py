"""Views, rebuilt from the text the source keeps of them."""

from __future__ import annotations

import re
from collections.abc import Mapping
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame

from tablehaul.functions.frames import small_frame
from tablehaul.sources.tables import TableSet

OUTCOME_SCHEMA = "view_name string, is_success string, error string"

_HEAD = re.compile(
    r"(?is)^\s*create\b.*?\bview\s+(?:`[^`]+`|[\w.$]+)(?:\.`[^`]+`)?"
    r"\s*(?P<columns>\([^()]*\))?\s*\bas\s+"
)
_CHECK = re.compile(r"(?i)\s+with\s+(?:(?:cascaded|local)\s+)?check\s+option\s*$")
_CONVERT = re.compile(r"(?i)\bconvert\s*\(")
_USING = re.compile(r"(?i)\s+using\s+\w+\s*$")
_RELATION = re.compile(r"'UnresolvedRelation \[([^\]]*)\]")
_LITERAL = re.compile(r"'(?:[^'\\]|\\.|'')*'", re.DOTALL)


def view_body(definition: str, schema: str = "") -> str:
    """The SELECT of a view: without the CREATE head and without character set conversions.

    Column names in the head are kept. Names qualified by ``schema`` lose that qualifier, so that
    they mean the tables of the set the view goes to.
    """
    head = _HEAD.match(definition)
    body = _without_charset(definition[head.end() :] if head else definition).strip().rstrip(";")
    body = _CHECK.sub("", body)
    if schema:
        body = _without_schema(body, schema)
    columns = head["columns"] if head else None
    return f"SELECT * FROM ({body}) AS named_columns {columns}" if columns else body


def _blanked(text: str) -> str:
    """The text with its literals blanked out, every position kept."""
    return _LITERAL.sub(lambda m: "'" + "x" * (len(m.group()) - 2) + "'", text)


def _without_schema(text: str, schema: str) -> str:
    """``schema.name`` becomes ``name``; a column of a table that is called as the schema is not
    touched after its table's name."""
    name = re.escape(schema)
    qualifier = re.compile(rf"(?<![\w`.$])(?:`{name}`|{name})\s*\.\s*(?=[`\w])")
    kept, start = [], 0
    for match in qualifier.finditer(_blanked(text)):
        kept.append(text[start : match.start()])
        start = match.end()
    return "".join(kept) + text[start:]


def _without_charset(text: str) -> str:
    """``CONVERT(x USING cs)`` becomes ``x``, at any depth; text in quotes is left alone.

    Positions are looked up in a copy of the text whose literals are blanked out.
    """
    plain = _blanked(text)
    start = 0
    while match := _CONVERT.search(plain, start):
        start = inner = match.end()
        end = _closing(plain, inner)
        using = _USING.search(plain, inner, end)
        if using is None:
            continue
        start = match.start()
        text = text[:start] + text[inner : using.start()] + text[end + 1 :]
        plain = plain[:start] + plain[inner : using.start()] + plain[end + 1 :]
    return text


def _closing(plain: str, position: int) -> int:
    """The index of the parenthesis that closes the one before ``position``."""
    depth = 1
    for i in range(position, len(plain)):
        if plain[i] in "()":
            depth += 1 if plain[i] == "(" else -1
            if depth == 0:
                return i
    raise ValueError("unbalanced parentheses in view text")


def tables_named(target: TableSet, body: str) -> set[str]:
    """The tables and views a SELECT names, in lower case, as Spark's parser finds them."""
    parser = target.spark._jsparkSession.sessionState().sqlParser()
    found = _RELATION.findall(parser.parsePlan(body).treeString())
    return {parts.split(", ")[-1].lower() for parts in found}


def needed_views(target: TableSet, bodies: Mapping[str, str]) -> dict[str, set[str]]:
    """For each view the others it names. A text that Spark cannot parse names none."""
    spelled = {name.lower(): name for name in bodies}
    tables = {t.lower() for t in target.table_names()}
    needs = {}
    for name, body in bodies.items():
        try:
            named = tables_named(target, body)
        except Exception:
            named = set()
        needs[name] = {spelled[n] for n in named & spelled.keys() if n != name.lower() or n not in tables}
    return needs


def _in_circles(needs: Mapping[str, set[str]]) -> dict[str, list[str]]:
    """For each view that needs itself in the end, the views of its circle."""
    reach = {}
    for name in needs:
        seen, open_ones = set(), set(needs[name])
        while open_ones:
            seen |= open_ones
            open_ones = set().union(*(needs[n] for n in open_ones)) - seen
        reach[name] = seen
    return {n: sorted(m for m in reach[n] if n in reach[m]) for n in needs if n in reach[n]}


def register_views(target: TableSet, views: Mapping[str, str], schema: str = "") -> DataFrame:
    """Define the views on the target's tables: ``(view_name, is_success, error)``.

    ``schema`` is the source's name, which its view texts may put before every table. Each view is
    defined once, after those it names. Views that need each other are reported with their circle, and a
    view that needs a failed one with that one's name.
    """
    target.expose_tables("\n".join(views.values()))
    errors: dict[str, str] = {}
    bodies: dict[str, str] = {}
    for name, definition in views.items():
        try:
            bodies[name] = view_body(definition, schema)
        except Exception as error:
            errors[name] = str(error)
    needs = needed_views(target, bodies)
    for name, circle in _in_circles(needs).items():
        errors[name] = f"views need each other: {', '.join(circle)}"
    order = TopologicalSorter({n: needs[n] - errors.keys() for n in bodies if n not in errors})
    for name in order.static_order():
        lost = sorted(needs[name] & errors.keys())
        if lost:
            errors[name] = f"needs {', '.join(lost)}, which failed"
            continue
        try:
            target.create_view(name, bodies[name])
        except Exception as error:
            errors[name] = str(error)
    rows = [(name, "N", errors[name]) if name in errors else (name, "Y", None) for name in views]
    return small_frame(target.spark, rows, OUTCOME_SCHEMA)
