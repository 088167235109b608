"""Fitting rows to the column types of a target table.

Everything here is built-in column expressions, so a conformed read stays one generated stage over
the scan. A value that cannot be held by its target column becomes NULL in ``conform``,
is counted by ``fit_report`` and is kept with its reason by ``split_valid``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablehaul.functions.binary import bits, hex_bytes
from tablehaul.functions.frames import small_frame
from tablehaul.functions.names import quoted
from tablehaul.functions.types import (
    ColumnSpec,
    bit_width,
    default_text,
    spec_metadata,
    target_type,
)
from tablehaul.shared import stage as staged

REJECT_REASON = "reject_reason"
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
# Decimal digits that hold every value of a type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
REPORT_SCHEMA = "column_name string, rule string, violations bigint"


def _source_types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name.lower(): f.dataType for f in df.schema.fields}


def _source_type(types: Mapping[str, T.DataType], spec: ColumnSpec) -> T.DataType:
    try:
        return types[spec.column_name.lower()]
    except KeyError:
        raise ValueError(f"the input has no column {spec.column_name!r}") from None


def converted(spec: ColumnSpec, source: T.DataType) -> Column:
    """The column as its target type, NULL where the value has no such form."""
    value = F.col(quoted(spec.column_name))
    wanted = target_type(spec)
    if source == wanted:
        return value
    if spec.word == "BIT" and isinstance(source, T.BinaryType):
        return bits(value, bit_width(spec))
    if isinstance(wanted, T.BinaryType) and isinstance(source, T.StringType):
        return hex_bytes(value)
    if isinstance(source, _TIMES) and spec.word == "TIME":
        # Drivers hand a time of day over as a time on some day.
        digits = spec.datetime_precision or 0
        return F.date_format(value, "HH:mm:ss" + ("." + "S" * digits if digits else ""))
    if isinstance(source, _TIMES) and spec.word == "YEAR":
        return F.year(value)
    return value.try_cast(wanted)


def conform(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """The columns of the target table: taken by name, in order, lower-case and typed.

    Each field keeps its column record as metadata.
    """
    types = _source_types(df)
    return df.select(
        *[
            converted(spec, _source_type(types, spec)).alias(
                spec.column_name.lower(), metadata=spec_metadata(spec)
            )
            for spec in columns
        ]
    )


def _is_fractional(kind: T.DataType) -> bool:
    if isinstance(kind, T.DecimalType):
        return kind.scale > 0
    return isinstance(kind, (T.FloatType, T.DoubleType))


def _violations(
    spec: ColumnSpec, source: T.DataType, length_unit: str
) -> list[tuple[str, Column]]:
    """The rules a column has to keep, each with the test that finds a breach."""
    value = F.col(quoted(spec.column_name))
    wanted = target_type(spec)
    rules: list[tuple[str, Column]] = []
    if not spec.is_nullable:
        rules.append(("not_null", value.isNull()))
    if spec.max_length is not None:
        length = F.char_length if length_unit == "char" else F.octet_length
        rules.append(("length", length(value.cast("string")) > F.lit(spec.max_length)))
    is_bits = spec.word == "BIT" and isinstance(source, T.BinaryType)
    if source == wanted or is_bits or _always_fits(source, wanted):
        return rules
    result = converted(spec, source)
    lost = value.isNotNull() & result.isNull()
    if isinstance(wanted, T.DecimalType):
        if isinstance(source, (T.NumericType, T.StringType)):
            is_number = value.try_cast("double").isNotNull()
            rules.append(("decimal", lost & is_number))
            if isinstance(source, T.StringType):
                rules.append(("cast", lost & ~is_number))
            return rules
    if isinstance(wanted, T.IntegralType) and _is_fractional(source):
        lost = lost | (value.isNotNull() & (F.floor(value) != value))
    rules.append(("cast", lost))
    return rules


def _always_fits(source: T.DataType, wanted: T.DataType) -> bool:
    """Whether no value can be lost, so that a test would only cost time."""
    if isinstance(source, _TIMES):
        return isinstance(wanted, (T.TimestampType, T.TimestampNTZType, T.StringType))
    if isinstance(source, T.IntegralType) and isinstance(wanted, T.IntegralType):
        return _DIGITS[type(source)] <= _DIGITS[type(wanted)]
    if isinstance(wanted, T.DecimalType):
        whole = wanted.precision - wanted.scale
        if isinstance(source, T.DecimalType):
            return source.precision - source.scale < whole or (
                source.precision - source.scale == whole and source.scale <= wanted.scale
            )
        return isinstance(source, T.IntegralType) and _DIGITS[type(source)] <= whole
    if isinstance(wanted, T.DoubleType):
        return isinstance(source, T.NumericType)
    return isinstance(wanted, T.StringType)


def _all_violations(
    df: DataFrame, columns: Sequence[ColumnSpec], length_unit: str
) -> list[tuple[str, str, Column]]:
    types = _source_types(df)
    return [
        (spec.column_name.lower(), rule, test)
        for spec in columns
        for rule, test in _violations(spec, _source_type(types, spec), length_unit)
    ]


def fit_report(
    df: DataFrame, columns: Sequence[ColumnSpec], length_unit: str = "char"
) -> DataFrame:
    """How many values break each rule of each column, counted in one scan."""
    rules = _all_violations(df, columns, length_unit)
    if not rules:
        return small_frame(df.sparkSession, [], REPORT_SCHEMA)
    counts = df.agg(*[F.count_if(test).alias(f"r{i}") for i, (_, _, test) in enumerate(rules)])
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(rule).alias("rule"),
                F.col(f"r{i}").alias("violations"),
            )
            for i, (name, rule, _) in enumerate(rules)
        ]
    )
    return counts.select(F.inline(lines))


def with_reject_reason(
    df: DataFrame, columns: Sequence[ColumnSpec], length_unit: str = "char"
) -> DataFrame:
    """The input with ``column:rule`` of every breach, empty where the row fits."""
    if REJECT_REASON in {c.lower() for c in df.columns}:
        raise ValueError(f"the input already has a column {REJECT_REASON!r}")
    reasons = [
        F.when(test, F.lit(f"{name}:{rule}"))
        for name, rule, test in _all_violations(df, columns, length_unit)
    ]
    reason = F.concat_ws(",", *reasons) if reasons else F.lit("")
    return df.withColumn(REJECT_REASON, reason)


def split_marked(marked: DataFrame, columns: Sequence[ColumnSpec]) -> tuple[DataFrame, DataFrame]:
    """Rows that fit, conformed, and rows that do not, as they came with their reason."""
    reason = F.col(REJECT_REASON)
    return conform(marked.filter(reason == ""), columns), marked.filter(reason != "")


def split_valid(
    df: DataFrame,
    columns: Sequence[ColumnSpec],
    length_unit: str = "char",
    stage: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``: every input row is in exactly one of the two.

    Both are filters over the same input. ``stage`` writes the marked rows to the shared
    folder first, for inputs that must not be read twice, such as a live database.
    """
    marked = with_reject_reason(df, columns, length_unit)
    if stage:
        marked = staged(marked, "marked")
    return split_marked(marked, columns)


def with_defaults(new_rows: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Fill the columns the input does not supply, then conform. A supplied NULL stays NULL."""
    supplied = {c.lower() for c in new_rows.columns}
    added = []
    for spec in columns:
        if spec.column_name.lower() in supplied:
            continue
        text, is_expression = default_text(spec)
        if text is None and not spec.is_nullable:
            raise ValueError(f"column {spec.column_name!r} is NOT NULL and has no default")
        value = F.expr(text) if is_expression and text is not None else F.lit(text)
        wanted = target_type(spec)
        if text is not None and not is_expression and isinstance(wanted, T.BinaryType):
            value = hex_bytes(value)
        added.append(value.cast(wanted).alias(spec.column_name))
    return conform(new_rows.select("*", *added), columns)
