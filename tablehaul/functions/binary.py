"""Binary and bit columns as text and numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.functions.names import quoted, replace_columns

HEX_PREFIX = "\\x"


def hex_text(value: Column) -> Column:
    return F.concat(F.lit(HEX_PREFIX), F.hex(value))


def hex_bytes(value: Column) -> Column:
    """Bytes of ``\\x`` text; text without the prefix stands for its own UTF-8 bytes."""
    return F.when(
        F.startswith(value, F.lit(HEX_PREFIX)), F.unhex(F.substring(value, 3, 2147483647))
    ).otherwise(F.encode(value, "UTF-8"))


def bits(value: Column, width: int) -> Column:
    """The value of a BIT(width) column held as big-endian bytes."""
    if not 1 <= width <= 64:
        raise ValueError(f"BIT width {width} is outside 1..64")
    number = F.conv(F.hex(value), 16, 10)
    if width == 1:
        return number != "0"
    return number.cast("decimal(20,0)" if width == 64 else "bigint")


def encode_binary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Binary columns as ``\\x`` followed by hex digits. NULL stays NULL."""
    return replace_columns(df, {c: hex_text(F.col(quoted(c))) for c in cols})


def decode_binary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Inverse of :func:`encode_binary`."""
    return replace_columns(df, {c: hex_bytes(F.col(quoted(c))) for c in cols})


def decode_bits(df: DataFrame, cols: Sequence[str], width: int) -> DataFrame:
    """BIT(1) columns as booleans, wider ones as numbers."""
    return replace_columns(df, {c: bits(F.col(quoted(c)), width) for c in cols})
