"""Scalar value encoding (F10-F13) and the per-value byte estimate.

Everything is written to give the same text whatever the session time zone, ANSI mode or base64
chunking setting is, because the caller's session is not ours to configure.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType, T.TimeType)


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, _TEMPORAL)


def utc_wall_clock(ts: Column) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ holding the UTC reading, without going through the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)


def _clock_text(text: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss[.f]' -> 'yyyy-MM-ddTHH:mm:ss[.SSS]Z', millis shown only when not zero."""
    seconds = F.replace(F.substring_index(text, ".", 1), F.lit(" "), F.lit("T"))
    fraction = F.when(
        F.instr(text, ".") > 0, F.rpad(F.substring(F.substring_index(text, ".", -1), 1, 3), 3, "0")
    ).otherwise(F.lit("000"))
    return F.when(fraction == "000", F.concat(seconds, F.lit("Z"))).otherwise(
        F.concat(seconds, F.lit("."), fraction, F.lit("Z"))
    )


def iso_instant(col: Column, dtype: T.DataType) -> Column:
    """Temporal value -> ISO-8601 UTC instant text. Sub-millisecond digits are cut."""
    if isinstance(dtype, T.TimestampType):
        return _clock_text(utc_wall_clock(col).cast("string"))
    if isinstance(dtype, T.TimestampNTZType):
        return _clock_text(col.cast("string"))
    if isinstance(dtype, T.DateType):
        return F.concat(col.cast("string"), F.lit("T00:00:00Z"))
    if isinstance(dtype, T.TimeType):
        return _clock_text(F.concat(F.lit("1970-01-01 "), col.cast("string")))
    raise TypeError(f"not a temporal type: {dtype}")


def decimal_text(col: Column) -> Column:
    """Decimal -> plain text; the cast alone may give '1E-8' outside ANSI mode."""
    text = col.cast("string")
    plain = F.concat(
        F.when(col < 0, F.lit("-0")).otherwise(F.lit("0")),
        F.substring((F.abs(col) + F.lit(1)).cast("string"), 2, 60),
    )
    return F.when(F.instr(text, "E") > 0, plain).otherwise(text)


def base64_text(col: Column) -> Column:
    """Binary -> base64 on one line."""
    return F.translate(F.base64(col), "\r\n", "")


def encoded_type(dtype: T.DataType) -> T.DataType:
    """The type of a scalar after encoding."""
    if isinstance(dtype, (T.BinaryType, T.DecimalType)) or is_temporal(dtype):
        return T.StringType()
    if isinstance(dtype, (T.ByteType, T.ShortType)):
        return T.IntegerType()
    if isinstance(dtype, (T.CharType, T.VarcharType)):
        return T.StringType()
    return dtype


def encode(col: Column, dtype: T.DataType) -> Column:
    """One scalar value as a document holds it."""
    if is_temporal(dtype):
        return iso_instant(col, dtype)
    if isinstance(dtype, T.DecimalType):
        return decimal_text(col)
    if isinstance(dtype, T.BinaryType):
        return base64_text(col)
    if isinstance(dtype, (T.ByteType, T.ShortType)):
        return col.cast("int")
    return col


def encode_text(col: Column, dtype: T.DataType) -> Column:
    """One scalar value as text, for the long form, where all fields share one value type."""
    if isinstance(dtype, T.VariantType):
        return F.try_variant_get(col, "$", "string")
    return encode(col, dtype).cast("string")


def utf16_bytes(text: Column) -> Column:
    """Two bytes per UTF-16 unit: what a text of this length is estimated at."""
    return F.octet_length(F.encode(text, "UTF-16BE")).cast("long")


def value_bytes(col: Column, dtype: T.DataType) -> Column:
    """Estimated size of one non-null value: text by length, numbers and booleans 16, anything else 32."""
    if isinstance(dtype, T.StringType):
        return utf16_bytes(col)
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return F.lit(16).cast("long")
    return F.lit(32).cast("long")
