"""Record headers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def ascii_long(text: Column) -> Column:
    """Text -> bigint: characters up to 0x20 are trimmed at both ends, one sign is allowed, then digits only.

    Anything else is NULL, and so is a number that does not fit (stated difference: it never wraps).
    """
    digits = F.regexp_extract(text, r"\A[\x00-\x20]*([+-]?[0-9]+)[\x00-\x20]*\z", 1)
    return digits.try_cast("bigint")


def header_version(headers: Column, name: str, dtype: T.ArrayType) -> Column:
    """Version carried by the LAST header called `name`; missing or unparseable -> NULL (unversioned)."""
    value_type = dtype.elementType["value"].dataType
    last = F.try_element_at(F.filter(headers, lambda h: h["key"] == name), F.lit(-1))["value"]
    if isinstance(value_type, T.NumericType):
        return last.try_cast("bigint")
    return ascii_long(last.cast("string"))
