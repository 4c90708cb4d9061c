"""Columns that hold a JSON array of flat objects as text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def element_type(fields: Mapping[str, str]) -> str:
    inner = ", ".join(f"`{name}`: {kind}" for name, kind in fields.items())
    return f"array<struct<{inner}>>"


def parse_array(column: Column, fields: Mapping[str, str]) -> Column:
    """Parse to an array of structs; text that is no array or object becomes NULL."""
    return F.from_json(column, element_type(fields))


def is_malformed(column: Column, fields: Mapping[str, str]) -> Column:
    """True for text that should hold an array but cannot be parsed as one."""
    empty = F.trim(column).isin("", "null")
    return column.isNotNull() & ~empty & parse_array(column, fields).isNull()
