"""Conditions on keys and missing values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def all_known(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{key}`").isNotNull() for key in keys])


def any_unknown(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{key}`").isNull() for key in keys])


def is_missing(name: str, kind: T.DataType) -> Column:
    """NULL, or NaN where the type has one."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def typed_literal(value: object, kind: T.DataType) -> Column:
    """A literal of the column's own type, so a filter on it reaches the scan."""
    return F.lit(value).cast(kind)


def equals(df: DataFrame, name: str, value: object) -> Column:
    return F.col(f"`{name}`") == typed_literal(value, df.schema[name].dataType)


def check_sentinel(column: str, kind: str, value: object) -> None:
    """Reject a fill value that Spark would silently skip for its type."""
    kind = kind.lower()
    fits = (kind == "string" and isinstance(value, str)) or (
        kind in _WHOLE and isinstance(value, int) and not isinstance(value, bool)
    )
    if not fits:
        raise TypeError(f"sentinel {value!r} does not fit column {column} of type {kind}")
