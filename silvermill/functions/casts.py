"""Casts that turn a value they cannot read into NULL, under ANSI mode too."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_WHOLE = ("tinyint", "smallint", "int", "integer", "bigint", "long")


def lenient_cast(column: Column, source: T.DataType, target: str) -> Column:
    """Cast without failing. Decimal text such as '1.7' is cut to a whole number.

    A cast that cannot fail stays a plain one, which filters can see through.
    """
    target = target.lower()
    if target == "string" or source.simpleString() == target:
        return column.cast(target)
    if isinstance(source, T.StringType) and target in _WHOLE:
        whole = F.regexp_extract(column, r"^\s*([+-]?\d+)(\.\d*)?\s*$", 1)
        return whole.try_cast(target)
    return column.try_cast(target)


def lenient_date(column: Column, pattern: str) -> Column:
    return F.try_to_date(column, pattern)
