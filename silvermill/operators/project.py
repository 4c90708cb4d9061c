"""Projections: choose, rename, cast, drop, flatten, fill."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F, types as T

from silvermill.functions.casts import lenient_cast, lenient_date
from silvermill.functions.checks import check_sentinel

if TYPE_CHECKING:
    from silvermill.spec import ColumnSpec


def typed_column(df: DataFrame, spec: ColumnSpec) -> Column:
    """The column under its new name and type. A rename of a column that is
    already renamed is no error, as with `withColumnRenamed`."""
    origin = spec.origin if spec.origin in df.columns else spec.name
    kind = df.schema[origin].dataType
    column = F.col(f"`{origin}`")
    if spec.type.lower() == "date" and isinstance(kind, T.StringType):
        return lenient_date(column, spec.date_format or "yyyy-M-d").alias(spec.name)
    return lenient_cast(column, kind, spec.type).alias(spec.name)


def filled(column: Column, value: object | None) -> Column:
    return column if value is None else F.coalesce(column, F.lit(value))


def typed_projection(
    df: DataFrame,
    columns: Sequence[ColumnSpec],
    sentinels: Mapping[str, object] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Choose, rename and cast in one projection, so the scan reads only these."""
    sentinels = sentinels or {}
    out = [
        filled(typed_column(df, spec), sentinels.get(spec.name)).alias(spec.name)
        for spec in columns
    ]
    return df.select(*out, *carry)


def flatten_struct(df: DataFrame, struct: str, fields: Iterable[str] | None = None) -> DataFrame:
    """Replace a struct column by its fields."""
    fields = list(fields or df.schema[struct].dataType.names)
    keep = [F.col(f"`{c}`") for c in df.columns if c != struct]
    return df.select(*keep, *[F.col(struct).getField(f).alias(f) for f in fields])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename; names that the frame lacks are passed over."""
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def fill_sentinels(df: DataFrame, sentinels: Mapping[str, object]) -> DataFrame:
    """Fill missing values, for instance of a table that was loaded unfilled."""
    for column, value in sentinels.items():
        check_sentinel(column, df.schema[column].dataType.simpleString(), value)
    return df.select(
        *[filled(F.col(f"`{c}`"), sentinels.get(c)).alias(c) for c in df.columns]
    )
