"""One row per element of a JSON array column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from silvermill.functions.json_arrays import parse_array
from silvermill.operators.project import filled, typed_column

if TYPE_CHECKING:
    from silvermill.spec import ColumnSpec


def normalize_json_array(
    df: DataFrame,
    parents: Sequence[ColumnSpec],
    array: str,
    element: Mapping[str, str],
    fields: Sequence[str],
    sentinels: Mapping[str, object] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Parse, explode and flatten `array`, keeping the parent columns.

    A parent whose array is empty, missing or unreadable keeps one row with the
    sentinel, so no parent is lost. Nothing is shuffled: each row of `df` is
    handled where it is read, only the parents and `array` are read, and only
    the wanted fields are parsed.
    """
    sentinels = sentinels or {}
    wanted = {field: element[field] for field in fields}
    exploded = df.select(
        *[typed_column(df, spec) for spec in parents],
        *carry,
        F.explode_outer(parse_array(F.col(f"`{array}`"), wanted)).alias("_item"),
    )
    parent_names = [spec.name for spec in parents]
    return exploded.select(
        *[filled(F.col(f"`{n}`"), sentinels.get(n)).alias(n) for n in parent_names],
        *[filled(F.col("_item").getField(f), sentinels.get(f)).alias(f) for f in fields],
        *carry,
    )
