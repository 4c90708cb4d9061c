"""Small tables given as Python rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def local_rows(
    spark: SparkSession, rows: Iterable[tuple], columns: Sequence[str] | str
) -> DataFrame:
    """`columns` is a list of names, or a DDL schema where types must be exact."""
    return spark.createDataFrame(list(rows), columns)
