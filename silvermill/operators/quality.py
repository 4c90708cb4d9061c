"""Counts and checks on silver tables, one pass over each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from silvermill.functions.checks import all_known, equals, is_missing
from silvermill.functions.json_arrays import is_malformed
from silvermill.spec import TableSpec


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def filtered_count(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.count_if(condition).alias("rows"))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """How many different values a column has, NULL being one of them."""
    has_null = F.max(F.col(column).isNull().cast("int"))
    return df.agg(
        (F.count_distinct(column) + F.coalesce(has_null, F.lit(0))).alias("distinct_values")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: how many values are NULL, or NaN where that exists."""
    counts = df.agg(*[
        F.count_if(is_missing(f.name, f.dataType)).alias(f"_{i}")
        for i, f in enumerate(df.schema.fields)
    ])
    pairs = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"_{i}").alias("null_count"))
        for i, name in enumerate(df.columns)
    ]
    return counts.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def schema_rows(df: DataFrame) -> DataFrame:
    """One row per column: its place, name, type, and how often it has a value."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"_{i}").alias("value_count"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def table_quality(
    df: DataFrame, name: str, keys: Sequence[str], sentinels: Mapping[str, object]
) -> DataFrame:
    """Rows, rows with a NULL key, and rows with a sentinel in a key."""
    is_sentinel = reduce(
        lambda a, b: a | b,
        [equals(df, c, v) for c, v in sentinels.items()],
        F.lit(False),
    )
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~all_known(keys)).alias("null_key_rows"),
        F.count_if(is_sentinel).alias("sentinel_rows"),
    )


def quality_report(tables: Mapping[str, tuple[DataFrame, TableSpec]]) -> DataFrame:
    reports = [
        table_quality(df, name, spec.keys, spec.sentinels)
        for name, (df, spec) in tables.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def malformed_report(bronze: DataFrame, specs: Sequence[TableSpec]) -> DataFrame:
    """Per array column: rows, rows without text, and rows that cannot be parsed.

    All three end as a sentinel row in silver, so they are told apart here.
    """
    arrays = [spec.array for spec in specs if spec.array is not None]
    measures = []
    for i, array in enumerate(arrays):
        column = F.col(f"`{array.column}`")
        blank = column.isNull() | (F.trim(column) == "")
        measures += [
            F.count_if(blank).alias(f"_blank{i}"),
            F.count_if(is_malformed(column, array.element)).alias(f"_malformed{i}"),
        ]
    counts = bronze.agg(F.count(F.lit(1)).alias("rows"), *measures)
    found = [
        F.struct(
            F.lit(array.column).alias("column_name"),
            F.col("rows"),
            F.col(f"_blank{i}").alias("blank_rows"),
            F.col(f"_malformed{i}").alias("malformed_rows"),
        )
        for i, array in enumerate(arrays)
    ]
    return counts.select(F.explode(F.array(*found)).alias("f")).select("f.*")
