"""Profiles that add up: counts and sketches of a column's values, part by part.

A sketch (HyperLogLog) of one part's values has a bounded size, and sketches of
parts merge into that of the whole. So a new part costs one pass over itself, where
an exact distinct count (`quality.distinct_count`) reads everything again.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import DataFrame, functions as F

from silvermill.functions.checks import is_missing

#: 2 to this many counters a sketch; a sketch has at most so many bytes, and some.
LG_COUNTERS = 12
PROFILE = "column_name string, rows bigint, missing bigint, nulls bigint, sketch binary"


def error_bound(lg_counters: int = LG_COUNTERS, deviations: float = 4.0) -> float:
    """The share of the true count by which an estimate may be off, at so many standard
    deviations of a HyperLogLog estimate; small counts are off by less."""
    return deviations * 1.04 / sqrt(2**lg_counters)


def partial_profile(
    df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None,
    lg_counters: int = LG_COUNTERS,
) -> DataFrame:
    """Per part (`by`) and column: rows, missing values (NULL or NaN), NULLs, and a sketch.

    One pass, aggregated before the shuffle; what is shuffled is one row per task and
    part, however many rows share a part. Values of any type but maps are sketched by a
    64-bit hash. Without `by`, an empty frame has one row per column; with it, none.
    """
    fields = [f for f in df.schema.fields if f.name not in by and (columns is None or f.name in columns)]
    measures = []
    for i, f in enumerate(fields):
        column = F.col(f"`{f.name}`")
        value = F.when(column.isNotNull(), F.xxhash64(column))
        measures += [
            F.count_if(is_missing(f.name, f.dataType)).alias(f"_missing{i}"),
            F.count_if(column.isNull()).alias(f"_nulls{i}"),
            F.hll_sketch_agg(value, F.lit(lg_counters)).alias(f"_sketch{i}"),
        ]
    parts = [F.col(f"`{name}`") for name in by]
    counts = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("_rows"), *measures)
    found = [
        F.struct(
            F.lit(f.name).alias("column_name"), F.col("_rows").alias("rows"),
            F.col(f"_missing{i}").alias("missing"), F.col(f"_nulls{i}").alias("nulls"),
            F.col(f"_sketch{i}").alias("sketch"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(*parts, F.inline(F.array(*found)))


def merged_profile(partials: DataFrame) -> DataFrame:
    """Per column, over all parts: rows, missing, and about how many different values it
    has, NULL being one of them, as in `distinct_count`. The counts are exact. An estimate
    depends a little on the order in which sketches meet, so two runs may differ by
    less than `error_bound`."""
    return partials.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("missing").alias("missing"),
        (
            F.hll_sketch_estimate(F.hll_union_agg("sketch"))
            + (F.sum("nulls") > 0).cast("int")
        ).alias("distinct_estimate"),
    )
