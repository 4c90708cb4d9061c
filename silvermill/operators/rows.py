"""Sets, sorting and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from silvermill.scratch import stored

#: Spark's `monotonically_increasing_id` counts a partition's rows in so many bits.
_ROW_BITS = 33


def append_union(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, duplicates kept."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def sort_rows(df: DataFrame, by: Sequence[str], descending: bool = False) -> DataFrame:
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in by]
    return df.orderBy(*order)


def top_rows(
    df: DataFrame, by: Sequence[str], n: int = 20, descending: bool = False
) -> DataFrame:
    """The first n rows in order: each task keeps n, nothing is sorted whole."""
    return sort_rows(df, by, descending).limit(n)


def rows_between(
    df: DataFrame, by: Sequence[str], first: int, last: int, descending: bool = False
) -> DataFrame:
    """Rows `first` to `last`, from 1, of the whole order, with their `row_number`.

    Rows are dealt to ranges of the order and sorted within them; a row's number is
    its place in its range and the sizes of the ranges before, one number each,
    which come to the driver. So no task sorts or counts all rows, and a page far
    down costs no more than the first. The sorted rows are written once, and only
    those of the page are read back, by a filter that reaches the scan. Rows that are equal in
    `by` stand in any order; give columns that tell all rows apart.
    """
    if first < 1 or last < first:
        raise ValueError(f"rows {first} to {last} are no page")
    spark = df.sparkSession
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in by]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = "_place" + "_" * max(map(len, df.columns), default=0)
    placed = stored(
        df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        .withColumn(place, F.monotonically_increasing_id()),
        "page",
    )
    part = F.shiftright(place, _ROW_BITS)
    sizes = placed.groupBy(part.alias("part")).count().orderBy("part").collect()
    before, pieces = 0, []
    for number, size in sizes:
        low, high = max(first - before, 1), min(last - before, size)
        if low <= high:  # a piece of the page lies in this range
            start = (number << _ROW_BITS) - 1
            pieces.append(
                placed.where(F.col(place).between(start + low, start + high))
                .withColumn("row_number", F.col(place) - F.lit(start - before))
            )
        before += size
    page = append_union(*pieces) if pieces else placed.limit(0).withColumn("row_number", F.col(place))
    return page.drop(place)


def preview(df: DataFrame, n: int = 20, truncate: bool = True) -> None:
    df.show(n, truncate=truncate)
