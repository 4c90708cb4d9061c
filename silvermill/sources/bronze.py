"""Bronze parts: Parquet files or folders named by table, date and time."""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from silvermill.functions.parts import part_date, part_glob, part_seq, part_time
from silvermill.sources.filesystem import any_match

SEQ = "_seq"


def read_parts(
    spark: SparkSession,
    root: str,
    table: str,
    days: Iterable[str | date] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame | None:
    """All parts of the given days in one scan, or None when there are none.

    The hidden column `_seq` says which part a row came from. Without `schema`,
    the columns are those of all parts together, whichever file is read first:
    a Spark job reads the footers, and a part that lacks a column gives NULL.
    Types that differ between parts are an error; see `read_each_part`.
    """
    pattern = part_glob(root, table, days)
    if not any_match(spark, pattern):
        return None
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    return with_part_seq(reader.parquet(pattern))


def read_each_part(
    spark: SparkSession,
    root: str,
    table: str,
    days: Iterable[str | date] | None = None,
) -> list[DataFrame]:
    """A frame per distinct schema among the parts, each with its own types.

    A column can be whole numbers in one part and, for want of a value, floating
    ones in the next; a single scan needs one type for all. Parts with the same
    columns and types share a scan. A column that only other parts have is NULL.
    The parts' names and footers come to the driver, their rows do not.
    """
    pattern = part_glob(root, table, days)
    if not any_match(spark, pattern):
        return []
    parts = list_parts(spark, root, table, days).orderBy("part_seq").collect()
    by_schema: dict[str, list[str]] = {}
    columns = {}
    for part in parts:
        path = f"{root}/{table}/{table}_part_{part.part_date}-{part.part_time}.parquet"
        schema = spark.read.option("mergeSchema", "true").parquet(path).schema
        by_schema.setdefault(schema.json(), []).append(path)
        for field in schema.fields:
            columns.setdefault(field.name, field.dataType)
    return [
        with_part_seq(spark.read.schema(StructType.fromJson(json.loads(text))).parquet(*paths))
        .select("*", *[
            F.lit(None).cast(kind).alias(name)
            for name, kind in columns.items()
            if name not in {f["name"] for f in json.loads(text)["fields"]}
        ])
        for text, paths in by_schema.items()
    ]


def with_part_seq(frame: DataFrame) -> DataFrame:
    return frame.select("*", part_seq(F.col("_metadata.file_path")).alias(SEQ))


def list_parts(
    spark: SparkSession,
    root: str,
    table: str,
    days: Iterable[str | date] | None = None,
) -> DataFrame:
    """One row per part: its date, its time and its place in the load order."""
    path = F.col("path")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(part_glob(root, table, days))
        .select(
            part_date(path).alias("part_date"),
            part_time(path).alias("part_time"),
            part_seq(path).alias("part_seq"),
        )
        .distinct()
    )
