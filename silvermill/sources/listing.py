"""What lies under a path."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from silvermill.sources.filesystem import any_match


def list_objects(spark: SparkSession, path: str, name_glob: str = "*") -> DataFrame:
    """Path, size and modification time of every file. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def objects_with_prefix(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """Files under `root` whose path relative to it starts with `prefix`. Only
    what fits the prefix is listed. Glob characters in it are taken as they are."""
    plain = re.sub(r"([\[\]{}*?\\,])", r"\\\1", prefix)
    start = f"{root.rstrip('/')}/{plain}*"
    if not any_match(spark, start):
        return list_objects(spark, root).limit(0)
    return list_objects(spark, start)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None when the path is absent or has no data file."""
    if not any_match(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
