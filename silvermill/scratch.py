"""Intermediate tables in the folder that the cluster shares.

A written table cuts lineage and outlives executors, unlike a cached frame.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


def _named(spark: SparkSession) -> str | None:
    context = spark.sparkContext
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )


def scratch_root(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; the library names none of its own."""
    named = _named(spark)
    if not named:
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that every executor can reach"
        )
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def name_local_scratch(spark: SparkSession) -> None:
    """For queries run on a plain local master whose session names no folder."""
    if not _named(spark) and re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="silvermill-"))


def with_scratch(query: Callable) -> Callable:
    """A registered query that has a scratch folder on a plain local master."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str):
        name_local_scratch(spark)
        return query(spark, sf_dir)

    return run


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder, in the denser zstd, and read back."""
    spark = frame.sparkSession
    folder = new_folder(spark, label)
    frame.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)
