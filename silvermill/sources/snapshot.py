"""Unmodified copies of a bronze frame under a dated path."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from silvermill.functions.parts import day_text


def write_snapshot(
    df: DataFrame, root: str, day: str | date, sub: str = "", fmt: str = "parquet"
) -> str:
    path = f"{root}/{day_text(day)}" + (f"/{sub}" if sub else "")
    df.write.mode("overwrite").format(fmt).save(path)
    return path
