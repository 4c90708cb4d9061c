"""Names of bronze parts: `<table>/<table>_part_<yyyyMMdd>-<HHmmss>.parquet`."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, functions as F

# How part files are named.
DATE_FORMAT = "yyyyMMdd"
PART_NAME = r"_part_(\d{8})-(\d{6})\.parquet"


def day_text(day: str | date) -> str:
    return day if isinstance(day, str) else day.strftime("%Y%m%d")


def today() -> Column:
    return F.date_format(F.current_date(), DATE_FORMAT)


def part_glob(root: str, table: str, days: Iterable[str | date] | None = None) -> str:
    """One path pattern for all parts of a table, or for the parts of some days."""
    if days is None:
        return f"{root}/{table}/{table}_part_*-*.parquet"
    names = [day_text(day) for day in days]
    choice = names[0] if len(names) == 1 else "{" + ",".join(names) + "}"
    return f"{root}/{table}/{table}_part_{choice}-*.parquet"


def part_date(path: Column) -> Column:
    return F.regexp_extract(path, PART_NAME, 1)


def part_time(path: Column) -> Column:
    return F.regexp_extract(path, PART_NAME, 2)


def part_seq(path: Column) -> Column:
    """The part's place in time as one number, yyyyMMddHHmmss.

    The name decides, not the file's modification time: parts may land late.
    """
    return F.concat(part_date(path), part_time(path)).try_cast("bigint")
