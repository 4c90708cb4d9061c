"""Bronze to silver: every table, all parts of the chosen days, one upsert each."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from silvermill.operators.quality import quality_report
from silvermill.operators.rows import append_union
from silvermill.plans.catalog import CREDITS_TABLES, MOVIES_TABLES
from silvermill.sources.bronze import SEQ, read_each_part, read_parts
from silvermill.spec import TableSpec
from silvermill.tables.delta import DeltaSilverTable
from silvermill.tables.silver import SilverTable

REPORT = "table string, source string, rows_in bigint, seconds double"


def silver_table(
    spark: SparkSession, root: str, spec: TableSpec, slices: int = 16,
    null_safe_keys: bool = False,
) -> SilverTable:
    return SilverTable(
        spark, f"{root}/{spec.name}", spec.keys, spec.slice_by, slices, null_safe_keys
    )


def delta_table(
    spark: SparkSession, root: str, spec: TableSpec, slices: int = 0
) -> DeltaSilverTable:
    """For `run_pipeline(open_table=...)`; Delta needs no slices."""
    return DeltaSilverTable(spark, f"{root}/{spec.name}", spec.keys)


def table_rows(
    spark: SparkSession,
    spec: TableSpec,
    bronze_root: str,
    days: Sequence[str | date] | None,
    mixed_types: bool = False,
) -> DataFrame | None:
    """What the parts of some days hold for one table, or None without parts."""
    if mixed_types:
        frames = read_each_part(spark, bronze_root, spec.source, days)
    else:
        frame = read_parts(spark, bronze_root, spec.source, days)
        frames = [] if frame is None else [frame]
    if not frames:
        return None
    return append_union(*[spec.transform(frame, carry=[SEQ]) for frame in frames])


def run_pipeline(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    bronze_root: str,
    silver_root: str,
    days: Iterable[str | date] | None = None,
    slices: int = 16,
    on_duplicate: str = "error",
    order_by: Mapping[str, Sequence[str]] | None = None,
    bootstrap: str = "if_missing",
    mixed_types: bool = False,
    replace_sentinel: bool = False,
    batch: str | None = None,
    parallel: int = 1,
    open_table: Callable[..., SilverTable | DeltaSilverTable] = silver_table,
) -> DataFrame:
    """Load the tables in order; the first failure ends the run.

    With `parallel` above 1, that many tables load at a time, so that one fills
    the cores that the last tasks of another leave idle; a failure then lets the
    tables that are loading finish and starts no more. The error that is raised
    has the report's rows of the tables that did load in `finished`.

    Each table scans only its own columns of the bronze parts, so six tables
    from one source read it about once in all, and nothing needs caching.
    `order_by` names, per table, the columns that decide between rows of one
    part with the same key when `on_duplicate` is "latest". `mixed_types` is
    for parts whose Parquet types differ: those of one schema share a scan.
    """
    days = None if days is None else list(days)

    def load(spec: TableSpec) -> tuple[str, str, int, float]:
        started = time.monotonic()
        rows = table_rows(spark, spec, bronze_root, days, mixed_types)
        rows_in = 0
        if rows is not None:
            rows_in = open_table(spark, silver_root, spec, slices).apply(
                rows,
                seq=SEQ,
                on_duplicate=on_duplicate,
                order_by=(order_by or {}).get(spec.name, ()),
                bootstrap=bootstrap,
                **({"sentinels": dict(spec.sentinels)}
                   if replace_sentinel and spec.sentinels else {}),
                **({"batch": batch} if batch else {}),
            )
        return spec.name, spec.source, rows_in, time.monotonic() - started

    report = _load_all(spark, specs, load, parallel)
    return spark.createDataFrame(report, REPORT)


def _load_all(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    load: Callable[[TableSpec], tuple],
    parallel: int,
) -> list[tuple]:
    """The report's rows, in the order of the specs."""
    waiting, running, done = list(enumerate(specs)), {}, {}
    with ThreadPoolExecutor(parallel) as pool:
        failed = None
        while running or (waiting and failed is None):
            while waiting and len(running) < parallel and failed is None:
                place, spec = waiting.pop(0)
                running[pool.submit(inheritable_thread_target(spark)(load), spec)] = place
            for each in wait(running, return_when=FIRST_COMPLETED).done:
                place = running.pop(each)
                if each.exception() is None:
                    done[place] = each.result()
                elif failed is None:
                    failed = each.exception()
    report = [done[place] for place in sorted(done)]
    if failed is not None:
        failed.finished = report
        raise failed
    return report


def run_daily(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    days: Iterable[str | date] | None = None,
    **options,
) -> DataFrame:
    """The whole job: the credits tables, then the movies tables. No movies
    table starts before all credits tables are loaded, also side by side."""
    days = None if days is None else list(days)
    reports = [
        run_pipeline(spark, stage, bronze_root, silver_root, days, **options)
        for stage in (CREDITS_TABLES, MOVIES_TABLES)
    ]
    return reports[0].unionByName(reports[1])


def append_pipeline(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    bronze_root: str,
    silver_root: str,
    days: Iterable[str | date] | None = None,
    slices: int = 16,
    open_table: Callable[..., SilverTable | DeltaSilverTable] = silver_table,
) -> None:
    """Add the rows of all parts without matching keys; loading twice doubles."""
    days = None if days is None else list(days)
    for spec in specs:
        rows = table_rows(spark, spec, bronze_root, days)
        if rows is not None:
            open_table(spark, silver_root, spec, slices).append(rows, seq=SEQ)


def silver_quality(
    spark: SparkSession,
    silver_root: str,
    specs: Sequence[TableSpec],
    open_table: Callable[..., SilverTable | DeltaSilverTable] = silver_table,
) -> DataFrame:
    """The quality report of silver tables: one row and one pass per table."""
    return quality_report({
        spec.name: (open_table(spark, silver_root, spec).read(), spec) for spec in specs
    })


def load_counts(rows: DataFrame, seq: str = SEQ, before: int = 0) -> DataFrame:
    """Per part: its rows, and the rows loaded up to and including it.

    One grouped count; the running total is over one row per part.
    """
    per_part = rows.groupBy(F.col(seq).alias("part_seq")).agg(
        F.count(F.lit(1)).alias("new_rows")
    )
    running = F.sum("new_rows").over(Window.orderBy("part_seq"))
    return per_part.select("part_seq", "new_rows", (running + before).alias("merged_rows"))
