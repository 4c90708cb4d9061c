"""A batch of bronze rows, reduced and written once before the table changes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silvermill.functions.checks import all_known, any_unknown
from silvermill.operators.parts import (
    check_parts,
    newest_of_parts,
    repeated_keys,
    settle_parts,
    without_stale,
)
from silvermill.operators.upsert import matching_rows
from silvermill.scratch import new_folder
from silvermill.sources.bronze import SEQ
from silvermill.sources.filesystem import delete_folder


@dataclass
class StagedBatch:
    """`updates` has one row per known key; `inserts` is what the batch leaves
    behind for keys the table lacks; `unknown` are the rows with a NULL key.
    `repeated` are keys that one part has several times, if any were looked
    for. `touched` lists the slices that known keys fall into."""

    spark: SparkSession
    keys: tuple[str, ...]
    updates: DataFrame | None = None
    inserts: DataFrame | None = None
    unknown: DataFrame | None = None
    repeated: DataFrame | None = None
    rows_in: int = 0
    touched: list[str] = field(default_factory=list)
    folders: list[str] = field(default_factory=list)

    def everything(self) -> DataFrame:
        return self.inserts if self.unknown is None else self.inserts.unionByName(self.unknown)

    def keep(self, rows: DataFrame, label: str) -> DataFrame:
        """Write rows to the shared scratch folder, and read them from there."""
        folder = new_folder(self.spark, label)
        self.folders.append(folder)
        rows.write.option("compression", "zstd").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def release(self) -> None:
        for folder in self.folders:
            delete_folder(self.spark, folder)


BATCH = "_batch"


def with_seq(source: DataFrame, seq: str | None) -> DataFrame:
    """The source with its part number in `_seq`, which is NULL if it has none."""
    if seq is None:
        return source.withColumn(SEQ, F.lit(None).cast("bigint"))
    return source if seq == SEQ else source.withColumnRenamed(seq, SEQ)


def with_origin(source: DataFrame, seq: str | None, batch: str | None = None) -> DataFrame:
    """As above, and with the batch's name in `_batch`."""
    return with_seq(source, seq).withColumn(BATCH, F.lit(batch).cast("string"))


def stage(
    source: DataFrame,
    keys: Sequence[str],
    seq: str | None = None,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    null_safe: bool = False,
    target: DataFrame | None = None,
    slice_of: Column | None = None,
    written_by_us: Column | None = None,
    newer_only: bool = False,
) -> StagedBatch:
    """Reduce the batch to its newest rows and write them to the shared scratch
    folder, so that the merge reads stable files.

    Bronze is read once. It is read again only where there are rows that the
    reduced batch lacks: rows with a NULL key, or repeated keys. Of the latter
    only their own rows are kept. `written_by_us` says of a target row that an
    earlier try of this batch wrote it. Under `newer_only`, repeated rows older
    than the target's cannot update it and so are not ambiguous.
    """
    if on_duplicate not in ("error", "latest"):
        raise ValueError(f"on_duplicate must be error or latest, not {on_duplicate!r}")
    if on_duplicate == "latest" and not order_by:
        raise ValueError("on_duplicate='latest' needs order_by")
    spark = source.sparkSession
    keys = tuple(keys)
    rows = with_seq(source, seq)
    batch = StagedBatch(spark, keys)
    try:
        _fill(
            batch, rows, on_duplicate, order_by, null_safe, target, slice_of,
            written_by_us, newer_only,
        )
    except BaseException:
        batch.release()
        raise
    return batch


def _fill(
    batch: StagedBatch,
    rows: DataFrame,
    on_duplicate: str,
    order_by: Sequence[str],
    null_safe: bool,
    target: DataFrame | None,
    slice_of: Column | None,
    written_by_us: Column | None,
    newer_only: bool,
) -> None:
    keys = batch.keys
    known = F.lit(True) if null_safe else all_known(keys)
    by_part = on_duplicate == "error"
    newest = batch.keep(newest_of_parts(rows, keys, SEQ, order_by, by_part), "newest")
    facts = newest.groupBy((F.lit("") if slice_of is None else slice_of).alias("slice")).agg(
        F.sum("_rows").alias("rows"),
        F.count_if(known).alias("known"),
        F.count_if(~known).alias("unknown"),
        F.max(F.when(known, F.col("_extra"))).alias("extra") if by_part else F.lit(0).alias("extra"),
    ).collect()
    batch.rows_in = sum(fact["rows"] for fact in facts)
    batch.touched = [fact["slice"] for fact in facts if fact["known"]]
    batch.updates = newest.where(known).drop("_rows", "_extra")
    batch.inserts = batch.updates
    if any(fact["unknown"] for fact in facts):
        batch.unknown = batch.keep(rows.where(any_unknown(keys)), "unknown")
    if by_part and any((fact["extra"] or 0) > 0 for fact in facts):
        several = newest.where(known & (F.col("_extra") > 0)).select(*keys)
        raw = batch.keep(matching_rows(rows, several, keys, null_safe), "raw")
        if target is not None:
            target = matching_rows(target, several, keys, null_safe)
            if written_by_us is not None:
                target = target.where(~F.coalesce(written_by_us, F.lit(False)))
            if newer_only:
                raw = without_stale(raw, target, keys, SEQ, null_safe)
        batch.repeated = batch.keep(repeated_keys(raw, keys, SEQ, null_safe), "repeated")
        check_parts(batch.repeated, keys, target, null_safe)
        settled = settle_parts(raw, keys, SEQ, null_safe).select(*rows.columns)
        once = newest.where(known & (F.col("_extra") == 0)).select(*rows.columns)
        batch.inserts = once.unionByName(batch.keep(settled, "settled"))
