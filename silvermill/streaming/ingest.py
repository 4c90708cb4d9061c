"""Incremental ingest: each bronze part once, then upserted, restartable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from silvermill.functions.parts import part_glob
from silvermill.sources.bronze import SEQ, with_part_seq
from silvermill.spec import TableSpec
from silvermill.tables.silver import SilverTable


def stream_parts(
    spark: SparkSession,
    root: str,
    table: str,
    schema: StructType | str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parts as a stream. Spark hands them over by modification time."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_part_seq(reader.parquet(part_glob(root, table)))


def start_ingest(
    spark: SparkSession,
    spec: TableSpec,
    bronze_root: str,
    table: SilverTable,
    checkpoint: str,
    schema: StructType | str,
    max_files_per_trigger: int | None = None,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    stream_id: str | None = None,
) -> StreamingQuery:
    """Ingest every part that is there and not yet loaded, then stop.

    A part that arrives late does not undo a later one: rows keep the part they
    came from. A batch that is run again after a failure replaces what it wrote.
    """
    name = stream_id or spec.name

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        table.apply(
            batch,
            seq=SEQ,
            on_duplicate=on_duplicate,
            order_by=order_by,
            newer_only=True,
            batch=f"{name}-{batch_id}",
        )

    rows = spec.transform(
        stream_parts(spark, bronze_root, spec.source, schema, max_files_per_trigger),
        carry=[SEQ],
    )
    return (
        rows.writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_available(*args, **kwargs) -> None:
    """`start_ingest`, waiting until it has stopped."""
    start_ingest(*args, **kwargs).awaitTermination()
