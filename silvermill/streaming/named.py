"""Bronze parts as a stream in the order of their names.

Spark's file source hands files over by modification time. Here a Python data source
streams the names of parts, and each trigger reads the parts it names with the
vectorized Parquet reader.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyarrow import fs
from pyspark.errors import PySparkValueError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from silvermill.functions.parts import PART_NAME
from silvermill.sources.bronze import SEQ, with_part_seq
from silvermill.spec import TableSpec
from silvermill.tables.silver import SilverTable


class NamedParts(DataSource):
    """Options: `path` (of the parts' folder), `table`, `partsPerTrigger`.

    The names are listed in Python on the driver, by Arrow's file systems (local
    paths, s3, gs, hdfs), which take their credentials from the environment.
    """

    @classmethod
    def name(cls) -> str:
        return "named_parts"

    def schema(self) -> str:
        return "part string"

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return NamedPartsReader(
            self.options["path"], self.options["table"], int(self.options.get("partsPerTrigger", 0))
        )


class NamedPartsReader(SimpleDataSourceStreamReader):
    """The offset holds the names of all parts handed over: a part that lands late,
    with a name before others', is still taken, and none is taken twice."""

    def __init__(self, path: str, table: str, per_trigger: int = 0):
        if per_trigger < 0:
            raise PySparkValueError("partsPerTrigger must not be negative")
        self.path, self.table, self.per_trigger = path, table, per_trigger

    def initialOffset(self) -> dict:
        return {"parts": []}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        new = sorted(self._names() - set(start["parts"]))
        new = new[: self.per_trigger or len(new)]
        return iter([(name,) for name in new]), {"parts": sorted([*start["parts"], *new])}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(name,) for name in sorted(set(end["parts"]) - set(start["parts"]))])

    def _names(self) -> set[str]:
        """No part may be in the folder before it is whole: write elsewhere, then move."""
        # Hadoop writes file:/a and s3a://b, Arrow file:///a and s3://b
        uri = re.sub(r"^file:/+", "/", re.sub(r"^s3[an]://", "s3://", self.path))
        files, folder = fs.FileSystem.from_uri(uri)
        found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        pattern = re.escape(self.table) + PART_NAME
        return {info.base_name for info in found if re.fullmatch(pattern, info.base_name)}


def ingest_by_name(
    spark: SparkSession,
    spec: TableSpec,
    bronze_root: str,
    table: SilverTable,
    checkpoint: str,
    schema: StructType | str,
    parts_per_trigger: int = 0,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    stream_id: str | None = None,
) -> None:
    """Ingest every part that is there and not yet loaded, by name, then stop.

    `parts_per_trigger` parts, or all (0), make one batch. A batch that failed is run
    again with the same parts and replaces what it wrote. A part that lands after
    later ones were loaded is taken, and does not undo them.
    """
    name = stream_id or spec.name
    folder = f"{bronze_root}/{spec.source}"

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [f"{folder}/{row.part}" for row in batch.collect()]
        parts = with_part_seq(batch.sparkSession.read.schema(schema).parquet(*paths))
        table.apply(
            spec.transform(parts, carry=[SEQ]),
            seq=SEQ,
            on_duplicate=on_duplicate,
            order_by=order_by,
            newer_only=True,
            batch=f"{name}-{batch_id}",
        )

    spark.dataSource.register(NamedParts)
    query = (
        spark.readStream.format(NamedParts.name())
        .option("table", spec.source).option("partsPerTrigger", parts_per_trigger).load(folder)
        .writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint).start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
