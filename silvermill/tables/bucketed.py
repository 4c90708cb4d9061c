"""A table that lies in buckets of its key, so that a merge never shuffles it.

A hash of the key deals rows to buckets, one sorted run of files for each, as Spark's
own joins deal rows to tasks. A merge shuffles its batch to the same buckets and meets the
table's rows where they lie. It rewrites the whole table, so it is meant for
batches that touch most of it; `SilverTable` rewrites only the slices that change.

Every write makes a new version beside the old ones, complete when its `_COMPLETE`
file is there. Readers take the newest complete version; a writer that dies leaves
the table as it was.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from silvermill.functions.checks import all_known
from silvermill.operators.upsert import conform, newest_with_counts
from silvermill.scratch import stored
from silvermill.sources.filesystem import any_match, delete_folder, mark, subfolders

_VERSION = re.compile(r"version=(\d+)-buckets=(\d+)")


class BucketedTable:
    """A table at `path`, matched by `keys`; `buckets` is the number of a new table's.

    Choose it so that a bucket of the largest the table will be fits a task, and not below
    `spark.sql.shuffle.partitions`. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 200) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = tuple(keys)
        self.new_buckets = buckets

    def _versions(self) -> list[tuple[int, int]]:
        """(version, buckets) of the complete versions, oldest first."""
        if not any_match(self.spark, self.path):
            return []
        found = [m for name in subfolders(self.spark, self.path) if (m := _VERSION.fullmatch(name))]
        return sorted(
            (int(m[1]), int(m[2])) for m in found if any_match(self.spark, f"{self.path}/{m[0]}/_COMPLETE")
        )

    def _folder(self, version: int, buckets: int) -> str:
        return f"{self.path}/version={version}-buckets={buckets}"

    def exists(self) -> bool:
        return bool(self._versions())

    def read(self) -> DataFrame:
        """The newest complete version; joins and groups by the keys need no exchange."""
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"no bucketed table at {self.path}")
        return self._open(*versions[-1])

    def _open(self, version: int, buckets: int) -> DataFrame:
        folder = self._folder(version, buckets)
        schema = self.spark.read.parquet(folder).schema
        columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(map(_name, self.keys))
        name = f"bucketed_{uuid.uuid4().hex}"
        location = folder.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        try:
            return self.spark.table(name)
        finally:  # the frame is resolved, and the files are not the catalog's
            self.spark.sql(f"DROP TABLE {name}")

    def overwrite(self, rows: DataFrame) -> None:
        """A new version with these rows. They may come from the table itself."""
        versions = self._versions()
        buckets = self.new_buckets
        dealt = rows.repartition(buckets, *self.keys)
        self._write([dealt], versions[-1][0] + 1 if versions else 1, buckets)

    def merge(self, source: DataFrame) -> None:
        """Upsert by key, as `operators.upsert.upsert` does, into a new version.

        Several source rows for one row of the table are an error; several that match
        none are all inserted. A null key matches nothing. The table's side of both
        joins is read where it lies, also of a key that many of its rows share, which
        therefore cannot be split.
        """
        version, buckets = self._versions()[-1]
        target = self._open(version, buckets)
        source = stored(conform(source, target), "bucketed-batch")
        self._write(list(self.merged(target, source, buckets)), version + 1, buckets)

    def merged(self, target: DataFrame, source: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
        """The table's rows after the merge, in their buckets, and the new rows."""
        keys = list(self.keys)
        values = [c for c in target.columns if c not in keys]
        newest = newest_with_counts(source.where(all_known(keys)), keys, [])
        new = newest.select(*keys, F.struct(*values, "_rows").alias("_new"))
        joined = target.join(new, keys, "left")
        once = F.when(
            F.col("_new._rows") > 1, F.raise_error(F.lit("several source rows match one target row"))
        ).otherwise(F.col("_new").isNotNull())
        updated = joined.select(*[
            F.when(once, F.col("_new").getField(c)).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in target.columns
        ])
        inserted = source.repartition(buckets, *keys).join(target.select(*keys), keys, "left_anti")
        return updated, inserted.select(*target.columns)

    def _write(self, frames: Sequence[DataFrame], version: int, buckets: int) -> None:
        folder = self._folder(version, buckets)
        delete_folder(self.spark, folder)  # what a writer that died has left
        name = f"bucketed_{uuid.uuid4().hex}"
        try:
            for frame in frames:
                (frame.write.format("parquet").mode("append").option("path", folder)
                 .bucketBy(buckets, *self.keys).sortBy(*self.keys).saveAsTable(name))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        mark(self.spark, f"{folder}/_COMPLETE")

    def vacuum(self, keep: int = 1) -> None:
        """Delete all but the `keep` newest complete versions, and what dead writers left."""
        kept = {self._folder(*version) for version in self._versions()[-keep:]}
        for name in list(subfolders(self.spark, self.path)):
            if _VERSION.fullmatch(name) and f"{self.path}/{name}" not in kept:
                delete_folder(self.spark, f"{self.path}/{name}")


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"
