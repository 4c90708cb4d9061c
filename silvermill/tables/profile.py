"""A profile of a silver table that follows its changes slice by slice."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from silvermill.operators.sketches import LG_COUNTERS, PROFILE, merged_profile, partial_profile
from silvermill.sources.filesystem import any_match, delete_folder, subfolders
from silvermill.tables.silver import SLICE, SilverTable

_VERSION = re.compile(r"v-(\d+)")


class TableProfile:
    """Rows, missing values and distinct counts of a table's columns, kept at `path`.

    Kept are one row per slice and column, with the state of the slice's files. A
    refresh reads only slices whose files have changed since, in whatever way, and
    only the profiled columns; it writes a new version, which counts once it is
    complete. So a refresh that dies changes nothing. One refresh at a time.
    """

    def __init__(
        self, table: SilverTable, path: str, columns: Sequence[str] | None = None,
        lg_counters: int = LG_COUNTERS,
    ) -> None:
        self.table = table
        self.spark: SparkSession = table.spark
        self.path = path.rstrip("/")
        self.columns = None if columns is None else tuple(columns)
        self.lg_counters = lg_counters

    def refresh(self) -> list[str]:
        """Bring the profile up to date and return the slices that were read for it."""
        rows = self.table.read_with_slices()
        states = self.table.slice_states()
        old = self._newest()
        kept: set[str] = set()
        if old is not None:
            known = self._partials(old).select(SLICE, "state").distinct().collect()
            kept = {row[SLICE] for row in known if states.get(row[SLICE]) == row["state"]}
            if kept == set(states) and len(known) == len(kept):
                return []
        changed = sorted(set(states) - kept)
        names = self.spark.createDataFrame(sorted(states.items()), f"{SLICE} string, state string")
        fresh = partial_profile(
            rows.where(F.col(SLICE).isin(changed)), [SLICE], self.columns, self.lg_counters
        ).join(names, SLICE)
        if kept:
            fresh = fresh.unionByName(self._partials(old).where(F.col(SLICE).isin(sorted(kept))))
        new = 0 if old is None else old + 1
        fresh.write.mode("overwrite").parquet(f"{self.path}/v-{new}")
        if old is not None:
            delete_folder(self.spark, f"{self.path}/v-{old}")
        return changed

    def read(self) -> DataFrame:
        """One row per column: column_name, rows, missing, distinct_estimate."""
        newest = self._newest()
        if newest is None:
            raise FileNotFoundError(f"no profile at {self.path}: see refresh()")
        return merged_profile(self._partials(newest))

    def _partials(self, version: int) -> DataFrame:
        schema = f"{SLICE} string, state string, {PROFILE}"
        return self.spark.read.schema(schema).parquet(f"{self.path}/v-{version}")

    def _newest(self) -> int | None:
        if not any_match(self.spark, self.path):
            return None
        versions = [int(m[1]) for m in map(_VERSION.fullmatch, subfolders(self.spark, self.path)) if m]
        complete = [v for v in versions if any_match(self.spark, f"{self.path}/v-{v}/_SUCCESS")]
        return max(complete, default=None)
