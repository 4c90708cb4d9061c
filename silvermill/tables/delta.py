"""The same table on Delta Lake, where its package is installed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from silvermill.operators.upsert import conform
from silvermill.sources.bronze import SEQ
from silvermill.tables.staging import stage


class DeltaSilverTable:
    """`SilverTable` on a Delta table: atomic, and readable by any Delta client."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]) -> None:
        from delta.tables import DeltaTable

        self._delta = DeltaTable
        self.spark = spark
        self.path = path
        self.keys = tuple(keys)

    def exists(self) -> bool:
        return self._delta.isDeltaTable(self.spark, self.path)

    def read(self) -> DataFrame:
        return self.spark.read.format("delta").load(self.path)

    def overwrite(self, df: DataFrame) -> None:
        df.write.mode("overwrite").format("delta").save(self.path)

    def append(self, df: DataFrame, seq: str | None = None) -> None:
        """Add rows without matching keys. The part `seq` is not kept."""
        df = df.drop(seq) if seq else df
        if self.exists():
            df = conform(df, self.read())
        df.write.mode("append").format("delta").save(self.path)

    def apply(
        self,
        source: DataFrame,
        seq: str | None = None,
        on_duplicate: str = "error",
        order_by: Sequence[str] = (),
        bootstrap: str = "if_missing",
        sentinels: dict[str, object] | None = None,
        newer_only: bool = False,
        rewrite: str = "matched",
        batch: str | None = None,
    ) -> int:
        """As `SilverTable.apply`. A Delta table does not keep the part and the
        batch of a row, so what needs them is refused before any work is done."""
        refused = {
            "sentinels": sentinels, "newer_only": newer_only, "batch": batch,
            "rewrite": rewrite != "matched",
        }
        named = [name for name, value in refused.items() if value]
        if named:
            raise ValueError(f"a Delta table cannot take {', '.join(named)}")
        if bootstrap not in ("if_missing", "always"):
            raise ValueError(f"bootstrap must be if_missing or always, not {bootstrap!r}")
        merge = bootstrap == "if_missing" and self.exists()
        target = self.read() if merge else None
        staged = stage(source, self.keys, seq, on_duplicate, order_by, target=target)
        try:
            rows = staged.everything().drop(SEQ)
            if merge:
                rows = conform(rows, target)
                match = " AND ".join(f"p.`{key}` = c.`{key}`" for key in self.keys)
                (self._delta.forPath(self.spark, self.path).alias("p")
                 .merge(rows.alias("c"), F.expr(match))
                 .whenMatchedUpdateAll()
                 .whenNotMatchedInsertAll()
                 .execute())
            else:
                self.overwrite(rows)
        finally:
            staged.release()
        return staged.rows_in
