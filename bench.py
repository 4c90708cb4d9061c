"""Time the headline queries; prints one JSON line.

`BENCH_SF_DIR` names the tables, `BENCH_CPUS` the cores. "queries" are timed
end to end into a sink that discards rows. "part_by_part" is the same load as
"load_credits", done as one scan and one merge per table and part: what the
one-pass plan has to beat.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from silvermill.plans import catalog, star
from silvermill.plans.pipeline import run_pipeline, silver_table
from silvermill.plans.queries import LATEST, all_queries
from silvermill.scratch import name_local_scratch, new_folder
from silvermill.sources import SEQ, list_parts, with_part_seq

HEADLINE = (
    "read_parts",
    "json_field",
    "normalize_array",
    "normalize_array_titled",
    "normalize_words",
    "typed_projection",
    "table_cast",
    "table_crew",
    "table_movies",
    "table_genres",
    "table_production_countries",
    "upsert_orders",
    "upsert_null_keys",
    "upsert_dup_target",
    "upsert_latest",
    "upsert_parts",
    "load_movies",
    "silver_merge",
    "append_load",
    "stream_ingest",
    "distinct_count",
    "null_profile",
    "quality_report",
    "sort_ascending",
    "top_rows",
)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.monotonic()
    action()
    return round(time.monotonic() - started, 3)


def one_pass(spark: SparkSession, bronze: str) -> None:
    silver = new_folder(spark, "silver")
    run_pipeline(spark, catalog.CREDITS_TABLES, bronze, silver, **LATEST)


def part_by_part(spark: SparkSession, bronze: str) -> None:
    silver = new_folder(spark, "silver")
    parts = list_parts(spark, bronze, "credits").orderBy("part_seq").collect()
    for spec in catalog.CREDITS_TABLES:
        table = silver_table(spark, silver, spec, LATEST["slices"])
        for part in parts:
            day = f"{part.part_date}-{part.part_time}"
            frame = read_parts_of(spark, bronze, spec.source, day)
            table.apply(
                spec.transform(frame, carry=[SEQ]), seq=SEQ, on_duplicate="latest",
                order_by=LATEST["order_by"][spec.name],
            )


def read_parts_of(spark: SparkSession, bronze: str, table: str, part: str) -> DataFrame:
    return with_part_seq(spark.read.parquet(f"{bronze}/{table}/{table}_part_{part}.parquet"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("silvermill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    name_local_scratch(spark)
    queries = all_queries()
    drain(queries["json_field"](spark, sf_dir))  # the first job also starts the engine

    seconds = {
        name: timed(lambda: drain(queries[name](spark, sf_dir))) for name in HEADLINE
    }
    bronze = new_folder(spark, "bronze")
    star.write_credits(spark, sf_dir, bronze)
    loop = timed(lambda: part_by_part(spark, bronze))
    seconds["load_credits"] = timed(lambda: one_pass(spark, bronze))
    print(json.dumps({
        "metric": "bronze_to_silver_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "part_by_part": {"load_credits": loop},
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
