"""Bronze-shaped frames derived from a star schema of orders and events.

These feed the registered queries and the benchmark, so that every operator
runs over whole tables. Each frame is built row by row: JSON arrays come from
the columns of one row, never from collecting a group.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from silvermill.sources.filesystem import move_folder, subfolders


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item, and every order that has none with NULL line columns."""
    lineitem = table(spark, sf_dir, "lineitem")
    lines = lineitem.select(
        F.col("l_orderkey").alias("orderkey"),
        "l_linenumber", "l_partkey", "l_suppkey",
        "l_returnflag", "l_linestatus", F.year("l_shipdate").alias("ship_year"),
    )
    with_lines = lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    empty = table(spark, sf_dir, "orders").join(with_lines, "o_orderkey", "left_anti")
    return lines.unionByName(
        empty.select(F.col("o_orderkey").alias("orderkey"), F.year("o_orderdate").alias("ship_year")),
        allowMissingColumns=True,
    )


def order_title() -> Column:
    return F.concat(F.lit("Order "), F.col("orderkey").cast("string"))


def line_items_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with a JSON array of its part and its supplier.

    Lines of status F lack the supplier's id. Orders without lines have text
    that holds no element: an empty array, blank text, broken text, or NULL.
    """
    pair = F.array(
        F.struct(F.col("l_partkey").alias("id"), F.concat(F.lit("part "), "l_returnflag").alias("name")),
        F.struct(
            F.when(F.col("l_linestatus") != "F", F.col("l_suppkey")).alias("id"),
            F.lit("supplier").alias("name"),
        ),
    )
    nothing = (
        F.when(F.col("ship_year") == 1995, "[]").when(F.col("ship_year") == 1996, "")
        .when(F.col("ship_year") == 1997, '[{"id": 1')
    )
    return order_lines(spark, sf_dir).select(
        F.col("orderkey").alias("order_id"),
        F.when(F.col("l_linenumber").isNull(), nothing).otherwise(F.to_json(pair)).alias("items"),
    )


def credits(spark: SparkSession, sf_dir: str, part: Column | None = None) -> DataFrame:
    """Credits: per line item, a cast array of two and a crew array of one. `part` says of
    a line which part it goes to."""
    number = F.col("l_linenumber")
    credit = F.concat_ws("-", F.lit("c"), "orderkey", "l_linenumber", "l_partkey")
    cast = F.array(
        F.struct(
            number.alias("cast_id"), F.col("l_returnflag").alias("character"),
            credit.alias("credit_id"),
            F.when(F.col("l_returnflag") == "A", 1).otherwise(2).alias("gender"),
            F.col("l_partkey").alias("id"),
            F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("name"),
            number.alias("order"),
        ),
        F.struct(
            (number + 100).alias("cast_id"), F.col("l_linestatus").alias("character"),
            F.when(F.col("l_returnflag") != "R", F.concat(credit, F.lit("-s"))).alias("credit_id"),
            F.lit(0).alias("gender"), F.col("l_suppkey").alias("id"),
            F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("name"),
            (number + 100).alias("order"),
        ),
    )
    crew = F.array(F.struct(
        F.when(F.col("l_linestatus") == "O", F.concat(credit, F.lit("-w"))).alias("credit_id"),
        F.col("l_returnflag").alias("department"), F.lit(1).alias("gender"),
        F.col("l_suppkey").alias("id"), F.col("l_linestatus").alias("job"),
        F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("name"),
    ))
    lines = order_lines(spark, sf_dir)
    return (lines if part is None else in_parts(lines, part)).select(
        F.col("orderkey").alias("movie_id"), order_title().alias("title"),
        F.when(number.isNotNull(), F.to_json(cast)).alias("cast"),
        F.when(number.isNotNull(), F.to_json(crew)).otherwise(F.lit("[]")).alias("crew"),
        "ship_year", *([] if part is None else ["_part"]),
    )


def _by_priority(priority: Column, two: Column, one: Column) -> Column:
    """Array text by priority: two elements, a lone object, or no element."""
    return (
        F.when(priority == "1", F.to_json(two))
        .when(priority == "2", F.to_json(one))
        .when(priority == "3", "[]")
        .when(priority == "4", "not json")
    )


def movies(
    spark: SparkSession, sf_dir: str, revised: bool = False, part: Column | None = None
) -> DataFrame:
    """Movies: one row per order. Low priorities lack the original title.

    The revised rows have the same keys, other votes and, as the priorities
    move on by one, other lists. `part` says of an order which part it goes to.
    """
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    text = key.cast("string")
    priority = F.substring("o_orderpriority", 1, 1)
    listed = F.translate(priority, "12345", "23451") if revised else priority

    def named(a: Column, b: Column) -> Column:
        return F.struct(a.alias("id"), b.alias("name"))

    def coded(field: str, a: Column, b: Column) -> Column:
        return F.struct(a.alias(field), b.alias("name"))

    def lists(make) -> Column:
        first = make(F.col("o_orderstatus"), customer)
        second = make(F.lit(None).cast("string"), key + 1_000_000)
        return _by_priority(listed, F.array(first, second), first)

    orders = table(spark, sf_dir, "orders")
    return (orders if part is None else in_parts(orders, part)).select(
        key.alias("id"),
        F.concat(F.lit("Order "), text).alias("title"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("budget"),
        F.concat(F.lit("http://example.org/"), text).alias("homepage"),
        F.col("o_orderstatus").alias("original_language"),
        F.when(
            priority != "5",
            F.concat(F.lit("Order "), text, F.lit(" of "), customer.cast("string")),
        ).alias("original_title"),
        F.col("o_orderpriority").alias("overview"),
        (customer / 8).alias("popularity"),
        F.date_format("o_orderdate", "yyyy-M-d").alias("release_date"),
        customer.alias("revenue"),
        F.when(F.col("o_orderstatus") == "P", float("nan")).otherwise(customer / 2).alias("runtime"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("tagline"),
        (customer / 4).alias("vote_average"),
        (customer + 1 if revised else customer).alias("vote_count"),
        lists(lambda code, number: named(number, code)).alias("genres"),
        lists(lambda code, number: named(F.when(code.isNotNull(), number), F.lit("word"))).alias("keywords"),
        lists(lambda code, number: named(number, F.lit("firm"))).alias("production_companies"),
        lists(lambda code, number: coded("iso_3166_1", code, number.cast("string"))).alias("production_countries"),
        lists(lambda code, number: coded("iso_639_1", code, number.cast("string"))).alias("spoken_languages"),
        F.year("o_orderdate").alias("order_year"), *([] if part is None else ["_part"]),
    )


#: Spark's name for the folder of the rows that have no part.
NO_PART = "__HIVE_DEFAULT_PARTITION__"


def in_parts(rows: DataFrame, part: Column) -> DataFrame:
    """Rows with their part in `_part`, sorted by it in each task. A column that may be
    NULL would be changed and sorted once more where it is written."""
    named = F.coalesce(part, F.lit(NO_PART))
    return rows.withColumn("_part", named).sortWithinPartitions("_part")


def write_parts(frame: DataFrame, root: str, name: str) -> None:
    """Write a bronze table as parts named by its column `_part`, in one job.

    Rows that `in_parts` has sorted are written by the tasks that make them: what
    they are made from is sorted, and their long texts are neither sorted nor
    shuffled. Spark names the folders of a partitioned write `_part=...`; they are
    then renamed to what bronze parts are called.
    """
    spark = frame.sparkSession
    staging = f"{root}/.{name}_parts"
    frame.write.option("compression", "zstd").partitionBy("_part").parquet(staging)
    for folder in subfolders(spark, staging):
        part = folder.removeprefix("_part=")
        move_folder(spark, f"{staging}/{folder}", f"{root}/{name}/{name}_part_{part}.parquet")


def _part_of_year(year: Column) -> Column:
    """Parts of 1 January 2024, one hour for each year since 1990."""
    hour = F.lpad((year - 1990).cast("string"), 2, "0")
    return F.concat(F.lit("20240101-"), hour, F.lit("0000"))


def write_credits(spark: SparkSession, sf_dir: str, root: str) -> None:
    frame = credits(spark, sf_dir, _part_of_year(F.col("ship_year")))
    write_parts(frame.drop("ship_year"), root, "credits")


def write_movies(spark: SparkSession, sf_dir: str, root: str) -> None:
    """A part per year of orders, and a part of the next day with all revisions."""
    def first() -> None:
        frame = movies(spark, sf_dir, part=_part_of_year(F.year("o_orderdate")))
        write_parts(frame.drop("order_year"), root, "movies")

    def second() -> None:
        frame = movies(spark, sf_dir, revised=True).drop("order_year")
        frame.write.option("compression", "zstd").parquet(
            f"{root}/movies/movies_part_20240102-080000.parquet"
        )

    with ThreadPoolExecutor(2) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write)) for write in (first, second)]
        for each in running:
            each.result()


def write_events(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Two parts a day, named for 8 and 20 o'clock."""
    half = F.when(F.hour("ts") < 12, "080000").otherwise("200000")
    part = F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("-"), half)
    frame = table(spark, sf_dir, "events").withColumn("_part", part)
    write_parts(frame.hint("rebalance", F.col("_part")), root, "events")
