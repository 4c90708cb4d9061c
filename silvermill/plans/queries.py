"""Every operator as a query over the star schema's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from silvermill.functions import equals, part_date, part_time
from silvermill.operators import quality, rows, sketches
from silvermill.operators.drift import element_drift
from silvermill.operators.normalize import normalize_json_array
from silvermill.operators.project import fill_sentinels, flatten_struct, typed_projection
from silvermill.operators.upsert import latest_per_key, upsert
from silvermill.plans import catalog, star
from silvermill.plans.pipeline import (
    append_pipeline,
    load_counts,
    run_daily,
    run_pipeline,
    silver_quality,
    silver_table,
)
from silvermill.scratch import new_folder, stored, with_scratch
from silvermill.sources import (
    SEQ,
    list_objects,
    list_parts,
    objects_with_prefix,
    push_then_pull,
    read_csv,
    read_parts,
    read_quoted_csv,
    write_csv,
    write_snapshot,
)
from silvermill.spec import ColumnSpec, TableSpec
from silvermill.streaming import ingest_available, ingest_by_name
from silvermill.tables import BucketedTable, SilverTable, TableProfile

Query = Callable[[SparkSession, str], DataFrame]

ITEM = {"id": "int", "name": "string"}
ORDER_KEYS = ("o_orderkey", "o_orderstatus")
ORDER_COLUMNS = ("o_orderkey", "o_orderstatus", "o_custkey", "o_totalprice", "o_orderpriority")
LINE_KEYS = ("l_orderkey", "l_linenumber")
EVENT_KEYS = ("user_id", "event_type")
EVENT_TABLE = TableSpec(
    name="last_events",
    source="events",
    columns=(
        ColumnSpec("user_id", "bigint"),
        ColumnSpec("event_type", "string"),
        ColumnSpec("event_id", "bigint"),
        ColumnSpec("value", "double"),
    ),
    keys=EVENT_KEYS,
)


# Reading bronze

def event_parts(spark: SparkSession, sf_dir: str) -> str:
    root = new_folder(spark, "bronze")
    star.write_events(spark, sf_dir, root)
    return root


def query_read_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = read_parts(spark, event_parts(spark, sf_dir), "events")
    path = F.col("_metadata.file_path")
    return frame.select(
        "event_id", part_date(path).alias("part_date"), part_time(path).alias("part_time"),
        F.col(SEQ).alias("part_seq"),
    )


def query_read_parts_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of the middle of January; other parts are not opened."""
    days = [f"202401{day:02d}" for day in range(10, 21)]
    frame = read_parts(spark, event_parts(spark, sf_dir), "events", days)
    return frame.select("event_id", "event_type", F.col(SEQ).alias("part_seq"))


def query_list_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_parts(spark, event_parts(spark, sf_dir), "events")


def query_list_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that have files, by listing alone."""
    root = event_parts(spark, sf_dir)
    return list_objects(spark, root, "*.parquet").select(
        part_date(F.col("path")).alias("part_date"), (F.col("length") > 0).alias("has_bytes")
    ).distinct()


def query_objects_with_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part files of the first nine days of January, by the start of their path."""
    root = event_parts(spark, sf_dir)
    found = objects_with_prefix(spark, root, "events/events_part_2024010")
    return found.where(F.col("path").endswith(".parquet")).select(
        part_date(F.col("path")).alias("part_date"), (F.col("length") > 0).alias("has_bytes")
    ).distinct()


def query_read_parts_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of which the later one has a column more; it is NULL in the first."""
    bronze = new_folder(spark, "bronze")
    events = star.table(spark, sf_dir, "events")
    morning = F.hour("ts") < 12
    events.where(morning).drop("props").write.parquet(f"{bronze}/events/events_part_20240101-080000.parquet")
    events.where(~morning).write.parquet(f"{bronze}/events/events_part_20240101-200000.parquet")
    return read_parts(spark, bronze, "events").select(
        "event_id", "event_type", "props", F.col(SEQ).alias("part_seq")
    )


def query_part_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_counts(read_parts(spark, event_parts(spark, sf_dir), "events"))


# Transforms

def query_json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = star.table(spark, sf_dir, "events")
    parsed = events.select("event_id", F.from_json("props", "k int").alias("props"))
    return flatten_struct(parsed, "props")


def query_json_lone_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object where an array is expected counts as an array of one."""
    return normalize_json_array(
        star.table(spark, sf_dir, "events"),
        parents=[ColumnSpec("event_id", "bigint")],
        array="props", element={"k": "int"}, fields=["k"], sentinels={"k": -9999},
    )


def query_normalize_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_json_array(
        star.line_items_json(spark, sf_dir),
        parents=[ColumnSpec("order_key", "string", source="order_id")],
        array="items", element=ITEM, fields=["id", "name"],
        sentinels={"id": catalog.NO_ID},
    )


def query_normalize_array_titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parent columns, a text sentinel, and a parsed field that is dropped."""
    order = F.array(F.struct(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("order_ref"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").alias("position"),
    ))
    customers = star.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = star.table(spark, sf_dir, "orders")
    with_orders = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "c_custkey", "c_name", F.to_json(order).alias("orders")
    )
    buyers = orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    without = customers.join(buyers, "c_custkey", "left_anti")
    return normalize_json_array(
        with_orders.unionByName(without, allowMissingColumns=True),
        parents=[ColumnSpec("c_custkey", "string"), ColumnSpec("c_name", "string")],
        array="orders",
        element={"order_ref": "string", "priority": "string", "position": "int"},
        fields=["order_ref", "priority"], sentinels={"order_ref": catalog.NO_CREDIT},
    )


def query_normalize_string_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array(
        F.struct(F.substring("p_type", 1, 2).alias("code"), F.col("p_type").alias("name")),
        F.struct(F.when(F.col("p_size") >= 25, F.col("p_brand")).alias("code"),
                 F.col("p_name").alias("name")),
    )
    parts = star.table(spark, sf_dir, "part")
    return normalize_json_array(
        parts.select("p_partkey", F.to_json(codes).alias("codes")),
        parents=[ColumnSpec("p_partkey", "string")],
        array="codes", element={"code": "string", "name": "string"},
        fields=["code", "name"], sentinels={"code": catalog.NO_CODE},
    )


def query_normalize_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long arrays: every word of every document, with its place."""
    words = F.transform(
        F.split("text", " ", -1),
        lambda word, i: F.struct(i.alias("id"), word.alias("name")),
    )
    documents = star.table(spark, sf_dir, "documents")
    return normalize_json_array(
        documents.select("doc_id", F.to_json(words).alias("words")),
        parents=[ColumnSpec("doc_id", "string")],
        array="words", element=ITEM, fields=["id", "name"], sentinels={"id": catalog.NO_ID},
    )


def query_element_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as elements whose id is sometimes text, whose name sometimes a number, and
    that have a field which is not declared."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    item = lambda name: F.to_json(F.struct(
        F.when(status == "F", F.concat(F.lit("p"), "l_partkey")).alias("id"), name.alias("name"),
        F.when(flag == "A", F.lit(True)).alias("extra"),
    ))
    number = F.to_json(F.struct(F.col("l_partkey").alias("id"), F.col("l_linenumber").alias("name")))
    text = F.when(flag == "R", F.concat(F.lit("["), number, F.lit(", null]"))).otherwise(item(status))
    return element_drift(star.table(spark, sf_dir, "lineitem").select(text.alias("items")), "items", ITEM)


def query_typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.table(spark, sf_dir, "orders").select(
        "*",
        F.date_format("o_orderdate", "yyyy-M-d").alias("day"),
        F.when(F.col("o_orderstatus") == "P", float("nan"))
        .otherwise(F.col("o_totalprice")).alias("price"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".7")).alias("text_number"),
    )
    typed = typed_projection(orders, [
        ColumnSpec("order_key", "string", source="o_orderkey"),
        ColumnSpec("customer", "int", source="o_custkey"),
        ColumnSpec("day", "date"),
        ColumnSpec("whole_price", "int", source="price"),
        ColumnSpec("price", "double", source="o_totalprice"),
        ColumnSpec("text_number", "int"),
        ColumnSpec("bad_number", "int", source="o_orderpriority"),
    ])
    return typed.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def comparable(df: DataFrame) -> DataFrame:
    """Floats as doubles and dates as text, which compare alike everywhere."""
    out = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind == "float":
            column = column.cast("double").alias(name)
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd").alias(name)
        out.append(column)
    return df.select(*out)


def table_query(spec: TableSpec) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bronze = {"credits": star.credits, "movies": star.movies}[spec.source]
        return comparable(spec.transform(bronze(spark, sf_dir)))
    return query


# Upserts

def orders_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(*ORDER_COLUMNS)


def orders_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star.table(spark, sf_dir, "orders")
    since = orders.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    return since.select(*ORDER_COLUMNS).withColumn("o_totalprice", F.col("o_totalprice") * 2)


def unknown_status(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))


def query_upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(orders_before(spark, sf_dir), orders_changed(spark, sf_dir), ORDER_KEYS)


def query_upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(
        unknown_status(orders_before(spark, sf_dir)),
        unknown_status(orders_changed(spark, sf_dir)),
        ORDER_KEYS,
    )


def query_upsert_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(
        unknown_status(orders_before(spark, sf_dir)),
        unknown_status(orders_changed(spark, sf_dir)),
        ORDER_KEYS,
        null_safe=True,
    )


def query_upsert_dup_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items repeat their key; line 0 of each order is new."""
    lines = star.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_quantity")
    totals = lines.groupBy(*LINE_KEYS).agg(F.sum("l_quantity").alias("l_quantity"))
    heads = star.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("l_linenumber"),
        F.lit(0.0).alias("l_quantity"),
    )
    return upsert(lines, totals.unionByName(heads), LINE_KEYS)


def query_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several source rows per key: the one with the greatest price counts."""
    customers = star.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.lit(0.0).alias("price")
    )
    orders = star.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_name"),
        F.col("o_totalprice").alias("price"),
    )
    return upsert(customers, orders, ["c_custkey"], "latest", order_by=["price", "c_name"])


def query_upsert_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_parts(spark, event_parts(spark, sf_dir), "events")
    newest = latest_per_key(events, EVENT_KEYS, [SEQ, "ts", "event_id"])
    return newest.select(*EVENT_KEYS, "event_id", "value", F.col(SEQ).alias("part_seq"))


# Silver tables

def query_silver_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = SilverTable(spark, new_folder(spark, "silver"), ORDER_KEYS)
    silver.overwrite(unknown_status(orders_before(spark, sf_dir)))
    silver.apply(unknown_status(orders_changed(spark, sf_dir)))
    return silver.read()


def query_silver_merge_blooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As silver_merge, with files that tell which keys they hold."""
    silver = SilverTable(spark, new_folder(spark, "silver"), ORDER_KEYS, slices=4, key_blooms=True)
    silver.overwrite(unknown_status(orders_before(spark, sf_dir)))
    silver.apply(unknown_status(orders_changed(spark, sf_dir)))
    return silver.read()


def query_merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As silver_merge, into a table whose side of the merge is not shuffled."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = BucketedTable(spark, new_folder(spark, "bucketed"), ORDER_KEYS, buckets)
    table.overwrite(unknown_status(orders_before(spark, sf_dir)))
    table.merge(unknown_status(orders_changed(spark, sf_dir)))
    return table.read()


def query_filter_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some customers' orders, and one month's, from files in Z-order of both columns."""
    orders = star.table(spark, sf_dir, "orders")
    silver = SilverTable(
        spark, new_folder(spark, "silver"), ["o_orderkey"], slices=4,
        cluster_by=["o_custkey", "o_orderdate"],
    )
    silver.overwrite(orders.where(F.col("o_orderdate") < "1997-01-01"))
    silver.apply(orders.where(F.col("o_orderdate") >= "1996-06-01"))
    found = silver.read().select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return rows.append_union(
        found.where(F.col("o_custkey").between(20, 40)).withColumn("found_by", F.lit("customer")),
        found.where(
            (F.col("o_orderdate") >= "1996-08-01") & (F.col("o_orderdate") < "1996-09-01")
        ).withColumn("found_by", F.lit("month")),
    ).drop("o_orderdate")


def query_silver_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load creates the table; the second replaces it on demand."""
    silver = SilverTable(spark, new_folder(spark, "silver"), ORDER_KEYS)
    silver.apply(orders_before(spark, sf_dir))
    silver.apply(orders_changed(spark, sf_dir), bootstrap="always")
    return silver.read()


def query_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = SilverTable(spark, new_folder(spark, "silver"), ["c_custkey"])
    silver.overwrite(star.table(spark, sf_dir, "customer"))
    return silver.read()


def query_append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = SilverTable(spark, new_folder(spark, "silver"), ORDER_KEYS)
    silver.append(orders_before(spark, sf_dir))
    silver.append(orders_changed(spark, sf_dir))
    return silver.read()


def query_raw_data_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Parquet files of a silver table, read without the table."""
    folder = new_folder(spark, "silver")
    SilverTable(spark, folder, ["s_suppkey"], slices=4).overwrite(
        star.table(spark, sf_dir, "supplier")
    )
    files = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    return files.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


def query_snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "snapshots")
    path = write_snapshot(star.table(spark, sf_dir, "part"), root, "20240101", "part")
    return spark.read.parquet(path)


def query_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "csv")
    write_csv(star.table(spark, sf_dir, "orders"), path, sep=";")
    return read_csv(spark, path, ["o_orderkey", "o_orderpriority", "o_totalprice"], sep=";")


def query_csv_push_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = new_folder(spark, "csv"), new_folder(spark, "csv")
    write_csv(star.table(spark, sf_dir, "customer"), source)
    return push_then_pull(spark, source, target, ["c_custkey", "c_name", "c_nationkey"])


# Pipelines

def query_csv_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, which have line breaks, quotes and commas, through CSV files that are
    read by byte ranges."""
    path = new_folder(spark, "csv")
    write_csv(star.table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), path)
    texts = read_quoted_csv(spark, path, schema="doc_id bigint, lang string, text string")
    return texts.select(
        "doc_id", "lang", F.char_length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")
    )


def every_column(spec: TableSpec) -> list[str]:
    return [c for c in spec.column_names if c not in spec.keys]


LATEST = {
    "on_duplicate": "latest",
    "order_by": {spec.name: every_column(spec) for spec in catalog.ALL_TABLES},
    "slices": 4,
    "parallel": 4,
}


def keyed_rows(spark: SparkSession, root: str, specs, label: dict[str, str]) -> DataFrame:
    """Rows of several silver tables as table, keys and one more column."""
    return rows.append_union(*[
        silver_table(spark, root, spec).read().select(
            F.lit(spec.name).alias("table_name"),
            F.col("movie_id"),
            F.col(next(k for k in spec.keys if k != "movie_id")).cast("string").alias("other_key"),
            F.col(label[spec.name]).cast("string").alias("label"),
        )
        for spec in specs
    ])


LABELS = {
    "cast": "character", "crew": "department", "movies": "vote_count",
    "genres": "name", "keywords": "name", "production_companies": "name",
    "production_countries": "name", "spoken_languages": "name",
}


def query_load_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    star.write_credits(spark, sf_dir, bronze)
    run_pipeline(spark, catalog.CREDITS_TABLES, bronze, silver, ["20240101"], **LATEST)
    return keyed_rows(spark, silver, catalog.CREDITS_TABLES, LABELS)


def query_load_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily runs: the second merges into the tables of the first."""
    bronze, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    star.write_movies(spark, sf_dir, bronze)
    for day in ("20240101", "20240102"):
        run_pipeline(spark, catalog.MOVIES_TABLES, bronze, silver, [day], **LATEST)
    return keyed_rows(spark, silver, catalog.MOVIES_TABLES, LABELS)


def query_load_replace_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A placeholder row goes once its parent has real rows."""
    bronze, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    star.write_movies(spark, sf_dir, bronze)
    for day in ("20240101", "20240102"):
        run_pipeline(
            spark, [catalog.GENRES], bronze, silver, [day], replace_sentinel=True, **LATEST
        )
    return keyed_rows(spark, silver, [catalog.GENRES], LABELS)


def query_silver_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report of tables that the pipeline has loaded."""
    bronze, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    star.write_movies(spark, sf_dir, bronze)
    specs = [catalog.MOVIES, catalog.KEYWORDS]
    run_pipeline(spark, specs, bronze, silver, **LATEST)
    return silver_quality(spark, silver, specs)


def query_append_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    star.write_movies(spark, sf_dir, bronze)
    append_pipeline(spark, [catalog.SPOKEN_LANGUAGES], bronze, silver, slices=4)
    return keyed_rows(spark, silver, [catalog.SPOKEN_LANGUAGES], LABELS)


def query_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the daily job read for each table; the seconds differ every time."""
    bronze, silver = new_folder(spark, "bronze"), new_folder(spark, "silver")
    star.write_credits(spark, sf_dir, bronze)
    star.write_movies(spark, sf_dir, bronze)
    report = run_daily(spark, bronze, silver, **LATEST)
    return report.select("table", "source", "rows_in", (F.col("seconds") > 0).alias("timed"))


def query_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = event_parts(spark, sf_dir)
    silver = silver_table(spark, new_folder(spark, "silver"), EVENT_TABLE, slices=4)
    ingest_available(
        spark, EVENT_TABLE, bronze, silver,
        checkpoint=new_folder(spark, "stream"),
        schema=star.table(spark, sf_dir, "events").schema,
        max_files_per_trigger=20,
        on_duplicate="latest", order_by=["event_id", "value"],
    )
    return silver.read()


def query_stream_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, parts taken in the order of their names."""
    bronze = event_parts(spark, sf_dir)
    silver = silver_table(spark, new_folder(spark, "silver"), EVENT_TABLE, slices=4)
    ingest_by_name(
        spark, EVENT_TABLE, bronze, silver,
        checkpoint=new_folder(spark, "stream"),
        schema=star.table(spark, sf_dir, "events").schema,
        parts_per_trigger=20,
        on_duplicate="latest", order_by=["event_id", "value"],
    )
    return silver.read()


# Checks and reports

def query_append_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.append_union(orders_before(spark, sf_dir), orders_changed(spark, sf_dir))


def query_filter_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cast = catalog.CAST.transform(star.credits(spark, sf_dir))
    return cast.where(F.col("credit_id") == catalog.NO_CREDIT)


def query_filter_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    genres = catalog.GENRES.transform(star.movies(spark, sf_dir))
    return genres.where(F.col("id") == catalog.NO_ID)


def query_filter_number_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value is given as text and takes the type of the column."""
    keywords = catalog.KEYWORDS.transform(star.movies(spark, sf_dir))
    return keywords.where(equals(keywords, "id", str(catalog.NO_ID)))


def query_filter_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    movies = catalog.MOVIES.transform(star.movies(spark, sf_dir))
    return movies.where(F.col("original_title").isNull()).select("movie_id", "title")


def query_repair_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = unknown_status(star.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"))
    return fill_sentinels(loaded, {"o_orderstatus": catalog.NO_CODE})


def query_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_count(star.table(spark, sf_dir, "lineitem"))


def query_filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    crew = catalog.CREW.transform(star.credits(spark, sf_dir))
    return quality.filtered_count(crew, F.col("credit_id") == catalog.NO_CREDIT)


def query_distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_count(
        catalog.CAST.transform(star.credits(spark, sf_dir)), "character"
    )


def query_distinct_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts of every column of events from one sketch per part, and whether
    each is as near to the exact count as its bound says."""
    events = read_parts(spark, event_parts(spark, sf_dir), "events")
    kept = stored(sketches.partial_profile(events, [SEQ]), "sketches")
    exact = rows.append_union(*[
        quality.distinct_count(events, name).withColumn("column_name", F.lit(name))
        for name in events.columns if name != SEQ
    ])
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_values"))
    return sketches.merged_profile(kept).join(exact, "column_name").select(
        "column_name", "rows", "missing", "distinct_values",
        (off <= 1 + sketches.error_bound() * F.col("distinct_values")).alias("within_bound"),
    )


def query_profile_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of a table after a merge, of which only changed slices were read again."""
    silver = SilverTable(spark, new_folder(spark, "silver"), ORDER_KEYS)
    profile = TableProfile(silver, new_folder(spark, "profile"))
    silver.overwrite(unknown_status(orders_before(spark, sf_dir)))
    profile.refresh()
    silver.apply(unknown_status(orders_changed(spark, sf_dir)))
    profile.refresh()
    return profile.read().select("column_name", "rows", "missing")


def query_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.distinct_rows(star.table(spark, sf_dir, "events"), "user_id", "event_type")


def query_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(star.movies(spark, sf_dir))


def query_schema_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.schema_rows(catalog.MOVIES.transform(star.movies(spark, sf_dir)))


def query_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    credits, movies = star.credits(spark, sf_dir), star.movies(spark, sf_dir)
    return quality.quality_report({
        spec.name: (spec.transform(credits if spec.source == "credits" else movies), spec)
        for spec in catalog.ALL_TABLES
    })


def query_malformed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.malformed_report(star.movies(spark, sf_dir), catalog.MOVIES_TABLES)


def query_sort_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = catalog.PRODUCTION_COMPANIES.transform(star.movies(spark, sf_dir))
    return rows.sort_rows(companies, ["id", "movie_id"])


def query_sort_descending(spark: SparkSession, sf_dir: str) -> DataFrame:
    languages = catalog.SPOKEN_LANGUAGES.transform(star.movies(spark, sf_dir))
    return rows.sort_rows(languages, ["iso_639_1", "movie_id"], descending=True)


def query_top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"
    )
    return rows.top_rows(
        lines, ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"], 20, descending=True
    )


def query_page_of_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows from the middle of an order of all line items."""
    by = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"]
    lines = star.table(spark, sf_dir, "lineitem").select(*by)
    return rows.rows_between(lines, by, 3001, 4000, descending=True)


def all_queries() -> dict[str, Query]:
    found = {
        name.removeprefix("query_"): function
        for name, function in globals().items()
        if name.startswith("query_")
    }
    found.update({f"table_{spec.name}": table_query(spec) for spec in catalog.ALL_TABLES})
    return {name: with_scratch(query) for name, query in found.items()}
