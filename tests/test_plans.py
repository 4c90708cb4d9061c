"""What the plans look like: what is read, shuffled, split and rewritten."""

import contextlib
import os
import re

from pyspark.sql import functions as F

from silvermill.operators.upsert import latest_per_key, unmatched_rows, updated_rows, upsert
from silvermill.plans import catalog
from silvermill.tables import SilverTable
from tests.conftest import rows


@contextlib.contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def bronze_movies(spark, folder):
    path = str(folder / "movies")
    (spark.range(20).selectExpr(
        "id", "concat('t', id) title", "concat('t', id) original_title",
        "'[{\"id\":1,\"name\":\"a\"}]' genres", "'[]' keywords", "'2020-1-2' release_date",
        "id budget", "'h' homepage", "'en' original_language", "'o' overview", "0.5 popularity",
        "id revenue", "1.0 runtime", "'s' status", "'t' tagline", "1.5 vote_average", "id vote_count",
    ).write.parquet(path))
    return spark.read.parquet(path)


def test_a_list_table_reads_two_columns_and_shuffles_nothing(spark, tmp_path):
    text = plan(catalog.GENRES.transform(bronze_movies(spark, tmp_path)))
    assert "ReadSchema: struct<id:bigint,genres:string>" in text
    assert "Exchange" not in text


def test_typed_projection_is_one_project(spark, tmp_path):
    text = plan(catalog.MOVIES.transform(bronze_movies(spark, tmp_path)))
    assert len(re.findall(r"Project \[", text)) == 1


def test_parent_filter_reaches_the_scan(spark, tmp_path):
    frame = bronze_movies(spark, tmp_path)
    out = catalog.MOVIES.transform(frame).where("title = 't3'")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(title,t3\)", plan(out))


def test_small_updates_leave_the_target_unshuffled(spark, tmp_path):
    target_path, batch_path = str(tmp_path / "t"), str(tmp_path / "b")
    spark.range(1000).selectExpr("id k", "id v").write.parquet(target_path)
    spark.range(10).selectExpr("id k", "0L v").write.parquet(batch_path)
    target, batch = spark.read.parquet(target_path), spark.read.parquet(batch_path)
    text = plan(updated_rows(target, batch, ["k"]))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    text = plan(unmatched_rows(target, batch, ["k"]))
    assert "SortMergeJoin" not in text


def test_a_sentinel_filter_reaches_the_silver_files(spark, tmp_path):
    table = SilverTable(spark, str(tmp_path / "t"), ["movie_id", "id"], slices=2)
    table.overwrite(catalog.GENRES.transform(bronze_movies(spark, tmp_path)))
    text = plan(table.read().where(F.col("id") == catalog.NO_ID).select("movie_id"))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(id,-9999\)", text)
    assert "ReadSchema: struct<movie_id:string,id:int>" in text




def hot_frame(spark, n):
    """Two thirds of the rows have one key."""
    return spark.range(n).selectExpr(
        "CASE WHEN id % 3 < 2 THEN 0 ELSE id END AS k", "id v",
        "sha2(cast(id as string), 256) AS pad",
    )


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "100k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100k",
}


def test_a_hot_target_key_is_split(spark, tmp_path):
    path = str(tmp_path / "hot")
    hot_frame(spark, 60_000).repartition(8).write.parquet(path)
    target = spark.read.parquet(path)
    source = spark.range(0, 60_000, 5).selectExpr("id k", "-1L v", "'new' pad")
    with settings(spark, **SKEW):
        out = upsert(target, source, ["k"])
        text = final_plan(out)
        assert "skew=true" in text
        assert out.where("k = 0 AND v = -1").count() == target.where("k = 0").count()


def test_a_hot_source_key_meets_partly_aggregated(spark):
    df = hot_frame(spark, 30_000)
    text = plan(latest_per_key(df, ["k"], ["v"]))
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "partial_max_by" in below
    assert "Window" not in text


def test_a_hot_slice_is_written_by_several_tasks(spark, tmp_path):
    table = SilverTable(spark, str(tmp_path / "t"), ["k", "v"], slice_by=["k"], slices=4)
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="200k"):
        table.overwrite(hot_frame(spark, 60_000))
    sizes = {
        name: len([f for f in os.listdir(tmp_path / "t" / name) if f.endswith(".parquet")])
        for name in os.listdir(tmp_path / "t") if name.startswith("slice_of_4=")
    }
    assert max(sizes.values()) > 2
    assert table.read().count() == 60_000


def test_untouched_slices_keep_their_files(spark, tmp_path):
    table = SilverTable(spark, str(tmp_path / "t"), ["k"], slices=16)
    table.overwrite(spark.range(200).selectExpr("id k", "id v"))

    def files():
        return {
            os.path.join(folder, f)
            for folder, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")
        }

    before = files()
    table.apply(spark.range(1).selectExpr("id k", "-1L v"))
    kept = before & files()
    assert len(before) - len(kept) == 1
    assert table.read().where("v = -1").count() == 1 and table.read().count() == 200


def test_slices_that_only_gain_rows_keep_their_files(spark, tmp_path):
    path = tmp_path / "t"
    table = SilverTable(spark, str(path), ["k"], slices=4)
    table.overwrite(spark.range(100).selectExpr("id k", "id v"))

    def files():
        return {
            os.path.join(folder, f)
            for folder, _, names in os.walk(path) for f in names if f.endswith(".parquet")
        }

    before = files()
    table.apply(spark.range(100, 200).selectExpr("id k", "id v"))
    assert before < files()
    table.apply(spark.range(150, 250).selectExpr("id k", "-1L v"), rewrite="touched")
    assert not before & files() and len(files()) == 4
    assert table.read().count() == 250 and table.read().where("v = -1").count() == 100


def test_both_sides_of_one_query_agree_under_skew_settings(spark):
    df = hot_frame(spark, 3_000)
    target = df.where("v < 2000").select("k", "v")
    source = df.where("v >= 1000").groupBy("k").agg(F.max("v").alias("v"))
    expected = rows(upsert(target, source, ["k"]))
    with settings(spark, **SKEW):
        assert rows(upsert(target, source, ["k"])) == expected


def scanned_rows(spark, frame) -> int:
    """Rows that the scans of a frame have given out, after it was run."""
    frame.collect()
    found, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().get("numOutputRows").get().value()
        for i in range(node.children().size()):
            todo.append(node.children().apply(i))
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
    return found


def keyed_table(spark, path, blooms):
    table = SilverTable(spark, path, ["k"], slices=1, key_blooms=blooms)
    table.overwrite(spark.range(40_000).selectExpr("md5(string(id)) k", "id v"))
    return table


def test_a_small_batch_reads_few_row_groups_of_the_target(spark, tmp_path):
    from silvermill.operators.upsert import key_filter, matching_rows

    batch = spark.range(3).selectExpr("md5(string(id * 1000)) k", "-1L v")
    read = {}
    # a row group's size is checked every 100 rows, so small groups can be made
    context = spark.sparkContext._jsc.hadoopConfiguration()
    context.set("parquet.block.size", str(64 << 10))
    context.set("parquet.page.size.row.check.min", "100")
    context.set("parquet.block.size.row.check.min", "100")
    try:
        for blooms in (False, True):
            table = keyed_table(spark, str(tmp_path / f"t{blooms}"), blooms)
            among = table.read().where(key_filter(batch, ["k"]))
            assert re.search(r"PushedFilters: \[[^\]]*In\(k, \[", plan(among))
            found = matching_rows(among.select("k"), batch, ["k"])
            read[blooms] = scanned_rows(spark, among.select("k"))
            assert found.count() == 3
            table.apply(batch)
            assert table.read().where("v = -1").count() == 3 and table.read().count() == 40_000
    finally:
        for name in ("parquet.block.size", "parquet.page.size.row.check.min", "parquet.block.size.row.check.min"):
            context.unset(name)
    assert read[True] < read[False] / 2


def test_key_filters_lose_no_match(spark):
    from silvermill.operators.upsert import key_filter

    target = spark.createDataFrame(
        [(i % 7 if i % 5 else None, None if i % 3 else str(i % 4), float(i)) for i in range(60)], "a int, b string, c double"
    )
    for data in ([], [(1, "2", 1.0)], [(None, "2", 1.0)], [(None, None, 1.0)], [(i, str(i), 0.0) for i in range(9)]):
        batch = spark.createDataFrame(data, target.schema)
        for keys in (["a"], ["a", "b"], ["a", "b", "c"]):
            for most in (1, 1000):
                for null_safe in (False, True):
                    left, right = target.alias("l"), batch.select(*keys).distinct().alias("r")
                    same = F.lit(True)
                    for k in keys:
                        x, y = F.col(f"l.{k}"), F.col(f"r.{k}")
                        same = same & (x.eqNullSafe(y) if null_safe else x == y)
                    wanted = left.join(right, same, "left_semi")
                    kept = target.where(key_filter(batch, keys, null_safe, most))
                    assert rows(kept.intersectAll(wanted)) == rows(wanted)
    assert key_filter(target, ["c"]) is None
