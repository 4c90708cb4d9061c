from datetime import date

import pytest
from pyspark.sql import functions as F

from silvermill.sources import csv, filesystem
from silvermill import scratch
from silvermill.functions import equals, part_glob, today
from silvermill.operators import quality, rows as row_ops
from silvermill.operators.project import fill_sentinels
from silvermill.plans import catalog
from silvermill.session import build_session, session_settings
from silvermill.sources import (
    ingest_csv,
    list_objects,
    list_parts,
    local_rows,
    objects_with_prefix,
    push_then_pull,
    read_csv,
    read_if_exists,
    read_each_part,
    read_parts,
    write_csv,
    write_snapshot,
)
from tests.conftest import rows

CUSTOMERS = [
    (1, "Ada", "North", "Hill", True, "1992-09-01", None),
    (2, "Bo, \"B\"", "South", "Lake", False, "1992-08-11", "1993-08-25"),
]
NAMES = ["Id", "personName", "state", "province", "still_here", "join_date", "leave_date"]


def test_local_rows(spark):
    df = local_rows(spark, CUSTOMERS, NAMES)
    assert dict(df.dtypes)["still_here"] == "boolean" and dict(df.dtypes)["Id"] == "bigint"
    assert df.count() == 2


def test_csv_roundtrip(spark, tmp_path):
    path = str(tmp_path / "c")
    write_csv(local_rows(spark, CUSTOMERS, NAMES), path, sep=";")
    back = read_csv(spark, path, ["Id", "personName", "leave_date"], sep=";")
    assert rows(back, "Id", "personName") == [(1, "Ada"), (2, 'Bo, "B"')]
    assert back.where("leave_date IS NULL").count() == 1
    typed = read_csv(spark, path, sep=";", schema="Id string, personName string, state string, "
                     "province string, still_here boolean, join_date date, leave_date date")
    assert dict(typed.dtypes)["Id"] == "string"


def test_csv_ingest_keeps_text(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "o")
    spark.createDataFrame([("007", "x")], "code string, name string").write.option("header", True).csv(source)
    ingest_csv(spark, source, target)
    assert spark.read.option("header", True).csv(target).first().code == "007"
    assert push_then_pull(spark, source, str(tmp_path / "p"), ["name"]).columns == ["name"]


def test_part_names():
    assert part_glob("r", "t", ["20240101"]) == "r/t/t_part_20240101-*.parquet"
    assert part_glob("r", "t", [date(2024, 1, 1), "20240102"]) == "r/t/t_part_{20240101,20240102}-*.parquet"
    assert part_glob("r", "t") == "r/t/t_part_*-*.parquet"


def test_parts_of_some_days(spark, tmp_path):
    root = str(tmp_path)
    for part in ("20240101-080000", "20240102-090000", "20240103-100000"):
        spark.range(2).coalesce(1).write.parquet(f"{root}/t/t_part_{part}.parquet")
    spark.range(5).write.parquet(f"{root}/t/other_20240101-080000.parquet")
    found = read_parts(spark, root, "t", ["20240101", "20240103", "20240109"])
    assert rows(found.groupBy("_seq").count()) == [(20240101080000, 2), (20240103100000, 2)]
    assert read_parts(spark, root, "t", ["20240109"]) is None
    assert read_parts(spark, root, "absent") is None
    assert rows(list_parts(spark, root, "t", ["20240102"])) == [("20240102", "090000", 20240102090000)]


def test_a_part_can_be_one_file(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "t").mkdir()
    pq.write_table(pa.table({"id": [1, 2]}), str(tmp_path / "t" / "t_part_20240101-080001.parquet"))
    assert rows(read_parts(spark, str(tmp_path), "t")) == [(1, 20240101080001), (2, 20240101080001)]


def test_listing(spark, tmp_path):
    root = str(tmp_path)
    for name in ("a/x", "a/y", "b/z"):
        spark.range(1).coalesce(1).write.parquet(f"{root}/{name}")
    assert list_objects(spark, root, "*.parquet").count() == 3
    assert objects_with_prefix(spark, root, "a/x/part").count() == 1
    assert objects_with_prefix(spark, root, "c/").count() == 0
    assert objects_with_prefix(spark, root, "x/").count() == 0
    assert objects_with_prefix(spark, root, "a*").count() == 0


def test_read_if_exists(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "absent")) is None
    (tmp_path / "empty").mkdir()
    assert read_if_exists(spark, str(tmp_path / "empty")) is None


def test_snapshot_path(spark, tmp_path):
    df = spark.range(3)
    assert write_snapshot(df, str(tmp_path), date(2024, 1, 2), "credits").endswith("/20240102/credits")
    assert write_snapshot(df, str(tmp_path), "20240103").endswith("/20240103")
    assert spark.read.parquet(str(tmp_path / "20240103")).count() == 3


def test_session_settings_hold_no_secret():
    env = {"AWS_ENDPOINT_URL": "http://store:9000", "AWS_SECRET_ACCESS_KEY": "hidden"}
    found = session_settings(env, use_delta=True)
    assert found["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert found["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert "Delta" in found["spark.sql.extensions"]
    assert "hidden" not in found.values()
    assert session_settings({}, use_delta=False) == {"spark.sql.session.timeZone": "UTC"}


def test_build_session_joins_the_running_one(spark):
    assert build_session(env={}).sparkContext is spark.sparkContext


def test_scratch_is_the_named_folder(spark):
    assert scratch.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch.new_folder(spark, "x") != scratch.new_folder(spark, "x")


def test_scratch_on_a_cluster_must_be_named():
    class Context:
        master = "yarn"

        @staticmethod
        def getConf():
            return {}

        @staticmethod
        def getCheckpointDir():
            return None

    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Session:
        conf = Conf
        sparkContext = Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session)


def test_today(spark):
    assert len(spark.range(1).select(today()).first()[0]) == 8


def test_quality(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), (None, -9999, float("nan")), ("a", None, None)], "k string, id int, x double"
    )
    assert rows(quality.null_profile(df)) == [("id", 1), ("k", 1), ("x", 2)]
    assert rows(quality.distinct_count(df, "k")) == [(2,)]
    assert rows(quality.distinct_count(df.where("k IS NOT NULL"), "k")) == [(1,)]
    assert rows(quality.distinct_count(df.where("false"), "k")) == [(0,)]
    assert rows(quality.row_count(df)) == [(3,)]
    assert rows(quality.filtered_count(df, equals(df, "id", "-9999"))) == [(1,)]
    assert rows(quality.table_quality(df, "t", ["k", "id"], {"id": -9999})) == [("t", 3, 2, 1)]
    assert rows(quality.schema_rows(df), "column_name", "data_type") == [
        ("id", "int"), ("k", "string"), ("x", "double")]
    assert rows(fill_sentinels(df, {"k": "XX"}), "k") == [("XX",), ("a",), ("a",)]


def test_malformed_report(spark):
    df = spark.createDataFrame([("[]",), ("",), (None,), ("not json",), ("null",)], "genres string")
    assert rows(quality.malformed_report(df, [catalog.GENRES])) == [("genres", 5, 2, 1)]


def test_sorting_and_previews(spark, capsys):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "id int, v string")
    assert [r.id for r in row_ops.sort_rows(df, ["id"]).collect()] == [1, 2, 3]
    assert [r.id for r in row_ops.top_rows(df, ["id"], 2, descending=True).collect()] == [3, 2]
    assert "TakeOrderedAndProject" in row_ops.top_rows(df, ["id"], 2)._jdf.queryExecution().toString()
    row_ops.preview(df, 1, truncate=False)
    df.printSchema()
    shown = capsys.readouterr().out
    assert "only showing top 1 row" in shown and "id: integer" in shown
    assert row_ops.distinct_rows(row_ops.append_union(df, df)).count() == 3


def test_csv_keeps_blanks_quotes_and_line_breaks(spark, tmp_path):
    values = ["  padded  ", 'a "quoted" word', "two\nlines", "comma, and more", " "]
    frame = spark.createDataFrame(list(enumerate(values)), "id int, value string")
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    csv.write_csv(frame, source)
    found = csv.push_then_pull(spark, source, target)
    assert sorted(r.value for r in found.collect()) == sorted(values)


def test_a_folder_that_cannot_be_moved_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="missing"):
        filesystem.move_folder(spark, str(tmp_path / "missing"), str(tmp_path / "to" / "it"))


@pytest.mark.parametrize("wide_first", [True, False])
def test_columns_of_all_parts_are_read(spark, tmp_path, wide_first):
    root = str(tmp_path / "drift")
    wide = spark.createDataFrame([(1, "x")], "id bigint, extra string")
    slim = spark.createDataFrame([(2,)], "id bigint")
    for hour, part in zip(("080000", "090000"), (wide, slim) if wide_first else (slim, wide)):
        part.coalesce(1).write.parquet(f"{root}/t/t_part_20240101-{hour}.parquet")
    assert rows(read_parts(spark, root, "t"), "id", "extra") == [(1, "x"), (2, None)]


def test_parts_of_one_schema_share_a_scan(spark, tmp_path):
    root = str(tmp_path / "kinds")
    parts = [("bigint", 1), ("double", 2.0), ("bigint", 3)]
    for hour, (kind, value) in enumerate(parts):
        frame = spark.createDataFrame([(hour, value)], f"id int, v {kind}")
        if hour == 1:
            frame = frame.selectExpr("*", "'e' AS extra")
        frame.coalesce(1).write.parquet(f"{root}/t/t_part_20240101-0{hour}0000.parquet")
    frames = read_each_part(spark, root, "t")
    assert len(frames) == 2
    found = [row for f in frames for row in rows(f.select("id", "v", "extra"))]
    assert found == [(0, 1, None), (2, 3, None), (1, 2.0, "e")]
