"""Merges of newest rows: what is shuffled, written and moved, and what is left."""

import pytest
from pyspark.sql import functions as F

from silvermill.operators.parts import newest_of_parts
from silvermill.operators.upsert import further_copies, key_filter
from silvermill.plans import star
from silvermill.sources import read_parts
from silvermill.tables import SilverTable
from tests.conftest import rows
from tests.test_plans import plan

SCHEMA = "k int, j string, v int, _seq bigint"
LATEST = {"seq": "_seq", "on_duplicate": "latest", "order_by": ["v"]}


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


@pytest.fixture
def table(spark, tmp_path, monkeypatch):
    def no_staging(*_, **__):
        raise AssertionError("the batch is written twice")

    monkeypatch.setattr("silvermill.tables.silver.stage", no_staging)
    return SilverTable(spark, str(tmp_path / "t"), ["k", "j"], slices=3)


def test_a_row_is_shuffled_once_and_no_set_without_need(spark):
    df = frame(spark, (1, "a", 1, 1), (1, "a", 2, 1), (1, "a", 9, 0), (None, "a", 3, 1))
    lean = newest_of_parts(df, ["k", "j"], "_seq", ["v"], count_extra=False)
    assert "max_by" not in plan(lean) and "collect_set" not in plan(lean)
    assert rows(lean, "k", "v", "_rows") == [(None, 3, 1), (1, 2, 3)]
    mapped = df.withColumn("m", F.create_map("j", "v"))
    assert "max_by" in plan(newest_of_parts(mapped, ["k", "j"], "_seq", ["v"]))


def test_newest_rows_are_written_once(spark, table):
    assert table.apply(frame(spark, (1, "a", 1, 1), (1, "a", 2, 1), (2, "b", 3, 1), (None, "c", 4, 1)), **LATEST) == 4
    assert rows(table.read(), "k", "v") == [(None, 4), (1, 2), (2, 3)]
    many = frame(spark, (1, "a", 7, 2), *[(k, "n", k, 2) for k in range(10, 40)], (None, "c", 5, 2))
    assert table.apply(many, **LATEST) == 32
    assert rows(table.read().where("k is null or k < 10"), "k", "v") == [(None, 4), (None, 5), (1, 7), (2, 3)]
    assert table.read().count() == 34
    assert table.apply(frame(spark), **LATEST) == 0 and table.read().count() == 34


def test_each_of_several_table_rows_is_updated(spark, table):
    table.append(frame(spark, (1, "a", 1, 0), (1, "a", 2, 0), (1, "a", 3, 0), (2, "b", 4, 0)), "_seq")
    table.apply(frame(spark, (1, "a", 9, 1), (3, "c", 5, 1)), **LATEST)
    assert rows(table.read(), "k", "v") == [(1, 9), (1, 9), (1, 9), (2, 4), (3, 5)]


def test_slices_that_gain_keep_their_files(spark, table, tmp_path):
    table.overwrite(frame(spark, *[(k, "a", k, 0) for k in range(30)]), "_seq")
    before = set((tmp_path / "t").rglob("*.parquet"))
    table.apply(frame(spark, *[(k, "a", k, 1) for k in range(30, 60)]), **LATEST)
    assert before < set((tmp_path / "t").rglob("*.parquet")) and table.read().count() == 60
    table.apply(frame(spark, *[(k, "a", -1, 2) for k in range(60)]), **LATEST)
    assert not before & set((tmp_path / "t").rglob("*.parquet"))
    assert table.read().where("v = -1").count() == table.read().count() == 60


def test_always_replaces_and_null_safe_keys_match(spark, tmp_path):
    table = SilverTable(spark, str(tmp_path / "n"), ["k", "j"], slices=2, null_safe_keys=True)
    table.apply(frame(spark, (None, "a", 1, 1), (2, "b", 3, 1)), **LATEST)
    table.apply(frame(spark, (None, "a", 5, 2)), **LATEST)
    assert rows(table.read(), "k", "v") == [(None, 5), (2, 3)]
    table.apply(frame(spark, (7, "a", 5, 2)), bootstrap="always", **LATEST)
    assert rows(table.read(), "k", "v") == [(7, 5)]


def test_a_merge_that_stops_loses_nothing(spark, table, monkeypatch):
    table.apply(frame(spark, (1, "a", 1, 1)), **LATEST)
    with monkeypatch.context() as stopped:
        stopped.setattr(table, "_keep_others", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.apply(frame(spark, (1, "a", 2, 2), (2, "b", 2, 2)), **LATEST)
    assert rows(table.read(), "k", "v") == [(1, 1)]
    table.apply(frame(spark, (3, "c", 3, 2)), **LATEST)
    assert rows(table.read(), "k", "v") == [(1, 1), (3, 3)]


def test_further_copies(spark):
    base = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    counts = spark.createDataFrame([(1, 1), (2, 3), (3, 25_002)], "k int, count bigint")
    found = further_copies(base, counts, ["k"]).groupBy("k", "v").count()
    assert rows(found) == [(2, "y", 2), (3, "z", 25_001)]


def test_many_keys_are_not_told_apart(spark, monkeypatch):
    calls = []
    kind = type(spark.range(1))
    distinct = kind.distinct
    monkeypatch.setattr(kind, "distinct", lambda self: calls.append(1) or distinct(self))
    batch = spark.range(5_000).selectExpr("id k")
    wanted = key_filter(batch, ["k"])
    assert not calls and spark.range(-5, 6_000).selectExpr("id k").where(wanted).count() == 5_000
    key_filter(batch.limit(10), ["k"])
    assert calls


def test_parts_are_sorted_before_their_texts_are_made(spark, tmp_path):
    spark.createDataFrame(
        [(1, "O", 5, "1-URGENT", 10.0, "1993-02-01"), (2, "F", 6, "2-HIGH", 20.0, "1994-02-01"), (3, "F", 6, "4-LOW", 20.0, None)],
        "o_orderkey bigint, o_orderstatus string, o_custkey bigint, o_orderpriority string, o_totalprice double, day string",
    ).selectExpr("*", "to_timestamp(day) o_orderdate").drop("day").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(
        [(1, 1, 7, 8, "A", "F", "1993-03-01"), (1, 2, 7, 8, "N", "O", "1994-03-01"), (1, 3, 7, 8, "N", "O", None)],
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string, day string",
    ).selectExpr("*", "to_timestamp(day) l_shipdate").drop("day").write.parquet(f"{tmp_path}/lineitem.parquet")
    made = star.credits(spark, str(tmp_path), F.lpad(F.col("ship_year").cast("string"), 6, "0"))
    text = plan(made)
    assert text.index(" AS cast#") < text.index("Sort [_part")
    star.write_credits(spark, str(tmp_path), f"{tmp_path}/bronze")
    star.write_movies(spark, str(tmp_path), f"{tmp_path}/bronze")
    assert rows(read_parts(spark, f"{tmp_path}/bronze", "credits"), "movie_id", "_seq") == [
        (1, 20240101030000), (1, 20240101040000), (2, 20240101040000),
    ]
    assert rows(read_parts(spark, f"{tmp_path}/bronze", "movies"), "id", "_seq") == [
        (1, 20240101030000), (1, 20240102080000), (2, 20240101040000), (2, 20240102080000), (3, 20240102080000),
    ]
