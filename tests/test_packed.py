"""Newest rows by compressed blocks: the same rows as Spark's aggregate, without its sorts."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silvermill.operators.packed import _BUCKET, bucket_count, can_pack, newest_packed
from silvermill.operators.parts import newest_of_parts
from silvermill.plans.catalog import CAST
from silvermill.sources.filesystem import total_bytes
from silvermill.tables import SilverTable
from tests.conftest import rows
from tests.test_plans import plan

SCHEMA = (
    "k int, `j.x` string, d double, f float, b boolean, t timestamp, n timestamp_ntz, s string, "
    "y binary, p decimal(12,2), e date, h smallint, _seq bigint"
)
KEYS = ["k", "j.x"]


def odd_rows(seed, n):
    chance = random.Random(seed)
    pick = lambda *values: chance.choice(values)
    return [(
        pick(None, 1, 2, 3, n), pick(None, "", "a", "ä", "a" * 40), pick(None, float("nan"), -1.0, 0.5, float("inf")),
        pick(None, float("nan"), 2.5), pick(None, True, False), pick(None, datetime(1960, 1, 1), datetime(2024, 5, 6, 7, 8, 9, 11)),
        pick(None, datetime(1500, 1, 1)), pick(None, "", "z", "Ω", "\U0001f600"), pick(None, b"", b"\xff", b"\x00a"),
        pick(None, Decimal("-1.50"), Decimal("9999999999.99")), pick(None, date(1582, 10, 4), date(2024, 2, 29)),
        pick(None, -5, 300), pick(None, 1, 2, 2**60),
    ) for _ in range(n)]


@pytest.mark.parametrize("portion_bytes", [1, 2000, 1 << 26])
def test_the_same_rows_as_the_aggregate(spark, portion_bytes):
    df = spark.createDataFrame(odd_rows(portion_bytes, 900), SCHEMA).repartition(5)
    names = [f"`{c}`" for c in df.columns]
    order = ["_seq", "d", "f", "b", "s", "y", "p"]
    assert can_pack(df, KEYS, order)
    plain = df.toDF(*[c.replace(".", "_") for c in df.columns])
    expected = newest_of_parts(plain, ["k", "j_x"], "_seq", order[1:], count_extra=False)
    found = newest_packed(df, KEYS, order, ["k"], 3, portion_bytes)
    assert found.columns == [*KEYS, *[c for c in df.columns if c not in KEYS], "_rows"]
    assert [str(r) for r in rows(found, *names, "_rows")] == [str(r) for r in rows(expected)]


def test_rows_of_a_task_are_neither_sorted_nor_shuffled_one_by_one(spark, monkeypatch, tmp_path):
    df = spark.createDataFrame([(1, "a", 1, 1), (1, "a", 2, 1), (2, "b", 3, 1), (None, "c", 4, 1)], "k int, j string, v int, _seq bigint")
    text = plan(newest_packed(df, ["k", "j"], ["_seq", "v"], ["k"], 4))
    assert "SortAggregate" not in text and "Sort [" not in text

    def aggregated(*_, **__):
        raise AssertionError("rows are sorted in each task")

    monkeypatch.setattr("silvermill.tables.silver.newest_of_parts", aggregated)
    df.write.parquet(f"{tmp_path}/batch")
    table = SilverTable(spark, str(tmp_path / "t"), ["k", "j"], ["k"], slices=3)
    batch = spark.read.parquet(f"{tmp_path}/batch")
    assert table.apply(batch, seq="_seq", on_duplicate="latest", order_by=["v"]) == 4
    assert rows(table.read(), "k", "v") == [(None, 4), (1, 2), (2, 3)]


def test_a_block_has_many_rows_and_a_hot_key_one(spark):
    lines = spark.range(60_000).select(
        F.concat(F.lit("c-"), (F.col("id") / 3).cast("int"), F.lit("-"), F.col("id") % 3).alias("credit_id"),
        (F.col("id") / 3).cast("int").cast("string").alias("movie_id"),
        F.concat(F.lit("Title of "), (F.col("id") / 3).cast("int")).alias("title"), F.lit(1).cast("bigint").alias("_seq"),
    )
    hot = lines.withColumn("credit_id", F.lit("hot")).withColumn("movie_id", F.lit("hot"))
    both = lines.unionByName(hot).coalesce(2)
    newest = newest_packed(both, CAST.keys, ["_seq"], CAST.slice_by, 4)
    assert newest.count() == 60_001
    assert newest.where("credit_id = 'hot'").select("_rows").first()[0] == 60_000
    from silvermill.operators import packed

    rows_in = lines.select("credit_id", "movie_id", "_seq", "title", F.lit(1).cast("bigint"), F.lit(0)).toDF(*"01234", _BUCKET)
    blocks = rows_in.coalesce(2).mapInArrow(packed._packer(2, 1 << 26), f"{_BUCKET} int, block binary")
    n, size = blocks.agg(F.count("*"), F.sum(F.length("block"))).first()
    assert n == 2 and size < 60_000 * 12  # each row has some 40 bytes of text


def test_types_that_arrow_orders_otherwise_stay_with_spark(spark):
    df = spark.createDataFrame([(1, 1.0, [1], 1)], "k int, f double, a array<int>, _seq bigint")
    assert can_pack(df.drop("a"), ["k"], ["f"])
    assert not can_pack(df, ["k"], ["f"])
    assert not can_pack(df.drop("a"), ["f"], [])
    assert not can_pack(df.drop("a"), ["k"], ["F"])
    assert not can_pack(df.drop("a").withColumn("_rows", F.lit(1)), ["k"], ["f"])


def test_buckets_follow_the_bytes_read(spark, tmp_path, monkeypatch):
    spark.range(1000).repartition(3).write.parquet(f"{tmp_path}/a b")
    df = spark.read.parquet(f"{tmp_path}/a b")
    size = sum(f.stat().st_size for f in (tmp_path / "a b").glob("*.parquet"))
    assert total_bytes(spark, df.inputFiles()) == size
    assert bucket_count(df, 3) == 6 and bucket_count(df, 100) == 4 and bucket_count(df, 2) == 4
    monkeypatch.setattr("silvermill.operators.packed._BUCKET_BYTES", size // 40)
    assert bucket_count(df, 4) in (40, 44)
    assert bucket_count(spark.range(5), 4) is None
