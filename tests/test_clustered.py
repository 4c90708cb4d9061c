from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from silvermill.tables import SilverTable
from silvermill.tables.zorder import share_bounds, z_value
from tests.conftest import rows

SMALL_GROUPS = {"parquet.block.size": "4096", "parquet.page.size": "1024"}


def interleaved(shares, bits):
    return sum((share >> bit & 1) << (bit * len(shares) + i) for i, share in enumerate(shares) for bit in range(bits))


def groups_that_fit(path, column, low, high):
    """How many row groups statistics leave in, of how many."""
    fit = total = 0
    for file in Path(path).rglob("*.parquet"):
        if ".incoming" in str(file):
            continue
        found = pq.ParquetFile(file).metadata
        index = found.schema.names.index(column)
        for i in range(found.num_row_groups):
            stats = found.row_group(i).column(index).statistics
            total += 1
            fit += stats.min <= high and stats.max >= low
    return fit, total


def two_keys(spark, n=20000):
    return spark.range(n).select(
        F.col("id").alias("k"), (F.col("id") * 7919 % n).alias("a"), (F.col("id") * 104729 % n).alias("b"),
        F.md5(F.col("id").cast("string")).alias("v"),
    )


def test_filters_on_either_key_meet_few_row_groups(spark, tmp_path):
    frame = two_keys(spark)
    plain = SilverTable(spark, str(tmp_path / "plain"), ["k"], slices=2, write_options=SMALL_GROUPS)
    plain.overwrite(frame)
    table = SilverTable(
        spark, str(tmp_path / "z"), ["k"], slices=2, cluster_by=["a", "b"], write_options=SMALL_GROUPS
    )
    table.overwrite(frame)
    for column in ("a", "b"):
        before, of = groups_that_fit(plain.path, column, 500, 520)
        after, of_after = groups_that_fit(table.path, column, 500, 520)
        assert of >= 40 and of_after >= 40
        assert before * 10 >= of * 9 and after * 3 < of_after
        wanted = F.col(column).between(500, 520)
        assert rows(table.read().where(wanted)) == rows(frame.where(wanted))


def test_a_merge_keeps_the_order_in_what_it_writes(spark, tmp_path):
    frame = two_keys(spark)
    table = SilverTable(
        spark, str(tmp_path / "z"), ["k"], slices=2, cluster_by=["a", "b"], write_options=SMALL_GROUPS
    )
    table.overwrite(frame.where("k < 15000"))
    table.apply(frame.where("k >= 10000").withColumn("v", F.lit("new")))
    assert table.read().count() == 20000 and table.read().where("v = 'new'").count() == 10000
    for column in ("a", "b"):
        fit, total = groups_that_fit(table.path, column, 500, 520)
        assert fit * 3 < total


def test_places_interleave_and_nulls_come_first(spark):
    data = [(i, None if i == 0 else 100 - i) for i in range(64)]
    frame = spark.createDataFrame(data, "a int, b int")
    bounds = share_bounds(frame, ["a", "b"], 2)
    assert all(len(cuts) == 3 for cuts in bounds.values())
    got = frame.select("a", "b", z_value(frame.schema, bounds, 2).alias("z")).collect()
    for row in got:
        places = [
            0 if value is None else sum(value > cut for cut in bounds[name])
            for name, value in (("a", row.a), ("b", row.b))
        ]
        assert row.z == interleaved(places, 2)


def test_all_kinds_of_columns_order_as_their_numbers(spark):
    frame = spark.createDataFrame(
        [("", False, date(1900, 1, 1), -2.5, "1.5"), ("a", False, date(1970, 1, 1), 0.0, "2.5"),
         ("aé", True, date(2024, 2, 29), 7.25, "3.5"), ("b" * 9000, True, date(9999, 1, 1), float("inf"), "4.5"),
         (None, None, None, None, None)],
        "s string, f boolean, d date, x double, n string",
    ).withColumns({"t": F.col("d").cast("timestamp_ntz"), "n": F.col("n").cast("decimal(5, 1)"), "raw": F.col("s").cast("binary")})
    for name in ("s", "d", "x", "n", "t", "raw"):
        bounds = share_bounds(frame, [name], 3)
        z = [row[0] for row in frame.select(z_value(frame.schema, bounds, 3).alias("z")).collect()]
        assert z[:4] == sorted(z[:4]) and len(set(z[:4])) == 4 and z[4] == 0
    assert share_bounds(frame, ["f"], 3)["f"] == [0, 1]
    with pytest.raises(ValueError):
        share_bounds(frame.select(F.array("s").alias("l")), ["l"], 3)


def test_no_rows_one_value_and_too_many_bits(spark, tmp_path):
    table = SilverTable(spark, str(tmp_path / "z"), ["k"], cluster_by=["a", "b"])
    same = spark.createDataFrame([(i, 7, None, i) for i in range(50)], "k int, a int, b string, _z int")
    table.apply(same.limit(0))
    assert not table.exists()
    table.apply(same)
    table.append(same)
    assert table.read().count() == 100 and table.read().where("_z = k").count() == 100
    with pytest.raises(ValueError):
        z_value(same.schema, {"a": [], "b": []}, 32)
