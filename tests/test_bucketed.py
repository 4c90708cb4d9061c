"""Merges into bucketed tables: results, plans, and writers that die."""

import re

import pytest
from pyspark.errors import PySparkException

from silvermill.operators.upsert import upsert
from silvermill.scratch import stored
from silvermill.tables import BucketedTable
from tests.conftest import rows
from tests.test_plans import plan, settings

SCHEMA = "k long, s string, v int"


def table(spark, tmp_path, data, buckets=4):
    made = BucketedTable(spark, str(tmp_path / "it's a table"), ["k", "s"], buckets)
    made.overwrite(spark.createDataFrame(data, SCHEMA))
    return made


def test_merge_equals_the_lazy_upsert(spark, tmp_path):
    old = [(i % 30, "abc"[i % 3], i) for i in range(60)] + [(None, "a", 1), (5, None, 2)]
    new = [(i, "abc"[i % 3], -i) for i in range(20, 50)] + [(None, "a", 3), (90, "z", 1), (90, "z", 2)]
    made = table(spark, tmp_path, old)
    source = spark.createDataFrame(new, SCHEMA)
    made.merge(source.select("v", "s", "k"))  # columns by name
    assert rows(made.read()) == rows(upsert(spark.createDataFrame(old, SCHEMA), source, ["k", "s"]))
    made.merge(spark.createDataFrame([], SCHEMA))
    assert made.read().count() == len(old) + 23


def test_several_source_rows_for_one_row_are_refused_and_change_nothing(spark, tmp_path):
    made = table(spark, tmp_path, [(1, "a", 1)])
    before = rows(made.read())
    with pytest.raises(PySparkException, match="several source rows"):
        made.merge(spark.createDataFrame([(1, "a", 2), (1, "a", 3)], SCHEMA))
    assert rows(made.read()) == before  # the version that was begun is not complete
    made.merge(spark.createDataFrame([(1, "a", 2)], SCHEMA))
    assert rows(made.read()) == [(1, "a", 2)]


def test_the_table_is_not_shuffled(spark, tmp_path):
    made = table(spark, tmp_path, [(i, "a", i) for i in range(1000)], buckets=8)
    source = stored(spark.createDataFrame([(i, "a", -i) for i in range(500, 1500)], SCHEMA), "batch")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        for frame in made.merged(made.read(), source, 8):
            text = plan(frame)
            assert "Bucketed: true" in text
            # every exchange reads the batch: none stands above the table's scan
            branch = re.split(r"(?=Exchange hashpartitioning)", text)
            assert len(branch) > 1 and all("Bucketed: true" not in part.split("SortMergeJoin")[0].split("FileScan")[1]
                                           for part in branch[1:] if "FileScan" in part)
            frame.collect()
        joined = made.read().join(made.read().withColumnRenamed("v", "w"), ["k", "s"])
        assert "Exchange" not in plan(joined) and joined.count() == 1000
        assert "Exchange" not in plan(made.read().groupBy("k", "s").count())


def test_versions_overwrite_from_itself_and_vacuum(spark, tmp_path):
    made = table(spark, tmp_path, [(i, "a", i) for i in range(10)])
    made.overwrite(made.read().where("v < 5"))
    assert made.read().count() == 5 and [v for v, _ in made._versions()] == [1, 2]
    again = BucketedTable(spark, made.path, ["k", "s"], buckets=7)
    assert again.exists() and again.read().count() == 5
    again.vacuum()
    assert [v for v, _ in again._versions()] == [2] and again.read().count() == 5
    with pytest.raises(FileNotFoundError):
        BucketedTable(spark, str(tmp_path / "none"), ["k"]).read()


def test_a_writer_that_dies_leaves_the_table(spark, tmp_path, monkeypatch):
    made = table(spark, tmp_path, [(1, "a", 1)])
    monkeypatch.setattr("silvermill.tables.bucketed.mark", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        made.merge(spark.createDataFrame([(1, "a", 5), (2, "b", 6)], SCHEMA))
    monkeypatch.undo()
    assert rows(made.read()) == [(1, "a", 1)]
    made.merge(spark.createDataFrame([(2, "b", 7)], SCHEMA))
    assert rows(made.read()) == [(1, "a", 1), (2, "b", 7)]
