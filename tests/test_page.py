import pytest
from pyspark.sql import functions as F

from silvermill.operators.rows import rows_between
from tests.conftest import rows
from tests.test_plans import plan


@pytest.mark.parametrize("first, last, descending", [(1, 1, False), (1, 7, True), (95, 333, False), (990, 1200, True), (2000, 2001, False)])
def test_pages_equal_the_sorted_rows(spark, first, last, descending):
    frame = spark.range(1000).select((F.col("id") * 7919 % 1000 % 90).alias("a"), F.md5(F.col("id").cast("string")).alias("b"))
    ordered = sorted(map(tuple, frame.collect()), reverse=descending)
    page = rows_between(frame, ["a", "b"], first, last, descending)
    assert sorted(map(tuple, page.collect()), key=lambda r: r[2]) == [
        (*row, n) for n, row in enumerate(ordered, 1) if first <= n <= last
    ]


def test_nulls_repeats_and_no_rows(spark):
    frame = spark.createDataFrame([(None,), (2,), (2,), (1,)], "a int")
    assert rows(rows_between(frame, ["a"], 2, 3).select("row_number", "a")) == [(2, 1), (3, 2)]
    assert rows_between(frame.limit(0), ["a"], 1, 5).collect() == []
    with pytest.raises(ValueError):
        rows_between(frame, ["a"], 0, 5)


def test_only_the_page_is_read_back_and_no_window_is_used(spark):
    text = plan(rows_between(spark.range(5000).toDF("a"), ["a"], 100, 110))
    assert "GreaterThanOrEqual(_place" in text and "Window" not in text and "SinglePartition" not in text
