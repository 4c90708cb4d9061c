"""Large CSV files read by byte ranges equal the same files read whole."""

import random

import pytest
from pyspark.sql import functions as F

from silvermill.sources.csv import _faithful, ingest_csv, push_then_pull, read_csv, read_quoted_csv, write_csv
from silvermill.sources.csv_records import csv_records, range_starts
from tests.conftest import rows
from tests.test_plans import settings


def small_ranges(spark, size):
    return settings(
        spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes="1",
        spark__sql__files__minPartitionNum="2",
    )


def quoted(value):
    return '"' + value.replace('"', '""') + '"' if any(c in value for c in '",\n\r') else value


def random_file(path, seed, end="\n", last_end=True, records=120):
    rng = random.Random(seed)
    values = ["a", "", "b c", 'say "hi"', "x,y", "one\ntwo", "\n\n\n", '"', 'q"\n"r', "é日", "w" * 30, '""', "t\r\nu"]
    lines = ["id,v1,v2"] + [
        f"{i},{quoted(rng.choice(values))},{quoted(rng.choice(values))}" for i in range(records)
    ]
    path.write_bytes((end.join(lines) + (end if last_end else "")).encode())


def whole(spark, path):
    return _faithful(spark.read, ",").option("multiLine", True).csv(path)


@pytest.mark.parametrize("seed, size, end", [
    (1, 100, "\n"), (2, 300, "\r\n"), (3, 700, "\n"), (4, 1 << 20, "\r\n"),
])
def test_ranges_of_any_size_equal_the_file_read_whole(spark, tmp_path, seed, size, end):
    path = tmp_path / "f.csv"
    random_file(path, seed, end, last_end=seed % 2 == 0)
    with small_ranges(spark, size):
        found = rows(read_quoted_csv(spark, str(path), infer=False))
    assert found == rows(whole(spark, str(path))) and len(found) == 120


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "f.csv"
    random_file(path, 8, records=400)
    with small_ranges(spark, 500):
        assert csv_records(spark, str(path)).select("record").rdd.getNumPartitions() > 10
        starts = range_starts(spark, str(path))
        assert starts.count() > 10 and starts.where("inside").count() > 0
        assert read_quoted_csv(spark, str(path), infer=False).count() == 400
    assert whole(spark, str(path)).rdd.getNumPartitions() == 1


def test_a_value_longer_than_several_ranges(spark, tmp_path):
    path = tmp_path / "f.csv"
    long_ = "\n".join(f"line {i} with \"\"quotes\"\", commas" for i in range(60))
    path.write_text(f'id,v\n1,"{long_}"\n2,x\n3,"{long_}"\n4,"a\nb"\n')
    with small_ranges(spark, 300):
        found = rows(read_quoted_csv(spark, str(path), schema="id int, v string"))
    assert found == [(1, long_.replace('""', '"')), (2, "x"), (3, long_.replace('""', '"')), (4, "a\nb")]


def test_several_files_each_with_a_header(spark, tmp_path):
    for i in range(3):
        random_file(tmp_path / f"f{i}.csv", 20 + i, "\r\n" if i == 1 else "\n", records=20)
    with small_ranges(spark, 200):
        assert rows(read_quoted_csv(spark, str(tmp_path), infer=False)) == rows(whole(spark, str(tmp_path)))


def test_types_are_inferred_as_by_the_reader(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('i,d,s,t,none\n1,1.5,"a\nb",2020-01-02,\n-20000000000,2,"c",2021-01-02,\n')
    ours, theirs = read_quoted_csv(spark, str(path)), read_csv(spark, str(path), multi_line=True)
    assert ours.dtypes == theirs.dtypes and rows(ours) == rows(theirs)
    assert read_quoted_csv(spark, str(path), ["s", "i"]).columns == ["s", "i"]


def test_odd_files(spark, tmp_path):
    cases = {
        "empty lines": "a,b\n\n1,2\n\n\n3,4\n", "header only": "a,b\n", "short and long rows": "a,b\n1\n1,2,3\n",
        "blanks": "a,b\n 1 , x \n", "no last end": 'a,b\n1,"x\ny"', "quoted names": '"a\nb","c,d"\n1,2\n',
        "a row like the header": "a,b\na,b\n1,2\n",
    }
    for name, text in cases.items():
        path = tmp_path / f"{name.replace(' ', '_')}.csv"
        path.write_text(text)
        with small_ranges(spark, 200):
            ours = read_quoted_csv(spark, str(path), infer=False)
            assert (ours.columns, rows(ours)) == (whole(spark, str(path)).columns, rows(whole(spark, str(path)))), name


def test_ingest_keeps_values_with_line_breaks(spark, tmp_path):
    frame = spark.range(40).selectExpr(
        "id", "concat('l', id, '\n\"m\", ', id) v", "CASE WHEN id % 3 = 0 THEN ' x ' END w"
    )
    write_csv(frame, str(tmp_path / "in"))
    with small_ranges(spark, 400):
        ingest_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"))
        back = push_then_pull(spark, str(tmp_path / "in"), str(tmp_path / "again"))
        assert rows(back.select(F.col("id").cast("long"), "v", "w")) == rows(frame)
    assert rows(whole(spark, str(tmp_path / "out"))) == rows(whole(spark, str(tmp_path / "in")))
