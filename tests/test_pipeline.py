import itertools
import time

import pytest
from pyspark.sql import functions as F

from silvermill.operators.parts import AmbiguousKeyError
from silvermill.plans import catalog
from silvermill.plans.pipeline import (
    append_pipeline,
    load_counts,
    run_daily,
    run_pipeline,
    silver_table,
)
from silvermill.sources import SEQ, read_parts
from silvermill.spec import ArraySpec, ColumnSpec, TableSpec
from silvermill.streaming import ingest_available
from tests.conftest import rows

MOVIE = (
    "id bigint, title string, budget bigint, homepage string, original_language string, "
    "original_title string, overview string, popularity double, release_date string, "
    "revenue bigint, runtime double, status string, tagline string, vote_average double, "
    "vote_count bigint, genres string, keywords string, production_companies string, "
    "production_countries string, spoken_languages string"
)


def movie(key, title="m", votes=1, genres="[]", original="m"):
    return (
        key, title, 5, None, "en", original, None, 0.5, "2009-1-5", 7, float("nan"), "Released",
        None, 7.5, votes, genres, "[]", '[{"id":1,"name":"firm"}]',
        '[{"iso_3166_1":"TR","name":"Turkey"}]', None,
    )


def write_movies(spark, root, part, data):
    spark.createDataFrame(data, MOVIE).coalesce(1).write.parquet(
        f"{root}/movies/movies_part_{part}.parquet"
    )


def write_credits(spark, root, part, data):
    spark.createDataFrame(data, "movie_id bigint, title string, `cast` string, crew string").coalesce(
        1
    ).write.parquet(f"{root}/credits/credits_part_{part}.parquet")


@pytest.fixture
def roots(tmp_path):
    return str(tmp_path / "bronze"), str(tmp_path / "silver")


def silver(spark, root, spec):
    return silver_table(spark, root, spec).read()


def test_daily_run_over_two_days(spark, roots):
    bronze, target = roots
    write_credits(spark, bronze, "20240101-080000", [(1, "m", '[{"credit_id":"c","cast_id":1}]', None)])
    write_movies(spark, bronze, "20240101-080000", [movie(1, votes=1), movie(2, original=None)])
    write_movies(spark, bronze, "20240101-200000", [movie(1, votes=2, genres='[{"id":3,"name":"Drama"}]')])
    write_movies(spark, bronze, "20240102-080000", [movie(1, votes=9)])

    report = run_daily(spark, bronze, target, ["20240101"])
    assert [(r.table, r.rows_in) for r in report.collect()] == [
        ("cast", 1), ("crew", 1), ("movies", 3), ("genres", 3), ("keywords", 3),
        ("production_companies", 3), ("production_countries", 3), ("spoken_languages", 3),
    ]
    assert rows(silver(spark, target, catalog.MOVIES), "movie_id", "vote_count", "runtime", "release_date")[0][:3] == ("1", 2, None)
    assert rows(silver(spark, target, catalog.GENRES)) == [("1", -9999, None), ("1", 3, "Drama"), ("2", -9999, None)]
    assert rows(silver(spark, target, catalog.CREW), "movie_id", "credit_id") == [("1", "0000000000")]
    assert rows(silver(spark, target, catalog.SPOKEN_LANGUAGES)) == [("1", "XX", None), ("2", "XX", None)]

    run_pipeline(spark, [catalog.MOVIES], bronze, target, ["20240102"])
    assert rows(silver(spark, target, catalog.MOVIES), "movie_id", "vote_count") == [("1", 9), ("2", 1)]


def test_a_day_without_parts_loads_nothing(spark, roots):
    bronze, target = roots
    report = run_pipeline(spark, [catalog.GENRES], bronze, target, ["19990101"])
    assert [(r.table, r.rows_in) for r in report.collect()] == [("genres", 0)]
    assert not silver_table(spark, target, catalog.GENRES).exists()


def test_the_first_failure_ends_the_run(spark, roots):
    bronze, target = roots
    bad = '[{"id":"x","name":"p"},{"id":"y","name":"q"}]'
    write_movies(spark, bronze, "20240101-080000", [movie(1, genres=bad)])
    write_movies(spark, bronze, "20240101-090000", [movie(1, genres=bad)])
    with pytest.raises(AmbiguousKeyError):
        run_pipeline(spark, [catalog.GENRES, catalog.KEYWORDS], bronze, target)
    assert not silver_table(spark, target, catalog.KEYWORDS).exists()


def test_tables_side_by_side(spark, roots):
    bronze, target = roots
    bad = '[{"id":"x","name":"p"},{"id":"y","name":"q"}]'
    write_movies(spark, bronze, "20240101-080000", [movie(1), movie(2)])
    specs = [catalog.GENRES, catalog.KEYWORDS, catalog.SPOKEN_LANGUAGES]
    report = run_pipeline(spark, specs, bronze, target, parallel=3)
    assert [(r.table, r.rows_in) for r in report.collect()] == [
        ("genres", 2), ("keywords", 2), ("spoken_languages", 2)]
    write_movies(spark, bronze, "20240102-080000", [movie(1, genres=bad)])
    with pytest.raises(AmbiguousKeyError):
        run_pipeline(spark, specs, bronze, target, ["20240102"], parallel=3)


def test_a_failure_side_by_side_starts_no_more(spark, roots):
    bronze, target = roots
    write_movies(spark, bronze, "20240101-080000", [movie(1)])
    started = []

    def open_table(spark, root, spec, slices):
        started.append(spec.name)
        if spec.name == "genres":
            raise OSError("no table")
        time.sleep(2)
        return silver_table(spark, root, spec, slices)

    specs = [catalog.GENRES, catalog.KEYWORDS, catalog.SPOKEN_LANGUAGES, catalog.MOVIES]
    with pytest.raises(OSError, match="no table") as failure:
        run_pipeline(spark, specs, bronze, target, parallel=2, open_table=open_table)
    assert sorted(started) == ["genres", "keywords"]
    assert [row[0] for row in failure.value.finished] == ["keywords"]


def test_bootstrap_always_replaces_what_is_there(spark, roots):
    bronze, target = roots
    write_movies(spark, bronze, "20240101-080000", [movie(1), movie(2)])
    write_movies(spark, bronze, "20240102-080000", [movie(3)])
    run_pipeline(spark, [catalog.GENRES], bronze, target, ["20240101"])
    run_pipeline(spark, [catalog.GENRES], bronze, target, ["20240102"], bootstrap="always")
    assert rows(silver(spark, target, catalog.GENRES), "movie_id") == [("3",)]


def test_parts_with_different_types(spark, roots):
    bronze, target = roots
    write_movies(spark, bronze, "20240101-080000", [movie(1)])
    whole = spark.createDataFrame([movie(2)], MOVIE).withColumn("runtime", F.lit(162).cast("bigint"))
    whole.coalesce(1).write.parquet(f"{bronze}/movies/movies_part_20240101-090000.parquet")
    run_pipeline(spark, [catalog.MOVIES], bronze, target, ["20240101"], mixed_types=True)
    assert rows(silver(spark, target, catalog.MOVIES), "movie_id", "runtime") == [("1", None), ("2", 162)]


def test_append_pipeline_and_load_counts(spark, roots):
    bronze, target = roots
    write_movies(spark, bronze, "20240101-080000", [movie(1), movie(2)])
    write_movies(spark, bronze, "20240101-090000", [movie(1)])
    for _ in range(2):
        append_pipeline(spark, [catalog.GENRES], bronze, target, ["20240101"])
    assert silver(spark, target, catalog.GENRES).count() == 6
    counts = load_counts(read_parts(spark, bronze, "movies"), before=10)
    assert rows(counts) == [(20240101080000, 2, 12), (20240101090000, 1, 13)]


PAIR = TableSpec(
    "pairs", "pairs", (ColumnSpec("parent", "string"),), ("parent", "id"),
    array=ArraySpec("items", {"id": "int", "name": "string"}, ("id", "name")),
    sentinels={"id": -9999}, slice_by=("parent",),
)
PAIR_SCHEMA = "parent bigint, items string"


def write_pairs(spark, root, part, data):
    spark.createDataFrame(data, PAIR_SCHEMA).coalesce(1).write.parquet(
        f"{root}/pairs/pairs_part_{part}.parquet"
    )


def test_stream_takes_each_part_once_in_name_order(spark, roots, tmp_path):
    bronze, target = roots
    table = silver_table(spark, target, PAIR, slices=2)

    def ingest():
        ingest_available(spark, PAIR, bronze, table, str(tmp_path / "ckpt"), PAIR_SCHEMA, 1)

    # The latest part by name arrives first.
    for time in ("222937", "105003", "080000"):
        write_pairs(spark, bronze, f"20240101-{time}", [(1, f'[{{"id":1,"name":"{time}"}}]'), (None, "[]")])
    ingest()
    assert rows(table.read()) == [(None, -9999, None)] * 3 + [("1", 1, "222937")]
    ingest()
    assert table.read().count() == 4
    write_pairs(spark, bronze, "20240102-010000", [(1, '[{"id":1,"name":"next"}]'), (2, "[]")])
    ingest()
    assert rows(table.read()) == [(None, -9999, None)] * 3 + [("1", 1, "next"), ("2", -9999, None)]


def test_batch_equals_stream(spark, roots, tmp_path):
    bronze, target = roots
    for day, key in itertools.product(("01", "02"), (1, 2)):
        write_pairs(spark, bronze, f"202401{day}-0{key}0000", [
            (key, f'[{{"id":{day},"name":"n{day}{key}"}}]'), (3, f'[{{"id":9,"name":"{day}{key}"}}]'),
        ])
    run_pipeline(spark, [PAIR], bronze, target)
    streamed = silver_table(spark, str(tmp_path / "streamed"), PAIR, slices=2)
    ingest_available(spark, PAIR, bronze, streamed, str(tmp_path / "ckpt"), PAIR_SCHEMA, 1)
    assert rows(silver(spark, target, PAIR)) == rows(streamed.read())


def test_seq_follows_the_name(spark, roots):
    bronze, _ = roots
    write_pairs(spark, bronze, "20240101-222937", [(1, "[]")])
    assert [r[0] for r in read_parts(spark, bronze, "pairs").select(SEQ).collect()] == [20240101222937]
