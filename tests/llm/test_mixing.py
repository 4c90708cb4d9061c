"""Source mixing against shares found by plain rounds and numeric integrals."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from silvermill.llm.mixing import CURRICULUM, mix_sources, source_targets, training_order, training_position
from silvermill.llm.queries import op7_mixing
from tests.llm.brute import shared_targets, words

SCHEMA = "doc_id long, text string, source string"


def corpus(n=300, seed=5):
    """One source holds most rows; one is tiny; texts may be null or empty."""
    draw = random.Random(seed)
    names = ["hot"] * 12 + ["b", "c", None, "É", "tiny"]
    rows = [
        (i, draw.choice([None, "", "w " * draw.randrange(1, 40), "w\t" * 9]), draw.choice(names)) for i in range(n)
    ]
    return rows + [(n, "w " * 4000, "hot")]


def mixed(spark, rows, **options):
    return mix_sources(spark.createDataFrame(rows, SCHEMA), **options).select("doc_id", "source", "mix.*").collect()


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 5, "c": 7, None: 900}, {"a": 10, "b": 0}, {"z": 1}, {"a": 0},
    {"a": 1, "b": 1, "c": 1, "d": 1, "e": 10_000}, {"a": 40, "B": 300, "é": 2, "~": 9, None: 1},
])
def test_targets_against_rounds(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in source_targets(frame).collect()}
    expected = shared_targets(sizes)
    assert found.keys() == expected.keys()
    assert all(abs(found[s] - expected[s]) < 1e-6 for s in expected)


def test_taken_words_meet_targets(spark):
    rows = corpus()
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(words(text))
    expected = shared_targets(sizes)
    for r in mixed(spark, rows):
        taken[r.source] += r.taken
        assert r.size == len(words(rows[r.doc_id][1])) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size and abs(r.target - expected[r.source]) < 1e-6
        assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1)
    assert all(abs(taken[s] - expected[s]) < 1 for s in sizes)


def test_the_query_takes_what_the_ordered_copies_hold(spark, tmp_path):
    rows = corpus(80)
    rows += [rows[0], (3, "another text of id three", "b")]  # a repeated row and a shared id
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    plain = mixed(spark, rows)
    expected = sorted(
        (r.doc_id, r.size, r.source_size, r.target, r.taken, -1.0 if r.position is None else round(r.position, 6))
        for r in plain
    )
    found = sorted(
        (r.doc_id, r.size, r.source_size, r.target, r.taken, -1.0 if r.position is None else r.position)
        for r in op7_mixing(spark, str(tmp_path)).collect()
    )
    assert len(found) == len(rows)
    for got, want in zip(found, expected):
        assert got[:3] == want[:3] and got[4] == want[4]
        assert abs(got[3] - want[3]) < 1e-9 and abs(got[5] - want[5]) < 2e-6


def test_reruns_and_other_layouts_agree(spark):
    rows = corpus()
    shuffled = random.Random(9).sample(rows, len(rows))
    key = lambda r: r.doc_id
    assert sorted(mixed(spark, rows), key=key) == sorted(mixed(spark, shuffled), key=key)
    assert sorted(mixed(spark, rows, bucket_digits=1), key=key) == sorted(mixed(spark, rows), key=key)


@pytest.mark.parametrize("rank", range(len(CURRICULUM)))
def test_positions_invert_the_schedule(spark, rank):
    shares = [i / 20 for i in range(21)]
    frame = spark.createDataFrame([(s,) for s in shares], "share double")
    position = training_position(F.col("share"), F.lit(rank), CURRICULUM)
    knots = CURRICULUM[rank]
    grid = np.linspace(0, 1, 100_001)
    weight = np.interp(grid, np.linspace(0, 1, len(knots)), knots)
    done = np.concatenate([[0], np.cumsum((weight[1:] + weight[:-1]) / 2)])
    for r in frame.select("share", position.alias("at")).collect():
        assert abs(np.interp(r["at"], grid, done / done[-1]) - r.share) < 1e-6


def test_training_order_reads_what_the_mix_takes(spark):
    rows = corpus()
    frame = mix_sources(spark.createDataFrame(rows, SCHEMA))
    ordered = training_order(frame, partitions=3).select("doc_id", "mix.*").collect()
    places = [r.position for r in ordered]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    read = defaultdict(int)
    for r in ordered:
        read[r.doc_id] += r.words
    assert dict(read) == {r.doc_id: r.taken for r in frame.select("doc_id", "mix.taken").collect() if r.taken}


def test_repeated_rows_and_null_ids_are_rows(spark):
    found = mixed(spark, [(1, "a b", "s")] * 3 + [(None, "c", "s"), (None, None, None)])
    assert sum(r.taken for r in found) == 7 and len(found) == 5


def test_empty_table_and_clashing_columns(spark):
    assert mixed(spark, []) == []
    frame = spark.createDataFrame(
        [(1, "a b", "s", 5, "m", 6, "k")],
        "doc_id long, text string, source string, size int, mix string, _mix_goal int, bucket string",
    )
    found = mix_sources(frame)
    assert found.columns == ["doc_id", "text", "source", "size", "bucket", "mix"]
    row = found.first()
    assert (row["size"], row.mix["size"], row.mix.taken) == (5, 2, 2)


def test_schedules_are_checked(spark):
    frame = spark.createDataFrame([], SCHEMA)
    for bad in ([(1.0,)], [(1.0, -1.0)], [(0.0, 0.0)]):
        with pytest.raises(ValueError):
            mix_sources(frame, schedules=bad)
