import itertools
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from silvermill.operators.parts import AmbiguousKeyError
from silvermill.operators.upsert import latest_per_key, upsert
from silvermill.tables import SilverTable
from tests.conftest import rows

KEYS = ("k1", "k2")
SCHEMA = "k1 int, k2 string, v string"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_rules(spark):
    target = frame(spark, [(1, "a", "t1"), (1, "a", "t1dup"), (2, None, "tnull"), (3, "c", "keep")])
    source = frame(spark, [(1, "a", "s1"), (2, None, "snull"), (4, "d", "new")])
    assert rows(upsert(target, source, KEYS)) == rows(frame(spark, [
        (1, "a", "s1"), (1, "a", "s1"), (2, None, "snull"), (2, None, "tnull"),
        (3, "c", "keep"), (4, "d", "new"),
    ]))


def test_null_safe_keys_match(spark):
    target = frame(spark, [(2, None, "tnull")])
    source = frame(spark, [(2, None, "snull"), (None, None, "new")])
    out = upsert(target, source, KEYS, null_safe=True)
    assert rows(out) == [(None, None, "new"), (2, None, "snull")]


def test_ambiguous_source(spark):
    target = frame(spark, [(1, "a", "t")])
    source = frame(spark, [(1, "a", "x"), (1, "a", "y")])
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(target, source, KEYS).collect()
    out = upsert(target, source, KEYS, "latest", order_by=["v"])
    assert rows(out) == [(1, "a", "y")]


def test_repeated_new_key_is_inserted_whole(spark):
    target = frame(spark, [(9, "z", "t")])
    source = frame(spark, [(1, "a", "x"), (1, "a", "y")])
    assert rows(upsert(target, source, KEYS)) == [(1, "a", "x"), (1, "a", "y"), (9, "z", "t")]


def test_source_columns_must_match(spark):
    with pytest.raises(ValueError, match="differ in columns"):
        upsert(frame(spark, []), frame(spark, [], "k1 int, k2 string"), KEYS)


def test_both_sides_from_one_frame(spark, star):
    orders = spark.read.parquet(f"{star}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    out = upsert(orders, orders.withColumn("o_totalprice", F.lit(0.0)), ["o_orderkey", "o_custkey"])
    assert out.count() == orders.count()
    assert out.where("o_totalprice <> 0").isEmpty()


def test_latest_per_key_keeps_null_keys(spark):
    df = frame(spark, [(1, "a", "x"), (1, "a", "y"), (1, None, "n"), (1, None, "n")])
    assert rows(latest_per_key(df, KEYS, ["v"])) == [(1, None, "n"), (1, None, "n"), (1, "a", "y")]


class Ambiguous(Exception):
    pass


def merge_in_turn(target, parts):
    """What applying the parts one after the other gives, in plain Python."""
    table = list(target or [])
    for part in parts:
        have = [r for r in table if None not in r[:2]]
        keys = {r[:2] for r in have}
        for key, group in itertools.groupby(sorted(r[:2] for r in part if None not in r[:2])):
            if key in keys and len(list(group)) > 1:
                raise Ambiguous(key)
        new = {r[:2]: r for r in part if r[:2] in keys}
        table = [new.get(r[:2], r) if None not in r[:2] else r for r in table]
        table += [r for r in part if r[:2] not in new]
    return table


@pytest.mark.parametrize("seed", range(14))
def test_one_pass_equals_parts_in_turn(spark, tmp_path, seed):
    rng = random.Random(seed)
    repeats = seed % 2 == 0
    counter = itertools.count()

    def make(n, unique):
        out, used = [], set()
        for _ in range(n):
            row = (rng.choice([1, 2, 3, 4, 5, None]), rng.choice(["a", "b", "c", None]), f"v{next(counter)}")
            if unique and None not in row[:2] and row[:2] in used:
                continue
            used.add(row[:2])
            out.append(row)
        return out

    target = make(4, unique=False) if seed % 3 else None
    parts = [make(3 if repeats else 6, unique=not repeats) for _ in range(3)]
    table = SilverTable(spark, str(tmp_path / "t"), KEYS, slices=4)
    if target:
        table.overwrite(frame(spark, target))
    source = frame(
        spark, [(*r, 100 + i) for i, p in enumerate(parts) for r in p], SCHEMA + ", seq bigint"
    )
    try:
        expected = merge_in_turn(target, parts)
    except Ambiguous:
        with pytest.raises(AmbiguousKeyError):
            table.apply(source, seq="seq")
        return
    assert table.apply(source, seq="seq") == sum(map(len, parts))
    assert rows(table.read()) == sorted(expected, key=lambda r: tuple((v is not None, str(v)) for v in r))
