import random

import numpy as np
import pytest

from silvermill.llm import prefix_trie as T
from silvermill.llm.oracle import PREFIX_TRIE
from silvermill.llm.queries import op11_prefix_trie
from tests.conftest import rows
from tests.llm import brute

SCHEMA = "conv_id long, turn long, role string, text string"


def made(spark, turns, **options):
    return rows(T.conversation_trie(spark.createDataFrame(turns, SCHEMA), **options))


def expected(turns):
    found = brute.trie_nodes(brute.conversation_lists(turns))
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))


def random_turns(seed, count, most, texts=("", "a", "a b", "c  d e")):
    rng = random.Random(seed)
    return [
        (conv, turn, rng.choice(["user", "bot"][: 1 + (turn > 2)]), rng.choice(texts))
        for conv in rng.sample(range(10 * count), count) for turn in range(rng.randint(1, most))
    ]


def test_range_minimum_against_loops():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64):
        values = rng.integers(0, 4, n)
        table = T.RangeMinimum(values)
        first, last = np.array([(a, b) for a in range(n) for b in range(a, n)]).T
        assert table.of(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last)]
        at, depth = np.array([(i, d) for i in range(n) for d in range(5)]).T
        right = [next((j - 1 for j in range(i + 1, n) if values[j] < d), n - 1) for i, d in zip(at, depth)]
        left = [next((j for j in range(i, 0, -1) if values[j] < d), 0) for i, d in zip(at, depth)]
        assert table.reach_right(at, depth).tolist() == right
        assert table.reach_left(at, depth).tolist() == left


def test_common_turns():
    a, b = b"x" * 48, b"x" * 32 + b"y" * 16
    assert T.common_turns(a, b) == 2 and T.common_turns(a, a[:16]) == 1
    assert T.common_turns(b"", a) == 0 and T.common_turns(a, a) == 3


@pytest.mark.parametrize("seed, block_turns", [(1, 200_000), (2, 6), (3, 3), (4, 1)])
def test_random_conversations_in_any_number_of_blocks(spark, seed, block_turns):
    turns = random_turns(seed, 60, 6)
    assert made(spark, turns, block_turns=block_turns) == expected(turns)


def test_copies_fill_many_blocks(spark):
    turns = [(c, t, "user", f"turn {t}") for c in range(70) for t in range(3)]
    turns += [(c, t, "user", f"turn {t}") for c in range(70, 80) for t in range(c % 5 + 1)]
    assert made(spark, turns, block_turns=20) == expected(turns)


def test_ends_of_a_node_are_hashed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 3)
    turns = [(c, 0, "user", "same") for c in range(50)] + [(c, 1, "user", "more") for c in range(0, 50, 7)]
    assert made(spark, turns, block_turns=10) == expected(turns)


def test_nulls_ties_repeats_and_negative_ids(spark):
    turns = [
        (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "bot", "z"),
        (2, None, "", ""), (2, 0, "bot", "z"), (2, 0, "user", "a"), (2, 0, "user", "a"),
        (None, 0, "user", "lost"), (-7, 3, "user", "a:b"), (-8, 3, "user:a", "b"), (2**63 - 1, 1, "x", "y"),
        (-(2**63), 1, "x", "y"),
    ]
    assert made(spark, turns) == expected(turns)


def test_a_long_conversation_and_a_long_text(spark):
    turns = [(c, t, "user", "word " * (t % 3)) for c in (5, 6) for t in range(300)]
    turns += [(6, 300, "user", "end"), (7, 0, "user", "w " * 200_000)]
    assert made(spark, turns, block_turns=40) == expected(turns)


def test_empty_and_extra_columns(spark):
    assert made(spark, []) == []
    turns = random_turns(5, 10, 3)
    frame = spark.createDataFrame(
        [(*t, 1, "x", 2) for t in turns], SCHEMA + ", place int, key string, turns int"
    )
    assert rows(T.conversation_trie(frame)) == expected(turns)


def test_the_query_rebuilds_conversations(spark, tmp_path):
    rng = random.Random(9)
    turns = [
        (conv, None if turn == 1 and rng.random() < 0.2 else turn, "user", rng.choice("ab"))
        for conv in range(90) if conv % 40 != 20 for turn in range(rng.randint(1, 5))
    ]
    spark.createDataFrame(turns, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    found = rows(op11_prefix_trie(spark, str(tmp_path)))
    wanted = brute.trie_nodes(brute.rebuilt_lists(brute.conversation_lists(turns)))
    assert found == sorted(wanted, key=lambda r: tuple((v is not None, str(v)) for v in r))
    duckdb = pytest.importorskip("duckdb")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
        assert sorted(con.execute(PREFIX_TRIE).fetchall(), key=str) == sorted(wanted, key=str)
