import random

import numpy as np
import pytest

from silvermill.llm import jaccard_join as J
from silvermill.llm.components import connected_components
from tests.llm.brute import jaccard_components

SCHEMA = "doc_id long, text string"


def run(spark, rows, **options):
    frame = J.near_duplicates(spark.createDataFrame(rows, SCHEMA), **options)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def copies(seed, bases=6, each=12, length=120, edits=8):
    """Near copies of several bases, at all distances around the threshold."""
    draw = random.Random(seed)
    rows, number = [], 0
    for base in range(bases):
        text = [f"w{draw.randrange(3000)}" for _ in range(draw.randrange(8, length))]
        for _ in range(each):
            mine = list(text)
            for _ in range(draw.randrange(edits)):
                mine[draw.randrange(len(mine))] = f"e{draw.randrange(50)}"
            rows.append((number * 7 % 1009, " ".join(mine)))
            number += 1
    return rows


@pytest.mark.parametrize("seed,size,percent", [(1, 3, 90), (2, 5, 80), (3, 1, 70), (4, 2, 50)])
def test_random_copies_against_brute_force(spark, seed, size, percent):
    rows = copies(seed)
    assert run(spark, rows, shingle=size, percent=percent) == jaccard_components(rows, size, percent)


@pytest.mark.parametrize("seed,size,percent", [(5, 3, 80), (6, 1, 70)])
def test_parts_of_blocks_find_what_whole_blocks_find(spark, seed, size, percent):
    rows = copies(seed, bases=4, each=30, length=60)
    expected = jaccard_components(rows, size, percent)
    assert run(spark, rows, shingle=size, percent=percent, part_rows=3) == expected


def test_cells_have_every_two_components_of_a_block_once_in_bounded_parts(spark):
    draw = random.Random(8)
    labels = {n: (1 if n < 300 else 2 if n < 360 else n) for n in range(400)}
    rows = [(7, n, labels[n]) for n in labels] + [(8, n, labels[n]) for n in (1, 310, 380)]
    rows += [(9, n, 1) for n in range(50)]
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, "block long, node long, label long")
    cells = {}
    for r in J._cells(frame, 20).collect():
        cells.setdefault((r.block, r.cell), []).append((r.node, r.label))
    assert {block for block, _ in cells} == {7, 8}
    assert max(len(members) for members in cells.values()) < 80
    met = {
        (block, min(a, b), max(a, b))
        for (block, _), members in cells.items() for a, x in members for b, y in members if x != y
    }
    assert met == {
        (block, a, b)
        for block, nodes in ((7, list(labels)), (8, [1, 310, 380]))
        for a in nodes for b in nodes if a < b and labels[a] != labels[b]
    }


def test_runs_of_a_hot_name_and_its_bucket_are_one_block():
    name = np.arange(1, 6, dtype=np.uint64) * np.uint64(977)
    names = np.concatenate([np.repeat(name[:1], 500), np.repeat(name[1:], 3)])
    nodes = np.concatenate([np.arange(500), np.tile([3, 5, 700], 4)]).astype(np.int64)
    halves = [J._by_bucket([names[i::2]], [nodes[i::2]], 4) for i in range(2)]
    packed = [h[~h["run"]] for h in halves]
    assert sum(len(x) // 8 for h in packed for x in h["names"]) < 30
    blocks = {}
    frame = J.pd.concat(halves)
    for _, group in frame.groupby("bucket"):
        found = J._members_of_blocks(group)
        for block, members in zip(found["block"], found["nodes"]):
            blocks.setdefault(block, set()).update(members.tolist())
    assert sorted(map(len, blocks.values()))[-1] == 500
    assert {3, 5, 700} in blocks.values()


def test_a_block_much_larger_than_its_parts(spark):
    draw = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(3000):
        mine = list(base)
        mine[draw.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(mine)))
    half = base[:60] + [f"y{i}" for i in range(60)]
    for i in range(200):  # shares blocks with the others, and no links
        mine = list(half)
        mine[draw.randrange(120)] = f"z{i}"
        rows.append((5000 + i, " ".join(mine)))
    found = run(spark, rows, shingle=3, percent=90, part_rows=100)
    assert {found[i][1] for i in range(3000)} == {0}
    assert {found[5000 + i][1] for i in range(200)} == {5000}


def test_short_texts_and_nulls(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\ttwo"), (8, None)]
    found = run(spark, rows, shingle=3, percent=90)
    assert found == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6), 7: (1, 6), 8: (0, 8)}


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (5, text), (5, text), (3, text), (None, "alone here and now")]
    frame = J.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    found = sorted((str(r.doc_id), str(r.component_id)) for r in frame.collect())
    assert found == [("3", "3"), ("5", "3"), ("5", "3"), ("None", "3"), ("None", "None")]
    assert run(spark, []) == {}


def test_a_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(130)]
    rows = [(i, " ".join(words[i : i + 100])) for i in range(30)]
    found = run(spark, rows, shingle=1, percent=90)
    assert {c for _, c in found.values()} == {0}


def test_many_near_copies_and_a_long_text(spark):
    draw = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        mine = list(base)
        mine[draw.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(mine)))
    rows.append((1000, " ".join(f"v{i}" for i in range(200_000))))
    rows.append((1001, " ".join(f"v{i}" for i in range(200_001))))
    found = run(spark, rows, shingle=3, percent=90)
    assert {found[i][1] for i in range(400)} == {0} and found[1001] == (199_999, 1000)


def test_extra_columns_do_not_matter(spark):
    frame = spark.createDataFrame([(1, "a b c", 5, "q")], "doc_id long, text string, node long, n_shingles string")
    assert J.near_duplicates(frame).columns == ["doc_id", "n_shingles", "component_id"]


@pytest.mark.parametrize("percent", [50, 80, 90, 97])
def test_links_always_share_a_block(percent):
    draw = np.random.default_rng(percent)
    starts = J.size_bands(percent, 4000)
    for _ in range(300):
        n = int(draw.integers(1, 400))
        a = np.unique(draw.integers(0, 2**64, n, dtype=np.uint64))
        b = a[draw.random(len(a)) > draw.random() * (100 - percent) / 100]
        b = np.unique(np.concatenate([b, draw.integers(0, 2**64, int(draw.integers(0, 1 + n // 9)), dtype=np.uint64)]))
        if len(b) and J.is_link(a, b, percent) and not np.array_equal(a, b):
            shared = np.intersect1d(J.block_names(a, percent, starts), J.block_names(b, percent, starts))
            assert len(shared), (len(a), len(b))


def test_tree_finds_what_all_pairs_find():
    draw = np.random.default_rng(3)
    base = draw.poisson(4, (20, 64))
    points = (np.repeat(base, 20, axis=0) + (draw.random((400, 64)) < 0.05)).astype(np.uint32)
    sizes = points.sum(axis=1).astype(np.int64)
    labels = draw.integers(0, 50, 400)
    tree = J.CountTree(points, sizes)
    found = {(int(i), int(j)) for a, b in tree.pairs(labels, 90) for i, j in zip(a, b)}
    expected = {
        (i, j) for i in range(400) for j in range(i + 1, 400)
        if labels[i] != labels[j]
        and np.minimum(points[i], points[j]).sum() >= J.needed_overlap(sizes[i], sizes[j], 90)
    }
    assert found == expected and expected


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (102, 100)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(41)} | {(i, 100) for i in (100, 101, 102)}
    assert len(found) == 44
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
