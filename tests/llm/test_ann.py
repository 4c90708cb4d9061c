"""Nearest neighbours against brute force: all lists searched, so nothing may be missed."""

import numpy as np
import pytest

from silvermill.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def brute(data, k):
    good = {
        i: np.array(v, np.float32).astype(float)
        for i, v in data
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)
    }
    ids = sorted(good)
    out = {}
    for q in ids:
        scores = [(-float(ann.products(good[q][None], good[i][None])[0]), i) for i in ids if i != q]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(spark, data, k, **options):
    table = spark.createDataFrame(data, SCHEMA)
    index = ann.build_index(table, list_size=8)
    got = {}
    for row in ann.nearest(index, table, k=k, ratio=100.0, **options).collect():
        got.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    for hits in got.values():
        hits.sort()
        assert [h[0] for h in hits] == list(range(1, len(hits) + 1))
    return {q: [(i, s) for _, i, s in hits] for q, hits in got.items()}


@pytest.fixture(scope="module")
def data():
    draw = np.random.default_rng(5)
    points = draw.normal(size=(120, 6)).astype(np.float32).tolist()
    points += [points[3]] * 12  # one vector many times: ties go to the smaller id
    odd = [None, [0.0] * 6, [float("nan")] * 6, [float("inf")] + [1.0] * 5, [None] + [1.0] * 5]
    return list(enumerate(points)) + [(900 + i, v) for i, v in enumerate(odd)]


@pytest.mark.parametrize("first_probes", [1, 3, 96])
def test_the_bound_of_the_first_lists_loses_nothing(spark, data, first_probes):
    assert found(spark, data, 5, first_probes=first_probes) == brute(data, 5)


def test_fewer_candidates_than_asked_for(spark):
    data = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])]
    assert found(spark, data, 20) == brute(data, 20)


def test_no_usable_vector(spark):
    assert found(spark, [(1, None), (2, [0.0, 0.0])], 3) == {}
    assert found(spark, [], 3) == {}


def test_small_clusters_far_apart_get_all_their_neighbours(spark):
    draw = np.random.default_rng(8)
    points = np.zeros((500, 6))
    points[:490, 0] = points[490:, 1] = 10
    data = list(enumerate((points + 0.01 * draw.normal(size=points.shape)).tolist()))
    table = spark.createDataFrame(data, SCHEMA)
    hits = ann.nearest(ann.build_index(table), table, k=20).groupBy("query_id").count().collect()
    assert len(hits) == 500 and {row["count"] for row in hits} == {20}


def test_lists_are_added_until_they_hold_enough():
    centres = np.arange(12.0)[:, None] * 10
    counts = np.array([1, 0, 1, 0, 1, 0, 1, 0, 1, 0, 1, 1])
    memory = centres, ann.centroid_graph(centres, degree=2), counts
    row, number, _ = ann.lists_of_queries(np.array([[0.0], [112.0]]), memory, 3, 1.0, 2)
    assert list(number[row == 0]) == [0, 1, 2, 3, 4, 5, 6]
    assert list(number[row == 1]) == [11, 10, 9, 8, 7, 6]


def test_recall_with_many_lists():
    points = np.random.default_rng(9).normal(size=(8000, 64))
    raised = ann.raised(points, np.sqrt((points * points).sum(1).max()))
    centres = ann.balanced_centroids(raised, 500)
    label = ann.squared_distances(raised, centres).argmin(axis=1)
    memory = centres, ann.centroid_graph(centres), np.bincount(label, minlength=500)
    asked = np.concatenate([points[:100], np.zeros((100, 1))], axis=1)
    best = np.argsort(-points[:100] @ points.T, axis=1)[:, :21]

    def recall(probes):
        row, number, _ = ann.lists_of_queries(asked, memory, 20, 1.2, probes)
        return np.mean([np.isin(label[best[i]], number[row == i]).mean() for i in range(100)])

    assert recall(96) < 0.8 and recall(ann.default_probes(500)) > 0.9


def test_different_vectors_of_one_score_go_to_the_smaller_ids(spark):
    data = [(i, [float(j == i % 60) * (1 + i // 60) for j in range(60)]) for i in range(120)]
    assert found(spark, data, 5) == brute(data, 5)


def test_more_neighbours_than_the_index_keeps_are_refused(spark):
    data = [(i, [1.0, 2.0]) for i in range(30)] + [(40 + i, [float(i), 1.0]) for i in range(3)]
    table = spark.createDataFrame(data, SCHEMA)
    with pytest.raises(ValueError, match="keep_ids"):
        ann.nearest(ann.build_index(table), table, k=25)
    index = ann.build_index(table, keep_ids=26)
    got = ann.nearest(index, table.where("vec_id = 0"), k=25, ratio=100.0).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [i for i, _ in brute(data, 25)[0]]
