import random

import numpy as np
import pytest

from silvermill.llm.quality import features, is_held_out, logistic_curve, score_quality, train_quality, word_shapes
from silvermill.llm.text import read_table

DOCS = "doc_id long, text string"
LABELS = "doc_id long, quality int"


def texts(n, seed=0):
    draw = random.Random(seed)
    for i in range(n):
        words = ["".join(draw.choices("abcdefgh", k=draw.randrange(2, 8))) for _ in range(60)]
        if i % 4 == 0:
            yield i, "!! ".join(w.upper() for w in words), 0
        else:
            yield i, " ".join(words) + ".", 1


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], DOCS)
    return docs, spark.createDataFrame([(i, q) for i, _, q in rows], LABELS)


def test_held_out_accuracy_on_the_tables(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    labels = read_table(spark, "/root/testdata/sf0.01", "labels")
    model = train_quality(docs, labels)
    held = (
        score_quality(docs, model).join(labels, "doc_id").where(is_held_out(labels["doc_id"]))
        .select("predicted", "quality", "score").collect()
    )
    assert len(held) > 50 and np.mean([r.predicted == r.quality for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in held)


def test_learns_and_scores_every_row(spark):
    docs, labels = frames(spark, list(texts(200)))
    extra = docs.union(spark.createDataFrame([(900, None), (901, ""), (902, "x" * 200_000), (3, "again"), (None, "no id")], DOCS))
    scored = score_quality(extra, train_quality(docs, labels)).collect()
    assert len(scored) == 205 and all(r.score is not None and r.predicted in (0, 1) for r in scored)
    assert all(r.predicted == (r.doc_id % 4 > 0) for r in scored if r.doc_id is not None and r.doc_id < 200 and r.text != "again")


def test_held_out_labels_are_not_used(spark):
    rows = list(texts(200))
    docs, labels = frames(spark, rows)
    held = {r.doc_id for r in docs.where(is_held_out(docs["doc_id"])).collect()}
    changed = spark.createDataFrame([(i, 1 - q if i in held else q) for i, _, q in rows], LABELS)
    one, two = train_quality(docs, labels), train_quality(docs, changed)
    assert held and np.array_equal(one.weights, two.weights) and one.centre == two.centre


def test_labels_repeated_contradicting_or_odd(spark):
    rows = list(texts(100))
    docs, labels = frames(spark, rows)
    odd = labels.union(labels).union(spark.createDataFrame([(None, 1), (1, None), (2, 5)], LABELS))
    assert np.allclose(train_quality(docs, labels).weights, train_quality(docs, odd).weights)
    against = labels.union(spark.createDataFrame([(i, 1 - q) for i, _, q in rows], LABELS))
    assert [r.score for r in score_quality(docs, train_quality(docs, against)).limit(3).collect()] == [0.5] * 3


@pytest.mark.parametrize("keep,expected", [((), 0.5), ((1,), 1.0), ((0,), 0.0)])
def test_without_both_classes(spark, keep, expected):
    rows = list(texts(40))
    docs, _ = frames(spark, rows)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if q in keep], LABELS)
    found = [r.score for r in score_quality(docs, train_quality(docs, labels)).collect()]
    assert np.allclose(found, expected, atol=1e-3)


def test_empty_table_and_clashing_columns(spark):
    docs, labels = frames(spark, list(texts(40)))
    model = train_quality(docs, labels)
    assert score_quality(docs.limit(0), model).count() == 0
    clash = docs.selectExpr("doc_id", "text", "'k' AS label", "1 AS score")
    assert score_quality(clash, model).columns == ["doc_id", "text", "label", "score", "predicted"]


def test_features_and_curve():
    raw = lambda s: np.frombuffer(s.encode(), np.uint8)
    assert len(features(raw(""), 17)) == 0 and len(features(raw("a"), 17)) == 2
    shapes = word_shapes(raw("no no no yes"))
    assert [(s >> 7) & 3 for s in shapes] == [0, 1, 3, 0]
    slope, centre = logistic_curve(np.array([-2.0, -1, 1, 2] * 20), np.array([-1, -1, 1, 1] * 20))
    assert slope > 0 and abs(centre) < 0.1
