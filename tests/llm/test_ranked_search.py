import random

import numpy as np
import pytest

from silvermill.llm import ranked_search as R
from tests.llm import brute

DOC, ITEM = "doc_id long, text string", "item_id long, text string"
WORDS = ["the", "The", "été", "a1", "x_y", "b-c", "日本", "rare", "q"]


def found(spark, docs, items, k=10, **options):
    index = R.build_index(spark.createDataFrame(docs, DOC))
    out = R.search(index, spark.createDataFrame(items, ITEM), k=k, **options)
    return sorted(map(tuple, out.collect()), key=str)


def random_texts(seed, count):
    rng = random.Random(seed)
    words = WORDS + [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 40, 300]))) for _ in range(count)]


def test_term_bytes_follow_the_pattern():
    for text in ("a\x00B/c9:d@E[f`g{h\x7fi\x80é日 \U0001F600z", "", "-", "ÀÉ İ"):
        assert len(R.term_hashes(text)) == len(brute.terms(text))
    same = [R.term_hashes(x).tolist() for x in ("ABC É", "abc É")]
    assert same[0] == same[1] != R.term_hashes("abc é").tolist()


@pytest.mark.parametrize("seed, k", [(1, 10), (2, 3), (3, 1000)])
def test_against_brute_force(spark, seed, k):
    docs = list(enumerate(random_texts(seed, 300)))
    items = dict(enumerate(random_texts(seed + 50, 12)))
    wanted = sorted(brute.ranked(docs, items, k), key=str)
    assert found(spark, docs, list(items.items()), k) == wanted
    assert found(spark, docs, list(items.items()), k, group_chars=200) == wanted  # several groups


def test_bounds_are_never_below_scores():
    texts = random_texts(7, 200)
    items = R._read_items([(i, [t]) for i, t in enumerate(random_texts(8, 20))])
    items.weights = np.arange(len(items.terms)) + 1
    hashes = [R.term_hashes(t) for t in texts]
    size = sum(map(len, hashes))
    block = R._Block(10)
    kept = [i for i, h in enumerate(hashes) if len(h)][:100]
    for i in kept:
        block.add(i, 0, 0, len(hashes[i]), R.signature_keys(*np.unique(hashes[i], return_counts=True)))
    row = block.packed()
    bounds = R.score_bounds(items, row["width"], np.array(row["n"]), row["slices"], len(kept), size)
    exact = np.stack([R.exact_scores(items, np.arange(20), texts[i], len(kept), size) for i in kept], axis=1)
    assert (bounds >= exact).all() and (exact > 0).any()


def test_copies_nulls_repeats_and_ties(spark):
    docs = [(i, "alpha beta") for i in range(40)] + [(None, "alpha beta"), (None, None), (3, "alpha beta"), (50, "")]
    docs += [(3, "other alpha words"), (60, "beta " * 70_000), (61, "gamma")]
    items = [(1, "alpha"), (2, "ALPHA Beta"), (3, None), (4, "--"), (None, "gamma"), (1, "beta beta"), (6, "nowhere")]
    merged = {1: "alpha beta", 2: "alpha beta", None: "gamma", 6: "nowhere"}
    for k in (1, 10, 60):
        assert found(spark, docs, items, k) == sorted(brute.ranked(docs, merged, k), key=str)


def test_empty_tables_and_extra_columns(spark):
    assert found(spark, [], [(1, "a")]) == [] and found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, "..")], [(1, "a")]) == []
    docs = spark.createDataFrame([(1, "a b", 5, "x", 2), (2, "c", 5, "y", 2)], DOC + ", a int, b string, n int")
    items = spark.createDataFrame([(9, "b", 1, 1)], ITEM + ", item int, rank int")
    out = R.search(R.build_index(docs), items).collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in out] == [(9, 1, 1)]


def test_text_ids(spark):
    docs = spark.createDataFrame([("x", "a b"), ("y", "a c"), (None, "a d")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "b c d")], "item_id string, text string")
    out = R.search(R.build_index(docs), items).orderBy("rank").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in out] == [("i", 1, "x"), ("i", 2, "y"), ("i", 3, None)]
