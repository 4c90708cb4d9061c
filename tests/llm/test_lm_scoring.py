"""Stupid backoff against plain dictionaries."""

import math
import re
from collections import Counter

import pytest

from silvermill.llm.lm_scoring import score_documents

TEXTS = [
    (1, "the cat sat on the mat"),
    (2, "the cat ate the rat on the mat"),
    (2, "the cat ate the rat on the mat"),
    (3, None),
    (4, "  \n\t "),
    (5, "alone"),
    (6, "the " * 300 + "cat"),
    (None, "on the mat"),
]


def brute(order, alpha, min_count):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text in TEXTS]
    counts = Counter(
        tuple(words[at : at + n])
        for _, words in docs for n in range(1, order + 1) for at in range(len(words) - n + 1)
    )
    total = sum(len(words) for _, words in docs)

    def score(gram):
        if len(gram) == 1:
            return counts[gram] / total
        if counts[gram] >= min_count:
            return counts[gram] / counts[gram[:-1]]
        return alpha * score(gram[1:])

    return [
        (i, len(words), sum(
            math.log(score(tuple(words[max(0, at - order + 1) : at + 1]))) for at in range(len(words))
        ))
        for i, words in docs
    ]


@pytest.mark.parametrize("order, block_bytes", [(1, 1 << 20), (2, 1 << 20), (2, 60), (3, 60)])
def test_scores(spark, order, block_bytes):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    found = score_documents(docs, order, 0.4, 2, block_bytes=block_bytes).collect()
    key = lambda row: (row[0] is None, row[0], row[1])
    expected = sorted(brute(order, 0.4, 2), key=key)
    got = sorted(((r.doc_id, r.n_words, r.log_score) for r in found), key=key)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert [g[2] for g in got] == pytest.approx([e[2] for e in expected])
    for row in found:
        mean = row.log_score / row.n_words if row.n_words else None
        assert row.mean_log_score == (None if mean is None else pytest.approx(mean))


def test_empty_table_and_bad_options(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert score_documents(empty).collect() == []
    with pytest.raises(ValueError):
        score_documents(empty, order=0)
