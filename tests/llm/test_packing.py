"""Packing: pieces against the tokenizers library, sequences by an exact round trip."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from silvermill.llm.packing import best_fit, pack_pieces, token_pieces

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    (1, "One plain sentence, with  two blanks\tand a tab.\n"),
    (2, None),
    (3, ""),
    (4, "naïve – 漢字 \U0001f600 don't 12345 " * 40),
    (5, "word " * 700),
    (6, "One plain sentence, with  two blanks\tand a tab.\n"),
    (6, "One plain sentence, with  two blanks\tand a tab.\n"),
]


def docs(spark, data=TEXTS):
    return spark.createDataFrame(data, "doc_id long, text string")


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return {
        number: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        for number, text in TEXTS
    }


def test_pieces_are_those_of_the_library(spark, whole):
    pieces = token_pieces(
        docs(spark), VOCABULARY, public_tokenizers.PATTERN, capacity=100, keep_ids=True
    ).collect()
    joined = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.piece)):
        assert len(p.ids) == p.length and (p.length == 100 or p.piece == 0)
        assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32
        assert p.ids == whole[p.doc_id][p.start : p.start + p.length]
        joined.setdefault(p.doc_id, 0)
        joined[p.doc_id] += p.length
    assert joined == {n: len(ids) * (2 if n == 6 else 1) for n, ids in whole.items()}


@pytest.mark.parametrize("text", [
    "one<|endoftext|>two  <|endoftext|>", "<|endoftext|>", "<|endoftext|", "a" + " " * 1_000_000 + "b",
    "\n" * 1_000_000,
], ids=["inside", "alone", "broken", "blanks", "lines"])
def test_special_tokens_and_long_runs_are_as_in_the_library(spark, text):
    ids = [*Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids, 2]
    pieces = token_pieces(docs(spark, [(1, text)]), VOCABULARY, public_tokenizers.PATTERN, capacity=1 << 21)
    assert [(p.start, p.length, p.ids_crc32) for p in pieces.collect()] == [
        (0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    ]


@pytest.mark.parametrize("rule", ["residual_norm", "dot_product"])
def test_every_constraint_holds_and_nothing_is_lost(spark, rule):
    draw = np.random.default_rng(3)
    lengths = [int(n) for n in draw.integers(1, 101, 600)]
    table = spark.createDataFrame(
        [(i, n, "clash") for i, n in enumerate(lengths)], "doc_id long, length long, offset string"
    )
    packed = pack_pieces(table, capacity=100, max_documents=3, rule=rule, group_pieces=200)
    rows = packed.toPandas()
    assert sorted(rows.doc_id) == list(range(600))
    for _, seq in rows.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq.length.sum() <= 100 and len(seq) <= 3
        assert list(seq.offset) == [0, *seq.length.cumsum()[:-1]]
    floor = -(-sum(lengths) // 100)
    assert rows.sequence_id.nunique() <= 1.15 * max(floor, 200)


def test_attention_is_a_capacity_of_its_own():
    needs = np.array([[50, 1, 2500]] * 4, float)
    bins = best_fit(needs, np.array([100, 10, 2500.0]), np.ones(3))
    assert list(bins) == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="over a capacity"):
        best_fit(needs, np.array([100, 10, 2000.0]), np.ones(3))


def test_the_best_fit_is_chosen():
    needs = np.array([[60, 1, 3600], [50, 1, 2500], [40, 1, 1600]], float)
    bins = best_fit(needs, np.array([100, 10, 10000.0]), np.array([1, 0, 0.0]))
    assert list(bins) == [0, 1, 0]


def test_empty_table(spark):
    empty = docs(spark, [])
    pieces = token_pieces(empty, VOCABULARY, public_tokenizers.PATTERN)
    assert pack_pieces(pieces).collect() == []


def test_columns_named_like_the_operators_own_are_kept(spark):
    pieces = spark.createDataFrame([(1, 5, 7, 8), (2, 6, 9, 10)], "doc_id long, length long, _group int, _salt int")
    found = sorted(map(tuple, pack_pieces(pieces, capacity=20).select("doc_id", "_group", "_salt").collect()))
    assert found == [(1, 7, 8), (2, 9, 10)]
