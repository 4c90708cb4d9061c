"""SimHash: every near pair is found, and likeness follows the text."""

import random
import re
from hashlib import sha256
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from silvermill.llm.queries import op6_simhash
from silvermill.llm.simhash import fingerprints, near_fingerprints


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


@pytest.mark.parametrize("radius, spare", [(0, 2), (1, 3), (3, 3), (5, 1)])
def test_all_pairs_within_the_radius(spark, radius, spare):
    draw = random.Random(radius)
    prints = []
    for _ in range(12):
        base = draw.getrandbits(64)
        prints += [base, base]
        for flips in range(1, 8):
            prints.append(base ^ sum(1 << bit for bit in draw.sample(range(64), flips)))
    table = spark.createDataFrame([(signed(p),) for p in prints] + [(None,)], "fingerprint long")
    found = near_fingerprints(table, radius, spare).collect()
    expected = {
        (min(signed(a), signed(b)), max(signed(a), signed(b)), (a ^ b).bit_count())
        for a, b in combinations(set(prints), 2) if (a ^ b).bit_count() <= radius
    }
    assert len(found) == len(expected)
    assert {tuple(row) for row in found} == expected


def test_equal_texts_and_small_edits(spark):
    text = " ".join(f"word{i}" for i in range(400))
    data = [
        (1, text), (2, text), (3, text.replace("word7 ", "other ")), (4, None), (5, ""),
        (6, " ".join(f"else{i}" for i in range(400))), (1, text), (7, "x" * 200_000),
    ]
    table = spark.createDataFrame(data, "doc_id long, text string")
    got = fingerprints(table).collect()
    assert len(got) == 7  # a repeated row is one
    prints = {row.doc_id: row.fingerprint for row in got}
    apart = lambda a, b: ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count()
    assert prints[1] == prints[2] and prints[4] == prints[5] == 0
    assert apart(1, 3) <= 8 < 16 <= apart(1, 6)


def test_empty_table_and_bad_options(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprints(empty).collect() == []
    with pytest.raises(ValueError):
        near_fingerprints(fingerprints(empty), radius=-1)


def plain_print(text):
    """The votes of a text's terms, one after another."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    votes = [0] * 64
    for i, word in enumerate(words):
        after = words[i + 1] if i + 1 < len(words) else None
        number, weight = xxhash.xxh64_intdigest(word.encode(), seed=42), len(word.encode())
        if after is not None:
            number = xxhash.xxh64_intdigest(after.encode(), seed=number)
            weight += len(after.encode())
        for bit in range(64):
            votes[bit] += weight if number >> bit & 1 else -weight
    return sum(1 << bit for bit in range(64) if votes[bit] > 0)


def plain_op6(data):
    """The whole query, document by document; ids must differ."""
    order = sorted(data, key=lambda row: (row[0] is not None, row[0] or 0), reverse=True)
    texts = [text or "" for _, text in order]
    prints = {text: plain_print(text) for text in texts}
    like = lambda a, b: 1 - (a ^ b).bit_count() / 64
    expected = set()
    for i, (doc_id, _) in enumerate(order):
        text, after = texts[i], texts[(i + 1) % len(order)]
        cut = len(text) // 2
        edited = text[:len(text) - cut] + after[:cut]
        mine, other = prints[text], plain_print(edited)
        near = sum(0 < (mine ^ p).bit_count() <= 3 for p in set(prints.values()))
        expected.add((
            doc_id, len(text), sha256(edited.encode()).hexdigest(), f"{mine:016x}", f"{other:016x}",
            like(mine, other), like(mine, prints[after]), near,
        ))
    return expected


@pytest.mark.parametrize("data", [
    [(4, "one lone text of a few words")],
    [(None, "no id"), (3, "A b\tC"), (-2, None)],
    [
        *((i * 3, " ".join(f"w{(i * 7 + j) % 50}" for j in range(1 + i % 60))) for i in range(80)),
        *((1000 + i, "same words in every copy of it " * 40 + "x" * i) for i in range(6)),
        (2000, None), (2001, ""), (2002, " \t\n"), (2003, "\u00e9\U0001f600\u0130 \u00a0Q " * 9), (2004, "long " * 30_000),
        (None, "a row without an id comes last"),
    ],
])
def test_the_whole_query_against_plain_votes(spark, tmp_path, data):
    table = spark.createDataFrame(data, "doc_id long, text string").withColumn("rank", F.lit("clash"))
    table.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = op6_simhash(spark, str(tmp_path)).collect()
    assert len(found) == len(data)
    assert {(
        r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next, r.n_near
    ) for r in found} == plain_op6(data)


def test_the_query_on_no_rows_and_shared_ids(spark, tmp_path):
    schema = "doc_id long, text string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op6_simhash(spark, f"{tmp_path}/none").collect() == []
    spark.createDataFrame([(7, "a b"), (7, "c d"), (None, "a b"), (None, None)], schema).write.parquet(
        f"{tmp_path}/shared/documents.parquet"
    )
    found = op6_simhash(spark, f"{tmp_path}/shared").collect()
    assert sorted((str(r.doc_id), r.n_chars, r.fingerprint) for r in found) == sorted(
        (str(i), len(t), f"{plain_print(t):016x}") for i, t in [(7, "a b"), (7, "c d"), (None, "a b"), (None, "")]
    )
