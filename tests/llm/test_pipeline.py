"""The pipeline's stages, each against a plain version on its own input."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from silvermill.llm.quality import is_held_out
from silvermill.llm.text import read_table
from silvermill.scratch import stored
from tests.llm.brute import dedup_lines, jaccard_components, shared_targets, words

SF = "/root/testdata/sf0.01"


def planted(spark):
    """Copies, near copies, shared lines, a long text, nulls: on top of the whole table."""
    docs = read_table(spark, SF, "documents")
    base = docs.where("char_length(text) > 400").orderBy("doc_id").limit(8)
    copy = base.withColumn("doc_id", F.col("doc_id") + 100_000)
    near = base.withColumn("doc_id", F.col("doc_id") + 200_000).withColumn("text", F.concat("text", F.lit(" ends so")))
    lined = base.withColumn("doc_id", F.col("doc_id") + 300_000).withColumn(
        "text", F.concat(F.lit("A line that many of the texts have\n"), F.reverse("text"))
    )
    odd = spark.createDataFrame(
        [(400_001, None, None, None, None), (400_002, "", "en", "web", 0), (400_003, "word " * 60_000, "en", "web", 300_000)],
        docs.schema,
    )
    return docs.union(copy).union(near).union(lined).union(odd)


@pytest.fixture(scope="module")
def steps(spark):
    """[(input rows, output rows)] of every stage, and the columns."""
    docs = stored(planted(spark), "planted")
    columns, found = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), name)
        found.append((docs.collect(), out.collect()))
        assert name == "packing" or out.columns == columns
        docs = out
    return found


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "jaccard_join", "mixing", "packing"
    ]


def test_quality_keeps_good_documents_whole(spark, steps):
    before, after = steps[0]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    kept = {r.doc_id for r in after}
    labels = read_table(spark, SF, "labels")
    held = labels.where(is_held_out(F.col("doc_id")) & labels.quality.isNotNull()).collect()
    good, poor = ([r.doc_id in kept for r in held if r.quality == q] for q in (1, 0))
    assert np.mean(good) >= 0.95 and np.mean(poor) <= 0.1


def test_line_dedup_against_brute_force(steps):
    before, after = steps[1]
    expected = dedup_lines([(r.doc_id, r.text) for r in before])
    assert {r.doc_id: r.text for r in after} == {i: text for i, (_, _, text) in expected.items()}
    assert all(r.n_chars == len(r.text) for r in after)
    others = {r.doc_id: (r.lang, r.source) for r in before}
    assert all(others[r.doc_id] == (r.lang, r.source) for r in after)


def test_jaccard_join_against_brute_force(steps):
    before, after = steps[2]
    expected = jaccard_components([(r.doc_id, r.text) for r in before], 5, 80)
    assert {r.doc_id for r in after} == {component for _, component in expected.values()}
    assert {tuple(r) for r in after} <= {tuple(r) for r in before} and len(after) == len({r.doc_id for r in after})


def test_mixing_meets_targets_by_whole_copies(steps):
    before, after = steps[3]
    size = {r.doc_id: len(words(r.text)) for r in before}
    sizes, mixed, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r.source] += size[r.doc_id]
        longest[r.source] = max(longest[r.source], size[r.doc_id])
    for r in after:
        mixed[r.source] += size[r.doc_id]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    copies = Counter(r.doc_id for r in after)
    assert max(copies.values()) <= 3 and all(size[i] for i in copies)
    targets = shared_targets(sizes)
    assert all(abs(mixed[s] - targets[s]) <= longest[s] / 2 + 1 for s in sizes)


def test_packing_is_an_exact_round_trip(steps):
    before, after = steps[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for doc_id, text in {(r.doc_id, r.text) for r in before}:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)] if len(ids) > 1024 else [0]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            expected[doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    copies = Counter(r.doc_id for r in before)
    expected = Counter({key: n * copies[key[0]] for key, n in expected.items()})
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after) == expected
    sequences = defaultdict(list)
    for r in after:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [at for at, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024
    tokens = sum(r.length for r in after)
    assert len(sequences) <= -(-tokens // 1024) * 1.02 + 1


def test_run_returns_the_last_stage(spark, steps, tmp_path):
    planted(spark).write.parquet(str(tmp_path / "documents.parquet"))
    read_table(spark, SF, "labels").write.parquet(str(tmp_path / "labels.parquet"))
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = corpus_pipeline.run(spark, str(tmp_path)).select(*key).collect()
    assert Counter(map(tuple, found)) == Counter(tuple(r[k] for k in key) for r in steps[4][1])


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        read_table(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_jaccard_join_judges_rows_and_not_ids(spark):
    schema = "doc_id long, text string, _row long, _component int"
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    c = " ".join(f"c{i}" for i in range(60))
    docs = spark.createDataFrame([
        (1, a, 1, 1), (2, a, 2, 2), (2, b, 3, 3),  # an id shared by a copy and a clean row
        (7, c, 4, 4), (7, c, 5, 5),  # a repeated row
        (None, "n " + b, 6, 6), (None, None, 7, 7), (None, None, 8, 8), (9, "", 9, 9),
    ], schema)
    kept = corpus_pipeline.jaccard_join(spark, docs, SF)
    assert kept.columns == docs.columns
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    assert found == Counter([(1, a), (2, b), (7, c), (None, None), (None, None), (9, "")])
