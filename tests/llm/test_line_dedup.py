from hypothesis import HealthCheck, given, settings, strategies as st

from silvermill.llm.line_dedup import dedup_lines
from tests.llm.brute import dedup_lines as plain

SCHEMA = "doc_id long, text string"


def run(spark, rows, **options):
    frame = dedup_lines(spark.createDataFrame(rows, SCHEMA), **options)
    return {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in frame.collect()}


LINE = st.sampled_from([
    "a shared line here", "  A Shared Line HERE\t", "short", "", "É shared ligne", "é shared ligne",
    "another long line", "another long line ", "x" * 10, "x" * 9, " ",
])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(LINE, max_size=6), max_size=8))
def test_random_texts_against_brute_force(spark, texts):
    rows = [(i, "\n".join(lines)) for i, lines in enumerate(texts)]
    assert run(spark, rows) == plain(rows)


def test_nulls_empty_texts_and_only_breaks(spark):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "a shared line here\n"), (5, "a shared line here\n")]
    found = run(spark, rows)
    assert found[1] == (1, 0, "") and found[2] == (1, 0, "") and found[3] == (3, 0, "\n\n")
    assert found[4] == (2, 0, "a shared line here\n") and found[5] == (2, 1, "")


def test_a_null_id_keeps_nothing(spark):
    frame = dedup_lines(spark.createDataFrame([(None, "a shared line here"), (9, "a shared line here")], SCHEMA))
    assert {(r.doc_id, r.text) for r in frame.collect()} == {(None, ""), (9, "a shared line here")}


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "a shared line here")] * 3
    frame = dedup_lines(spark.createDataFrame(rows, SCHEMA))
    assert [r.n_dropped for r in frame.collect()] == [0, 0, 0]
    rows = [(1, "a shared line here\nzz")] + [(2, "a shared line here\nyy")] * 3
    frame = dedup_lines(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.text for r in frame.collect() if r.doc_id == 2) == ["yy"] * 3


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == {}
    rows = [(1, "a shared line here", "k", 7), (2, "a shared line here", "l", 8)]
    frame = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, key string, n_lines int"))
    assert frame.columns == ["doc_id", "text", "key", "n_lines", "n_dropped"]
    assert sorted((r.key, r.n_lines, r.text) for r in frame.collect()) == [("k", 1, "a shared line here"), ("l", 1, "")]
    assert dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, a string, b int"), counts=None).columns == [
        "doc_id", "text", "a", "b"
    ]


def test_thresholds(spark):
    rows = [(i, "a shared line here") for i in range(3)]
    assert sum(v[1] for v in run(spark, rows, min_docs=4).values()) == 0
    assert sum(v[1] for v in run(spark, rows, min_docs=3).values()) == 2
    assert sum(v[1] for v in run(spark, rows, min_chars=19).values()) == 0


def test_a_text_of_many_lines(spark):
    many = "\n".join(f"line number {i:06d}" for i in range(60_000))
    found = run(spark, [(1, many), (2, many + "\nown line of two")])
    assert found[2] == (60_001, 60_000, "own line of two") and found[1][1] == 0


def test_columns_named_like_the_operators_own_are_kept(spark):
    names = ["_id", "_gone", "_version", "_lines", "_text_hash", "id", "key", "pos"]
    docs = spark.createDataFrame(
        [(1, "a shared line here\nx", *range(8)), (2, "a shared line here\ny", *range(8, 16))],
        "doc_id long, text string, " + ", ".join(f"{n} int" for n in names),
    )
    out = sorted(map(tuple, dedup_lines(docs).select("doc_id", "text", *names).collect()))
    assert out == [(1, "a shared line here\nx", *range(8)), (2, "y", *range(8, 16))]


def test_a_line_of_very_many_documents_is_split(spark):
    from tests.test_plans import final_plan, settings

    docs = spark.range(20_000).selectExpr(
        "id doc_id", "concat('the very same line for all\n', md5(string(id))) text"
    )
    low = {
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "10k",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10k",
        "spark__sql__autoBroadcastJoinThreshold": "-1",
    }
    with settings(spark, **low):
        assert "skew=true" in final_plan(dedup_lines(docs))
