import numpy as np
import pytest

from silvermill.llm.url_filter import _hashes, build_cascade, judge_urls, listed
from pyspark.sql import functions as F

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/")]


@pytest.mark.parametrize("n", [1, 7, 300])
def test_cascade_is_exact_over_the_universe(spark, n):
    universe = spark.range(3000).select(F.concat(F.lit("key"), "id").alias("key"))
    cascade = build_cascade(universe.limit(n), universe)
    rows = universe.select("key", *_hashes(F.col("key"))).toPandas()
    found = listed(cascade, rows["a"].to_numpy(), rows["b"].to_numpy())
    assert set(rows["key"][found]) == {r.key for r in universe.limit(n).collect()}


def test_longest_rule_wins_and_odd_urls(spark):
    urls = [
        "http://EXAMPLE.com/en/1", "https://www.example.com/en/?q", "http://a.example.com/de/", "http://x.org/en/",
        None, "", "no scheme/en/", "http://com", "http://notexample.com/en/", "x://h?u=http://example.com/en/",
    ]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(frame, RULES).collect()}
    assert found == {
        0: ("example.com", "/en/1", "example.com/en/", "block"),
        1: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        2: ("a.example.com", "/de/", "com/", "allow"), 3: ("x.org", "/en/", None, "allow"),
        4: ("", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("com", "", None, "allow"), 8: ("notexample.com", "/en/", "com/", "allow"), 9: ("h", "", None, "allow"),
    }
    assert judge_urls(frame.limit(0), RULES).count() == 0
    assert np.all([r.verdict == "allow" for r in judge_urls(frame, []).collect()])


def test_columns_named_like_the_operators_own_are_kept(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.com/x", 7, 8, 9)], "page_id long, url string, _keys int, _said int, _best int"
    )
    row = judge_urls(pages, [("block", "com", "/x")]).first()
    assert (row._keys, row._said, row._best, row.verdict) == (7, 8, 9, "block")
