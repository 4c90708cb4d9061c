"""URL rules looked up in a cascade of Bloom filters.

The universe is every key that some URL of the corpus could match. Level 1
encodes the listed keys, level 2 the keys of the universe that level 1 takes for
listed by mistake, level 3 the listed keys that level 2 takes for mistakes, and
so on until a level makes none. Over that universe the cascade is exact, so URLs
are judged without a join.

The rules must fit the driver (`max_filter_bytes` bounds what is broadcast); the
universe may have any size: its keys are counted and tested by the executors,
and each level only keeps what the one before got wrong.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from silvermill.llm.text import ascii_lower, whole_text, free_names
from silvermill.scratch import stored

#: (verdict, host, path)
Rule = tuple[str, str, str]


def url_host(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?` or `#`; A to Z lower-cased."""
    return ascii_lower(F.regexp_extract(whole_text(url), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host up to `?` or `#`; empty if the URL has no `://`."""
    return F.regexp_extract(whole_text(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


#: A level: its bits as 64-bit words, and how many of them a key sets. Levels are
#: plain values, so that a broadcast needs no class of this package to be read.
Level = tuple[np.ndarray, int]

#: A prime over 2^40. Hashes times an odd number of the level, modulo it, give
#: every level places of its own; keys that meet in one level part in another.
PRIME = 1099511627791


def holds(level: Level, depth: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether all bits of the keys with these hashes are set."""
    words, hashes = level
    size = np.int64(len(words) * 64)
    found = np.ones(len(a), bool)
    a, b = a * (2 * depth + 1) % PRIME, b * (2 * depth + 3) % PRIME
    for i in range(hashes):
        at = (a + np.int64(i) * b) % size
        found &= (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return found


def listed(cascade: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the keys with these hashes are listed; exact over the universe."""
    undecided, answer = np.ones(len(a), bool), np.zeros(len(a), bool)
    for depth, level in enumerate(cascade):
        found = holds(level, depth, a, b)
        answer[undecided & ~found] = depth % 2 == 1
        undecided &= found
    answer[undecided] = len(cascade) % 2 == 1
    return answer


def _hashes(key: Column) -> list[Column]:
    """Two hashes below 2^40, the second odd, so that their sums stay positive."""
    return [
        F.pmod(F.xxhash64(key), F.lit(1 << 40)).alias("a"),
        F.pmod(F.xxhash64(F.lit(2), key), F.lit(1 << 40)).bitwiseOR(F.lit(1)).alias("b"),
    ]


def _build(keys: DataFrame, depth: int, count: int, rate: float, max_bytes: int) -> Level:
    """From distinct (a, b); the bits are set by the executors."""
    bits = max(64, math.ceil(count * -math.log(rate) / math.log(2) ** 2))
    words = (bits + 63) // 64
    if words * 8 > max_bytes:
        raise ValueError(f"a filter of {words * 8} bytes is over max_filter_bytes")
    hashes = max(1, round(words * 64 / max(count, 1) * math.log(2)))
    hashes = min(hashes, max(1, math.ceil(-math.log2(rate))))
    a = F.pmod(F.col("a") * (2 * depth + 1), F.lit(PRIME))
    b = F.pmod(F.col("b") * (2 * depth + 3), F.lit(PRIME))
    at = F.pmod(a + F.col("i") * b, F.lit(words * 64))
    rows = (
        keys.select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(hashes - 1))).alias("i"))
        .select(F.floor(at / 64).alias("word"), F.expr("1L").alias("one"), (at % 64).cast("int").alias("bit"))
        .select("word", F.expr("shiftleft(one, bit)").alias("bits"))
        .groupBy("word").agg(F.bit_or("bits").alias("bits"))
        .collect()
    )
    array = np.zeros(words, np.int64)
    for row in rows:
        array[row.word] = row.bits
    return array.view(np.uint64), hashes


def _passing(keys: DataFrame, level: Level, depth: int) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def keep(frames):
        for frame in frames:
            yield frame[holds(shared.value, depth, frame["a"].to_numpy(), frame["b"].to_numpy())]

    return keys.mapInPandas(keep, "a long, b long")


def build_cascade(
    members: DataFrame, universe: DataFrame, key_col: str = "key",
    rate: float = 0.5, max_filter_bytes: int = 256 << 20,
) -> list[Level]:
    """A cascade that answers rightly for each key of `universe`.

    The first level's rate is chosen so that it lets about as many unlisted keys
    pass as there are listed ones; later levels use `rate`. Null keys take no
    part, repeated keys count once, listed keys need not be in the universe. An
    empty list gives a cascade that holds nothing.
    """
    keys = lambda frame: (
        frame.select(F.col(key_col).alias("key")).where(F.col("key").isNotNull())
        .select(*_hashes(F.col("key"))).distinct()
    )
    inside = stored(keys(members), "cascade-listed")
    count = inside.count()
    if not count:
        return []
    outside = stored(keys(universe).join(inside, ["a", "b"], "left_anti"), "cascade-rest")
    others = outside.count()
    levels: list[Level] = []
    encode, test = inside, outside
    n, target = count, min(rate, count / max(others, 1))
    while n:
        level = _build(encode, len(levels), n, target, max_filter_bytes)
        wrong = stored(_passing(test, level, len(levels)), "cascade-wrong")
        levels.append(level)
        encode, test, n, target = wrong, encode, wrong.count(), rate
    return levels


def _candidates(host: Column, path: Column, labels: int, lengths: Iterable[int]) -> Column:
    """The rule keys that could fit: host suffixes by label, path prefixes by length.

    Only the longest rule's number of labels and the rules' path lengths matter,
    so nothing that a rule could fit is left out.
    """
    parts = F.split(host, r"\.", -1)
    suffixes = F.filter(F.array(*[
        F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), ".")) if n else F.lit(None)
        for n in range(1, labels + 1)
    ]), lambda s: s.isNotNull() & (s != ""))
    prefixes = F.filter(F.array(*[
        F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(lengths))
    ]), lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge_urls(
    pages: DataFrame, rules: Iterable[Rule], url_col: str = "url", default: str = "allow",
    max_filter_bytes: int = 256 << 20,
) -> DataFrame:
    """The rows with host, path, rule and verdict of each URL.

    A rule (verdict, host, path) fits its host and all subdomains if the URL's
    path starts with the rule's. The longest rule wins; a URL that none fits is
    not listed and gets `default`. Columns of these names are replaced. A null
    URL, or one without `://`, has an empty host and path and fits no rule. A
    rule that is listed twice with the same verdict counts once; with different
    verdicts, it is refused.
    """
    spark = pages.sparkSession
    rules = sorted({(v, ascii_text(h), p) for v, h, p in rules})
    texts = [h + p for _, h, p in rules]
    if len(set(texts)) < len(texts) or any(v not in ("allow", "block") for v, _, _ in rules):
        raise ValueError("each rule needs one verdict, allow or block")
    if any(not h or (p and not p.startswith("/")) for _, h, p in rules):
        raise ValueError("a rule needs a host, and its path starts with /")
    added = ("host", "path", "rule", "verdict")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in added]
    split = pages.select(*kept, url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    if not rules:
        return split.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    labels = max(h.count(".") + 1 for _, h, _ in rules)
    keys = _candidates(F.col("host"), F.col("path"), labels, [len(p) for _, _, p in rules])
    universe = split.select(F.explode(keys).alias("key")).distinct()
    table = spark.createDataFrame([(v, h + p) for v, h, p in rules], "verdict string, key string")
    cascades = {
        verdict: build_cascade(
            table.where(F.col("verdict") == verdict), universe, max_filter_bytes=max_filter_bytes
        )
        for verdict in ("allow", "block")
    }
    shared = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("array<string>")
    def verdicts(a: pd.Series, b: pd.Series) -> pd.Series:
        sizes = a.map(len).to_numpy()
        flat_a = np.concatenate([*a, np.zeros(0, np.int64)]).astype(np.int64)
        flat_b = np.concatenate([*b, np.zeros(0, np.int64)]).astype(np.int64)
        said = np.where(
            listed(shared.value["block"], flat_a, flat_b), "block",
            np.where(listed(shared.value["allow"], flat_a, flat_b), "allow", ""),
        )
        return pd.Series(np.split(said, np.cumsum(sizes)[:-1]) if len(sizes) else [])

    own_keys, said, own_best = free_names(split, "keys", "said", "best")
    tried = split.withColumn(own_keys, keys)
    hashed = tried.withColumn(said, verdicts(
        F.transform(own_keys, lambda k: _hashes(k)[0]), F.transform(own_keys, lambda k: _hashes(k)[1])
    ))
    hits = F.filter(
        F.arrays_zip(F.col(own_keys).alias("key"), F.col(said).alias("said")),
        lambda x: x["said"] != "",
    )
    best = F.element_at(F.array_sort(F.transform(
        hits, lambda x: F.struct(F.char_length(x["key"]).alias("n"), x["key"].alias("key"), x["said"].alias("said"))
    )), -1)
    best = F.when(F.size(hits) > 0, best)
    return hashed.withColumn(own_best, best).select(
        *kept, "host", "path", F.col(f"{own_best}.key").alias("rule"),
        F.coalesce(F.col(f"{own_best}.said"), F.lit(default)).alias("verdict"),
    )


def ascii_text(host: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
