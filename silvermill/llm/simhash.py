"""SimHash fingerprints, and all pairs of them within a Hamming radius.

Every word starts a term: the word and the one after it. A term's 64-bit hash
votes on each bit, with the term's length as weight; a bit is set where the
votes for it outweigh those against. Near fingerprints are found in permuted
tables: the bits are cut into blocks, and for every choice of blocks to leave
out, fingerprints that agree on the others meet under one key.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from silvermill.llm.text import GAP, WHITE, ascii_lower, whole_text

BITS = 64


def words_of(text: Column) -> Column:
    return F.split(F.btrim(ascii_lower(text), F.lit(WHITE)), GAP, -1)


def fingerprint_rows(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """One row per key with its fingerprint, a long; keys must be unique.

    If `rows` lie partitioned by some of the keys, nothing is shuffled.
    A text without words votes for nothing: its fingerprint is 0.
    """
    words = rows.select(*keys, words_of(F.col(text_col)).alias("_w"))
    terms = words.select(
        *keys,
        F.inline_outer(F.arrays_zip(
            F.col("_w").alias("_a"), F.slice("_w", 2, 2147483647).alias("_b")
        )),
    ).toDF(*keys, "_a", "_b")
    hashed = terms.select(
        *keys,
        F.xxhash64("_a", "_b").alias("_h"),
        F.when(
            F.coalesce(F.col("_a"), F.lit("")) != "",
            F.octet_length("_a") + F.coalesce(F.octet_length("_b"), F.lit(0)),
        ).otherwise(0).cast("long").alias("_weight"),
    )
    votes = hashed.groupBy(*keys).agg(
        F.sum("_weight").alias("_all"),
        *[
            F.sum(F.shiftright("_h", j).bitwiseAND(F.lit(1)) * F.col("_weight")).alias(f"_v{j}")
            for j in range(BITS)
        ],
    )
    bits = F.lit(0).cast("long")
    for j in range(BITS):
        bit = 1 << j if j < BITS - 1 else -(1 << j)
        bits = bits.bitwiseOR(
            F.when(F.col(f"_v{j}") * 2 > F.col("_all"), F.lit(bit)).otherwise(F.lit(0)).cast("long")
        )
    return votes.select(*keys, bits.alias("fingerprint"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids and the fingerprints of whole texts; equal texts have equal ones.

    Null texts count as empty. Rows with equal id and text are one row; rows
    that share an id but not the text have a row each.
    """
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).alias(id_col), F.xxhash64(text).alias("_text"), text.alias("_whole")
    ).dropDuplicates([id_col, "_text"])
    return fingerprint_rows(rows, [id_col, "_text"], "_whole").drop("_text")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / float(BITS)


def _blocks(radius: int, spare: int) -> list[tuple[int, int]]:
    """Shift and mask of each block; there are `spare` more than the radius."""
    count = radius + spare
    edges = [BITS * i // count for i in range(count + 1)]
    return [(lo, (1 << (hi - lo)) - 1) for lo, hi in zip(edges, edges[1:])]


def near_fingerprints(
    prints: DataFrame, radius: int = 3, spare: int = 3, col: str = "fingerprint"
) -> DataFrame:
    """All pairs (a < b, distance) of different fingerprints within `radius`.

    Equal fingerprints are one; nulls take no part. Of `radius + spare` blocks,
    two near fingerprints agree on at least `spare`, so one of the tables, each
    keyed by `spare` blocks, holds both. A pair is given out by the first such
    table alone, so none is found twice.
    """
    if radius < 0 or spare < 1 or radius + spare > BITS:
        raise ValueError("radius and spare must fit the bits")
    blocks = _blocks(radius, spare)
    choices = list(combinations(range(len(blocks)), spare))
    part = [F.shiftrightunsigned("f", lo).bitwiseAND(F.lit(mask)) for lo, mask in blocks]
    distinct = prints.select(F.col(col).alias("f")).where(F.col("f").isNotNull()).distinct()
    tables = distinct.select("f", F.explode(F.array(*[
        F.struct(F.lit(i).alias("table"), F.xxhash64(*[part[b] for b in choice]).alias("key"))
        for i, choice in enumerate(choices)
    ])).alias("at")).select("f", "at.table", "at.key")
    left = tables.withColumnRenamed("f", "a")
    right = tables.withColumnRenamed("f", "b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    same = F.array(*[
        F.when(F.shiftrightunsigned(differ, lo).bitwiseAND(F.lit(mask)) == 0, F.lit(i))
        for i, (lo, mask) in enumerate(blocks)
    ])
    first = F.slice(F.array_compact(same), 1, spare)
    numbers = F.array(*[F.array(*map(F.lit, choice)) for choice in choices])
    return (
        left.join(right, ["table", "key"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(differ) <= radius))
        .where(first == F.get(numbers, F.col("table")))
        .select("a", "b", F.bit_count(differ).alias("distance"))
    )
