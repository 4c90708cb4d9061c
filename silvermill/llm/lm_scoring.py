"""Stupid-backoff scores of documents against the corpus they belong to.

S(w | context) = count(context w) / count(context) if count(context w) is at
least `min_count`, else alpha times S(w | the context without its first word);
a single word's score is its count over the number of words. A document's score
is the sum of the logarithms over its words.

Three tables meet by hash. The n-grams of a block of documents are exploded, and
each different one of the block goes, once, to the bucket of its hash: a bucket
is a partition of the count table. There counts are summed over the blocks and
joined back to the n-grams that asked. The answers go to the block, where the
logarithms are summed per document. So a frequent n-gram costs one entry per
block, not per occurrence, and neither n-grams nor counts pass one task. Rows hold
packed arrays, because a row per n-gram would take several times the disk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from silvermill.llm.text import WORD, mix, whole_text, word_hashes

ASKED = "bucket int, block int, rank int, grams binary, counts binary"


class BlockGrams:
    """The n-grams of a block's documents: for each order the distinct hashes,
    their counts, and which of them stands at each place."""

    def __init__(self, texts, order: int):
        parts = [word_hashes(text) for text in texts]
        self.lengths = np.array([len(p) for p in parts], np.int64)
        flat = np.concatenate([*parts, np.zeros(0, np.uint64)])
        ends = np.cumsum(self.lengths)
        begin = np.repeat(ends - self.lengths, self.lengths)
        self.place = np.arange(len(flat)) - begin  # in its document
        self.grams, self.counts, self.at = [], [], []
        hashed = mix(flat)
        for n in range(1, order + 1):
            if n > 1:
                hashed = mix(np.concatenate([hashed[:1], hashed[:-1]]) * np.uint64(3) + flat)
            ends_here = np.flatnonzero(self.place >= n - 1)
            grams, at, counts = np.unique(hashed[ends_here], return_inverse=True, return_counts=True)
            full = np.full(len(flat), -1, np.int64)
            full[ends_here] = at
            self.grams.append(grams)
            self.counts.append(counts.astype(np.uint32))
            self.at.append(full)


def _ask(order: int, buckets: int):
    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        block = int(frame["block"].iloc[0])
        found = BlockGrams(frame.sort_values("row")["text"], order)
        out = []
        for n, (grams, counts) in enumerate(zip(found.grams, found.counts), 1):
            bucket = (mix(grams) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            used, first = np.unique(bucket[by], return_index=True)
            for b, x, y in zip(used, first, [*first[1:], len(by)]):
                mine = by[x:y]
                out.append((b, block, n, grams[mine].tobytes(), _pack(counts[mine])))
        return pd.DataFrame(out, columns=["bucket", "block", "rank", "grams", "counts"])

    return ask


def _pack(counts: np.ndarray) -> bytes:
    """One byte each if that is enough; the first byte says."""
    small = bool(len(counts) == 0 or counts.max() < 256)
    return b"\1" + counts.astype(np.uint8).tobytes() if small else b"\4" + counts.astype("<u4").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    kind = np.uint8 if data[:1] == b"\1" else np.dtype("<u4")
    return np.frombuffer(data, kind, offset=1).astype(np.int64)


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """Counts over all blocks, in the order in which each block asked."""
    out = []
    for rank, rows in frame.groupby("rank", sort=True):
        asked = [np.frombuffer(x, np.uint64) for x in rows["grams"]]
        counts = np.concatenate([_unpack(x) for x in rows["counts"]])
        _, at = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(at, weights=counts).astype(np.int64)[at]
        ends = np.cumsum([len(x) for x in asked])
        for bucket, block, mine in zip(rows["bucket"], rows["block"], np.split(total, ends[:-1])):
            out.append((bucket, block, rank, _pack(np.minimum(mine, 2**32 - 1))))
    return pd.DataFrame(out, columns=["bucket", "block", "rank", "counts"])


def log_scores(found: BlockGrams, counts: list[np.ndarray], words: int, alpha: float, min_count: int) -> np.ndarray:
    """The natural logarithm of S at each place of a block."""
    order = len(counts)
    at_place = [np.where(at >= 0, c[at] if len(c) else 0, 0).astype(float) for c, at in zip(counts, found.at)]
    score = np.log(at_place[0] / words) if words else np.zeros(0)
    backed = np.log(alpha)
    for n in range(2, order + 1):  # from the shortest: a longer one replaces it
        context = np.concatenate([[0.0], at_place[n - 2][:-1]])[: len(score)]
        usable = found.place >= n - 1
        seen = usable & (at_place[n - 1] >= min_count)
        with np.errstate(divide="ignore", invalid="ignore"):
            direct = np.log(at_place[n - 1] / context)
        score = np.where(seen, direct, np.where(usable, score + backed, score))
    return score


def _sum_up(order: int, buckets: int, words: int, alpha: float, min_count: int):
    def sum_up(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values("row")
        found = BlockGrams(docs["text"], order)
        counts = []
        for n, grams in enumerate(found.grams, 1):
            bucket = (mix(grams) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            mine = answers[answers["rank"] == n].sort_values("bucket")
            total = np.zeros(len(grams), np.int64)
            total[by] = np.concatenate([*map(_unpack, mine["counts"]), np.zeros(0, np.int64)])
            counts.append(total)
        score = log_scores(found, counts, words, alpha, min_count)
        of = np.repeat(np.arange(len(docs)), found.lengths)
        sums = np.bincount(of, weights=score, minlength=len(docs))
        return pd.DataFrame({
            "doc_id": docs["doc_id"], "n_words": found.lengths, "log_score": sums,
            "mean_log_score": np.where(found.lengths > 0, sums / np.maximum(found.lengths, 1), np.nan),
        })

    return sum_up


def score_documents(
    docs: DataFrame, order: int = 2, alpha: float = 0.4, min_count: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = 4 << 20, bucket_bytes: int = 64 << 20,
) -> DataFrame:
    """doc_id, n_words, log_score and mean_log_score of every row.

    Counts cover the whole table. n-grams do not cross documents. A text without
    words (null, empty, blank) has 0 words, log_score 0 and a null mean. Repeated
    rows count and are scored each. Documents are dealt to blocks of about
    `block_bytes` of text by a hash of id and text; a single long text may exceed
    that. Buckets hold about `bucket_bytes` of text's n-grams. An empty table
    gives an empty table.
    """
    if order < 1 or not 0 < alpha <= 1 or min_count < 1:
        raise ValueError("order and min_count start at 1; alpha lies in (0, 1]")
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    size = rows.agg(
        F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.regexp_count("text", F.lit(WORD)).cast("long")), F.lit(0)).alias("words"),
    ).first()
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-size.bytes // block_bytes))
    buckets = max(tasks, -(-size.bytes // bucket_bytes))
    row = F.xxhash64("doc_id", "text")
    dealt = rows.withColumns({"row": row, "block": F.pmod(row, F.lit(blocks)).cast("int")})
    asked = dealt.groupBy("block").applyInPandas(_ask(order, buckets), ASKED)
    answers = asked.groupBy("bucket").applyInPandas(
        lambda frame: _answer(frame), "bucket int, block int, rank int, counts binary"
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        _sum_up(order, buckets, size.words, alpha, min_count),
        f"doc_id {kind}, n_words long, log_score double, mean_log_score double",
    )
    return scored.withColumn("mean_log_score", F.nanvl("mean_log_score", F.lit(None)))
