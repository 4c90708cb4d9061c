"""Ranked lexical search over bit-sliced Bloom signatures, with exact results.

A term is a maximal run of ASCII letters, digits and code points from 0x80; only
A to Z are lower-cased. A document scores

    sum over an item's distinct terms of w * ((1000000000 * tf) div (1000 * tf + 8 * m))

with w = floor(1000 * ln((2 N + 2) / (2 df + 1))) and m = 10 + (90 n N) div L, all but
w in whole numbers: tf, n are the term's and all terms' occurrences in the document,
df the documents with the term, N the documents with any term, L all occurrences.

The index holds, for a few hundred documents at a time, a block of slices: slice
p is a bitmap of the documents that have p among their signature's bits. A
document's signature has bits for each term and for each of the levels 1, 2, 4, ...
that the term's tf reaches. The AND of a key's slices is a bitmap that misses no
document with that key and has a few too many. So a term's slices bound its tf from
above, the formula grows with tf, and the weighted sum over an item's terms is an
upper bound of a document's score. Documents of a block have alike numbers of keys,
so that a block's width suits all of them.

A search goes over the slices twice. The first time, the documents with the
greatest bounds are scored exactly, which gives every item a score that its last
result reaches. The second time, all documents whose bound is not below it are
scored exactly from their whole texts; no other can be a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from silvermill.llm.text import mix, whole_text, word_hashes
from silvermill.scratch import stored

#: Bytes that belong to terms.
TERM_BYTES = np.array(
    [chr(b).isalnum() if b < 128 else True for b in range(256)]
)
HASHES = 4
BITS_A_KEY = 12
LEVELS = 10
#: Beyond this width a signature only gets denser, and its bounds looser.
WIDEST = 1 << 20
BLOCK_BITS = 1 << 23
_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def term_hashes(text: str | None) -> np.ndarray:
    return word_hashes(text, TERM_BYTES)


def document_lengths(n: np.ndarray, documents: int, occurrences: int) -> np.ndarray:
    """m of documents with n terms."""
    return np.array([10 + (90 * int(x) * documents) // occurrences for x in n], np.int64)


def term_share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


# Signatures

def level_keys(terms: np.ndarray, level: int) -> np.ndarray:
    """The keys of terms that occur 2 ** level times or more."""
    return terms if level == 0 else mix(terms ^ np.uint64(level * 0x9E3779B1))


def signature_keys(terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
    keys = [terms]
    for level in range(1, LEVELS):
        often = tf >= 1 << level
        terms, tf = terms[often], tf[often]
        if not len(terms):
            break
        keys.append(level_keys(terms, level))
    return np.concatenate(keys)


def signature_bits(keys: np.ndarray, width: int) -> np.ndarray:
    """The places of each key's bits, one row for each hash: a walk with a step of the key's own."""
    spread = mix(keys)
    walk = (spread >> _HALF) + np.arange(HASHES, dtype=np.uint64)[:, None] * (spread & _LOW | np.uint64(1))
    return (((walk & _LOW) * np.uint64(width)) >> _HALF).astype(np.int64)


def width_class(keys: int) -> int:
    """Signatures' widths go by powers of 2 ** 0.5."""
    return max(8, math.ceil(2 * math.log2(max(keys, 1))))


def class_width(kind: int) -> int:
    return min(WIDEST, math.ceil(BITS_A_KEY * 2 ** (kind / 2)))


def class_documents(kind: int) -> int:
    """Documents in a block: a multiple of 8, so that a block's bits are bounded."""
    return max(8, min(1024, BLOCK_BITS // class_width(kind) // 8 * 8))


class _Block:
    def __init__(self, kind: int):
        self.width, self.room = class_width(kind), class_documents(kind)
        self.clear()

    def clear(self) -> None:
        self.ids, self.a, self.b, self.n = [], [], [], []
        self.bits = np.zeros((self.width, self.room), bool)

    def add(self, doc_id, a: int, b: int, n: int, keys: np.ndarray) -> None:
        self.bits[signature_bits(keys, self.width), len(self.ids)] = True
        self.ids.append(doc_id)
        self.a.append(a)
        self.b.append(b)
        self.n.append(n)

    def packed(self) -> dict:
        slices = np.packbits(self.bits[:, : len(self.ids)], axis=1).tobytes()
        row = {"width": self.width, "ids": self.ids, "a": self.a, "b": self.b, "n": self.n, "slices": slices}
        self.clear()
        return row


@dataclass(frozen=True)
class SearchIndex:
    """What `build_index` wrote, and the documents it was built of."""

    docs: DataFrame  # doc_id, text, a, b: the text's hash
    blocks: DataFrame  # width, ids, a, b, n, slices
    counts: DataFrame  # terms, df: packed counts of documents by term
    documents: int
    occurrences: int


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> SearchIndex:
    """Signatures and counts of all rows, written to the shared folder.

    Nothing is shuffled: a task makes blocks of the rows it reads. Null texts
    have no terms; documents without terms are in no block. Every row is a
    document of its own, also with a repeated or null id. Other columns are not
    looked at. Terms are told apart by 64-bit hashes.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumns({"a": F.xxhash64("text"), "b": F.xxhash64(F.lit(1), "text")})
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"width int, ids array<{kind}>, a array<long>, b array<long>, n array<long>, slices binary"

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks: dict[int, _Block] = {}
        for frame in frames:
            found, full = [], []
            for doc_id, text, a, b in zip(frame["doc_id"], frame["text"], frame["a"], frame["b"]):
                hashes = term_hashes(text)
                if not len(hashes):
                    continue
                terms, tf = np.unique(hashes, return_counts=True)
                found.append(terms)
                keys = signature_keys(terms, tf)
                size = width_class(len(keys))
                if size not in blocks:
                    blocks[size] = _Block(size)
                block = blocks[size]
                block.add(None if pd.isna(doc_id) else doc_id, a, b, len(hashes), keys)
                if len(block.ids) == block.room:
                    full.append(block.packed())
            if found:
                terms, df = np.unique(np.concatenate(found), return_counts=True)
                full.append({"terms": terms.tobytes(), "df": df.astype("<u4").tobytes()})
            yield _rows(full)
        yield _rows([block.packed() for block in blocks.values() if block.ids])

    written = stored(rows.mapInPandas(index, f"{schema}, terms binary, df binary"), "signatures")
    blocks = written.where("width IS NOT NULL")
    sizes = blocks.select(F.explode("n").alias("n")).agg(F.count("*"), F.sum("n")).first()
    return SearchIndex(
        rows, blocks.drop("terms", "df"), written.where("terms IS NOT NULL").select("terms", "df"),
        sizes[0], sizes[1] or 0,
    )


def _rows(found: list[dict]) -> pd.DataFrame:
    names = ["width", "ids", "a", "b", "n", "slices", "terms", "df"]
    frame = pd.DataFrame({name: pd.Series([row.get(name) for row in found], dtype=object) for name in names})
    return frame.assign(width=frame["width"].astype("Int32"))


# Items

@dataclass
class ItemTerms:
    """Items by number, and their terms with weights; terms of no weight are left out."""

    ids: list
    terms: np.ndarray  # distinct, sorted
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    item: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # of pairs item, term
    term: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def _read_items(rows: list) -> ItemTerms:
    ids, found = [], []
    for item_id, texts in rows:
        ids.append(item_id)
        found.append(np.unique(np.concatenate([term_hashes(t) for t in texts])))
    item = np.repeat(np.arange(len(ids)), [len(x) for x in found])
    terms, term = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]), return_inverse=True)
    return ItemTerms(ids, terms, np.zeros(len(terms), np.int64), item, term)


def _weigh(items: ItemTerms, index: SearchIndex) -> None:
    """Document counts of the items' terms, and their weights."""
    terms = items.terms

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(terms), np.int64)
        for frame in frames:
            for some, df in zip(frame["terms"], frame["df"]):
                some, df = np.frombuffer(some, np.uint64), np.frombuffer(df, "<u4")
                at = np.minimum(np.searchsorted(some, terms), len(some) - 1)
                total += np.where(some[at] == terms, df[at], 0)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"at": used, "df": total[used]})

    df = dict(
        index.counts.mapInPandas(count, "at long, df long").groupBy("at").agg(F.sum("df")).collect()
    )
    items.weights = np.array(
        [term_weight(index.documents, df[at]) if at in df else 0 for at in range(len(terms))], np.int64
    )
    some = items.weights[items.term] > 0
    items.item, items.term = items.item[some], items.term[some]


def score_bounds(
    items: ItemTerms, width: int, n: np.ndarray, slices: bytes, documents: int, occurrences: int
) -> np.ndarray:
    """Upper bounds of the scores of a block's documents, items by documents."""
    count = len(n)
    bits = np.frombuffer(slices, np.uint8).reshape(width, -1)
    level = np.zeros((len(items.terms), count), np.uint8)
    alive = np.flatnonzero(items.weights > 0)
    held = np.full((len(alive), bits.shape[1]), 255, np.uint8)
    for number in range(LEVELS):
        for places in signature_bits(level_keys(items.terms[alive], number), width):
            held &= bits[places]
        some = held.any(axis=1)
        alive, held = alive[some], held[some]
        if not len(alive):
            break
        level[alive] += np.unpackbits(held, axis=1, count=count)
    m = document_lengths(n, documents, occurrences)
    most = [np.minimum((1 << number) - 1, n) for number in range(LEVELS)] + [n]
    share = np.stack([term_share(tf, m) for tf in most])
    pair_level = level[items.term]
    pair, doc = np.nonzero(pair_level)
    gains = items.weights[items.term[pair]] * share[pair_level[pair, doc], doc]
    # whole numbers below 2 ** 53, which doubles add exactly
    total = np.bincount(items.item[pair] * count + doc, gains, len(items.ids) * count)
    return total.astype(np.int64).reshape(len(items.ids), count)


def exact_scores(
    items: ItemTerms, wanted: np.ndarray, text: str, documents: int, occurrences: int
) -> np.ndarray:
    """The scores of one text for the items with the numbers `wanted`."""
    hashes = term_hashes(text)
    terms, tf = np.unique(hashes, return_counts=True)
    at = np.minimum(np.searchsorted(terms, items.terms), len(terms) - 1)
    here = np.where(terms[at] == items.terms, tf[at], 0)
    m = document_lengths(np.array([len(hashes)]), documents, occurrences)
    gains = items.weights * term_share(here, m)
    total = np.zeros(len(items.ids), np.int64)
    np.add.at(total, items.item, gains[items.term])
    return total[wanted]


# Search

def _greatest_bounds(index: SearchIndex, items: ItemTerms, keep: int) -> DataFrame:
    """(item, doc_id, a, b, bound): each task's `keep` greatest bounds of every item."""
    documents, occurrences = index.documents, index.occurrences
    kind = index.docs.schema["doc_id"].dataType.simpleString()

    def bound(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list[list[tuple]] = [[] for _ in items.ids]
        for frame in frames:
            for row in frame.itertuples(index=False):
                bounds = score_bounds(items, row.width, np.asarray(row.n), row.slices, documents, occurrences)
                few = np.argsort(-bounds, axis=1, kind="stable")[:, :keep]
                for item, docs in enumerate(few):
                    floor = best[item][-1][0] if len(best[item]) == keep else 0
                    fresh = [
                        (int(bounds[item, d]), row.ids[d], int(row.a[d]), int(row.b[d]))
                        for d in docs if bounds[item, d] > floor
                    ]
                    if fresh:
                        best[item] = sorted(best[item] + fresh, key=lambda x: -x[0])[:keep]
        out = [(item, doc, a, b, top) for item, rows in enumerate(best) for top, doc, a, b in rows]
        yield pd.DataFrame(out, columns=["item", "doc_id", "a", "b", "bound"], dtype=object)

    found = index.blocks.mapInPandas(bound, f"item int, doc_id {kind}, a long, b long, bound long")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), F.asc_nulls_last("doc_id"), "a", "b")
    ranked = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    return ranked.drop("place", "bound").distinct()


def _not_excluded(index: SearchIndex, items: ItemTerms, floors: dict[int, tuple]) -> DataFrame:
    """(item, doc_id, a, b) of the documents that may be among an item's results.

    `floors`: the score and the id of the last of as many documents as are
    asked for. A bound below that score rules out, and one equal to it where the
    id comes later: the document could only follow all of them.
    """
    documents, occurrences = index.documents, index.occurrences
    kind = index.docs.schema["doc_id"].dataType.simpleString()
    least = np.array([floors.get(i, (1, None))[0] for i in range(len(items.ids))], np.int64)
    last = [floors[i][1] if i in floors else None for i in range(len(items.ids))]

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                bounds = score_bounds(items, row.width, np.asarray(row.n), row.slices, documents, occurrences)
                for item, doc in zip(*np.nonzero(bounds >= least[:, None])):
                    doc_id = row.ids[doc]
                    tied = bounds[item, doc] == least[item] and last[item] is not None
                    if tied and (doc_id is None or doc_id > last[item]):
                        continue
                    out.append((item, doc_id, row.a[doc], row.b[doc]))
            yield pd.DataFrame(out, columns=["item", "doc_id", "a", "b"], dtype=object)

    return index.blocks.mapInPandas(keep, f"item int, doc_id {kind}, a long, b long")


def _scored(index: SearchIndex, items: ItemTerms, pairs: DataFrame, few: bool) -> DataFrame:
    """(item, doc_id, score) of pairs of items and documents, from whole texts.

    Every document meets its items once: rows with one id and text are one key
    on the side of the pairs, and each such row of the documents is scored.
    """
    documents, occurrences = index.documents, index.occurrences
    kind = index.docs.schema["doc_id"].dataType.simpleString()
    wanted = pairs.groupBy("doc_id", "a", "b").agg(F.collect_set("item").alias("items"))
    wanted = stored(wanted, "search-pairs")
    names = [F.col(f"d.{x}").eqNullSafe(F.col(f"w.{x}")) for x in ("doc_id", "a", "b")]
    right = wanted.alias("w")
    joined = index.docs.alias("d").join(
        F.broadcast(right) if few else right, names[0] & names[1] & names[2]
    ).select("d.doc_id", "d.text", "w.items")

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, text, some in zip(frame["doc_id"], frame["text"], frame["items"]):
                scores = exact_scores(items, some, text, documents, occurrences)
                own = None if pd.isna(doc_id) else doc_id
                out += [(item, own, int(s)) for item, s in zip(some, scores) if s > 0]
            yield pd.DataFrame(out, columns=["item", "doc_id", "score"], dtype=object)

    return joined.mapInPandas(score, f"item int, doc_id {kind}, score long")


def _first(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_group(index: SearchIndex, rows: list, item_type: str, k: int) -> DataFrame:
    spark = index.docs.sparkSession
    items = _read_items(rows)
    _weigh(items, index)
    seeds = _first(_scored(index, items, _greatest_bounds(index, items, 2 * k), few=True), k)
    floors = {
        row["item"]: (row["score"], row["doc_id"]) for row in seeds.where(F.col("rank") == k).collect()
    }
    results = _first(_scored(index, items, _not_excluded(index, items, floors), few=False), k)
    numbers = spark.createDataFrame(list(enumerate(items.ids)), f"item int, item_id {item_type}")
    return results.join(F.broadcast(numbers), "item").select("item_id", "rank", "doc_id", "score")


def search(
    index: SearchIndex, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text",
    group_chars: int = 4_000_000,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `k` best documents with a score above 0.

    Equal scores go by ascending doc_id, null last. Rows with one item_id (also
    null) are one item with the terms of all of them; items without terms have
    no results. Items are searched in groups of about `group_chars`, whose terms go
    to the tasks; one item's text must fit the driver. All other work grows with
    the documents and is spread over them.
    """
    spark = index.docs.sparkSession
    asked = items.select(F.col(id_col).alias("item_id"), whole_text(text_col).alias("text"))
    item_type = asked.schema["item_id"].dataType.simpleString()
    kind = index.docs.schema["doc_id"].dataType.simpleString()
    size = asked.agg(F.sum(F.char_length("text"))).first()[0] or 0
    groups = -(-size // group_chars) if index.occurrences else 0
    found = spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {kind}, score long")
    dealt = asked.withColumn("group", F.pmod(F.xxhash64("item_id"), F.lit(max(groups, 1))))
    for group in range(groups):
        rows = dealt.where(F.col("group") == group).groupBy("item_id").agg(F.collect_list("text")).collect()
        if rows:
            found = found.union(_search_group(index, rows, item_type, k))
    return found
