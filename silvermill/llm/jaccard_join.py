"""Near-duplicate documents: a Jaccard join on word shingles, by group counts.

A document is its set of shingle hashes. Hashes are cut into groups by range;
the counts of a set's hashes in the groups are a point, and the overlap of two
sets is at most the sum of the smaller coordinates of their points. Points are
held in R-trees: below a tree node whose largest coordinates do not reach the
overlap that a link needs, nothing is looked at. Pairs that survive are verified
on the whole sets.

One tree over all points would be searched almost whole: two unrelated sets of
500 differ in every coordinate by a little, and a link may differ in many of
them. So points are first dealt to blocks, and trees are built in blocks. If two
sets differ in at most k hashes and are cut into more than k groups, some group
is the same in both. Each set is therefore in one block per group, named by the
group's content, and no link is lost. The number of groups depends on the size
alone, and sizes of a link are within the threshold's ratio.

Copies in thousands would make millions of pairs in a block. In a first round
every set of a block is only compared with the block's smallest; linked sets
become one component. In blocks that still hold several, the same is done once
more with leaders: sets that no other leader is near. Trees are then built for
the blocks that even so hold several components, and give out every pair of
different ones that may be a link.

No block comes whole into one task. Sets that a map task finds more than `RUN`
times under one name leave it as runs of their own, and the name's bucket gets
only their smallest. For leaders and trees, a block is dealt to cells: the members
of its commonest component once each, in parts, and the others' beside every part,
since only different components are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from silvermill.llm.components import connected_components
from silvermill.llm.text import distinct, mix, shingles, whole_text, word_hashes
from silvermill.scratch import stored

COORDINATES = 256
LEAF = 32
RUN = 64
RUN_NODES = 65_536


# Sets

def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    return distinct(shingles(word_hashes(text), size))


def set_hash(hashes: np.ndarray) -> int:
    """One signed 64-bit number for a set."""
    total = mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(np.array([total ^ np.uint64(len(hashes))]))[0].astype(np.int64))


def group_counts(hashes: np.ndarray, groups: int = COORDINATES) -> np.ndarray:
    return np.bincount(_group_of(hashes, groups), minlength=groups).astype(np.uint32)


def _group_of(hashes: np.ndarray, groups: int) -> np.ndarray:
    """Ranges of the upper 32 bits, so groups of a sorted set lie side by side."""
    return (((hashes >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)).astype(np.int64)


def needed_overlap(a, b, percent: int):
    """The least intersection of linked sets of these sizes."""
    return -((-(a + b) * percent) // (100 + percent))


def is_link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


# Blocks

def size_bands(percent: int, upto: int) -> list[int]:
    """Starts of the bands of sizes; linked sets are in one band or in two adjacent ones."""
    starts = [1]
    while starts[-1] <= upto:
        starts.append(starts[-1] * 100 // percent + 1)
    return starts


def band_groups(percent: int, largest: int) -> tuple[int, int]:
    """(k, groups) for links whose smaller set has at most `largest` hashes.

    k is the most hashes in which such sets differ. There are more than k + 1
    groups, so that as many may be empty as there are to spare.
    """
    k = (100 - percent) * (largest * 100 // percent) // 100
    groups = k + 1
    return k, groups + 1 + groups * (100 - percent) // 100


def block_names(hashes: np.ndarray, percent: int, starts: list[int]) -> np.ndarray:
    """The blocks of a sorted set, in the scheme of its band and of the one below.

    Empty groups name no block, unless there are so many that the same groups of
    a link might all be empty: then the band's block of such sets is named.
    """
    band = int(np.searchsorted(starts, len(hashes), "right")) - 1
    spread = mix(hashes)
    names = []
    for scheme in (band, band - 1):
        if scheme < 0:
            continue
        k, groups = band_groups(percent, starts[scheme + 1] - 1)
        if k == 0:
            continue  # such links are equal sets
        group = _group_of(hashes, groups)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        content = np.add.reduceat(spread, first)
        place = group[first].astype(np.uint64) + np.uint64(scheme << 40)
        names.append(mix(content ^ mix(place)))
        if groups - len(first) >= groups - k:
            names.append(mix(np.array([np.uint64(scheme) ^ np.uint64(0xE3779B97)])))
    return np.concatenate(names) if names else np.zeros(0, np.uint64)


def _document_sets(docs: DataFrame, shingle: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [shingle_set(text, shingle) for text in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"],
                "n_shingles": np.array([len(s) for s in found], np.int64),
                "node": np.array([set_hash(s) if len(s) else 0 for s in found], np.int64),
            })

    return stored(docs.mapInPandas(sets, f"doc_id {kind}, n_shingles long, node long"), "sets")


def _blocks(docs: DataFrame, shingle: int, percent: int, largest: int, buckets: int) -> DataFrame:
    """The blocks of every set, packed by hash bucket.

    (bucket, names, nodes, hot, run): a run holds many sets of one name, in a bucket
    that does not follow from it; `hot` are the names of a bucket that have runs.
    """
    starts = size_bands(percent, largest)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        names, nodes, held = [], [], 0
        for frame in frames:
            for text in frame["text"]:
                hashes = shingle_set(text, shingle)
                node = set_hash(hashes) if len(hashes) else None
                if node is None or node in seen:
                    continue  # copies that lie together need no blocks of their own
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(node)
                mine = block_names(hashes, percent, starts)
                names.append(mine)
                nodes.append(np.full(len(mine), node, np.int64))
                held += len(mine)
            if held >= 2_000_000:
                yield _by_bucket(names, nodes, buckets)
                names, nodes, held = [], [], 0
        if held:
            yield _by_bucket(names, nodes, buckets)

    return docs.select("text").mapInPandas(
        deal, "bucket int, names binary, nodes binary, hot binary, run boolean"
    )


def _by_bucket(names: list, nodes: list, buckets: int) -> pd.DataFrame:
    name, node = np.concatenate(names), np.concatenate(nodes)
    order = np.lexsort((node, name))
    name, node = name[order], node[order]
    first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    size = np.diff(np.append(first, len(name)))
    runs = []
    for i in np.flatnonzero(size > RUN):
        for at in range(first[i], first[i] + size[i], RUN_NODES):
            mine = node[at : min(at + RUN_NODES, first[i] + size[i])]
            place = mix(name[first[i] : first[i] + 1] ^ mine[:1].astype(np.uint64))[0]
            runs.append((int(place % np.uint64(buckets)), name[first[i]].tobytes(), mine.tobytes(), b"", True))
    least = np.repeat(size <= RUN, size)
    least[first] = True
    hot = np.repeat(size > RUN, size)[least]
    name, node = name[least], node[least]
    bucket = (name % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    used, first = np.unique(bucket[order], return_index=True)
    packed = [
        (int(at), name[mine].tobytes(), node[mine].tobytes(), name[mine][hot[mine]].tobytes(), False)
        for at, mine in zip(used, np.split(order, first[1:]))
    ]
    return pd.DataFrame(packed + runs, columns=["bucket", "names", "nodes", "hot", "run"])


def _members_of_blocks(frame: pd.DataFrame) -> pd.DataFrame:
    """Blocks with several sets, in pieces named by their smallest; of blocks with the same sets, one.

    A hot block is named by its name, so that its runs and what lies here are one.
    """
    runs, frame = frame[frame["run"]], frame[~frame["run"]]
    found = [
        (int(mix(np.frombuffer(name, np.uint64))[0].astype(np.int64)), np.frombuffer(nodes, np.int64))
        for name, nodes in zip(runs["names"], runs["nodes"])
    ]
    if len(frame):
        name = np.concatenate([np.frombuffer(x, np.uint64) for x in frame["names"]])
        node = np.concatenate([np.frombuffer(x, np.int64) for x in frame["nodes"]])
        hot = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in frame["hot"]]))
        order = np.lexsort((node, name))
        name, node = name[order], node[order]
        fresh = np.concatenate([[True], (name[1:] != name[:-1]) | (node[1:] != node[:-1])])
        name, node = name[fresh], node[fresh]
        first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        size = np.diff(np.append(first, len(name)))
        content = np.add.reduceat(mix(node.astype(np.uint64)), first)
        is_hot = np.isin(name[first], hot)
        content[is_hot] = mix(name[first][is_hot])
        several = np.flatnonzero((size > 1) | is_hot)
        _, kept = np.unique(content[several], return_index=True)
        for i in several[kept]:
            for at in range(first[i], first[i] + size[i], RUN_NODES):
                found.append((content[i].astype(np.int64), node[at : min(at + RUN_NODES, first[i] + size[i])]))
    return pd.DataFrame({
        "block": np.array([block for block, _ in found], np.int64),
        "piece": np.array([nodes[0] for _, nodes in found], np.int64),
        "nodes": pd.Series([nodes for _, nodes in found], dtype=object),
    })


# Trees

class CountTree:
    """An R-tree over count vectors, bulk-loaded by halving the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.arange(len(points))
        self.points, self.sizes = points, sizes
        self.low_child, self.high_child, self.span, self.top, self.least = [], [], [], [], []
        self._build(0, len(points))
        self.top, self.least = np.array(self.top), np.array(self.least)
        self.low_child, self.high_child = np.array(self.low_child), np.array(self.high_child)

    def _build(self, a: int, b: int) -> int:
        mine = self.order[a:b]
        points = self.points[mine]
        number = len(self.span)
        self.span.append((a, b))
        self.top.append(points.max(axis=0))
        self.least.append(self.sizes[mine].min())
        self.low_child.append(-1)
        self.high_child.append(-1)
        if b - a > LEAF:
            axis = np.argmax(points.max(axis=0) - points.min(axis=0))
            self.order[a:b] = mine[np.argsort(points[:, axis], kind="stable")]
            middle = (a + b) // 2
            self.low_child[number] = self._build(a, middle)
            self.high_child[number] = self._build(middle, b)
        return number

    def pairs(self, labels: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index pairs i < j, of different labels, whose overlap may reach a link's."""
        for at in range(0, len(self.points), 256):
            query = np.arange(at, min(at + 256, len(self.points)))
            node = np.zeros(len(query), np.int64)
            while len(query):
                reach = np.minimum(self.points[query], self.top[node]).sum(axis=1, dtype=np.int64)
                alive = reach >= needed_overlap(self.sizes[query], self.least[node], percent)
                query, node = query[alive], node[alive]
                leaf = self.low_child[node] < 0
                for q, number in zip(query[leaf], node[leaf]):
                    a, b = self.span[number]
                    other = self.order[a:b]
                    other = other[(other > q) & (labels[other] != labels[q])]
                    reach = np.minimum(self.points[other], self.points[q]).sum(axis=1, dtype=np.int64)
                    other = other[reach >= needed_overlap(self.sizes[q], self.sizes[other], percent)]
                    if len(other):
                        yield np.full(len(other), q), other
                inner = ~leaf
                query = np.concatenate([query[inner], query[inner]])
                node = np.concatenate([self.low_child[node[inner]], self.high_child[node[inner]]])


def candidate_pairs(
    points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A small block is one leaf, compared without a tree."""
    if len(points) > 2 * LEAF:
        yield from CountTree(points, sizes).pairs(labels, percent)
        return
    i, j = np.triu_indices(len(points), 1)
    other = labels[i] != labels[j]
    i, j = i[other], j[other]
    reach = np.minimum(points[i], points[j]).sum(axis=1, dtype=np.int64)
    near = reach >= needed_overlap(sizes[i], sizes[j], percent)
    yield i[near], j[near]


def leader_pairs(
    nodes: np.ndarray, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a leader and those of other components that may link with it.

    Whoever is near a leader, or in its component, leads nobody: copies give one
    pair each and not one for every two of them.
    """
    left = np.argsort(mix(nodes.astype(np.uint64)))
    while len(left) > 1:
        leader, left = left[0], left[1:]
        left = left[labels[left] != labels[leader]]
        reach = np.minimum(points[left], points[leader]).sum(axis=1, dtype=np.int64)
        near = reach >= needed_overlap(sizes[leader], sizes[left], percent)
        if near.any():
            yield np.full(near.sum(), leader), left[near]
        left = left[~near]


def _pairs_of_cells(percent: int, leaders: bool):
    def pairs(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["cell", "node"])
        cell, node = frame["cell"].to_numpy(), frame["node"].to_numpy()
        label, size = frame["label"].to_numpy(), frame["n"].to_numpy(np.int64)
        points = np.frombuffer(b"".join(frame["counts"]), np.uint32).reshape(len(frame), -1)
        edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y in zip(edges, edges[1:]):
            own = points[x:y], size[x:y], label[x:y], percent
            found = leader_pairs(node[x:y], *own) if leaders else candidate_pairs(*own)
            for i, j in found:
                a.append(node[x + i])
                b.append(node[x + j])
        a, b = np.concatenate(a), np.concatenate(b)
        return pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)}).drop_duplicates()

    return pairs


# Cells

def _cells(labelled: DataFrame, part_rows: int) -> DataFrame:
    """(block, cell, node, label) of the blocks with several labels (components).

    Any two of a block with different labels are in some cell, and a cell has at
    most about twice `part_rows` members. Cell (p, q) has part p of the commonest
    label and part q of the others, cell (-1 - q, r) parts q < r of the others.
    Beside the parts but the first, the others have one label: they meet in (0, q).
    """
    sizes = labelled.groupBy("block", "label").agg(F.count("*").alias("n"))
    facts = sizes.groupBy("block").agg(
        F.count("*").alias("labels"), F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("top")
    ).where("labels > 1")
    parts = lambda n: F.ceil(n / F.lit(part_rows)).cast("int")
    small = F.col("all") <= part_rows
    facts = stored(facts.select(
        "block", F.col("top.label").alias("common"),
        F.when(small, 1).otherwise(parts(F.col("top.n"))).alias("common_parts"),
        F.when(small, 1).otherwise(parts(F.col("all") - F.col("top.n"))).alias("other_parts"),
    ), "mixed-blocks")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    common = F.col("label") == F.col("common")
    spread = F.xxhash64(F.lit(1), "node")
    part = F.pmod(spread, F.when(common, F.col("common_parts")).otherwise(F.col("other_parts"))).cast("int")
    row = lambda x, y, label: F.struct(x.alias("x"), y.alias("y"), label.alias("label"))
    beside = F.transform(upto("common_parts"), lambda p: row(
        p, F.col("part"), F.when(p == 0, F.col("label")).otherwise(F.bitwise_not("common"))
    ))
    among = F.transform(
        F.filter(upto("other_parts"), lambda r: r != F.col("part")),
        lambda r: row(-1 - F.least(r, "part"), F.greatest(r, "part"), F.col("label")),
    )
    own = F.transform(upto("other_parts"), lambda q: row(F.col("part"), q, F.col("label")))
    dealt = (
        labelled.join(facts.hint("merge"), "block").withColumn("part", part)
        .select("block", "node", F.explode(F.when(common, own).otherwise(F.concat(beside, among))).alias("at"))
    )
    return dealt.select("block", F.xxhash64("block", "at.x", "at.y").alias("cell"), "node", "at.label")


# The join

def _verified(pairs: DataFrame, members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are links; a pair meets the texts of both its sets."""
    a = members.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = members.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = (None, None)
        for frame in frames:
            good = np.zeros(len(frame), bool)
            for i, (text_a, number, text_b) in enumerate(zip(frame["text_a"], frame["b"], frame["text_b"])):
                if kept[0] != number:
                    kept = number, shingle_set(text_b, shingle)
                good[i] = is_link(shingle_set(text_a, shingle), kept[1], percent)
            yield frame.loc[good, ["a", "b"]]

    return stored(pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").mapInPandas(check, "a long, b long"), "links")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80,
    id_col: str = "doc_id", text_col: str = "text", bucket_entries: int = 1_000_000,
    part_rows: int = 1024,
) -> DataFrame:
    """Each row's doc_id, n_shingles and component_id.

    Two documents link if 100 * |intersection| >= percent * |union| of their
    sets of `shingle`-word shingles (fewer words: one shingle of all of them).
    component_id is the smallest id reachable by links, the own id included.
    Links are exact up to collisions of 64-bit hashes.

    Null, empty and blank texts have the empty set, which links with nothing. A
    document with a null id gets the component of its copies, null if it has
    none, and links nothing itself. Rows with one id are judged each by its own
    text. An empty table gives an empty table. `part_rows` bounds what is compared
    at once (1 KB a row), not what is found.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent must be 1 to 100")
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    sets = _document_sets(rows, shingle)
    full = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("node").agg(F.min("doc_id").alias("first"))
    facts = full.agg(F.max("n_shingles"), F.sum("n_shingles")).first()
    largest, total = facts[0] or 0, facts[1] or 0
    buckets = max(1, -(-total * 3 * (100 - percent) // 100 // bucket_entries))
    buckets = max(buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = stored(
        _blocks(rows.where("doc_id IS NOT NULL"), shingle, percent, largest, buckets)
        .groupBy("bucket").applyInPandas(
            lambda frame: _members_of_blocks(frame), "block long, piece long, nodes array<long>"
        ).dropDuplicates(["block", "piece"]),
        "blocks",
    )
    entries = stored(blocks.select("block", F.explode("nodes").alias("node")).distinct(), "entries")
    members = _members(rows, entries.select("node").distinct(), classes, shingle)
    others = F.explode(F.slice("nodes", 2, 2147483647))
    stars = stored(blocks.select(others.alias("a"), F.col("nodes")[0].alias("b")).distinct(), "stars")
    links = _verified(stars, members, shingle, percent)
    roots = stored(connected_components(links), "roots")
    tested = stars
    for leaders in (True, False):
        labelled = entries.join(roots.hint("merge"), "node", "left").select(
            "block", "node", F.coalesce("root", "node").alias("label")
        )
        cells = stored(_cells(labelled, part_rows), "cells")
        groups = max(buckets, cells.count() // (8 * part_rows))
        points = cells.drop("block").join(members.select("node", "n", "counts").hint("merge"), "node")
        pairs = stored(
            points.groupBy(F.pmod("cell", F.lit(groups)).alias("bucket"))
            .applyInPandas(_pairs_of_cells(percent, leaders), "a long, b long").distinct()
            .join(tested.hint("merge"), ["a", "b"], "left_anti"),
            "pairs",
        )
        links = links.union(_verified(pairs, members, shingle, percent))
        tested, entries = tested.union(pairs), cells.select("block", "node").distinct()
        roots = stored(connected_components(links), "roots")
    named = classes.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_node = stored(named.join(least.hint("merge"), "root").select("node", "component_id"), "classes")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return sets.join(of_node.hint("merge"), "node", "left").select(
        "doc_id", "n_shingles", F.coalesce(own, "doc_id").alias("component_id")
    )


def _members(rows: DataFrame, nodes: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """(node, n, counts, text) of the sets that share a block with another."""
    wanted = classes.join(nodes.hint("merge"), "node").select("node", F.col("first").alias("doc_id"))

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for frame in frames:
            out = []
            for node, text in zip(frame["node"], frame["text"]):
                if node in seen:
                    continue  # a repeated row
                hashes = shingle_set(text, shingle)
                if len(hashes) and set_hash(hashes) == node:  # an id may have other texts
                    seen.add(node)
                    out.append((node, len(hashes), group_counts(hashes).tobytes(), text))
            yield pd.DataFrame(out, columns=["node", "n", "counts", "text"])

    joined = rows.join(wanted.hint("merge"), "doc_id").select("node", "text")
    measured = joined.mapInPandas(measure, "node long, n long, counts binary, text string")
    return stored(measured, "members")
