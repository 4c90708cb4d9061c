"""The trie of conversations' common beginnings, from sorted rows and range minima.

Conversations are sorted by their turns' hashes, and the length of the common
beginning of each row and the row before (LCP) is taken in turns. A prefix of d
turns of some row belongs to the rows around it up to where an LCP is below d. So a
node of the trie is an interval of sorted rows. Each prefix finds the two ends of
its interval by itself, by binary search in a sparse table of the LCPs' range
minima; nothing is passed from row to row or held on a stack.

Rows are sorted into blocks, each small enough for one task. A block has a sparse
table of its own, and one more goes over the blocks' minima, a few numbers for
each block. A prefix that reaches a block's edge is searched in the table of
blocks, which names the block where it ends; that block tells the row. Only the
prefixes of a block's first and last row can reach an edge, so these few questions
are answered by a join. What a block knows of a node that spans several is added
up at the end.

A node's subtree is a run of (row, depth) pairs in sorted order, so sums over it
are differences of prefix sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from silvermill.llm.mixing import word_count
from silvermill.llm.text import whole_text
from silvermill.scratch import stored

KEY = 16  # bytes of a turn's hash
CHUNK = 1000  # ids hashed at a time

NODES = (
    "first long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, open boolean, ends_sha256 string, place long, ids string"
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


# Rebuilding

def ordered_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, turns): each conversation's (key, words) in order.

    The order is made by a range sort of all rows, so rows of one conversation
    and turn, which go by role and text, need not meet in one task. Only hashes
    and word counts are gathered by conversation.
    """
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        whole_text(role_col).alias("role"), whole_text(text_col).alias("text"),
    ).where("conv_id IS NOT NULL")
    order = ("conv_id", F.asc_nulls_first("turn"), "role", "text")
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = F.concat_ws(":", F.char_length("role").cast("string"), "role", "text")
    placed = rows.repartitionByRange(tasks, *order, F.rand(7)).sortWithinPartitions(*order).select(
        "conv_id", F.monotonically_increasing_id().alias("place"),
        F.md5(whole.cast("binary")).alias("key"), word_count(F.col("text")).cast("int").alias("words"),
    )
    gathered = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "key", "words"))).alias("turns")
    )
    return gathered.select("conv_id", F.transform("turns", lambda t: t.dropFields("place")).alias("turns"))


def rebuilt(conversations: DataFrame, block: int = 20, heads: int = 4) -> DataFrame:
    """Every conversation with the first turns of its block's first one for its own.

    The number of such turns is the CRC-32 of the decimal conv_id modulo `heads`.
    """
    head = F.slice("turns", 1, heads - 1)
    bases = conversations.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), head.alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    empty = F.slice("turns", 1, 0)
    return conversations.withColumns({
        "base": F.col("conv_id") - F.col("conv_id") % block, "taken": taken,
    }).join(bases, "base", "left").select("conv_id", F.concat(
        F.slice(F.coalesce("head", empty), F.lit(1), F.col("taken")),
        F.slice("turns", F.col("taken") + 1, F.size("turns")),
    ).alias("turns"))


# Range minima

class RangeMinimum:
    """A sparse table: level k has the minima of all runs of 2 ** k values."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values)]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            below, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima of the runs first to last, both included."""
        first, last = np.asarray(first), np.asarray(last)
        level = np.floor(np.log2(np.maximum(last - first + 1, 1))).astype(int)
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            some = level == k
            values = self.levels[k]
            out[some] = np.minimum(values[first[some]], values[last[some] - (1 << k) + 1])
        return out

    def reach_right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to which all values after `at` are `depth` or more."""
        at = np.array(at)
        for k in range(len(self.levels) - 1, -1, -1):
            values = self.levels[k]
            fits = at + (1 << k) < len(self.levels[0])
            start = np.minimum(at + 1, len(values) - 1)
            fits &= values[start] >= depth
            at = at + (fits << k)
        return at

    def reach_left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place from which all values after it up to `at` are `depth` or more."""
        at = np.array(at)
        for k in range(len(self.levels) - 1, -1, -1):
            values = self.levels[k]
            start = at - (1 << k) + 1
            fits = start >= 1
            fits &= values[np.maximum(start, 0)] >= depth
            at = at - (fits << k)
        return at


def common_turns(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // KEY
    x, y = (np.frombuffer(v[:size], np.uint64).reshape(-1, 2) for v in (a, b))
    return int(np.argmax((x != y).any(axis=1)))


def neighbour_lcps(keys: list[bytes]) -> np.ndarray:
    """LCPs of each row with the row before; the first has none, so 0."""
    return np.array([0] + [common_turns(a, b) for a, b in zip(keys, keys[1:])], np.int64)


# Blocks

def _falls(lcp: np.ndarray, side: str, conv: np.ndarray, length: np.ndarray) -> dict:
    """Where the LCPs, read from the first row on or from the last row back, reach new minima.

    With each fall goes the smallest conv_id and the greatest length of the rows
    from that edge up to it.
    """
    order = np.arange(1, len(lcp)) if side == "head" else np.arange(len(lcp) - 1, 0, -1)
    read = lcp[order]
    lowest = np.minimum.accumulate(read)
    new = np.flatnonzero(read < np.concatenate([[np.iinfo(np.int64).max], lowest[:-1]])) if len(read) else order
    at = order[new]
    if side == "head":
        low, long_ = np.minimum.accumulate(conv)[at - 1], np.maximum.accumulate(length)[at - 1]
    else:
        low, long_ = np.minimum.accumulate(conv[::-1])[::-1][at], np.maximum.accumulate(length[::-1])[::-1][at]
    return {f"{side}_at": at, f"{side}_lcp": lcp[at], f"{side}_conv": low, f"{side}_length": long_}


def _edge_facts(frame: pd.DataFrame) -> pd.DataFrame:
    """One row of a block: what its neighbours and the table of blocks need."""
    frame = frame.sort_values("place")
    keys, conv = frame["key"].tolist(), frame["conv_id"].to_numpy(np.int64)
    lcp = neighbour_lcps(keys)
    length = np.array([len(key) // KEY for key in keys], np.int64)
    row = {
        "block": frame["block"].iloc[0], "n": len(frame), "first_key": keys[0], "last_key": keys[-1],
        "least": lcp[1:].min() if len(lcp) > 1 else np.iinfo(np.int64).max,
        "conv": conv.min(), "length": length.max(),
    }
    row |= _falls(lcp, "head", conv, length) | _falls(lcp, "tail", conv, length)
    return pd.DataFrame({name: [value] for name, value in row.items()})


FACTS = (
    "block long, n long, first_key binary, last_key binary, least long, conv long, length long, "
    + ", ".join(f"{side}_{x} array<long>" for side in ("head", "tail") for x in ("at", "lcp", "conv", "length"))
)


class BlockTable:
    """Blocks in order: where their rows start, and range minima over whole blocks."""

    def __init__(self, facts: pd.DataFrame):
        """`facts`: block, n, least, conv, length, and `edge`, the LCP with the block before."""
        self.start = np.concatenate([[0], np.cumsum(facts["n"])]).astype(np.int64)
        self.number = {int(b): i for i, b in enumerate(facts["block"])}
        self.edge = facts["edge"].to_numpy(np.int64)
        self.conv = RangeMinimum(facts["conv"].to_numpy(np.int64))
        self.short = RangeMinimum(-facts["length"].to_numpy(np.int64))
        self.lcps = RangeMinimum(np.minimum(facts["least"].to_numpy(np.int64), self.edge))

    def whole_blocks(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest conv_id and greatest length of blocks first to last, if any."""
        some = first <= last
        conv = np.full(len(first), np.iinfo(np.int64).max)
        length = np.full(len(first), -1, np.int64)
        conv[some] = self.conv.of(first[some], last[some])
        length[some] = -self.short.of(first[some], last[some])
        return conv, length


ANSWERS = "asker long, side int, depth int, row long, conv long, length long"


def _questions(shared):
    """Where prefixes that cross a block's edges end: the block, asked for the row."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value[0]
        names = list(table.number)
        last_block = len(table.edge) - 1
        for frame in frames:
            out = []
            for block in frame["block"]:
                at = table.number[int(block)]
                after = table.edge[at + 1] if at < last_block else -1
                depth = np.arange(after + 1)
                here = np.full(len(depth), at)
                end = table.lcps.reach_right(here, depth)  # up to here all rows of blocks
                conv, length = table.whole_blocks(here + 1, end)
                out.append(pd.DataFrame({
                    "asker": block, "side": 1, "depth": depth, "block": np.minimum(end + 1, last_block),
                    "row": table.start[end + 1] - 1, "conv": conv, "length": length,
                    "inside": (end < last_block) & (table.edge[np.minimum(end + 1, last_block)] >= depth),
                }))
                depth = np.arange(table.edge[at] + 1 if at else 0)
                here = np.full(len(depth), at)
                end = table.lcps.reach_left(here - 1, depth)  # the block that they begin in
                conv, length = table.whole_blocks(end + 1, here - 1)
                out.append(pd.DataFrame({
                    "asker": block, "side": 0, "depth": depth, "block": end,
                    "row": table.start[end], "conv": conv, "length": length, "inside": True,
                }))
            found = pd.concat(out)
            yield found.assign(block=[names[i] for i in found["block"]])

    return ask


def _answers(questions: pd.DataFrame, facts: pd.DataFrame, start: dict[int, int]) -> pd.DataFrame:
    """The rows where the prefixes end, by the falls of the block that holds them."""
    if not len(questions) or not len(facts):
        return pd.DataFrame(columns=["asker", "side", "depth", "row", "conv", "length"])
    fact = facts.iloc[0]
    first, n = start[int(fact["block"])], int(fact["n"])
    out = []
    for side, some in questions.groupby("side"):
        falls = np.asarray(fact["head_lcp" if side else "tail_lcp"], np.int64)
        names = ["head_at", "head_conv", "head_length"] if side else ["tail_at", "tail_conv", "tail_length"]
        at, conv, length = (np.asarray(fact[name], np.int64) for name in names)
        depth = some["depth"].to_numpy(np.int64)
        # the falls descend: the first below the depth
        where = np.searchsorted(-falls, -depth, "right")
        found = where < len(falls)
        pick = np.minimum(where, max(len(falls) - 1, 0))
        pad = np.zeros(1, np.int64)
        at, conv, length = (np.concatenate([x, pad]) for x in (at, conv, length))
        row = np.where(found, first + at[pick] - (1 if side else 0), first + n - 1 if side else first)
        own_conv = np.where(found, conv[pick], fact["conv"])
        own_length = np.where(found, length[pick], fact["length"])
        inside = some["inside"].to_numpy(bool)
        out.append(some.assign(
            row=np.where(inside, row, some["row"]),
            conv=np.where(inside, np.minimum(own_conv, some["conv"]), some["conv"]),
            length=np.where(inside, np.maximum(own_length, some["length"]), some["length"]),
        ))
    return pd.concat(out)[["asker", "side", "depth", "row", "conv", "length"]]


# Nodes

def block_nodes(
    conv: np.ndarray, keys: list[bytes], words: list[np.ndarray], start: int,
    before: pd.DataFrame, after: pd.DataFrame,
) -> tuple[pd.DataFrame, list[tuple]]:
    """A block's share of every node that has rows in it.

    `before` and `after` tell for the depths 0, 1, ... where the prefixes that
    cross an edge end, and the smallest conv_id and greatest length beyond it.
    Returned are the nodes, with `open` for those that cross an edge, and, for
    these, the ids of the conversations that end there, in chunks (first row,
    depth, place, text): others may end there in other blocks.
    """
    n = len(conv)
    lcp = neighbour_lcps(keys)
    length = np.array([len(key) // KEY for key in keys], np.int64)
    # candidates: the depths of a row that the row before in this block has not
    first_new = np.where(np.arange(n) == 0, 0, lcp + 1)
    count = np.maximum(length - first_new + 1, 0)
    row = np.repeat(np.arange(n), count)
    offset = np.cumsum(count) - count
    depth = np.arange(len(row)) - offset[row] + first_new[row]
    minima, convs, shorts = RangeMinimum(lcp), RangeMinimum(conv), RangeMinimum(-length)
    low, high = minima.reach_left(row, depth), minima.reach_right(row, depth)
    least, longest = convs.of(low, high), -shorts.of(low, high)
    left, right = start + low, start + high
    for at, beyond, edge_rows in ((left, before, low == 0), (right, after, high == n - 1)):
        some = np.flatnonzero(edge_rows & (depth < len(beyond)))  # answers are there for 0, 1, ...
        told = beyond.sort_values("depth").iloc[depth[some]]
        at[some] = told["row"]
        least[some] = np.minimum(least[some], told["conv"])
        longest[some] = np.maximum(longest[some], told["length"])
    fresh = left == start + row  # the node's first row is here, and counts it
    n_convs = right - left + 1
    # one turn less: the candidate before, or that of the first row that shares the LCP
    holder = minima.reach_left(row, depth - 1)
    parent = np.where(depth > 0, offset[holder] + depth - 1 - first_new[holder], 0)
    n_children = np.bincount(parent[fresh & (depth > 0)], minlength=len(row))
    last_words = np.concatenate([np.append(0, w)[f:] for w, f in zip(words, first_new)]).astype(np.int64)
    saved = np.where(fresh, (n_convs - 1) * last_words, 0)
    leaf = fresh & (longest == depth)
    # the subtree: from the candidate itself to the last one of the interval's rows
    end = (offset + count)[high]
    def within(values: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(values)])
        return upto[end] - upto[:-1]

    crossing = (left < start) | (right >= start + n)
    nodes = pd.DataFrame({
        "first": left, "depth": depth, "conv_id": least,
        "parent_conv_id": pd.array(np.where(depth > 0, least[parent], 0), "Int64"), "n_convs": n_convs,
        "n_children": n_children, "n_leaves": within(leaf.astype(np.int64)), "saved_tokens": within(saved),
        "open": crossing,
    })
    # those who end at a node are the first rows of its interval
    ends, chunks = np.full(len(row), None, object), []
    for c in np.flatnonzero(depth == length[row]):
        a, b = low[c], low[c]
        while b + 1 <= high[c] and length[b + 1] == depth[c]:
            b += 1
        ids = [str(x) for x in conv[a : b + 1].tolist()]
        if crossing[c]:
            chunks += [
                (left[c], depth[c], start + a + k, ",".join(ids[k : k + CHUNK])) for k in range(0, len(ids), CHUNK)
            ]
        else:
            ends[c] = hashlib.sha256(",".join(ids).encode()).hexdigest()
    nodes.loc[depth == 0, "parent_conv_id"] = pd.NA
    return nodes.assign(ends_sha256=ends), chunks



def _neighbours(facts: DataFrame, blocks: list[int]) -> dict[int, int]:
    """For each block but the first, the LCP of its first row and the row before."""
    following = dict(zip(blocks, blocks[1:]))

    def facing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            after = frame.assign(block=frame["block"].map(following), key=frame["last_key"])
            own = frame.assign(key=frame["first_key"])
            yield pd.concat([own, after.dropna(subset="block")])[["block", "key"]]

    def lcp(frame: pd.DataFrame) -> pd.DataFrame:
        if len(frame) < 2:
            return pd.DataFrame(columns=["block", "edge"])
        return pd.DataFrame({"block": frame["block"].iloc[:1], "edge": [common_turns(*frame["key"])]})

    keys = facts.select("block", "first_key", "last_key").mapInPandas(facing, "block long, key binary")
    return dict(keys.groupBy("block").applyInPandas(lcp, "block long, edge long").collect())


def _chunk_hashes(chunks: DataFrame) -> DataFrame:
    """(first, depth, ends_sha256): the chunks of a node, joined by commas, as they pass by."""

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, digest = None, None
        for frame in frames:
            out = []
            for first, depth, ids in zip(frame["first"], frame["depth"], frame["ids"]):
                if (first, depth) != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (first, depth), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["first", "depth", "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, digest.hexdigest())], columns=["first", "depth", "ends_sha256"])

    tasks = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        chunks.repartition(tasks, "first", "depth").sortWithinPartitions("first", "depth", "place")
        .select("first", "depth", "ids").mapInPandas(hashed, "first long, depth long, ends_sha256 string")
    )


def prefix_nodes(conversations: DataFrame, block_turns: int = 200_000) -> DataFrame:
    """A row for each node of the trie of (conv_id, turns), turns being (key, words).

    Columns: conv_id (the smallest of a member), depth, parent_conv_id (null at
    the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Every
    conv_id is there once. No conversations give no nodes, not even a root.

    A block holds about `block_turns` turns. One conversation's hashes, 16 bytes a
    turn, are one value and must fit a task; copies of a conversation, in any
    number, are dealt to blocks like others. A few numbers for each block go to
    the driver and back as a broadcast.
    """
    spark = conversations.sparkSession
    rows = stored(conversations.select(
        "conv_id", F.unhex(F.array_join(F.col("turns.key"), "")).alias("key"), F.col("turns.words").alias("words"),
    ), "trie-rows")
    turns = rows.agg(F.sum(F.size("words"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // block_turns))
    place = F.monotonically_increasing_id()
    blocks = stored(
        rows.repartitionByRange(tasks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
        .withColumn("place", place).withColumn("block", F.shiftright("place", 33)),
        "trie-blocks",
    )
    facts = stored(
        blocks.select("block", "place", "conv_id", "key").groupBy("block").applyInPandas(_edge_facts, FACTS),
        "trie-facts",
    )
    known = facts.select("block", "n", "least", "conv", "length").toPandas().sort_values("block")
    names = [int(b) for b in known["block"]]
    if not names:
        return spark.createDataFrame([], NODES).select(*_COLUMNS)
    edge = _neighbours(facts, names)
    table = BlockTable(known.assign(edge=[edge.get(b, -1) for b in names]))
    start = dict(zip(names, table.start.tolist()))
    shared = spark.sparkContext.broadcast((table, start))

    def answer(questions: pd.DataFrame, facts: pd.DataFrame) -> pd.DataFrame:
        return _answers(questions, facts, shared.value[1])

    questions = facts.select("block").mapInPandas(
        _questions(shared),
        "asker long, side int, depth long, block long, row long, conv long, length long, inside boolean",
    )
    answers = questions.groupBy("block").cogroup(facts.groupBy("block")).applyInPandas(answer, ANSWERS)

    def nodes(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        found, chunks = block_nodes(
            frame["conv_id"].to_numpy(np.int64), frame["key"].tolist(), frame["words"].tolist(),
            shared.value[1][int(frame["block"].iloc[0])],
            answers[answers["side"] == 0], answers[answers["side"] == 1],
        )
        ids = pd.DataFrame(chunks, columns=["first", "depth", "place", "ids"])
        return pd.concat([found.assign(place=None, ids=None), ids])[_NODE_NAMES]

    made = stored(
        blocks.groupBy("block").cogroup(answers.groupBy("asker")).applyInPandas(nodes, NODES), "trie-nodes"
    )
    whole = made.where("ids IS NULL AND NOT open").select(*_COLUMNS)
    shares = made.where("ids IS NULL AND open").groupBy("first", "depth").agg(
        *[F.max(c).alias(c) for c in ("conv_id", "parent_conv_id", "n_convs")],
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
    )
    ends = _chunk_hashes(made.where("ids IS NOT NULL"))
    joined = shares.join(ends, ["first", "depth"], "left").select(*_COLUMNS)
    return whole.union(joined).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))


_NODE_NAMES = [column.split()[0] for column in NODES.split(", ")]
_COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
]


def conversation_trie(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", block_turns: int = 200_000,
) -> DataFrame:
    """The trie of the conversations of a table of turns.

    A null role or text is empty. Turns go by `turn_col`, null first, and those of
    one number by role, then text; a repeated row is a turn of its own. Rows
    without a conv_id belong to no conversation. Other columns are not looked at.
    saved_tokens counts words of the texts. See `prefix_nodes`.
    """
    return prefix_nodes(ordered_turns(turns, conv_col, turn_col, role_col, text_col), block_turns)


def rebuilt_trie(turns: DataFrame) -> DataFrame:
    """`conversation_trie` of the conversations after `rebuilt`."""
    ordered = stored(ordered_turns(turns, "conv_id", "turn", "role", "text"), "conversations")
    return prefix_nodes(rebuilt(ordered))
