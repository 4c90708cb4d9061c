"""Documents as token pieces, packed into sequences by vector best fit.

A sequence has three capacities: tokens, documents, and attention cost (the sum
of squared piece lengths). Pieces are placed in the order of falling length;
among the open sequences that can take a piece under every capacity, one is
chosen by the weighted norm of what would be left (`residual_norm`) or by the
weighted dot product of piece and room (`dot_product`).

A piece that fills a sequence is one. The others are dealt at random into groups
of about `group_pieces`, packed independently: a group is small enough for one
task and large enough that its own last, partly filled sequences do not count.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from silvermill.llm.text import free_names, whole_text

PIECES = "piece int, start long, length long, ids_crc32 long"


def byte_ranks(content: dict) -> dict[bytes, int]:
    """The byte-level vocabulary of a tokenizer's JSON, ids as merge ranks."""
    byte_of, spare = {}, 256
    for value in range(256):
        plain = 33 <= value <= 126 or 161 <= value <= 172 or 174 <= value <= 255
        byte_of[chr(value if plain else spare)] = value
        spare += not plain
    special = {token["content"] for token in content["added_tokens"]}
    return {
        bytes(byte_of[c] for c in token): number
        for token, number in content["model"]["vocab"].items() if token not in special
    }


class LibraryEncoder:
    """The ids that `tokenizers` gives by encode(text, add_special_tokens=False).

    tiktoken, with the merges as ranks, gives the same ids several times as fast,
    but for texts that hold an added token, which it takes for ordinary text, and
    for those on which its pattern fails (some 1,000,000 blanks in a row). These
    go to the library itself.
    """

    def __init__(self, content: str, pattern: str):
        parsed = json.loads(content)
        self.content, self.library = content, None
        self.added = [token["content"] for token in parsed["added_tokens"]]
        self.fast = tiktoken.Encoding(
            "bytes", pat_str=pattern, mergeable_ranks=byte_ranks(parsed), special_tokens={}
        )

    def __call__(self, text: str) -> np.ndarray:
        if not any(token in text for token in self.added):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")
            except ValueError:  # the pattern ran out of stack
                pass
        if self.library is None:
            self.library = Tokenizer.from_str(self.content)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


def cut_pieces(length: int, capacity: int) -> np.ndarray:
    """Starts of the pieces of `length` tokens: all but the first are full."""
    first = (length - 1) % capacity + 1
    return np.concatenate([[0], np.arange(first, length, capacity)]).astype(np.int64)


def token_pieces(
    docs: DataFrame, vocabulary: str, pattern: str, capacity: int = 1024, end_id: int = 2,
    id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Each document's ids and `end_id`, cut into pieces of at most `capacity`.

    Columns: doc_id, piece, start, length, ids_crc32 (of the ids as
    little-endian 32-bit numbers), and ids if they are kept. Only documents that
    are too long are cut, and only their first piece may be shorter than
    `capacity`. A null or empty text is the piece [end_id]. Repeated rows give
    their pieces again.

    The ids are those of the `tokenizers` library for the JSON file
    `vocabulary` (see `LibraryEncoder`); a special token in a text is its one id.
    The vocabulary, some 50,000 entries, is read by the driver and broadcast.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, {PIECES}"
    schema += ", ids array<int>" * keep_ids

    with open(vocabulary, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = LibraryEncoder(content.value, pattern)
        end = np.array([end_id], "<u4")
        for frame in frames:
            out = []
            for number, text in zip(frame["doc_id"], frame["text"]):
                ids = np.concatenate([encode(text), end])
                starts = cut_pieces(len(ids), capacity)
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    row = (number, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    out.append((*row, ids[a:b].astype(np.int32)) if keep_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
            yield pd.DataFrame(out, columns=names)

    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInPandas(cut, schema)


def best_fit(
    needs: np.ndarray, capacities: np.ndarray, weights: np.ndarray, rule: str = "residual_norm"
) -> np.ndarray:
    """The bin of each row of `needs`, bins numbered from 0; rows in placing order.

    Ties go to the bin opened first. Every need must fit an empty bin.
    """
    if (needs > capacities).any():
        raise ValueError("a piece is over a capacity")
    scaled = needs / capacities
    room = np.empty((64, needs.shape[1]))
    names = np.empty(64, np.int64)
    least = np.minimum.accumulate(needs[::-1], axis=0)[::-1]  # of this row and all later ones
    bins, open_, made = np.empty(len(needs), np.int64), 0, 0
    slack = 1e-12
    for i in range(len(needs)):
        left = room[:open_] - scaled[i]
        fits = np.flatnonzero((left >= -slack).all(axis=1))
        if len(fits):
            if rule == "residual_norm":
                score = (left[fits] ** 2) @ weights
            else:
                score = -(room[fits] * scaled[i]) @ weights
            at = fits[np.argmin(score)]
            room[at] = left[at]
        else:
            if open_ == len(room):
                room = np.concatenate([room, np.empty_like(room)])
                names = np.concatenate([names, np.empty_like(names)])
            at, open_ = open_, open_ + 1
            room[at], names[at] = 1 - scaled[i], made
            made += 1
        bins[i] = names[at]
        if i + 1 < len(needs) and ((room[at] * capacities + 1e-9) < least[i + 1]).any():
            room[at : open_ - 1] = room[at + 1 : open_]  # nothing to come fits: closed
            names[at : open_ - 1] = names[at + 1 : open_]
            open_ -= 1
    return bins


def pack_pieces(
    pieces: DataFrame,
    capacity: int = 1024,
    max_documents: int | None = None,
    max_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1),
    rule: str = "residual_norm",
    group_pieces: int = 20_000,
    length_col: str = "length",
) -> DataFrame:
    """The rows with sequence_id and offset: pieces of a sequence lie end to end.

    `max_documents` and `max_attention` bound a sequence's pieces and the sum of
    their squared lengths; None leaves them free. Columns of the added names are
    replaced. Lengths must be 1 to `capacity`; a null length is refused by the
    task that meets it. Sequences of different groups have different ids; ids
    have gaps. Rows that are equal are separate pieces. Groups depend on the rows'
    content and number only, so a rerun packs alike.
    """
    if rule not in ("residual_norm", "dot_product"):
        raise ValueError(f"unknown rule {rule!r}")
    documents = max_documents or capacity
    attention = max_attention or capacity * capacity
    kept = [name for name in pieces.columns if name not in ("sequence_id", "offset")]
    rows = pieces.select(*[F.col(f"`{name}`") for name in kept])
    full = F.coalesce(F.col(length_col) == capacity, F.lit(False))
    if attention < capacity * capacity:
        full = F.lit(False)
    groups = max(1, -(-rows.where(~full).count() // group_pieces))
    salt = F.xxhash64(*[F.col(f"`{name}`") for name in kept])
    own_salt, own_group = free_names(rows, "salt", "group")
    dealt = rows.withColumns({own_salt: salt, own_group: F.pmod(salt, F.lit(groups))})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    limits = np.array([capacity, documents, attention], float)

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        group = frame[own_group].iloc[0]
        frame = frame.sort_values([length_col, own_salt], ascending=[False, True], kind="stable")
        length = frame[length_col].to_numpy(float)
        if not ((length >= 1) & (length <= capacity)).all():
            raise ValueError("a piece's length must be 1 to the capacity")
        needs = np.stack([length, np.ones(len(frame)), length * length], axis=1)
        bins = best_fit(needs, limits, np.asarray(weights, float), rule)
        before = frame.groupby(bins)[length_col].cumsum() - frame[length_col]
        return frame[kept].assign(
            sequence_id=group * np.int64(1 << 32) + bins, offset=before.astype("int64")
        )

    short = dealt.where(~full).groupBy(own_group).applyInPandas(
        pack, f"{schema}, sequence_id long, offset long"
    )
    alone = rows.where(full).withColumns({
        "sequence_id": F.lit(-1) - F.monotonically_increasing_id(),
        "offset": F.lit(0).cast("long"),
    })
    return short.unionByName(alone)
