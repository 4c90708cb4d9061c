"""SentencePiece ids of whole texts, by a table of distinct marked words, and back.

In a normalized text every blank is the marker U+2581, and one stands in front. If no
piece of a model has a marker after another character, no merge crosses from a
word to the next marker, so a text's ids are those of its marked words, one after
the other. Each distinct marked word is segmented by the library once and its
ids are put wherever the word stands.

Documents are cut into batches of some million characters. A batch is its distinct
words, in the order of a hash, and each place's number in that list. The
distinct words of all batches meet by ranges of the hash, where the library segments
each once; the ids return to the batches, which lay them out by place. Words and
places go to different tasks, so batches are made twice, which is cheaper than
writing them down; a sum over the words tells whether both made the same ones.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from silvermill.llm.text import whole_text

MARK = "▁"
_MARKED = re.compile(f"{MARK}+[^{MARK}]*")


def load_model(content: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=content)


def check_model(model: sentencepiece.SentencePieceProcessor) -> None:
    """Refuses models whose texts are not the sum of their marked words."""
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            if MARK in model.id_to_piece(i).lstrip(MARK):
                raise ValueError(f"piece {i} has a marker after another character")
    if model.normalize(" a  b\tﬁＡ ") != f"{MARK}{MARK}a{MARK}{MARK}b\tﬁＡ{MARK}":
        raise ValueError("the model must mark blanks, put a marker in front, and change nothing else")


def marked_words(normalized: str) -> list[str]:
    """The words without their first marker: a run of markers belongs to what follows."""
    words = normalized.split(MARK)[1:]
    if "" in words[:-1]:
        words = [word[1:] for word in _MARKED.findall(normalized)]
    return words


def word_ids(model: sentencepiece.SentencePieceProcessor, words: list[str]) -> list[list[int]]:
    """The ids of marked words; the library itself puts the first marker in front."""
    lone = [model.piece_to_id(MARK)]
    return [ids or lone for ids in model.encode(words, num_threads=1)]


# Packed arrays

def _pack(values: np.ndarray) -> bytes:
    """Little-endian numbers by their bytes' significance, which compresses better."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_words(words: list[str]) -> tuple[bytes, bytes]:
    raw = [word.encode() for word in words]
    return _pack(np.array([len(x) for x in raw], np.uint32)), zstandard.compress(b"".join(raw))


def _unpack_words(sizes: bytes, data: bytes) -> np.ndarray:
    raw, ends = zstandard.decompress(data), np.cumsum(_unpack(sizes), dtype=np.int64)
    starts = np.append(0, ends)[: len(ends)]
    return np.array([raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())], object)


def _spread(words: np.ndarray) -> np.ndarray:
    return pd.util.hash_array(words, categorize=False) if len(words) else np.zeros(0, np.uint64)


# Encoding

def _batches(docs: DataFrame, content, batch_chars: int, told, schema: str) -> DataFrame:
    """What `told` says of each batch: its number, sum, ids, codes and words, both by the hash's order."""

    def finish(number: int, ids: list, codes: list[np.ndarray], seen: dict[str, int]) -> pd.DataFrame:
        words = np.array(list(seen), object)
        spread = _spread(words)
        order = np.argsort(spread, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        total = zlib.crc32(spread[order].tobytes(), len(seen))
        return told(number, total, ids, [place[x] for x in codes], words[order], spread[order])

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model(content.value)
        number = TaskContext.get().partitionId() << 32
        ids, codes, seen, held = [], [], {}, 0
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                words = marked_words(model.normalize(text))
                ids.append(None if pd.isna(doc_id) else doc_id)
                # a dict, as pandas takes U+0000 for a string's end
                mine = (seen.setdefault(word, len(seen)) for word in words)
                codes.append(np.fromiter(mine, np.uint32, len(words)))
                held += len(text)
                if held >= batch_chars or len(ids) >= 100_000:
                    yield finish(number, ids, codes, seen)
                    ids, codes, seen, held, number = [], [], {}, 0, number + 1
        if ids:
            yield finish(number, ids, codes, seen)

    return docs.mapInPandas(cut, schema)


def _places(docs: DataFrame, content, batch_chars: int) -> DataFrame:
    """(batch, sum, ids, counts, codes): each batch's documents and the numbers of their words."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def told(number, total, ids, codes, words, spread) -> pd.DataFrame:
        counts = [len(x) for x in codes]
        row = {"batch": number, "sum": total, "ids": ids, "counts": counts, "codes": _pack(np.concatenate(codes))}
        return pd.DataFrame({name: [value] for name, value in row.items()})

    schema = f"batch long, sum long, ids array<{kind}>, counts array<long>, codes binary"
    return _batches(docs, content, batch_chars, told, schema)


def _dealt_words(docs: DataFrame, content, batch_chars: int, buckets: int) -> DataFrame:
    """(bucket, batch, sum, sizes, words): the batches' lists, cut at ranges of the hash.

    A batch without words has an empty part, so that it too meets its sum.
    """

    def told(number, total, ids, codes, words, spread) -> pd.DataFrame:
        bucket = ((spread >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        used, first = np.unique(bucket, return_index=True) if len(words) else (np.zeros(1, int), [0])
        parts = [_pack_words(words[a:b].tolist()) for a, b in zip(first, [*first[1:], len(words)])]
        return pd.DataFrame({
            "bucket": used.astype(np.int64), "batch": number, "sum": total,
            "sizes": [p[0] for p in parts], "words": [p[1] for p in parts],
        })

    schema = "bucket long, batch long, sum long, sizes binary, words binary"
    return _batches(docs, content, batch_chars, told, schema)


def _segmented(frame: pd.DataFrame, content) -> pd.DataFrame:
    """The ids of a bucket's words for each batch; each distinct word is segmented once."""
    model = load_model(content.value)
    place: dict[str, int] = {}
    codes = []
    for packed in zip(frame["sizes"], frame["words"]):
        words = _unpack_words(*packed)
        codes.append(np.fromiter((place.setdefault(word, len(place)) for word in words), np.int64, len(words)))
    lengths, pieces = [], []
    distinct = list(place)
    for at in range(0, len(distinct), 100_000):
        found = word_ids(model, distinct[at : at + 100_000])
        lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
        pieces.append(np.fromiter(chain.from_iterable(found), np.uint32, lengths[-1].sum()))
    length = np.concatenate([*lengths, np.zeros(0, np.int64)])
    pieces = np.concatenate([*pieces, np.zeros(0, np.uint32)])
    out = []
    for some in codes:
        size = length[some]
        out.append((_pack(size.astype(np.uint32)), _pack(pieces[_runs(length, some)])))
    return pd.DataFrame({
        "batch": frame["batch"], "bucket": frame["bucket"], "sum": frame["sum"],
        "lengths": [x[0] for x in out], "pieces": [x[1] for x in out],
    })


def _runs(length: np.ndarray, some: np.ndarray) -> np.ndarray:
    """The indexes of the runs `some`, one after the other, of runs that lie end to end."""
    size = length[some]
    before = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat((np.cumsum(length) - length)[some] - before, size)


def _laid_out(batch: pd.DataFrame, parts: pd.DataFrame, end: list[int]) -> tuple[list, list[np.ndarray]]:
    """The ids of a batch's documents, from its places and its words' ids."""
    if not len(batch) or (parts["sum"] != batch["sum"].iloc[0]).any():
        raise RuntimeError("the documents came in another order the second time: write them to a table first")
    row = batch.iloc[0]
    parts = parts.sort_values("bucket")
    empty = [np.zeros(0, np.uint32)]
    length = np.concatenate([_unpack(x) for x in parts["lengths"]] + empty).astype(np.int64)
    pieces = np.concatenate([_unpack(x) for x in parts["pieces"]] + empty).astype(np.int32)
    codes = _unpack(row["codes"])
    upto = np.append(0, np.cumsum(length[codes]))
    ids = pieces[_runs(length, codes)]
    ends = upto[np.append(0, np.cumsum(np.asarray(row["counts"], np.int64)))]
    tail = np.array(end, np.int32)
    return list(row["ids"]), [np.concatenate([ids[a:b], tail]) for a, b in zip(ends, ends[1:])]


def encode_pieces(
    docs: DataFrame, model: str, add_end: bool = True, id_col: str = "doc_id", text_col: str = "text",
    decode: bool = False, batch_chars: int = 8_000_000, bucket_bytes: int = 32_000_000,
) -> DataFrame:
    """(doc_id, ids) of every row: the library's encode(text), and the end id if asked for.

    With `decode`, also `decoded`, the library's decode(ids). `model` is a file of the
    driver, some hundred kilobytes, which is broadcast;
    it must be one whose pieces do not cross markers (`check_model`). A null text
    is empty and has no ids but the end id. Rows with one id, or a null id, are
    each encoded. Other columns are not looked at.

    `docs` is read twice and must come in the same order each time, as a table
    does; if it does not, the job fails. A batch holds whole documents, so one
    very long text is a batch by itself; it must fit a task, as it must to be one
    row. A bucket holds about `bucket_bytes` of the batches' distinct words.
    """
    with open(model, "rb") as file:
        proto = file.read()
    check_model(load_model(proto))
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(proto)
    end = [load_model(proto).eos_id()] if add_end else []
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # distinct words are about a seventh of a batch of prose; no more than the text at worst
    size = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 7
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // bucket_bytes))
    segmented = _dealt_words(rows, content, batch_chars, buckets).groupBy("bucket").applyInPandas(
        lambda frame: _segmented(frame, content),
        "batch long, bucket long, sum long, lengths binary, pieces binary",
    )

    def lay_out(batch: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        doc_ids, found = _laid_out(batch, parts, end)
        frame = pd.DataFrame({"doc_id": doc_ids, "ids": found}, dtype=object)
        if decode:
            model = load_model(content.value)
            frame["decoded"] = pd.Series([model.decode(ids.tolist()) for ids in found], dtype=object)
        return frame

    schema = f"doc_id {kind}, ids array<int>" + ", decoded string" * decode
    return _places(rows, content, batch_chars).groupBy("batch").cogroup(
        segmented.groupBy("batch")
    ).applyInPandas(lay_out, schema)


def decode_pieces(encoded: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The rows with the library's decode(ids) in `text_col`; null ids give a null text."""
    with open(model, "rb") as file:
        content = encoded.sparkSession.sparkContext.broadcast(file.read())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != text_col)

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model(content.value)
        for frame in frames:
            texts = [None if ids is None else model.decode(ids.tolist()) for ids in frame[ids_col]]
            yield frame.assign(**{text_col: pd.Series(texts, index=frame.index, dtype=object)})

    return encoded.drop(text_col).mapInPandas(decode, f"{schema}, `{text_col}` string")
