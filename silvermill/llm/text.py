"""What the operators share: words, hashes of words, and null-safe columns.

A word is a run of bytes other than space and 0x09 to 0x0D. Only A to Z are
lower-cased, so results do not depend on a locale or a Unicode version.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str | Column) -> Column:
    """The text, empty where it is null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def ascii_lower(column: Column) -> Column:
    return F.translate(column, UPPER, UPPER.lower())


def free_names(frame: DataFrame, *wanted: str) -> list[str]:
    """Names for an operator's own columns that no column of the frame has."""
    taken = {name.lower() for name in frame.columns}
    found = []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def hash128(column: Column) -> Column:
    """Two hashes of 64 bits; one alone would collide among 10^11 values."""
    return F.struct(F.xxhash64(column).alias("a"), F.xxhash64(F.lit(1), column).alias("b"))


def raw_texts(texts: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text of an Arrow array without nulls, not copied."""
    wide = pa.types.is_large_string(texts.type)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32) if len(texts) else np.zeros(1, int)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    for i in range(texts.offset, texts.offset + len(texts)):
        yield bytes_[offsets[i] : offsets[i + 1]]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit."""
    values = values + _STEP
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def _multipliers(count: int) -> np.ndarray:
    return mix(np.arange(count, dtype=np.uint64)) | np.uint64(1)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SOLID = np.ones(256, bool)
_SOLID[[32, 9, 10, 11, 12, 13]] = False
_FACTORS = _multipliers(4096)


def word_hashes(text: str | None, solid_bytes: np.ndarray = _SOLID) -> np.ndarray:
    """The words' 64-bit hashes in their order, as uint64.

    A word's hash is the sum of its bytes, each times a factor of its place.
    `solid_bytes` says of each byte whether it belongs to a word.
    """
    raw = _LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
    solid = solid_bytes[raw]
    at = np.flatnonzero(solid)
    if not len(at):
        return np.zeros(0, np.uint64)
    edges = np.concatenate([[0], np.flatnonzero(solid[1:] != solid[:-1]) + 1, [len(raw)]])
    edges = edges[0 if solid[0] else 1 :]
    length = edges[1::2] - edges[: len(edges) // 2 * 2 : 2]
    first = np.cumsum(length) - length
    place = np.arange(len(at)) - np.repeat(first, length)
    longest = int(length.max())
    factors = _FACTORS if longest <= len(_FACTORS) else _multipliers(longest)
    total = np.add.reduceat((raw[at].astype(np.uint64) + np.uint64(1)) * factors[place], first)
    return mix(total ^ length.astype(np.uint64))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of `size` words; one of the whole if it is shorter."""
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total += words[k : k + count] * _FACTORS[k]
    return mix(total)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    hashes = np.sort(hashes)
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])] if len(hashes) else hashes
