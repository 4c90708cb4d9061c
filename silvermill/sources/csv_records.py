"""CSV records of large files, read by many tasks, also where values hold line breaks.

A line break ends a record only outside of quotes, and whether a byte range of a file
starts inside of quotes depends on all the bytes before. So the ranges are read
twice. The first time each range tells, without knowing how it starts, whether its
number of quotes is odd, and whether a record would start in it if it started
inside. From the bits of the ranges before, a window over each file's ranges then
says how each one starts. The second time, each range gives out the records that
lie in it whole. A record that crosses a range's edge is put together from its parts.

Quotes follow RFC 4180: a value with a quote in it is quoted, and the quote
doubled. Records end with \\n, or with \\r\\n in files whose first line does; there
\\r\\n is read as \\n in values too, as Spark reads such a file whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from silvermill.scratch import stored

RANGE = ("file", "range")
_PARTS = pa.schema([
    ("file", pa.string()), ("range", pa.int64()), ("head", pa.bool_()), ("first", pa.bool_()), ("text", pa.string()),
])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in their order within a range; a line belongs to the range it starts in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range")
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array, np.ndarray]]:
    """A batch's lines by range, with the number of quotes in each line."""
    if not len(batch):
        return
    start, file = batch["range"].to_numpy(), batch["file"].dictionary_encode().indices.to_numpy()
    quotes = pc.count_substring(batch["value"], '"').to_numpy()
    edges = np.flatnonzero((start[1:] != start[:-1]) | (file[1:] != file[:-1])) + 1
    for a, b in zip([0, *edges], [*edges, len(batch)]):
        yield (batch["file"][int(a)].as_py(), int(start[a])), batch["value"].slice(a, b - a), quotes[a:b]


def _range_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range: whether its quotes are odd, whether, started inside of
    quotes, a record would start in it, and whether its first line ends with \\r."""
    here, odd, reopens, returns = None, False, False, False

    def told():
        values = [[here[0]], [here[1]], [odd], [reopens], [returns]]
        return pa.record_batch(values, ["file", "range", "odd", "reopens", "returns"])

    for batch in batches:
        for name, lines, quotes in _runs(batch):
            if name != here:
                if here is not None:
                    yield told()
                here, odd, reopens = name, False, False
                returns = lines[0].as_py().endswith("\r")
            before = (np.cumsum(quotes) - quotes + odd) % 2 == 1  # outside, if the range began inside
            reopens = reopens or bool(before.any())
            odd = bool((quotes.sum() + odd) % 2)
    if here is not None:
        yield told()


def range_starts(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, inside, owner, returns) of each byte range: whether it starts
    inside of quotes, the range in which the record that goes on there started, and
    whether the first line ends with \\r."""
    bits = _lines(spark, path).mapInArrow(
        _range_bits, "file string, range long, odd boolean, reopens boolean, returns boolean"
    )
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("odd").cast("int")).over(earlier), F.lit(0)) % 2 == 1
    states = bits.withColumn("inside", inside)
    starts = F.when(~F.col("inside") | F.col("reopens"), F.col("range"))
    return states.withColumn("starts", starts).select(
        *RANGE, "inside", F.last("starts", ignorenulls=True).over(earlier).alias("owner"), "returns"
    )


class _Range:
    """The records of one range, as its lines pass by."""

    def __init__(self, name: tuple[str, int], inside: bool):
        self.name, self.inside = name, inside
        self.open: list[str] = []  # lines of the record that has not ended yet
        self.head = inside  # whether that is the one that came in
        self.first = name[1] == 0

    def _row(self, text: str, head: bool, whole: bool) -> tuple:
        first, self.first = self.first and not head, False
        return (None if whole else self.name[0], None if whole else self.name[1], head, first, text)

    def take(self, lines: pa.Array, quotes: np.ndarray) -> pa.RecordBatch:
        after = (np.cumsum(quotes) + self.inside) % 2 == 1
        ends = np.flatnonzero(~after)
        begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        rows = []
        single = np.zeros(0, np.int64)
        if len(ends):
            if self.open or self.head or self.first:
                a, b = begins[0], ends[0]
                text = "\n".join([*self.open, *lines.slice(a, b - a + 1).to_pylist()])
                rows.append(self._row(text, self.head, not self.head))
                self.open, self.head, begins, ends = [], False, begins[1:], ends[1:]
            alone = begins == ends
            single = ends[alone]
            for a, b in zip(begins[~alone], ends[~alone]):
                rows.append(self._row("\n".join(lines.slice(a, b - a + 1).to_pylist()), False, True))
        last = np.flatnonzero(~after)
        self.open += lines.slice(last[-1] + 1 if len(last) else 0).to_pylist()
        self.inside = bool(after[-1])
        return _batch(rows, lines.take(pa.array(single)))

    def end(self) -> pa.RecordBatch:
        """What is left open goes on in the next range."""
        return _batch([self._row("\n".join(self.open), self.head, False)] if self.open else [])


def _batch(rows: list[tuple], whole: pa.Array | None = None) -> pa.RecordBatch:
    columns = [list(x) for x in zip(*rows)] or [[] for _ in _PARTS]
    odd = pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _PARTS)], schema=_PARTS)
    if whole is None or not len(whole):
        return odd
    n, no = len(whole), pa.array([False]).take(pa.array(np.zeros(len(whole), np.int64)))
    plain = pa.record_batch(
        [pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), no, no, whole.cast(pa.string())], schema=_PARTS
    )
    return pa.Table.from_batches([odd, plain]).combine_chunks().to_batches()[0]


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(first, record) of every record under `path`; `first` is the first of its file.

    A file of any size is read by as many tasks as it has byte ranges, whatever its
    values hold. Empty lines are no records. One record must fit a task. The
    ranges that start inside of quotes, and the files whose lines end with \\r\\n, go
    to all tasks by name.
    """
    ranges = stored(range_starts(spark, path), "csv-ranges")
    told = ranges.where("inside OR (returns AND range = 0)").collect()
    inside = {(row["file"], row["range"]) for row in told if row["inside"]}
    returns = {row["file"] for row in told if row["returns"] and row["range"] == 0}
    shared = spark.sparkContext.broadcast((inside, returns))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, returns = shared.value
        here = None
        for batch in batches:
            for name, lines, quotes in _runs(batch):
                if here is None or here.name != name:
                    if here is not None:
                        yield here.end()
                    here = _Range(name, name in inside)
                if name[0] in returns:
                    lines = pc.replace_substring_regex(lines, "\r$", "")
                yield here.take(lines, quotes)
        if here is not None:
            yield here.end()

    parts = _lines(spark, path).mapInArrow(
        cut, "file string, range long, head boolean, first boolean, text string"
    )
    if inside:
        parts = stored(parts, "csv-records")
        crossing = parts.where("file IS NOT NULL").join(ranges.select(*RANGE, "owner"), [*RANGE])
        owner = F.when(F.col("head"), F.col("owner")).otherwise(F.col("range"))
        place = F.struct("range", ~F.col("head"), "text")
        joined = crossing.groupBy("file", owner.alias("owner")).agg(
            F.max("first").alias("first"), F.sort_array(F.collect_list(place)).alias("parts")
        ).select("first", F.array_join("parts.text", "\n").alias("record"))
        found = parts.where("file IS NULL").select("first", F.col("text").alias("record")).union(joined)
    else:  # a last record whose quote is never closed is all that can be left open
        found = parts.select("first", F.col("text").alias("record"))
    return found.where(F.col("record") != "")
