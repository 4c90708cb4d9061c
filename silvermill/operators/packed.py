"""The newest row of each key, with rows shuffled as compressed columns.

Spark's aggregate sorts all rows of a task before it shuffles them one by one, each
number in eight bytes: what a task cannot hold is spilled, here and where the rows
meet. Here a task reduces its rows in portions of bounded size, and what is left of a
portion goes to buckets as blocks, small Parquet files of neighbouring rows. So a key
that holds a third of all rows does not fill one task. A bucket is a task: it reads the
keys of its blocks, then block after block, and holds only rows whose key comes again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F, types as T

from silvermill.functions.checks import all_known
from silvermill.operators.upsert import has_one_form
from silvermill.sources.filesystem import total_bytes

_BUCKET = "_bucket"
_ROWS = "_rows"
_PORTION_BYTES = 64 << 20
_BUCKET_BYTES = 16 << 20
_MAX_BATCH = 10_000


def can_pack(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> bool:
    """Whether all values are of types that Arrow keeps and orders as Spark does."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return (
        len(kinds) == len(df.columns)
        and {*keys, *order_by} <= set(kinds)
        and not {_BUCKET, _ROWS} & set(kinds)
        and all(has_one_form(kinds[key]) for key in keys)
        and all(has_one_form(k) or isinstance(k, (T.FloatType, T.DoubleType)) for k in kinds.values())
    )


def bucket_count(df: DataFrame, slices: int) -> int | None:
    """Buckets for what the files under `df` hold, so that each lies in one slice, or
    holds whole ones. None without files, when nothing tells the size beforehand."""
    spark = df.sparkSession
    files = df.inputFiles()
    if not files:
        return None
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = max(
        -(-total_bytes(spark, files) // _BUCKET_BYTES),
        min(usual, spark.sparkContext.defaultParallelism),
    )
    if least >= slices:
        return -(-least // slices) * slices
    return next(n for n in range(least, slices + 1) if slices % n == 0)


def newest_packed(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    deal_by: Sequence[str],
    buckets: int,
    portion_bytes: int = _PORTION_BYTES,
) -> DataFrame:
    """As `newest_of_parts` without `_extra`, where `can_pack` says so.

    `deal_by`, some of the keys, decides the bucket, so that rows alike in them
    share blocks. Rows with a NULL key are dealt by all keys.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in dict.fromkeys(order_by) if c in rest]
    names = [*keys, *order, *[c for c in rest if c not in order]]
    by, all_keys = ([F.col(f"`{c}`") for c in some] for some in (deal_by, keys))
    dealt = F.when(all_known(keys), F.xxhash64(*by)).otherwise(F.xxhash64(*all_keys))
    # columns are named by their place: pyspark and Parquet take a dot for a field
    rows = df.select(
        *[F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(names)],
        F.lit(1).cast("bigint").alias(str(len(names))),
        F.pmod(dealt, F.lit(buckets)).cast("int").alias(_BUCKET),
    )
    blocks = rows.mapInArrow(_packer(len(keys), portion_bytes), f"{_BUCKET} int, block binary")
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in names]).add(_ROWS, "long")
    newest = blocks.repartitionById(buckets, _BUCKET).mapInArrow(_settler(len(keys), schema.names), schema)
    return newest.select(*[F.col(f"`{c}`") for c in [*keys, *rest]], _ROWS)


def _packer(n_keys: int, portion_bytes: int) -> Callable:
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # no name here holds a portion while the next one is gathered
        return map(partial(_packed, n_keys=n_keys), _portions(batches, portion_bytes))

    return pack


def _packed(rows: pa.Table, n_keys: int) -> pa.RecordBatch:
    """A block per bucket of the newest rows of a portion."""
    bucket = rows.column(_BUCKET).to_numpy()
    rows = rows.drop_columns([_BUCKET])
    places, read = _newest(rows, n_keys)
    by_bucket = np.argsort(bucket[places], kind="stable")
    places, read = places[by_bucket], read[by_bucket]
    kept = _counted(rows.take(pa.array(places)), read)
    starts = np.flatnonzero(np.diff(bucket[places], prepend=-1))
    blocks = [
        _block(kept.slice(start, end - start))
        for start, end in zip(starts, [*starts[1:], len(places)], strict=True)
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[places][starts], pa.int32()), pa.array(blocks, pa.binary())],
        [_BUCKET, "block"],
    )


def _settler(n_keys: int, names: Sequence[str]) -> Callable:
    def settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [block for batch in batches for block in batch.column("block")]
        if not blocks:
            return
        some = [str(i) for i in range(n_keys)]
        again = _repeated(_codes(pa.concat_tables([_opened(b, some) for b in blocks]), n_keys))
        held, start = [], 0
        for block in blocks:
            rows = _opened(block)
            here = again[start:start + rows.num_rows]
            start += rows.num_rows
            if here.any():
                held.append(rows.filter(pa.array(here)))
                rows = rows.filter(pa.array(~here))
            yield from rows.rename_columns(names).to_batches(_MAX_BATCH)
        if held:
            rows = _joined(held)
            places, read = _newest(rows, n_keys)
            rows = _counted(rows.take(pa.array(places)), read)
            yield from rows.rename_columns(names).to_batches(_MAX_BATCH)

    return settle


def _portions(batches: Iterable[pa.RecordBatch], most_bytes: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
        if size >= most_bytes:
            size = 0
            yield _joined(held)
    if held:
        yield _joined(held)


def _joined(held: list[pa.Table]) -> pa.Table:
    """One table of all that is held, which is let go."""
    whole = pa.concat_tables(held).combine_chunks()
    held.clear()
    return whole


def _counted(rows: pa.Table, read: np.ndarray) -> pa.Table:
    last = rows.num_columns - 1
    return rows.set_column(last, rows.column_names[last], pa.array(read, pa.int64()))


def _block(rows: pa.Table) -> bytes:
    """Neighbours share beginnings and are near in number, so columns hold differences."""
    coded = {
        f.name: "DELTA_BYTE_ARRAY" if pa.types.is_string(f.type) or pa.types.is_binary(f.type)
        else "DELTA_BINARY_PACKED"
        for f in rows.schema
        if not (pa.types.is_boolean(f.type) or pa.types.is_floating(f.type) or pa.types.is_decimal(f.type))
    }
    sink = pa.BufferOutputStream()
    pq.write_table(
        rows, sink, compression="zstd", use_dictionary=False, column_encoding=coded,
        write_statistics=False, store_schema=False,
    )
    return sink.getvalue().to_pybytes()


def _opened(block: pa.BinaryScalar, columns: Sequence[str] | None = None) -> pa.Table:
    return pq.read_table(pa.BufferReader(block.as_buffer()), columns=columns, use_threads=False)


def _codes(rows: pa.Table, n_keys: int) -> np.ndarray:
    """A number per row, from 0 on without gaps, the same for equal keys; NULL is a value."""
    codes = np.zeros(rows.num_rows, np.int64)
    for column in rows.columns[:n_keys]:
        found = pc.dictionary_encode(column.combine_chunks(), null_encoding="encode")
        here = found.indices.to_numpy().astype(np.int64)
        codes = np.unique(codes * (here.max(initial=0) + 1) + here, return_inverse=True)[1]
    return codes


def _repeated(codes: np.ndarray) -> np.ndarray:
    return np.bincount(codes)[codes] > 1


def _newest(rows: pa.Table, n_keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the newest row of each key, ascending, and the rows read for each. The
    last column has the rows read for a row, those after the keys its order."""
    codes = _codes(rows, n_keys)
    again = _repeated(codes)
    read = rows.column(rows.num_columns - 1).to_numpy().copy()
    if not again.any():
        return np.arange(rows.num_rows), read
    several = np.flatnonzero(again)
    several = several[_ascending(rows.take(pa.array(several)), codes[several], n_keys)]
    ends = np.flatnonzero(np.append(np.diff(codes[several]), 1))
    newest = several[ends]
    read[newest] = np.add.reduceat(read[several], np.append(0, ends[:-1] + 1))
    places = np.sort(np.append(np.flatnonzero(~again), newest))
    return places, read[places]


def _ascending(rows: pa.Table, codes: np.ndarray, n_keys: int) -> np.ndarray:
    """The order of rows by key, and as Spark orders structs: NULL first, NaN last."""
    by = {"code": pa.array(codes)}
    for i, column in enumerate(rows.columns[n_keys:-1]):
        if pa.types.is_floating(column.type):
            odd = pc.is_nan(column)
            by[f"{i} nan"] = odd.cast(pa.int8())
            column = pc.if_else(odd, pa.scalar(0, column.type), column)
        elif pa.types.is_boolean(column.type):
            column = column.cast(pa.int8())
        by[str(i)] = column
    keys = [(name, "ascending") for name in by]
    return pc.sort_indices(pa.table(by), sort_keys=keys, null_placement="at_start").to_numpy()
