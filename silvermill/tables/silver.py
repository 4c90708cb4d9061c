"""A mutable table in plain Parquet.

Rows lie in folders by a hash of the key. An upsert rewrites only the folders
that hold a row to update, and adds files to those that only gain rows. Rows with a NULL key can never be updated, so
they lie in folders of their own, one per batch, and are never rewritten.

Three columns of the files are not part of the table: the folder name, which also
records the number of folders, `_seq`, the bronze part a row came from, and
`_batch`, the named batch that last wrote it.

A merge writes its new folders to `.incoming` inside the table, which readers
skip. Only when they are complete do they replace the old ones, so a driver that
dies at any point loses nothing: the next write throws an incomplete `.incoming`
away and finishes a complete one. An overwrite of a table that is there goes
through `.replacing` in the same way, and then all old folders go.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from silvermill.functions.checks import all_known, any_unknown
from silvermill.operators.packed import bucket_count, can_pack, newest_packed
from silvermill.operators.parts import newest_of_parts, without_replayed
from silvermill.operators.upsert import (
    conform,
    further_copies,
    has_one_form,
    key_filter,
    matching_rows,
    rows_without,
    updated_rows,
    without_placeholders,
)
from silvermill.sources.bronze import SEQ
from silvermill.sources.filesystem import (
    any_match,
    delete_folder,
    file_names,
    mark,
    move_file,
    move_folder,
    subfolders,
)
from silvermill.sources.listing import list_objects, read_if_exists
from silvermill.tables.staging import BATCH, StagedBatch, stage, with_origin
from silvermill.tables.zorder import share_bounds, z_value

_SLICE_PREFIX = "slice_of_"
_UNKNOWN = "unknown-"
SLICE = "_slice"


def _slice_folders(spark: SparkSession, path: str) -> list[str]:
    return [name for name in subfolders(spark, path) if name.startswith(_SLICE_PREFIX)]


class SilverTable:
    """A table at `path` whose rows are matched by `keys`.

    `slices` is the number of folders of a table that does not exist yet; an
    existing table keeps its own. Aim at slices of some gigabytes. One writer
    at a time, and no reader while it swaps folders: `read()` refuses a table
    that is being swapped, or whose writer died then, until the next write or
    `recover()` finishes the swap.

    `key_blooms` writes a Bloom filter of each key to each row group, of a size
    that fits its values. A merge looks for its keys with a filter on the target's
    scan (`key_filter`); the blooms let it leave out row groups of a touched slice
    that hold none of a small batch's keys. Files without them stay readable.

    `cluster_by` sorts the rows of each file in Z-order of these columns, by
    `cluster_bits` bits of each one's place among the rows written, so that a filter
    on any of them leaves out row groups. It holds for the files that this table
    object writes; others stay as they are. The places are found by one more pass
    over these columns alone. `write_options` go to the Parquet writer.

    A swap deletes and moves up to `swap_threads` folders or files at a time.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        slice_by: Sequence[str] = (),
        slices: int = 16,
        null_safe_keys: bool = False,
        key_blooms: bool = False,
        cluster_by: Sequence[str] = (),
        cluster_bits: int = 6,
        write_options: Mapping[str, str] | None = None,
        swap_threads: int = 32,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = tuple(keys)
        self.slice_by = tuple(slice_by) or self.keys
        self.new_slices = slices
        self.null_safe_keys = null_safe_keys
        self.key_blooms = key_blooms
        self.cluster_by = tuple(cluster_by)
        self.cluster_bits = cluster_bits
        self.write_options = dict(write_options or {})
        self.swap_threads = swap_threads

    def exists(self) -> bool:
        return self._stored() is not None

    def read(self) -> DataFrame:
        stored = self._readable()
        return stored.drop(self._slice_column(stored), SEQ, BATCH)

    def read_with_slices(self) -> DataFrame:
        """The table and a column `_slice`, the folder a row lies in; a filter on it
        leaves out whole folders."""
        stored = self._readable()
        column = self._slice_column(stored)
        return stored.drop(SEQ, BATCH).withColumnRenamed(column, SLICE)

    def slice_states(self) -> dict[str, str]:
        """Per slice, a digest of its files' names and sizes, which no two writes share.
        Files are listed, not opened."""
        files = list_objects(self.spark, self.path, "*.parquet").select(
            F.regexp_extract("path", f"/{_SLICE_PREFIX}[0-9]+=([^/]+)/[^/]+$", 1).alias("slice"),
            F.concat_ws(" ", F.element_at(F.split("path", "/"), -1), "length").alias("file"),
        )
        per_slice = files.where("slice <> ''").groupBy("slice").agg(
            F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("file"))), 256).alias("state")
        )
        return {row["slice"]: row["state"] for row in per_slice.collect()}

    def recover(self) -> None:
        """Finish what a writer that died has begun. Every write does this first."""
        delete_folder(self.spark, self._gaining)
        for incoming in (self._incoming, self._replacing):
            if self._complete(incoming):
                self._swap(incoming)
            else:
                delete_folder(self.spark, incoming)

    def overwrite(self, df: DataFrame, seq: str | None = None) -> None:
        """Replace the whole table, or leave it as it was. `df` must not read from it."""
        self.recover()
        self._replace_all(with_origin(df, seq), self.new_slices)

    def append(self, df: DataFrame, seq: str | None = None) -> None:
        """Add rows without matching keys; loading a part twice doubles it."""
        self.recover()
        stored = self._stored()
        rows = with_origin(df, seq)
        if stored is not None:
            rows = conform(rows, stored.drop(self._slice_column(stored)))
        self._write(rows, self._slices(stored), "append")

    def apply(
        self,
        source: DataFrame,
        seq: str | None = None,
        on_duplicate: str = "error",
        order_by: Sequence[str] = (),
        bootstrap: str = "if_missing",
        sentinels: dict[str, object] | None = None,
        newer_only: bool = False,
        rewrite: str = "matched",
        batch: str | None = None,
    ) -> int:
        """Upsert all parts in `source` at once and return the rows read.

        `seq` orders the parts; the result is that of applying them in turn.
        `bootstrap="always"` replaces the table instead of merging into it.
        `sentinels` makes a placeholder row go once its parent has real rows.
        `newer_only` leaves rows alone that a later part has already written.
        `rewrite="matched"` rewrites the slices that hold a row to update and adds
        files to those that only gain rows; `"touched"` rewrites both, which also
        merges their small files.
        `batch` names the batch: applying it again then replaces what it wrote,
        also its rows with a NULL key and new rows that share one.
        """
        if bootstrap not in ("if_missing", "always"):
            raise ValueError(f"bootstrap must be if_missing or always, not {bootstrap!r}")
        if rewrite not in ("matched", "touched"):
            raise ValueError(f"rewrite must be matched or touched, not {rewrite!r}")
        self.recover()
        stored = self._stored() if bootstrap == "if_missing" else None
        self._check_layout(stored)
        slices = self._slices(stored)
        target = None
        source = with_origin(source, seq, batch)
        if stored is not None:
            target = stored.drop(self._slice_column(stored))
            source = conform(source, target)
        if (
            on_duplicate == "latest" and order_by
            and not (sentinels or newer_only or self.cluster_by)
            and all(has_one_form(source.schema[key].dataType) for key in self.keys)
        ):
            return self._apply_newest(source, stored, slices, order_by, rewrite, batch)
        staged = stage(
            source, self.keys, SEQ, on_duplicate, order_by, self.null_safe_keys,
            target, self._slice_name(slices),
            None if batch is None else F.col(BATCH) == batch, newer_only,
        )
        try:
            if target is None:
                rows = staged.everything()
                if sentinels:
                    rows = self._without_placeholders(rows, sentinels)
                self._replace_all(rows, slices, batch, staged.everything())
            else:
                self._merge(stored, staged, slices, sentinels, newer_only, rewrite, batch)
        finally:
            staged.release()
        return staged.rows_in

    def _apply_newest(
        self,
        source: DataFrame,
        stored: DataFrame | None,
        slices: int,
        order_by: Sequence[str],
        rewrite: str,
        batch: str | None,
    ) -> int:
        """Upsert the newest row of each key and return the rows read.

        An updated row is the batch's own row. So the batch is reduced, written once
        by the tasks that reduce it, in the folders of its slices, and these files are
        moved into the table; of the table only rows that stay are written again.
        """
        column = f"{_SLICE_PREFIX}{slices}"
        incoming = self._replacing if stored is None and self.exists() else self._incoming
        known = F.lit(True) if self.null_safe_keys else all_known(self.keys)
        rows = source.drop(BATCH)  # what all rows of the batch share is not shuffled
        buckets = bucket_count(rows, slices) if can_pack(rows, self.keys, order_by) else None
        if buckets:
            newest = newest_packed(rows, self.keys, [SEQ, *order_by], self.slice_by, buckets)
        else:
            newest = newest_of_parts(rows, self.keys, SEQ, order_by, count_extra=False)
        newest = newest.withColumn(BATCH, F.lit(batch).cast("string"))
        newest = newest.withColumn(column, self._slice_name(slices))
        seen = Observation()
        counted = newest.observe(
            seen, F.sum("_rows").alias("rows"), F.count_if(~known).alias("unknown")
        )
        newest = counted.where(known).select(*source.columns, column)
        self._add_files(newest, column, incoming)
        facts = seen.get
        touched = [
            name.removeprefix(f"{column}=") for name in _slice_folders(self.spark, incoming)
        ]
        rewritten = touched
        if stored is not None and touched:
            updates = self.spark.read.schema(newest.schema).parquet(incoming)
            rewritten = self._keep_others(stored, updates, touched, column, rewrite)
        if facts["unknown"]:
            rows = source.where(any_unknown(self.keys))
            rows = rows.withColumn(column, self._slice_name(slices, batch))
            self._add_files(rows.hint("rebalance", F.col(column)), column, incoming)
        gaining = [f"{column}={name}" for name in touched if name not in rewritten]
        for name in gaining:
            move_folder(self.spark, f"{incoming}/{name}", f"{self._gaining}/{name}")
        if rewritten or facts["unknown"]:
            mark(self.spark, f"{incoming}/_SUCCESS")
            self._swap(incoming)
        else:
            delete_folder(self.spark, incoming)
        self._move_files(self._gaining, gaining)
        delete_folder(self.spark, self._gaining)
        self.spark.catalog.refreshByPath(self.path)
        return facts["rows"] or 0

    def _keep_others(
        self, stored: DataFrame, updates: DataFrame, touched: list[str], column: str, rewrite: str
    ) -> list[str]:
        """Write the rows that stay of the slices to rewrite beside the batch's, and the
        further copies of rows that the table has several times. Returns these slices."""
        keys, null_safe = self.keys, self.null_safe_keys
        target = stored.where(F.col(column).isin(touched))
        among = target
        if (wanted := key_filter(updates, keys, null_safe)) is not None:
            among = target.where(wanted)
        matched = matching_rows(among.select(*keys, column), updates, keys, null_safe)
        counts = matched.groupBy(*keys, column).count()
        most = dict(counts.groupBy(column).agg(F.max("count")).collect())
        rewritten = touched if rewrite == "touched" else list(most)
        if rewritten:
            here = F.col(column).isin(rewritten)
            kept = rows_without(target.where(here), updates.where(here).select(*keys), keys, null_safe)
            self._add_files(kept.select(*updates.columns), column, self._incoming)
        if any(n > 1 for n in most.values()):
            copies = further_copies(updates, counts.drop(column), keys, null_safe)
            self._add_files(copies, column, self._incoming)
        return rewritten

    def _add_files(self, rows: DataFrame, column: str, folder: str) -> None:
        """Add rows to a folder that is not complete before it is marked so."""
        (rows.write.mode("append")
         .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
         .options(**self._file_options())
         .partitionBy(column)
         .parquet(folder))

    def _merge(
        self,
        stored: DataFrame,
        staged: StagedBatch,
        slices: int,
        sentinels: dict[str, object] | None,
        newer_only: bool,
        rewrite: str,
        batch: str | None,
    ) -> None:
        keys, null_safe = self.keys, self.null_safe_keys
        column = self._slice_column(stored)
        target = stored.where(F.col(column).isin(staged.touched))
        replayed = batch is not None and staged.repeated is not None
        if replayed:
            ours = F.col(BATCH) == batch
            target = without_replayed(target, staged.repeated, keys, ours, null_safe)
        among = target
        if (wanted := key_filter(staged.updates, keys, null_safe)) is not None:
            among = target.where(wanted)
        matched = matching_rows(among.select(*keys, column), staged.updates, keys, null_safe)
        matched = staged.keep(matched.distinct(), "matched")

        rewritten = staged.touched
        if rewrite == "matched" and not sentinels and not replayed:
            rewritten = [row[0] for row in matched.select(column).distinct().collect()]
        here = self._slice_name(slices).isin(rewritten)
        accept = None
        if newer_only:
            new_seq, old_seq = F.col("_new").getField(SEQ), F.col(SEQ)
            accept = new_seq.isNull() | old_seq.isNull() | (new_seq >= old_seq)
        old = target.where(F.col(column).isin(rewritten)).drop(column)
        rows = updated_rows(
            old, staged.updates.where(here), keys, null_safe, accept,
        ).unionByName(rows_without(staged.inserts.where(here), matched, keys, null_safe))
        if sentinels:
            # a merge keeps all keys, so those that it joins have the parents it leaves
            both = old.select(*keys).unionByName(staged.inserts.where(here).select(*keys))
            rows = self._without_placeholders(rows, sentinels, both)
        if staged.unknown is not None:
            rows = rows.unionByName(staged.unknown)
        if rewritten or staged.unknown is not None:
            self._replace_folders(rows, slices, batch, self._columns_seen(target, staged))
        if set(staged.touched) - set(rewritten):
            self._write(staged.inserts.where(~here), slices, "append")

    def _without_placeholders(
        self, rows: DataFrame, sentinels: dict[str, object], keyed: DataFrame | None = None
    ) -> DataFrame:
        """`rows` hold all rows of their parents, those of the table included,
        so the result does not depend on which batch a real row came with. `keyed`
        has the same keys and is less costly to make."""
        parents = [k for k in self.keys if k not in sentinels]
        if not parents or set(self.slice_by) - set(parents):
            raise ValueError("to replace sentinel rows, slice the table by its parent key")
        placeholder = F.lit(True)
        for name, value in sentinels.items():
            placeholder = placeholder & F.col(name).eqNullSafe(F.lit(value))
        real = (rows if keyed is None else keyed).where(~placeholder)
        return without_placeholders(rows, real, parents, placeholder)

    def _readable(self) -> DataFrame:
        if self._swapping():
            raise RuntimeError(f"{self.path} is half swapped: see recover()")
        stored = self._stored()
        if stored is None:
            raise FileNotFoundError(f"no silver table at {self.path}")
        return stored

    def _stored(self) -> DataFrame | None:
        stored = read_if_exists(self.spark, self.path)
        if stored is not None and BATCH not in stored.columns:
            stored = stored.withColumn(BATCH, F.lit(None).cast("string"))
        return stored

    def _slice_column(self, stored: DataFrame) -> str:
        for name in stored.columns:
            if name.startswith(_SLICE_PREFIX):
                return name
        raise ValueError(f"{self.path} was not written as a silver table")

    def _slices(self, stored: DataFrame | None) -> int:
        if stored is None:
            return self.new_slices
        return int(self._slice_column(stored).removeprefix(_SLICE_PREFIX))

    def _check_layout(self, stored: DataFrame | None) -> None:
        if stored is not None and self.null_safe_keys:
            column = self._slice_column(stored)
            if not stored.where(F.col(column).startswith(_UNKNOWN)).isEmpty():
                raise ValueError(
                    f"{self.path} holds rows written with null_safe_keys=False"
                )

    def _slice_name(self, slices: int, batch: str | None = None) -> Column:
        key = F.concat(
            F.lit("key-"), F.pmod(F.xxhash64(*self.slice_by), F.lit(slices)).cast("string")
        )
        if not self.null_safe_keys:
            unknown = F.lit(_UNKNOWN + (batch or uuid.uuid4().hex))
            key = F.when(all_known(self.keys), key).otherwise(unknown)
        return key

    def _columns_seen(self, target: DataFrame, staged: StagedBatch) -> DataFrame | None:
        """The columns to cluster by, as they lie in files, without the merge's joins."""
        if not self.cluster_by:
            return None
        return target.select(*self.cluster_by).unionByName(staged.everything().select(*self.cluster_by))

    @property
    def _incoming(self) -> str:
        return f"{self.path}/.incoming"

    @property
    def _replacing(self) -> str:
        return f"{self.path}/.replacing"

    @property
    def _gaining(self) -> str:
        return f"{self.path}/.gaining"

    def _complete(self, incoming: str) -> bool:
        return any_match(self.spark, f"{incoming}/_SUCCESS")

    def _swapping(self) -> bool:
        return self._complete(self._incoming) or self._complete(self._replacing)

    def _replace_folders(
        self, rows: DataFrame, slices: int, batch: str | None, seen: DataFrame | None = None
    ) -> None:
        """Replace the folders that `rows` fall into, and no others."""
        self._write_and_swap(rows, slices, batch, self._incoming, seen)

    def _replace_all(
        self, rows: DataFrame, slices: int, batch: str | None = None, seen: DataFrame | None = None
    ) -> None:
        """A table that is not there yet is written in place: there is nothing to lose."""
        if self.exists():
            self._write_and_swap(rows, slices, batch, self._replacing, seen)
        else:
            self._write(rows, slices, "overwrite", batch, seen=seen)

    def _write_and_swap(
        self, rows: DataFrame, slices: int, batch: str | None, incoming: str, seen: DataFrame | None
    ) -> None:
        self._write(rows, slices, "overwrite", batch, incoming, seen)
        if not self._complete(incoming):
            mark(self.spark, f"{incoming}/_SUCCESS")
        self._swap(incoming)
        self.spark.catalog.refreshByPath(self.path)

    def _swap(self, incoming: str) -> None:
        """First all old folders go, then the new files come. Each step can be
        repeated, and the new files exist all the time. A copy that a store made
        before it died counts as the move, as its file is then complete."""
        cleared = f"{incoming}/_CLEARED"
        folders = _slice_folders(self.spark, incoming)
        if not any_match(self.spark, cleared):
            old = _slice_folders(self.spark, self.path) if incoming == self._replacing else folders
            self._side_by_side(lambda name: delete_folder(self.spark, f"{self.path}/{name}"), old)
            mark(self.spark, cleared)
        self._move_files(incoming, folders)
        # _SUCCESS goes last but one, so that a swap stopped here is finished, not
        # thrown away, and what is thrown away holds no file.
        self._side_by_side(lambda name: delete_folder(self.spark, f"{incoming}/{name}"), folders)
        delete_folder(self.spark, f"{incoming}/_SUCCESS")
        delete_folder(self.spark, incoming)

    def _move_files(self, incoming: str, folders: Iterable[str]) -> None:
        self._side_by_side(
            lambda file: move_file(self.spark, f"{incoming}/{file}", f"{self.path}/{file}"),
            [f"{name}/{file}" for name in folders
             for file in file_names(self.spark, f"{incoming}/{name}")],
        )

    def _side_by_side(self, step: Callable[[str], None], paths: Iterable[str]) -> None:
        """The store does the work; the driver's threads only wait. The first failure ends it."""
        with ThreadPoolExecutor(self.swap_threads) as pool:
            running = [pool.submit(step, path) for path in paths]
            try:
                for each in running:
                    each.result()
            except BaseException:
                pool.shutdown(cancel_futures=True)
                raise

    def _write(
        self,
        rows: DataFrame,
        slices: int,
        mode: str,
        batch: str | None = None,
        path: str | None = None,
        seen: DataFrame | None = None,
    ) -> None:
        """Rebalanced by slice: small slices share a task, and adaptive
        execution splits a slice that is too large for one. `seen` gives the bounds
        to cluster by where `rows` are costly to make."""
        column = f"{_SLICE_PREFIX}{slices}"
        dealt = rows.withColumn(column, self._slice_name(slices, batch)).hint("rebalance", F.col(column))
        if self.cluster_by:
            bounds = share_bounds(rows if seen is None else seen, self.cluster_by, self.cluster_bits)
            z = "_z" + "_" * max(map(len, dealt.columns))  # no column of the table
            dealt = (
                dealt.withColumn(z, z_value(rows.schema, bounds, self.cluster_bits))
                .sortWithinPartitions(column, z).drop(z)
            )
        (dealt.write.mode(mode)
         .option("partitionOverwriteMode", "static")
         .options(**self._file_options())
         .partitionBy(column)
         .parquet(path or self.path))

    def _file_options(self) -> dict[str, str]:
        options = {"compression": "zstd"}
        if self.key_blooms:
            options |= {f"parquet.bloom.filter.enabled#{key}": "true" for key in self.keys}
            options["parquet.bloom.filter.adaptive.enabled"] = "true"
        return options | self.write_options
