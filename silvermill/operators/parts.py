"""Apply many ordered parts at once, with the result of applying them in turn.

Merging part after part into a table costs one join and one rewrite per part.
Here the parts are first reduced to what they leave behind together, and the
table is merged once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from silvermill.functions.checks import all_known
from silvermill.operators.upsert import matching_rows, newest_with_counts, updated_rows

_NO_PART = -1


class AmbiguousKeyError(ValueError):
    """Several rows of one part would update the same row of the table."""


def newest_of_parts(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    order_by: Sequence[str] = (),
    count_extra: bool = True,
) -> DataFrame:
    """The newest row per key, `_rows` read for it, and `_extra`: how many of
    these came from a part that already had the key. NULL is grouped as a key.

    One shuffle of partly aggregated rows answers both questions. The set
    inside is one number per part and key, never more than there are parts.
    Without `count_extra` there is no `_extra`, and no set.
    """
    rest = [c for c in df.columns if c not in keys]
    part = F.coalesce(F.col(seq), F.lit(_NO_PART))
    grouped = df.groupBy(*keys).agg(
        _newest(df, rest, [seq, *order_by]).alias("_row"),
        F.count(F.lit(1)).alias("_rows"),
        *([F.size(F.collect_set(part)).alias("_parts")] if count_extra else []),
    )
    return grouped.select(
        *keys,
        *[F.col("_row").getField(c).alias(c) for c in rest],
        "_rows",
        *([(F.col("_rows") - F.col("_parts")).alias("_extra")] if count_extra else []),
    )


def _newest(df: DataFrame, rest: Sequence[str], order_by: Sequence[str]) -> Column:
    """The greatest row by `order_by`. As the order comes first in the row, the row
    is its own order and is shuffled once; a type without an order needs it apart."""
    if set(order_by) <= set(df.columns) and all(_has_order(df.schema[c].dataType) for c in rest):
        order = [c for c in dict.fromkeys(order_by) if c in rest]
        return F.max(F.struct(*order, *[c for c in rest if c not in order]))
    return F.max_by(F.struct(*rest), F.struct(*order_by))


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType, T.UserDefinedType))


def part_counts(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Per key: its first part, its last part, and in how many of the later
    parts it occurs more than once."""
    part = F.coalesce(F.col(seq), F.lit(_NO_PART)).alias("_part")
    per_part = df.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("_n"))
    per_key = per_part.groupBy(*keys).agg(
        F.min("_part").alias("_first"),
        F.max("_part").alias("_last"),
        F.min_by("_n", "_part").alias("_n_first"),
        F.count_if(F.col("_n") > 1).alias("_repeats"),
    )
    late = F.col("_repeats") - F.when(F.col("_n_first") > 1, 1).otherwise(0)
    return per_key.select(
        *keys, "_first", "_last", (F.col("_repeats") > 0).alias("_repeated"),
        (late > 0).alias("_late_repeat"),
    )


def settle_parts(
    df: DataFrame, keys: Sequence[str], seq: str, null_safe: bool = False
) -> DataFrame:
    """What the parts leave behind for keys that the table does not have yet.

    The first part that has a key inserts all its rows, even several. Later
    parts update each of them, so they must have the key once.
    """
    known = df if null_safe else df.where(all_known(keys))
    first = part_counts(known, keys, seq).select(*keys, "_first")
    part = F.coalesce(F.col(seq), F.lit(_NO_PART))
    marked = updated_rows(
        known.withColumn("_first", F.lit(None).cast("bigint")), first, keys, null_safe
    )
    firsts = marked.where(part == F.col("_first")).drop("_first")
    later = marked.where(part > F.col("_first")).drop("_first")
    newest = newest_with_counts(later, keys, [seq], known_only=not null_safe)
    return updated_rows(firsts, newest.drop("_rows"), keys, null_safe)


def repeated_keys(
    df: DataFrame, keys: Sequence[str], seq: str, null_safe: bool = False
) -> DataFrame:
    """Keys that occur several times in one part, with the first part they are in."""
    counts = part_counts(df if null_safe else df.where(all_known(keys)), keys, seq)
    return counts.where("_repeated").select(*keys, "_first", "_late_repeat")


def check_parts(
    repeated: DataFrame,
    keys: Sequence[str],
    target: DataFrame | None,
    null_safe: bool = False,
) -> None:
    """Fail when a repeated key would update rows: of an earlier part, or of the
    target. As new rows, they may repeat."""
    report(repeated.where("_late_repeat"), keys)
    if target is not None:
        report(matching_rows(target.select(*keys), repeated, keys, null_safe), keys)


def without_replayed(
    target: DataFrame,
    repeated: DataFrame,
    keys: Sequence[str],
    batch: Column,
    null_safe: bool = False,
) -> DataFrame:
    """The target less the rows that an earlier try of the same batch inserted
    for repeated keys. `batch` says of a target row that this batch wrote it."""
    marked = updated_rows(
        target.withColumn("_first", F.lit(None).cast("bigint")),
        repeated.select(*keys, "_first"), keys, null_safe,
    )
    replayed = F.col("_first").isNotNull() & F.coalesce(batch, F.lit(False))
    return marked.where(~replayed).drop("_first")


def without_stale(
    rows: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    seq: str,
    null_safe: bool = False,
) -> DataFrame:
    """`rows` less those that are older than every target row of their key. A
    row or a target row without a part is never taken for older or newer."""
    oldest = target.groupBy(*keys).agg(
        F.min(F.coalesce(F.col(seq), F.lit(_NO_PART))).alias("_oldest")
    )
    marked = updated_rows(
        rows.withColumn("_oldest", F.lit(None).cast("bigint")), oldest, keys, null_safe
    )
    stale = F.coalesce(F.col(seq) < F.col("_oldest"), F.lit(False))
    return marked.where(~stale).drop("_oldest")


def report(offending: DataFrame, keys: Sequence[str]) -> None:
    sample = offending.select(*keys).limit(5).collect()
    if sample:
        shown = ", ".join(str(tuple(row)) for row in sample)
        raise AmbiguousKeyError(
            f"several rows of one part match the same row by {list(keys)}, such as {shown}"
        )
