"""Upsert by key: update every matched row, insert every unmatched one.

Keys compare with `=`, so a row with a NULL key never matches: it stays in the
target and is inserted from the source. When several target rows share a key,
each of them is updated. Several source rows for one target row are ambiguous.

A full outer join would say this in one step, but Spark cannot split a skewed
key in a full outer join. Each join below keeps its possibly skewed side on the
left of a left outer, left semi or left anti join, where it can.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from silvermill.functions.checks import all_known, any_unknown

_SPREAD = "_spread"
_NEW = "_new"


def _with_spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a hash of the keys, to be used as one more join key.

    An aggregate or a join leaves its rows partitioned by the keys. A join on
    exactly those keys would reuse that, and adaptive execution splits a skewed
    partition only where the join has an exchange of its own.
    """
    return df.withColumn(_SPREAD, F.xxhash64(*keys))


def _right_side(df: DataFrame, keys: Sequence[str], *others: Column) -> DataFrame:
    """The keys under other names, so that both sides can come from one table."""
    renamed = [F.col(f"`{k}`").alias(f"_r_{k}") for k in keys]
    return df.select(*renamed, F.xxhash64(*keys).alias(f"_r_{_SPREAD}"), *others)


def _match(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool
) -> Column:
    condition = left[_SPREAD] == right[f"_r_{_SPREAD}"]
    for key in keys:
        a, b = left[key], right[f"_r_{key}"]
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return condition


def updated_rows(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    accept: Column | None = None,
) -> DataFrame:
    """`target` with the values of `updates`, which has one row per key.

    `accept` may use the columns of `target` and the struct `_new`; where it is
    not true the target row stays as it was.
    """
    values = [c for c in updates.columns if c not in keys]
    if not values:
        return target
    left = _with_spread(target, keys)
    right = _right_side(updates, keys, F.struct(*values).alias(_NEW))
    joined = left.join(right, _match(left, right, keys, null_safe), "left")
    take = F.col(_NEW).isNotNull()
    if accept is not None:
        take = take & F.coalesce(accept, F.lit(False))
    return joined.select(*[
        F.when(take, F.col(_NEW).getField(c)).otherwise(F.col(c)).alias(c)
        if c in values
        else F.col(c)
        for c in target.columns
    ])


def matching_rows(
    df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows of `df` whose key is also in `other`."""
    left, right = _with_spread(df, keys), _right_side(other, keys)
    return left.join(right, _match(left, right, keys, null_safe), "left_semi").drop(_SPREAD)


#: Types whose least and greatest values Parquet keeps for a row group and Spark compares.
_ORDERED = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, T.TimestampType,
    T.TimestampNTZType,
)


def key_filter(
    batch: DataFrame, keys: Sequence[str], null_safe: bool = False, most_values: int = 1000
) -> Column | None:
    """What the keys of a batch have in common, as a filter that reaches a Parquet scan.

    Each key is within the batch's least and greatest value, and, where the batch
    has at most `most_values` different ones, among these; with Bloom filters in the
    files, a scan then leaves out row groups that hold none. The batch's own
    values decide, so no row that a key matches is lost. At most `most_values` of a
    key come to the driver. None, if no key can be filtered by.
    """
    some = [k for k in keys if isinstance(batch.schema[k].dataType, _ORDERED)]
    if not some:
        return None
    first = batch.select(*some)
    facts = first.agg(
        *[f(F.col(f"`{k}`")).alias(f"{f.__name__}{i}") for i, k in enumerate(some) for f in (F.min, F.max)],
        *[F.count_if(F.col(f"`{k}`").isNull()).alias(f"null{i}") for i, k in enumerate(some)],
        *[F.approx_count_distinct(F.col(f"`{k}`")).alias(f"about{i}") for i, k in enumerate(some)],
    ).first()
    found = None
    for i, key in enumerate(some):
        column, low, high = F.col(f"`{key}`"), facts[f"min{i}"], facts[f"max{i}"]
        if low is None:  # only nulls, or no rows
            fits = F.lit(False)
        else:
            fits = column.between(low, high)
            if facts[f"about{i}"] <= 2 * most_values:  # far more are not told apart
                values = [row[0] for row in first.select(key).where(column.isNotNull()).distinct().limit(most_values + 1).collect()]
                if len(values) <= most_values:
                    fits = column.isin(values)
        if null_safe and facts[f"null{i}"]:
            fits = fits | column.isNull()
        found = fits if found is None else found & fits
    return found


def unmatched_rows(
    target: DataFrame, inserts: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows of `inserts` whose key is not in `target`.

    Only the keys of `target` are read, and only those that occur in `inserts`
    go on. When `inserts` is small enough for Spark to broadcast, `target` is
    not shuffled.
    """
    seen = matching_rows(target.select(*keys), inserts, keys, null_safe).distinct()
    return rows_without(inserts, seen, keys, null_safe)


def rows_without(
    df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows of `df` whose key is not in `other`, where no key repeats."""
    left, right = _with_spread(df, keys), _right_side(other, keys)
    return left.join(right, _match(left, right, keys, null_safe), "left_anti").drop(_SPREAD)


def without_placeholders(
    rows: DataFrame, real: DataFrame, parents: Sequence[str], placeholder: Column
) -> DataFrame:
    """`rows` less the placeholder rows of those parents that `real` has."""
    left = _with_spread(rows.where(placeholder), parents)
    right = _right_side(real.select(*parents).distinct(), parents)
    condition = _match(left, right, parents, null_safe=False)
    kept = left.join(right, condition, "left_anti").drop(_SPREAD)
    return rows.where(~placeholder).unionByName(kept)


def further_copies(
    rows: DataFrame, counts: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Each of `rows`, whose keys do not repeat, once less than its key's `count`."""
    left = _with_spread(rows, keys)
    right = _right_side(counts.where("count > 1"), keys, (F.col("count") - 1).alias("_more"))
    joined = left.join(right, _match(left, right, keys, null_safe), "inner").select(*rows.columns, "_more")
    tens = joined.select("*", F.explode(F.sequence(F.lit(0), F.expr("(_more - 1) div 10000"))).alias("_from"))
    return tens.select(
        *rows.columns,
        F.explode(F.sequence(F.lit(1), F.least(F.lit(10000), F.expr("_more - 10000 * _from")))).alias("_copy"),
    ).drop("_copy")


def has_one_form(kind: T.DataType) -> bool:
    """Whether equal values of a type are the same value, unlike 0.0 and -0.0."""
    return isinstance(kind, (*_ORDERED, T.BooleanType, T.DecimalType, T.BinaryType)) and (
        not isinstance(kind, T.StringType) or kind.simpleString() == "string"
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """The greatest row per key by `order_by`; rows with a NULL key all stay.

    An aggregate, not a window: rows of one key meet partly aggregated, so a
    key that holds a third of all rows does not fill one task. Rows with a NULL
    key are read apart, by a filter that reaches the scan.
    """
    return (
        newest_with_counts(df, keys, order_by)
        .drop("_rows")
        .select(*df.columns)
        .unionByName(df.where(any_unknown(keys)))
    )


def newest_with_counts(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], known_only: bool = True
) -> DataFrame:
    """As above, for known keys only, with the number of rows each key had."""
    rest = [c for c in df.columns if c not in keys]
    rows = df.where(all_known(keys)) if known_only else df
    order = F.struct(*order_by) if order_by else F.lit(1)
    grouped = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max_by(F.struct(*rest), order).alias("_row"),
    )
    return grouped.select(
        *keys, *[F.col("_row").getField(c).alias(c) for c in rest], "_rows"
    )


def conform(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns in the order and with the types of the target."""
    if set(source.columns) != set(target.columns):
        odd = sorted(set(source.columns) ^ set(target.columns))
        raise ValueError(f"source and target differ in columns {odd}")
    return source.select(*[
        F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
        if source.schema[f.name].dataType != f.dataType
        else F.col(f"`{f.name}`")
        for f in target.schema.fields
    ])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    null_safe: bool = False,
) -> DataFrame:
    """The target after the upsert, as one lazy plan.

    `on_duplicate="error"` fails when several source rows match one target row;
    several source rows that match nothing are all inserted. `"latest"` keeps,
    per key, the source row that is greatest by `order_by`.
    """
    if on_duplicate not in ("error", "latest"):
        raise ValueError(f"on_duplicate must be error or latest, not {on_duplicate!r}")
    if on_duplicate == "latest" and not order_by:
        raise ValueError("on_duplicate='latest' needs order_by")
    keys = list(keys)
    source = conform(source, target)
    newest = newest_with_counts(source, keys, order_by, known_only=not null_safe)
    if on_duplicate == "latest":
        updates, accept = newest.drop("_rows"), None
        inserts = updates if null_safe else latest_per_key(source, keys, order_by)
    else:
        updates, inserts = newest, source
        accept = F.when(
            F.col(_NEW).getField("_rows") > 1,
            F.raise_error(F.lit("several source rows match one target row")),
        ).otherwise(F.lit(True))
    changed = updated_rows(target, updates, keys, null_safe, accept)
    return changed.unionByName(unmatched_rows(target, inserts, keys, null_safe))
