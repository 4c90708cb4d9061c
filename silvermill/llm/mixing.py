"""Sources mixed to target weights, in a curriculum that changes over time.

Each source has a schedule: its weight at evenly spaced moments of the training,
linear in between. The schedule's integral sets the source's share of all
words; shares over `max_repeat` times a source's size are cut to that, and the
excess goes to the other sources by weight. A document's place in its source's
cumulative demand, put through the inverse of the integrated schedule, is its
training position in [0, 1].

A source may hold any share of the rows: running sums are taken in two levels,
over 16^`bucket_digits` buckets of a hash within each source, then within a
bucket. The table of sources has one row per source and is ranked in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from silvermill.llm.text import WORD, whole_text

Schedules = Sequence[Sequence[float]]

#: Falling, even and rising, with integrals 1, 2 and 3.
CURRICULUM: Schedules = ((1.5, 0.5), (2.0, 2.0), (2.0, 4.0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def schedule_integral(knots: Sequence[float]) -> float:
    steps = len(knots) - 1
    return sum((a + b) / 2 for a, b in zip(knots, knots[1:])) / steps


def _check(schedules: Schedules) -> None:
    for knots in schedules:
        if len(knots) < 2 or min(knots) < 0 or schedule_integral(knots) <= 0:
            raise ValueError("a schedule needs two weights or more, none negative, not all zero")


def source_targets(
    sizes: DataFrame, schedules: Schedules = CURRICULUM, max_repeat: int = 3
) -> DataFrame:
    """From (source, source_size): rank, weight, cap and target of each source.

    Sources rank by code point, null last; schedules repeat along the ranks. A
    source is capped if its cap is below its share of what the sources with a
    smaller ratio of cap to weight leave over.
    """
    _check(schedules)
    weights = F.array(*[F.lit(float(schedule_integral(k))) for k in schedules])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumns({
        "weight": F.get(weights, F.col("rank") % len(schedules)),
        "cap": (F.col("source_size") * max_repeat).cast("double"),
        "total": F.sum("source_size").over(everything).cast("double"),
    })
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    flagged = ranked.withColumn(
        "capped", F.col("cap") * F.sum("weight").over(rest) < F.col("weight") * left
    )
    open_total = F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    unit = flagged.withColumn("unit", F.try_divide(open_total, open_weight))
    return unit.select(
        "source", "source_size", "rank", "weight",
        F.when(F.col("capped"), F.col("cap"))
        .otherwise(F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("unit"), F.lit(0.0))))
        .alias("target"),
    )


def _segments(schedules: Schedules) -> Column:
    """For each schedule its pieces: share done before it, start, weight, slope."""
    all_pieces = []
    for knots in schedules:
        steps, area, done, pieces = len(knots) - 1, schedule_integral(knots), 0.0, []
        for i, (a, b) in enumerate(zip(knots, knots[1:])):
            pieces.append(F.struct(
                F.lit(done).alias("done"), F.lit(i / steps).alias("start"),
                F.lit(a / area).alias("weight"), F.lit((b - a) * steps / area).alias("slope"),
            ))
            done += (a + b) / 2 / steps / area
        all_pieces.append(F.array(*pieces))
    return F.array(*all_pieces)


def training_position(share: Column, rank: Column, schedules: Schedules) -> Column:
    """The moment by which a source's demand reaches `share` of its total."""
    pieces = F.get(_segments(schedules), rank % len(schedules))
    piece = F.element_at(
        F.filter(pieces, lambda p: (p["done"] <= share) | (p["start"] == 0)), -1
    )
    due = share - piece["done"]
    root = F.sqrt(F.greatest(
        piece["weight"] * piece["weight"] + 2 * piece["slope"] * due, F.lit(0.0)
    ))
    step = F.coalesce(F.try_divide(2 * due, piece["weight"] + root), F.lit(0.0))
    return F.least(piece["start"] + step, F.lit(1.0))


def mix_sources(
    docs: DataFrame,
    schedules: Schedules = CURRICULUM,
    max_repeat: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    size_col: str | None = None,
    bucket_digits: int = 3,
    out: str = "mix",
) -> DataFrame:
    """Every row with a struct `out` that says what the mix takes of it.

    Fields: size, source_size, target (of its source), passes (whole copies),
    cut (words of one more, incomplete copy), taken (words in all, at most
    `max_repeat` times size), position (of the first copy, null if none).
    Documents are taken in the order of a hash of their id, so reruns agree, and
    a source's taken words differ from its target by less than one word.

    Null texts have size 0 and are never taken; a null source is a source of its
    own; rows with equal ids are separate rows, in the order of their sizes. A
    column named `out` is replaced; columns named with a leading `_mix_` are
    dropped. An empty table gives an empty table.
    """
    size = F.col(size_col).cast("long") if size_col else word_count(whole_text(text_col))
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    clash = [name for name in docs.columns if name == out or name.startswith("_mix_")]
    keep = [name for name in docs.columns if name not in clash]
    rows = docs.withColumns({
        "_mix_source": F.col(source_col), "_mix_id": F.col(id_col),
        "_mix_size": F.coalesce(size, F.lit(0)), "_mix_order": order,
        "_mix_bucket": F.substring(order, 1, bucket_digits),
    })
    buckets = (
        docs.select(
            F.col(source_col).alias("source"),
            F.substring(order, 1, bucket_digits).alias("bucket"),
            F.coalesce(size, F.lit(0)).alias("size"),
        )
        .groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    )
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = buckets.withColumn(
        "_mix_start", F.coalesce(F.sum("bucket_size").over(running), F.lit(0))
    )
    targets = source_targets(
        buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")),
        schedules, max_repeat,
    )
    plan = starts.join(
        targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))
    ).select(
        F.col("source").alias("_mix_s"), F.col("bucket").alias("_mix_b"), "_mix_start",
        F.struct("source_size", "target", "rank").alias("_mix_plan"),
    )
    placed = rows.join(
        plan,
        F.col("_mix_source").eqNullSafe(F.col("_mix_s"))
        & (F.col("_mix_bucket") == F.col("_mix_b")),
    )
    inside = Window.partitionBy("_mix_source", "_mix_bucket").orderBy(
        "_mix_order", "_mix_id", "_mix_size"
    ).rowsBetween(Window.unboundedPreceding, -1)
    own, total = F.col("_mix_plan.source_size"), F.col("_mix_plan.target")
    goal = F.floor(total)
    passes = F.coalesce(F.floor(F.try_divide(total, own)), F.lit(0))
    first = F.col("_mix_start") + F.coalesce(F.sum("_mix_size").over(inside), F.lit(0))
    cut = F.least(
        F.col("_mix_size"), F.greatest(F.lit(0), F.col("_mix_goal") - F.col("_mix_passes") * own - F.col("_mix_first"))
    )
    taken = F.col("_mix_passes") * F.col("_mix_size") + F.col("_mix_cut")
    middle = F.col("_mix_first") + F.when(
        F.col("_mix_passes") > 0, F.col("_mix_size")
    ).otherwise(F.col("_mix_cut")) / 2.0
    return (
        placed.withColumns({"_mix_goal": goal, "_mix_passes": passes, "_mix_first": first})
        .withColumn("_mix_cut", cut)
        .withColumn("_mix_taken", taken)
        .withColumn(out, F.struct(
            F.col("_mix_size").alias("size"), own.alias("source_size"), total.alias("target"),
            F.col("_mix_passes").alias("passes"), F.col("_mix_cut").alias("cut"),
            F.col("_mix_taken").alias("taken"),
            F.col("_mix_first").alias("start"), F.col("_mix_plan.rank").alias("rank"),
            F.when(F.col("_mix_taken") > 0, training_position(
                F.try_divide(middle, F.col("_mix_goal")), F.col("_mix_plan.rank"), schedules
            )).alias("position"),
        ))
        .select(*[F.col(f"`{name}`") for name in keep], out)
    )


def training_order(
    mixed: DataFrame, schedules: Schedules = CURRICULUM, out: str = "mix",
    cut_copies: bool = True, partitions: int | None = None,
) -> DataFrame:
    """The copies that training reads, range-sorted by position.

    From `mix_sources`: each whole copy, and the incomplete one (`cut_copies`),
    as a row whose `out` says copy (from 0), words and position. Without
    `cut_copies`, an incomplete copy counts as whole from half its size on and
    as none below. Rows without words have no copies, in any source.
    """
    m = {name: F.col(f"{out}.{name}") for name in (
        "passes", "cut", "size", "start", "source_size", "target", "rank"
    )}
    extra = F.when(
        m["cut"] > 0 if cut_copies else (m["cut"] * 2 >= m["size"]) & (m["cut"] > 0), 1
    ).otherwise(0)
    copies = F.when(
        (m["passes"] + extra > 0) & (m["size"] > 0), F.sequence(F.lit(0).cast("long"), m["passes"] + extra - 1)
    )
    rows = mixed.withColumn("_mix_copy", F.explode(copies))
    copy = F.col("_mix_copy")
    words = F.when(copy < m["passes"], m["size"]).otherwise(
        m["cut"] if cut_copies else m["size"]
    )
    share = F.try_divide(
        copy * m["source_size"] + m["start"] + words / 2.0, F.floor(m["target"])
    )
    position = training_position(F.least(share, F.lit(1.0)), m["rank"], schedules)
    ordered = rows.withColumn(
        out, F.struct(copy.alias("copy"), words.alias("words"), position.alias("position"))
    ).drop("_mix_copy")
    key = F.col(f"{out}.position")
    dealt = ordered.repartitionByRange(partitions, key) if partitions else ordered.repartitionByRange(key)
    return dealt.sortWithinPartitions(key)
