"""Each row beside the next one in a global order, without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec


def ring_buckets(rows: DataFrame, id_col: str, buckets: int) -> tuple[DataFrame, WindowSpec]:
    """Rows dealt into ranges of ids, and the window that orders each range.

    Order: descending id, nulls last, ties by a hash of the row's other columns
    in `_tie`, which the caller provides. Added columns: `_bucket`, `_guest`. A
    range's last row is followed by the greatest id of the range below, which is
    there as a guest; the lowest range ends with the greatest id of all. Guests
    are for `lead` only and are dropped afterwards. Ranges end at ids that
    occur, so there are as many guests as ranges; at most `buckets` ids come to
    the driver.
    """
    steps = [i / buckets for i in range(1, buckets + 1)]
    ends = rows.agg(F.percentile_approx(id_col, steps, 100 * buckets)).first()[0]
    ends = sorted(set(ends or []))
    here = F.size(F.filter(F.array(*map(F.lit, ends)), lambda end: end < F.col(id_col))) if ends else F.lit(0)
    here = F.when(F.col(id_col).isNull(), F.lit(0)).otherwise(here)
    guest_of = F.when(
        F.col(id_col).isin(ends) if ends else F.lit(False),
        F.when(F.col(id_col) == (ends[-1] if ends else None), F.struct(F.lit(0).alias("bucket"), F.lit(2).alias("guest")))
        .otherwise(F.struct((here + 1).alias("bucket"), F.lit(1).alias("guest"))),
    )
    if not ends:  # only null ids: a ring of its own
        guest_of = F.lit(None).cast("struct<bucket:int,guest:int>")
    places = F.array_compact(F.array(
        F.struct(here.alias("bucket"), F.lit(0).alias("guest")), guest_of
    ))
    dealt = rows.withColumn("_at", F.explode(places)).withColumns(
        {"_bucket": F.col("_at.bucket"), "_guest": F.col("_at.guest")}
    ).drop("_at")
    order = Window.partitionBy("_bucket").orderBy(
        F.col("_guest") == 2, F.col(id_col).desc_nulls_last(), "_tie"
    )
    return dealt, order
