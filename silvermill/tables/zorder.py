"""Z-order: rows that are near in several columns at once lie near in a file.

A row's place in each column, in equal shares of all rows, is cut to a few bits, and
the bits of the columns are interleaved. In the order of the resulting number, a
filter on any one of the columns meets few row groups, where an order by the first
column alone would help that column only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: A text counts by so many of its first bytes, which fit a bigint.
_TEXT_BYTES = 7


def order_number(name: str, kind: T.DataType) -> Column:
    """A number that orders as the column does; texts that share their first bytes are equal."""
    column = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.hex(F.substring(column.cast("binary"), 1, _TEXT_BYTES))
        return F.conv(F.rpad(head, 2 * _TEXT_BYTES, "0"), 16, 10).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return column.cast("double")
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return column.cast("long")
    raise ValueError(f"{name} is {kind.simpleString()}, which has no order to cluster by")


def share_bounds(rows: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list]:
    """Per column, the values that cut all rows into at most 2 to the `bits` equal shares.

    One pass with a sketch of bounded size a task; a value that fills several shares
    bounds one. So many numbers a column come to the driver, whatever the table holds.
    """
    cuts = [i / 2**bits for i in range(1, 2**bits)]
    found = rows.agg(*[
        F.percentile_approx(order_number(name, rows.schema[name].dataType), cuts).alias(f"_{i}")
        for i, name in enumerate(columns)
    ]).first()
    return {name: sorted(set(found[i] or [])) for i, name in enumerate(columns)}


def _search(number: Column, bounds: Sequence, leaves: Sequence[Column]) -> Column:
    """The leaf after the last bound below the number, by halving."""
    if not bounds:
        return leaves[0]
    middle = len(bounds) // 2
    return F.when(
        number > F.lit(bounds[middle]), _search(number, bounds[middle + 1:], leaves[middle + 1:])
    ).otherwise(_search(number, bounds[:middle], leaves[:middle + 1]))


def z_value(schema: T.StructType, bounds: Mapping[str, Sequence], bits: int) -> Column:
    """The interleaved places of a row in all columns of `bounds`; nulls come first."""
    count = len(bounds)
    if bits < 1 or bits * count > 62:
        raise ValueError(f"{count} columns of {bits} bits do not fit a number")
    z = F.lit(0).cast("long")
    for place, (name, cuts) in enumerate(bounds.items()):
        spread = [
            sum((share >> bit & 1) << (bit * count + place) for bit in range(bits))
            for share in (i * 2**bits // (len(cuts) + 1) for i in range(len(cuts) + 1))
        ]
        leaves = [F.lit(value).cast("long") for value in spread]
        z = z.bitwiseOR(_search(order_number(name, schema[name].dataType), cuts, leaves))
    return z
