"""Ranks over a whole frame without sorting it in one task.

A frame is written once, range-partitioned by its whole order key, with the number of
its partition as a column. Spark draws the limits of the ranges; equal values are
divided by the key that follows them, so a value shared by a third of the rows spreads
over as many ranges as its share asks for. Rows are then counted per range, counts
become offsets by a join, and each range is numbered by itself. How even the ranges are
never changes the result, and nothing that grows with the rows reaches the driver.
Tiles and top fractions need no rank of every row: ``selection`` finds the rows at the
cuts, and a row's tile is how many of them it reaches.

Order columns are ascending with nulls first, and together unique. The frames are
read several times: pass a stored one (``runtime.materialize``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.selection import rows_at_ranks
from tallyloom.runtime import materialize

ROWS_PER_RANGE = 1_000_000
_RANGE = "_range"


def reaches(order: Sequence[str], point: Sequence) -> Column:
    """True for rows at or after ``point`` in the order."""
    return _at_or_after(order, [F.lit(value) for value in point])


def _at_or_after(order: Sequence[str], point: Sequence[Column]) -> Column:
    result = F.lit(True)
    for name, value in reversed(list(zip(order, point))):
        col = F.col(name)
        # a null value comes first: whatever is not null is after it
        after = F.when(value.isNull(), col.isNotNull()).otherwise(F.coalesce(col > value, F.lit(False)))
        result = after | (col.eqNullSafe(value) & result)
    return result


def stored_ranges(df: DataFrame, order: Sequence[str], rows: int,
                  rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, DataFrame]:
    """``df`` with the number of each row's range, stored, and (range, start, n): the
    rows before each range and in it."""
    ranges = max(1, math.ceil(rows / rows_per_range))
    dealt = df.repartitionByRange(ranges, *[F.col(c).asc_nulls_first() for c in order])
    ranged = materialize(dealt.withColumn(_RANGE, F.spark_partition_id()), "ranges")
    counted = ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)  # one row per range
    starts = counted.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return ranged, materialize(starts.select(_RANGE, "_start", "_n"), "range-starts")


def global_row_number(df: DataFrame, order: Sequence[str], name: str = "row_number",
                      rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add the 1-based position of each row in the total order."""
    ranged, starts = stored_ranges(df, order, df.count(), rows_per_range)
    within = F.row_number().over(W.partitionBy(_RANGE).orderBy(*order))
    numbered = ranged.withColumn("_within", within).join(starts.select(_RANGE, "_start"), _RANGE)
    return numbered.withColumn(name, F.col("_within") + F.col("_start")).select(*df.columns, name)


def rows_at(df: DataFrame, order: Sequence[str], ranks: Sequence[int], rows: int,
            rows_per_range: int = ROWS_PER_RANGE) -> dict[int, tuple]:
    """Order keys of the rows at some 1-based ranks by (value, unique key); ranks outside
    the frame are left out."""
    value, key = order
    return rows_at_ranks(df, [value], key, lambda _: {value: ranks}, rows_per_range)[1][value]


def tile_starts(rows: int, tiles: int) -> list[int]:
    """First rank of the tiles 2, 3, ... of NTILE; a start past the end has no row."""
    size, larger = divmod(rows, tiles)
    return [t * size + min(t, larger) + 1 for t in range(1, tiles)]


def count_reached(order: Sequence[str], at: dict[int, tuple], ranks: Sequence[int]) -> Column:
    """How many of the rows at ``ranks`` a row reaches."""
    total = F.lit(0)
    for rank in ranks:
        if rank in at:
            total = total + reaches(order, at[rank]).cast("int")
    return total


def ntile(df: DataFrame, order: Sequence[str], tiles: int, name: str,
          rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add the NTILE number over the whole frame, by (value, unique key)."""
    value, key = order
    rows, at = rows_at_ranks(df, [value], key, lambda n: {value: tile_starts(n, tiles)}, rows_per_range)
    return df.withColumn(name, count_reached(order, at[value], tile_starts(rows, tiles)) + 1)


def top_fraction_sum(df: DataFrame, value: str, key: str, parts: int, name: str,
                     rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row: the sum of the largest ceil(n / parts) values. Equal values at the
    border count alike whichever is taken, so the order of ``key`` does not matter."""
    keyed = df.select((-F.col(value)).alias("_descending"), key, value)
    rows, at = rows_at_ranks(keyed, ["_descending"], key, lambda n: {"_descending": [-(-n // parts) + 1]}, rows_per_range)
    border = list(at["_descending"].values())
    kept = keyed.where(~reaches(["_descending", key], border[0])) if border else keyed
    return kept.agg(F.sum(value).alias(name))


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """The first k rows of a total order: every task keeps k rows, then they merge."""
    return df.orderBy(*order).limit(k)


def rank_small(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Rank of a result that is already aggregated to a few rows."""
    return df.withColumn(name, F.row_number().over(W.orderBy(*order)))
