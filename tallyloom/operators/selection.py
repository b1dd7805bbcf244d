"""Rows at given ranks of several measures at once, exact, in two passes.

The first pass counts rows and sketches the quantiles of every measure and of the key.
Each wanted rank then has a bracket of values that must hold it. The second pass counts
the values inside the brackets, and below each as one number; values are divided by
ranges of the key, so one value with a third of the rows is many cells. Running sums of
the cells find the one that holds the rank, and only that cell's rows are sorted by key.

Nothing is collected but the sketch and one row per rank. A bracket that misses its rank
(sketches are approximate) is opened wholly and counted again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.runtime import literal_rows

GRID = 1000  # quantiles of each measure that are sketched
ACCURACY = 10_000  # a sketched quantile is off by one in so many rows at most
KEY_RANGES = 256
ROWS_PER_CELL = 1_000_000

Ranks = Callable[[int], Mapping[str, Sequence[int]]]


@dataclass(frozen=True)
class Profile:
    """Rows, rows with a value and quantiles of each measure, and quantiles of the key."""

    rows: int
    known: dict[str, int]
    quantiles: dict[str, list]
    keys: list


def profile(df: DataFrame, measures: Sequence[str], key: str) -> Profile:
    """One pass over the columns; sketches are combined before they travel."""
    shares = [i / GRID for i in range(GRID + 1)]
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(m).alias(f"n{i}") for i, m in enumerate(measures)],
        *[F.percentile_approx(m, shares, ACCURACY).alias(f"q{i}") for i, m in enumerate(measures)],
        F.percentile_approx(key, [i / KEY_RANGES for i in range(1, KEY_RANGES)], ACCURACY).alias("keys"),
    ).first()
    return Profile(
        found["rows"], {m: found[f"n{i}"] for i, m in enumerate(measures)},
        {m: found[f"q{i}"] or [] for i, m in enumerate(measures)}, sorted(set(found["keys"] or [])))


def _bracket(known: Profile, measure: str, rank: int, rows_per_cell: int) -> tuple:
    """(least, greatest) value that the rank can have, None where it is open. Rows without
    a value come first and are in open brackets only."""
    quantiles, rows = known.quantiles[measure], known.known[measure]
    place = rank - (known.rows - rows)
    if place < 1 or rows <= rows_per_cell:
        return None, None
    width = max(1, GRID * rows_per_cell // (4 * rows))
    slack = GRID // ACCURACY + 1
    low, high = (place - 1) * GRID // rows - width - slack, -(-place * GRID // rows) + width + slack
    return (quantiles[low] if low > 0 else None), (quantiles[high] if high < GRID else None)


def _spread(value: Column, entries: Sequence[tuple[int, int, tuple]]) -> list[Column]:
    """One struct per bracket that the value lies in or before; null for others."""
    parts = []
    for measure, number, (low, high) in entries:
        below = F.lit(False) if low is None else value.isNull() | (value < F.lit(low))
        beyond = F.lit(False) if high is None else F.coalesce(value > F.lit(high), F.lit(False))
        inside = ~F.coalesce(below, F.lit(False))
        parts.append(F.when(~beyond, F.struct(
            F.lit(measure).alias("measure"), F.lit(number).alias("bracket"), inside.alias("inside"),
            F.when(inside, value).alias("value"))))
    return parts


def rows_at_ranks(df: DataFrame, measures: Sequence[str], key: str, ranks: Ranks,
                  rows_per_cell: int = ROWS_PER_CELL) -> tuple[int, dict[str, dict[int, tuple]]]:
    """(rows, {measure: {rank: (value, key)}}): of each measure the rows at the 1-based
    ranks that ``ranks`` names for the number of rows; ranks outside the frame are left
    out. Order is ascending by (measure, key), no value first; keys are unique and not
    null. The frame is read three times: pass a stored one."""
    known = profile(df, measures, key)
    wanted = {m: sorted({r for r in rs if 1 <= r <= known.rows}) for m, rs in ranks(known.rows).items()}
    found: dict[str, dict[int, tuple]] = {m: {} for m in wanted}
    for open_all in (False, True):
        missing = {m: [r for r in rs if r not in found[m]] for m, rs in wanted.items()}
        if not any(missing.values()):
            break
        for measure, rank, value, at in _find(df, measures, key, missing, known, rows_per_cell, open_all):
            found[measures[measure]][rank] = (value, at)
    return known.rows, found


def _find(df: DataFrame, measures: Sequence[str], key: str, wanted: Mapping[str, Sequence[int]], known: Profile,
          rows_per_cell: int, open_all: bool) -> list[tuple]:
    """(measure, rank, value, key) of the wanted ranks whose bracket holds them."""
    kind = df.select(F.array(*measures).alias("v")).schema["v"].dataType.elementType
    targets, parts = [], []
    for place, measure in enumerate(measures):
        numbers: dict[tuple, int] = {}
        for rank in wanted.get(measure, ()):
            bracket = (None, None) if open_all else _bracket(known, measure, rank, rows_per_cell)
            number = numbers.setdefault(bracket, len(numbers))
            targets.append((place, number, rank))
        entries = [(place, number, bracket) for bracket, number in numbers.items()]
        parts += _spread(F.col(measure).cast(kind), entries)
    # the key ranges only matter where a value may have more rows than a cell should hold
    limits = known.keys if known.rows > rows_per_cell else []
    key_range = F.size(F.filter(F.array(*map(F.lit, limits)), lambda x: x < F.col(key))) if limits else F.lit(0)
    placed = df.select(F.col(key).alias("_key"), key_range.alias("_range"), F.explode(F.array(*parts)).alias("_e")).where(
        F.col("_e").isNotNull()).select("_key", "_e.*", F.when(F.col("_e.inside"), F.col("_range")).alias("range"))
    cell = ["measure", "bracket", "inside", "value", "range"]
    counted = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    running = W.partitionBy("measure", "bracket").orderBy("inside", F.asc_nulls_first("value"), "range")
    summed = counted.withColumn("upto", F.sum("n").over(running))
    schema = T.StructType([T.StructField(n, T.IntegerType()) for n in ("measure", "bracket")]
                          + [T.StructField("rank", T.LongType())])
    asked = F.broadcast(literal_rows(df.sparkSession, targets, schema))  # one row per rank
    holds = (F.col("rank") > F.col("upto") - F.col("n")) & (F.col("rank") <= F.col("upto")) & F.col("inside")
    cells = summed.join(asked, ["measure", "bracket"]).where(holds).select(
        *[F.col(c).alias(f"_{c}") for c in cell], "rank", (F.col("rank") - F.col("upto") + F.col("n")).alias("_nth"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cell]
    inside = placed.join(F.broadcast(cells), same[0] & same[1] & same[2] & same[3] & same[4])  # one row per rank
    ordered = inside.withColumn("_row", F.row_number().over(W.partitionBy("measure", "rank").orderBy("_key")))
    return [tuple(r) for r in ordered.where(F.col("_row") == F.col("_nth")).select("measure", "rank", "value", "_key").collect()]
