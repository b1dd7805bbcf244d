"""Left lookup that spreads heavy keys over many tasks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAVY_SHARE = 0.0001  # a key with more than this share of the rows is heavy
PART_SHARE = 0.0001  # and is divided into parts of about this share
POSITION = "_position"


def with_position(df: DataFrame) -> DataFrame:
    """Add the position of each row in its input split. Call it on a scan, where a
    task that runs again numbers its rows in the same way."""
    return df.withColumn(POSITION, F.monotonically_increasing_id())


def heavy_keys(df: DataFrame, column: str, share: float = HEAVY_SHARE,
               part_share: float = PART_SHARE) -> dict:
    """Every value that owns more than ``share`` of the rows, with the number of parts
    to divide it into: at most 1 / share values. Counts are combined before the
    shuffle."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    heavy = counts.crossJoin(total).where(F.col("n") > F.col("total") * share)
    return {
        row[0]: math.ceil(row.n / row.total / part_share)
        for row in heavy.select(column, "n", "total").collect()
    }


def salted_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  heavy: dict | None = None) -> DataFrame:
    """Left join of ``left`` (with position) to ``right``, whose key is unique.

    Rows of a heavy key, and rows without a key, are spread by their position over
    several join keys; the one matching row of ``right`` is repeated as often. Where
    Spark finds ``right`` below its broadcast threshold it broadcasts it, and nothing
    of ``left`` is shuffled.
    """
    # a null would meet all other nulls in one task; its stand-in only has to be spread
    stand_in = F.concat(F.lit("null-"), F.col(POSITION).cast("string"))
    left = left.withColumn("_key", F.coalesce(F.col(left_key).cast("string"), stand_in))
    on = (F.col("_key") == F.col(right_key).cast("string")) & F.col(left_key).isNotNull()
    if heavy:
        schema = T.StructType([T.StructField("_heavy", left.schema[left_key].dataType),
                               T.StructField("_parts", T.IntegerType())])
        # at most 1 / HEAVY_SHARE rows
        table = F.broadcast(left.sparkSession.createDataFrame(list(heavy.items()), schema))
        parts = F.coalesce("_parts", F.lit(1))
        left = left.join(table, F.col(left_key) == F.col("_heavy"), "left").withColumn(
            "_salt", F.pmod(F.col(POSITION), parts).cast("int")
        ).drop("_heavy", "_parts")
        right = right.join(table, F.col(right_key) == F.col("_heavy"), "left").withColumn(
            "_right_salt", F.explode(F.sequence(F.lit(0), parts - 1))
        ).drop("_heavy", "_parts")
        on &= F.col("_salt") == F.col("_right_salt")
    return left.join(right, on, "left").drop("_key", "_salt", "_right_salt", right_key)
