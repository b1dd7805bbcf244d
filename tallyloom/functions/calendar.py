"""Dates as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_sk(col: Column) -> Column:
    """YYYYMMDD integer of a date, timestamp or ISO text; null where it is no date."""
    day = col.try_cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def month_label(day: Column) -> Column:
    """Short label such as ``May 26``."""
    return F.date_format(day, "MMM yy")


def previous_sunday(ts: Column) -> Column:
    """The most recent Sunday 02:00 at or before ``ts`` (UTC)."""
    two_hours = F.expr("INTERVAL 2 HOURS")
    one_day = F.expr("INTERVAL 1 DAY")
    return F.date_trunc("week", ts - two_hours + one_day) - one_day + two_hours


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end``; Sunday is day 0, Friday and
    Saturday are the weekend."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )
    weekday = F.dayofweek("full_date") - 1
    return days.select(
        date_sk(F.col("full_date")).alias("date_sk"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.dayofmonth("full_date").alias("day"),
        weekday.alias("day_of_week"),
        weekday.isin(5, 6).alias("is_weekend"),
    )
