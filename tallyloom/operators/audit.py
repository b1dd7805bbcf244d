"""Run log and quarantine of a warehouse."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.schemas import ETL_RUNS

CATCH_UP_DAYS = 8


def run_row(spark: SparkSession, **values: object) -> DataFrame:
    """One line of the append-only run log."""
    return spark.createDataFrame([tuple(values.get(c) for c in ETL_RUNS.names)], ETL_RUNS)


def open_run(spark: SparkSession, batch_id: str, mode: str, at: dt.datetime,
             feeds: Sequence[str] = ()) -> DataFrame:
    return run_row(spark, batch_id=batch_id, mode=mode, started_at=at, status="running", rows_extracted=0,
                   rows_loaded=0, rows_quarantined=0, logged_at=at, feeds=",".join(feeds))


def close_run(spark: SparkSession, batch_id: str, mode: str, started_at: dt.datetime,
              at: dt.datetime, extracted: int, loaded: int, quarantined: int,
              status: str, notes: str | None = None, feeds: Sequence[str] = ()) -> DataFrame:
    return run_row(spark, batch_id=batch_id, mode=mode, started_at=started_at, finished_at=at,
                   rows_extracted=extracted, rows_loaded=loaded, rows_quarantined=quarantined,
                   status=status, notes=notes, logged_at=at, feeds=",".join(feeds))


def current_runs(log: DataFrame) -> DataFrame:
    """Latest line of every run; a closing line beats the opening one, and a run that
    has succeeded once stays so whatever is logged under its id later."""
    line = F.struct(*[c for c in ETL_RUNS.names if c != "batch_id"])
    latest = F.max_by(line, F.struct(F.col("status") == "succeeded", "logged_at", F.col("status") != "running"))
    return log.groupBy("batch_id").agg(latest.alias("run")).select("batch_id", "run.*").select(
        *ETL_RUNS.names
    )


def last_success(runs: DataFrame, feed: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Start of the last succeeded run, null if there is none: one row, or one per value
    of ``by``. With a feed, only full and incremental runs that extracted it count: a load
    from a given date may leave a gap before that date, and a stream has read files, not a
    time range."""
    done = F.col("status") == "succeeded"
    if feed is not None:
        done &= F.col("mode").isin("full", "incremental") & F.array_contains(F.split("feeds", ","), feed)
    return runs.groupBy(*by).agg(F.max(F.when(done, F.col("started_at"))).alias("last_success"))


def catchup_due(runs: DataFrame, now: Column, days: int = CATCH_UP_DAYS, feed: str | None = None,
                by: Sequence[str] = ()) -> DataFrame:
    """Start of the last success, its age in whole seconds, and whether a catch-up is due
    (no success, or one of more than ``days`` days ago); as ``last_success`` for a feed or
    for each value of ``by``."""
    last = F.col("last_success")
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(last.cast("timestamp"))
    due = last.isNull() | (age > days * 86_400)
    return last_success(runs, feed, by).select(*by, "last_success", age.alias("age_seconds"), due.alias("due"))


def stamp_quarantine(bad: DataFrame, batch_id: str, at: dt.datetime) -> DataFrame:
    """Quarantine rows with the batch they came from."""
    return bad.withColumns({"batch_id": F.lit(batch_id), "occurred_at": F.lit(at)})
