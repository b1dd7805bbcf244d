"""Monthly forecast per key: Holt's linear trend, fitted by least squares.

A series is one array of months per key. Facts are combined per month first, so
an array has as many entries as the calendar has months, whatever the data size.
Many keys (company, product, city) are fitted in parallel.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions.calendar import month_start
from tallyloom.functions.holt_grid import PARAMETERS, fit_batch

HORIZON = 3
MIN_POINTS = 3
Z_80 = 1.2815515655446004  # fixed value: normal quantile of a two-sided 80% band


def monthly_series(monthly: DataFrame) -> DataFrame:
    """(company_code, period, sales_syp) from monthly sales; period is the first day."""
    return monthly.select(
        "company_code", month_start(F.col("year"), F.col("month")).alias("period"), "sales_syp"
    )


def drop_partial(series: DataFrame, keys: Sequence[str], mode: str = "always",
                 run_date: dt.date | None = None, min_points: int = MIN_POINTS) -> DataFrame:
    """Leave out keys with fewer than ``min_points`` months, then the last month:
    ``always``, in ``run_month`` only if its month number is that of ``run_date``, or
    ``keep`` it. A single month is never dropped."""
    last_first = W.partitionBy(*keys).orderBy(F.col("period").desc())
    counted = series.withColumns({
        "_from_end": F.row_number().over(last_first),
        "_points": F.count(F.lit(1)).over(W.partitionBy(*keys)),
    }).where(F.col("_points") >= min_points)
    last = (F.col("_from_end") == 1) & (F.col("_points") > 1)
    if mode == "run_month":
        last &= F.month("period") == run_date.month
    elif mode == "keep":
        last = F.lit(False)
    elif mode != "always":
        raise ValueError(f"unknown mode: {mode}")
    return counted.where(~last).drop("_from_end", "_points")


def _points(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    point = F.struct("period", F.col("sales_syp").cast("double").alias("y"))
    return series.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("points"))


def _smooth(points: Column, alpha: Column, beta: Column, level: Column, trend: Column) -> Column:
    """Fold the series: level, trend, and the fitted value of every month."""
    start = F.struct(level.cast("double").alias("level"), trend.cast("double").alias("trend"),
                     F.array().cast("array<double>").alias("fitted"))

    def step(state: Column, point: Column) -> Column:
        expected = state["level"] + state["trend"]
        new_level = alpha * point["y"] + (1 - alpha) * expected
        new_trend = beta * (new_level - state["level"]) + (1 - beta) * state["trend"]
        return F.struct(new_level.alias("level"), new_trend.alias("trend"),
                        F.concat(state["fitted"], F.array(expected)).alias("fitted"))

    return F.aggregate(points, start, step)


def holt(series: DataFrame, keys: Sequence[str], alpha: float, beta: float,
         level: float | Column, trend: float | Column) -> DataFrame:
    """Smoothing with given parameters: one row per key with ``points``, ``fitted`` and
    the final ``level`` and ``trend``. Start values may be columns over ``points``."""
    start = [v if isinstance(v, Column) else F.lit(v) for v in (level, trend)]
    done = _points(series, keys).withColumns({"alpha": F.lit(float(alpha)), "beta": F.lit(float(beta))})
    return _apply(done.withColumns({"level0": start[0], "trend0": start[1]}), keys)


def _apply(params: DataFrame, keys: Sequence[str]) -> DataFrame:
    state = _smooth(F.col("points"), F.col("alpha"), F.col("beta"), F.col("level0"), F.col("trend0"))
    return params.withColumn("_state", state).select(
        *keys, "points", "alpha", "beta", "level0", "trend0",
        F.col("_state.level").alias("level"), F.col("_state.trend").alias("trend"),
        F.col("_state.fitted").alias("fitted"),
    )


def holt_fit(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Least-squares fit per key: one row as ``holt`` gives it. Keys without a unique
    fit (fewer than two months) are left out.

    For fixed (alpha, beta) the start values have a closed solution; the two
    parameters are searched on a grid, then on a finer one around the best cell.
    """
    fit = F.pandas_udf(fit_batch, PARAMETERS)
    values = F.transform("points", lambda p: p["y"])
    # two months always have a fit, so no filter has to look at the result of the fit,
    # which would make Spark compute it twice
    enough = _points(series, keys).where(F.size("points") >= 2)
    return _apply(enough.withColumn("_fit", fit(values)).select(*keys, "points", "_fit.*"), keys)


def fitted_rows(fit: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, period, actual, fitted), one row per month of the series."""
    pairs = F.arrays_zip("points", "fitted")
    return fit.select(*keys, F.explode(pairs).alias("_p")).select(
        *keys, F.col("_p.points.period").alias("period"),
        F.col("_p.points.y").alias("actual"), F.col("_p.fitted").alias("fitted"),
    )


def _ahead(last: Column, horizon: int) -> Column:
    return F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(horizon)),
        lambda h: F.struct(h.alias("step"), F.add_months(last, h).alias("period")),
    ))


def holt_forecast(fit: DataFrame, keys: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """(keys, step, period, forecast) for the months after the series."""
    last = F.element_at("points", -1)["period"]
    return fit.select(*keys, "level", "trend", _ahead(last, horizon).alias("_h")).select(
        *keys, F.col("_h.step").alias("step"), F.col("_h.period").alias("period"),
        (F.col("level") + F.col("_h.step") * F.col("trend")).alias("forecast"),
    )


def trend_forecast(series: DataFrame, keys: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """Straight line through the months, numbered 1, 2, ...; columns as ``holt_forecast``."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy("period")).cast("double")
    lines = series.withColumns({"_x": place, "_y": F.col("sales_syp").cast("double")}).groupBy(*keys).agg(
        F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("intercept"),
        F.max("_x").alias("_n"), F.max("period").alias("_last"),
    )
    return lines.select(*keys, "slope", "intercept", "_n", _ahead(F.col("_last"), horizon).alias("_h")).select(
        *keys, F.col("_h.step").alias("step"), F.col("_h.period").alias("period"),
        (F.col("intercept") + F.col("slope") * (F.col("_n") + F.col("_h.step"))).alias("forecast"),
    )


def bands(fit: DataFrame, keys: Sequence[str], horizon: int = HORIZON, z: float = Z_80) -> DataFrame:
    """Forecast with a normal band, by default 80%. The error of step h grows with
    alpha and beta; sigma is the root mean squared in-sample error."""
    squares = F.transform(F.arrays_zip("points", "fitted"),
                          lambda p: F.pow(p["points"]["y"] - p["fitted"], F.lit(2)))
    total = F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)
    sigma = F.sqrt(total / F.size("points"))
    errors = fit.select(*keys, "alpha", "beta", sigma.alias("sigma"))
    later = F.transform(F.sequence(F.lit(1), F.col("step") - 1), lambda j: F.pow(
        F.col("alpha") + F.col("alpha") * F.col("beta") * j, F.lit(2)))
    beyond_first = F.when(
        F.col("step") > 1, F.aggregate(later, F.lit(0.0), lambda s, x: s + x)
    ).otherwise(0.0)
    half = F.lit(z) * F.col("sigma") * F.sqrt(1 + beyond_first)
    return holt_forecast(fit, keys, horizon).join(errors, list(keys)).select(
        *keys, "step", "period", "forecast",
        (F.col("forecast") - half).alias("lower"), (F.col("forecast") + half).alias("upper"),
    )


def forecast_metrics(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """In-sample RMSE, and MAPE in percent over the months with sales."""
    error = F.col("actual") - F.col("fitted")
    relative = F.when(F.col("actual") != 0, F.abs(error / F.nullif(F.col("actual"), F.lit(0.0))))
    return pairs.groupBy(*keys).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), (F.avg(relative) * 100).alias("mape")
    )


def forecast_check(forecast: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``status``: FAIL below zero, WARN above twice the highest month, else OK."""
    highest = actual.groupBy(*keys).agg(F.max("actual").alias("history_max"))
    return forecast.join(highest, list(keys)).withColumn(
        "status",
        F.when(F.col("forecast") < 0, "FAIL")
        .when(F.col("forecast") > 2 * F.col("history_max"), "WARN")
        .otherwise("OK"),
    )


def forecast_long(fit: DataFrame, keys: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """Rows (keys, period ``yyyy-MM``, type, sales_syp) of type actual, fitted, forecast."""
    past = fitted_rows(fit, keys)

    def rows(df: DataFrame, kind: str, value: str) -> DataFrame:
        return df.select(*keys, F.date_format("period", "yyyy-MM").alias("period"),
                         F.lit(kind).alias("type"), F.col(value).alias("sales_syp"))

    return (
        rows(past, "actual", "actual")
        .unionByName(rows(past, "fitted", "fitted"))
        .unionByName(rows(holt_forecast(fit, keys, horizon), "forecast", "forecast"))
    )


def forecast_summary(fit: DataFrame, keys: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """One row per key: the forecast values in order, RMSE and MAPE."""
    ahead = holt_forecast(fit, keys, horizon).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("step", "period", "forecast"))).alias("_steps")
    )
    values = ahead.select(
        *keys, F.transform("_steps", lambda s: F.date_format(s["period"], "yyyy-MM")).alias("periods"),
        F.transform("_steps", lambda s: s["forecast"]).alias("forecasts"),
    )
    return values.join(forecast_metrics(fitted_rows(fit, keys), keys), list(keys))


def combined_forecast(forecast: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Forecast months side by side: one column per company, and their sum."""
    values = [
        F.max(F.when(F.col("company_code") == c, F.col("forecast"))).alias(c.lower()) for c in codes
    ]
    return forecast.groupBy("period").agg(*values, F.sum("forecast").alias("combined"))
