import datetime as dt
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.operators import forecast as fc
from tallyloom.sources import results

KEYS = ["company_code"]
# Two published 12-month series from May 2025 on, and the published fit
# of the first (a straight line) with its error and forecast.
SERIES = {
    "BB": [29534000, 52285000, 55604000, 62905000, 58193000, 62880000,
           58083000, 61323000, 58992000, 49392000, 62750000, 58625000],
    "AA": [31622000, 57020000, 53529000, 59458000, 57317000, 61120000,
           56776000, 62784000, 66087000, 52455000, 58034000, 56019000],
}
PUBLISHED_RMSE = {"AA": 7377980, "BB": 7818328}
LINE_RMSE = {"AA": 7261470, "BB": 7802628}


def month(i):
    return dt.date(2025 + (4 + i) // 12, (4 + i) % 12 + 1, 1)


def series(spark, values):
    table = [(code, month(i), float(v)) for code, ys in values.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(table, "company_code STRING, period DATE, sales_syp DOUBLE")


def test_fit_is_no_worse_than_published(spark):
    fit = fc.holt_fit(series(spark, SERIES), KEYS)
    metrics = {r.company_code: r for r in fc.forecast_metrics(fc.fitted_rows(fit, KEYS), KEYS).collect()}
    for code in SERIES:
        assert metrics[code].rmse <= PUBLISHED_RMSE[code]
        assert metrics[code].rmse <= LINE_RMSE[code] + 1
        assert 12 < metrics[code].mape < 13.5
    first = [r.period for r in fc.holt_forecast(fit, KEYS).where("company_code = 'AA'").orderBy("step").collect()]
    assert first == [dt.date(2026, 5, 1), dt.date(2026, 6, 1), dt.date(2026, 7, 1)]


def holt_by_hand(ys, alpha, beta, level, trend):
    fitted = []
    for y in ys:
        fitted.append(level + trend)
        new = alpha * y + (1 - alpha) * (level + trend)
        level, trend = new, beta * (new - level) + (1 - beta) * trend
    return level, trend, fitted


def test_smoothing_with_given_parameters(spark):
    ys = [3.0, 5.0, 4.0, 8.0]
    got = fc.holt(series(spark, {"AA": ys}), KEYS, 0.4, 0.3, 2.0, 1.0).first()
    level, trend, fitted = holt_by_hand(ys, 0.4, 0.3, 2.0, 1.0)
    assert got.fitted == pytest.approx(fitted) and (got.level, got.trend) == pytest.approx((level, trend))


def test_fit_finds_a_generated_model(spark):
    """No parameters of a coarse scan, with free start values, do better."""
    ys = [10, 12, 11, 30, 32, 31, 33, 12, 10, 11, 13, 40, 42, 41, 43]
    fit = fc.holt_fit(series(spark, {"AA": ys}), KEYS).first()
    best = sum((y - f) ** 2 for y, f in zip(ys, fit.fitted))
    assert fit.alpha > 0
    for alpha in (0.0, 0.25, 0.5, 0.75, 1.0):
        for beta in (0.0, 0.5, 1.0):
            for level in (fit.level0 - 2, fit.level0, fit.level0 + 2):
                for trend in (fit.trend0 - 1, fit.trend0, fit.trend0 + 1):
                    fitted = holt_by_hand(ys, alpha, beta, level, trend)[2]
                    assert best <= sum((y - f) ** 2 for y, f in zip(ys, fitted)) + 1e-6


def test_constant_and_short_series(spark):
    fit = fc.holt_fit(series(spark, {"AA": [5, 5, 5, 5], "BB": [1, 3], "CC": [7], "DD": [0, 0, 0]}), KEYS)
    ahead = {(r.company_code, r.step): r.forecast for r in fc.holt_forecast(fit, KEYS).collect()}
    assert {code for code, _ in ahead} == {"AA", "BB", "DD"}
    assert ahead["AA", 3] == pytest.approx(5) and ahead["BB", 2] == pytest.approx(7) and ahead["DD", 1] == 0
    one = fit.where("company_code = 'AA'").first()
    assert (one.alpha, one.beta) == (0.0, 0.0)  # of equal errors the smallest parameters


def test_last_month_is_dropped(spark):
    values = series(spark, {"AA": [1, 2, 3, 4], "BB": [1, 2]})  # May to August

    def left(**kw):
        return [r.sales_syp for r in fc.drop_partial(values, KEYS, **kw).orderBy("company_code", "period").collect()]

    assert left() == [1, 2, 3]
    assert left(min_points=1) == [1, 2, 3, 1]
    assert left(mode="keep") == [1, 2, 3, 4]
    assert left(mode="run_month", run_date=dt.date(2030, 8, 15)) == [1, 2, 3]
    assert left(mode="run_month", run_date=dt.date(2030, 9, 15)) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        left(mode="sometimes")


def test_zero_actual_is_left_out_of_mape(spark):
    pairs = spark.createDataFrame([("AA", 0.0, 1.0), ("AA", 10.0, 9.0)], "company_code STRING, actual DOUBLE, fitted DOUBLE")
    got = fc.forecast_metrics(pairs, KEYS).first()
    assert (got.rmse, got.mape) == (1.0, pytest.approx(10.0))


def test_check_of_forecasts(spark):
    ahead = spark.createDataFrame([("AA", -1.0), ("AA", 21.0), ("AA", 20.0)], "company_code STRING, forecast DOUBLE")
    actual = spark.createDataFrame([("AA", 10.0), ("AA", 3.0)], "company_code STRING, actual DOUBLE")
    assert rows(fc.forecast_check(ahead, actual, KEYS), "forecast", "status") == [
        (-1.0, "FAIL"), (20.0, "OK"), (21.0, "WARN")]


def test_trend_is_the_line(spark):
    got = fc.trend_forecast(series(spark, {"AA": [1, 3, 5]}), KEYS, 2)
    assert rows(got, "step", "forecast") == [(1, pytest.approx(7)), (2, pytest.approx(9))]


def test_bands_widen_with_the_horizon(spark):
    ys = [10, 12, 11, 30, 32, 31, 33, 12, 10, 11, 13, 40, 42, 41, 43]
    fit = fc.holt_fit(series(spark, {"AA": ys}), KEYS)
    one = fit.first()
    sigma = math.sqrt(sum((y - f) ** 2 for y, f in zip(ys, one.fitted)) / len(ys))
    got = fc.bands(fit, KEYS).orderBy("step").collect()
    c = [one.alpha + one.alpha * one.beta * j for j in (1, 2)]
    factors = [1, math.sqrt(1 + c[0] ** 2), math.sqrt(1 + c[0] ** 2 + c[1] ** 2)]
    assert [r.upper - r.forecast for r in got] == pytest.approx([fc.Z_80 * sigma * f for f in factors])
    assert [r.forecast - r.lower for r in got] == pytest.approx([fc.Z_80 * sigma * f for f in factors])


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_stored_forecast(spark, tmp_path, fmt):
    fit = fc.holt_fit(series(spark, SERIES), KEYS)
    long = fc.forecast_long(fit, KEYS)
    assert long.groupBy("company_code", "type").count().where("count not in (12, 3)").isEmpty()
    results.write_forecast(long, str(tmp_path / "f"), fmt)
    back = results.read_forecast(spark, str(tmp_path / "f"), fmt)
    assert rows(back["actual"].where("company_code = 'AA'"), "sales_syp") == sorted((float(v),) for v in SERIES["AA"])
    assert back["forecast"].count() == 6
    direct = rows(fc.forecast_metrics(fc.fitted_rows(fit, KEYS), KEYS))
    assert [r[1:] for r in rows(back["metrics"])] == [pytest.approx(r[1:]) for r in direct]


def test_summary_and_side_by_side(spark):
    fit = fc.holt_fit(series(spark, SERIES), KEYS)
    summary = fc.forecast_summary(fit, KEYS).orderBy("company_code").first()
    assert list(summary.periods) == ["2026-05", "2026-06", "2026-07"] and len(summary.forecasts) == 3
    wide = fc.combined_forecast(fc.holt_forecast(fit, KEYS), ["AA", "BB"])
    assert wide.where(F.abs(F.col("aa") + F.col("bb") - F.col("combined")) > 1e-6).isEmpty() and wide.count() == 3
