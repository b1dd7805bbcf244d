import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.functions.calendar import date_sk, dim_date, month_label, previous_sunday
from tallyloom.functions.money import line_total, money_avg, pct, short_money, to_money
from tallyloom.functions.text import phone_e164, transliterate
from tallyloom.specs import PHONE_E164, PHONE_NATIONAL


def one(spark, value, kind, column):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw, expected", [
    ("+963911111111", "+963911111111"),
    (" +9639 1111 1111 ", "+963911111111"),
    ("+96391111111", None),
    ("+9639111111111", None),
    ("0911111111", None),
    ("+9639١١١١١١١١", None),
    (None, None),
])
def test_international_phone(spark, raw, expected):
    assert one(spark, raw, "STRING", lambda c: phone_e164(c, PHONE_E164)) == expected


@pytest.mark.parametrize("raw, expected", [
    ("0933333333", "+963933333333"),
    ("09 3333\t3333", "+963933333333"),
    ("093333333", None),
    ("09333333333", None),
    ("+963933333333", None),
    (None, None),
])
def test_national_phone(spark, raw, expected):
    assert one(spark, raw, "STRING", lambda c: phone_e164(c, PHONE_NATIONAL)) == expected


@pytest.mark.parametrize("value, expected", [
    ("2024-02-29", 20240229), ("2023-12-31", 20231231), ("no date", None), (None, None),
])
def test_date_key_of_text(spark, value, expected):
    assert one(spark, value, "STRING", date_sk) == expected


def test_date_key_of_timestamp(spark):
    assert one(spark, dt.datetime(2026, 12, 31, 23, 59), "TIMESTAMP", date_sk) == 20261231


@pytest.mark.parametrize("now, expected", [
    (dt.datetime(2026, 5, 17, 1, 59), dt.datetime(2026, 5, 10, 2)),
    (dt.datetime(2026, 5, 17, 2, 0), dt.datetime(2026, 5, 17, 2)),
    (dt.datetime(2026, 5, 17, 2, 1), dt.datetime(2026, 5, 17, 2)),
    (dt.datetime(2026, 5, 16, 12, 0), dt.datetime(2026, 5, 10, 2)),
])
def test_previous_sunday(spark, now, expected):
    assert one(spark, now, "TIMESTAMP", previous_sunday) == expected


def test_calendar(spark):
    days = dim_date(spark, dt.date(2022, 1, 1), dt.date(2026, 12, 31))
    assert days.count() == 1826
    week = {r.full_date: (r.day_of_week, r.is_weekend)
            for r in days.where("full_date between '2026-05-14' and '2026-05-17'").collect()}
    assert week == {dt.date(2026, 5, 14): (4, False), dt.date(2026, 5, 15): (5, True),
                    dt.date(2026, 5, 16): (6, True), dt.date(2026, 5, 17): (0, False)}
    leap = days.where("full_date = '2024-02-29'").first()
    assert (leap.date_sk, leap.quarter, leap.month_name, leap.day) == (20240229, 1, "February", 29)


def test_month_label(spark):
    assert one(spark, dt.date(2026, 5, 1), "DATE", month_label) == "May 26"


@pytest.mark.parametrize("value, expected", [
    ("12.345", Decimal("12.35")), ("n/a", None), (None, None), ("1e20", None),
])
def test_to_money(spark, value, expected):
    assert one(spark, value, "STRING", to_money) == expected


def test_line_total_out_of_range_is_null(spark):
    df = spark.createDataFrame([(3, Decimal("100.50")), (2_000_000_000, Decimal("999999999999.99"))],
                               "q INT, p DECIMAL(14,2)")
    assert [r[0] for r in df.select(line_total(F.col("q"), F.col("p"))).collect()] == [Decimal("301.50"), None]


def test_quotients_guard_zero(spark):
    df = spark.createDataFrame([(Decimal("10.00"), 0, Decimal("0.00")), (Decimal("1.01"), 2, Decimal("3.00"))],
                               "a DECIMAL(14,2), n LONG, w DECIMAL(14,2)")
    got = df.select(money_avg(F.col("a"), F.col("n")), pct(F.col("a"), F.col("w"))).collect()
    assert tuple(got[0]) == (None, None)
    assert tuple(got[1]) == (Decimal("0.51"), Decimal("33.67"))


@pytest.mark.parametrize("value, expected", [
    (702_400_000.0, "702M"), (2_500_000.0, "2M"), (3_500_000.0, "4M"), (25_000.0, "25K"),
    (999.9, "999"), (0.0, "0"), (999_999.0, "1000K"),
])
def test_short_money(spark, value, expected):
    assert one(spark, value, "DOUBLE", short_money) == expected


def test_transliterate_keeps_unknown_words(spark):
    df = spark.createDataFrame([("  سمر   خالد x ",), ("",)], "v STRING")
    got = df.select(transliterate(F.col("v"), {"سمر": "Samar"}).alias("v"))
    assert rows(got) == [("",), ("Samar خالد x",)]
