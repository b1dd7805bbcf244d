import json
from decimal import Decimal

import pytest
from conftest import DAY, feeds, rows, source_frames
from pyspark.sql import functions as F

from tallyloom.functions.text import first_failure
from tallyloom.operators import conform
from tallyloom.sources.operational import read_source_a, read_source_b, since_filter


def customers(spark, city_maps, table):
    frames = source_frames(spark, customers=table)
    feed = feeds(frames)[0]
    return conform.conform_customers(read_source_a(feed.reader)["customers"], feed.spec, city_maps["ar"])


def test_first_broken_rule_gives_the_reason(spark, city_maps):
    judged = customers(spark, city_maps, [
        (1, "Both", "bad", 3, DAY), (2, "Phone", "bad", 1, DAY), (3, "Good", "+963911111111", 1, DAY),
        (4, None, "+963911111112", 1, DAY),
    ])
    assert rows(judged, "source_customer_id", "reason_code", "reason", "rejected") == [
        ("1", "unknown_city", "unknown city: 'مدينة 3'", True),
        ("2", "invalid_phone", "invalid phone for AA: 'bad'", True),
        ("3", None, None, False),
        ("4", "null_name", "customer name is null", True),
    ]


def test_names_pass_unchanged_unless_trimmed(spark, city_maps):
    table = [(1, "  Ann ", "+963911111111", 1, DAY)]
    assert customers(spark, city_maps, table).first().full_name == "  Ann "
    feed = feeds(source_frames(spark, customers=table))[0]
    raw = read_source_a(feed.reader)["customers"]
    trimmed = conform.conform_customers(raw, feed.spec, city_maps["ar"], trim_names=True)
    assert trimmed.first().full_name == "Ann"


def test_payload_is_the_raw_row_with_nulls(spark, city_maps):
    judged = customers(spark, city_maps, [(1, None, "x", 3, DAY), (2, "Ok", "+963911111111", 1, DAY)])
    payload = {r.source_customer_id: r.source_row for r in judged.collect()}
    assert payload["2"] is None
    assert json.loads(payload["1"]) == {
        "customer_id": "1", "full_name": None, "phone": "x", "city_ar": "مدينة 3",
        "signup_date": "2024-03-01"}


def test_category_case_is_exact(spark, catalogs):
    frames = source_frames(
        spark,
        products=[(1, "x", "Internet", 5, True), (2, "x", "internet", 5, True), (3, "x", "INTERNET", 5, True)],
        items=[("1", "x", "INTERNET", "5"), ("2", "x", "Internet", "5"), ("3", "x", "OTHER", "5")])
    a, b = feeds(frames)
    judged = conform.union_all([
        conform.conform_products(read_source_a(a.reader)["products"], a.spec, catalogs["local_name"]),
        conform.conform_products(read_source_b(b.reader)["items"], b.spec, catalogs["english_name"]),
    ])
    good = judged.where("not rejected")
    assert rows(good, "source_system", "source_product_id", "category") == [
        ("AA", "1", "INTERNET"), ("BB", "1", "INTERNET")]
    assert {r.reason_code for r in judged.where("rejected").collect()} == {"unknown_category"}


def test_unknown_product_name_falls_through(spark, catalogs):
    a, b = feeds(source_frames(spark))
    names = conform.conform_products(read_source_a(a.reader)["products"], a.spec, catalogs["local_name"])
    assert rows(names, "source_product_id", "product_name_en") == [("10", "Small Plan"), ("11", "باقة 9")]


def test_non_numeric_price_is_rejected(spark, catalogs):
    a, _ = feeds(source_frames(spark))
    raw = spark.createDataFrame([("1", "x", "Voice", "abc"), ("2", "x", "Voice", "7.5")],
                                "product_id STRING, product_name STRING, category STRING, unit_price STRING")
    judged = conform.conform_products(raw, a.spec, catalogs["local_name"])
    assert rows(judged, "source_product_id", "unit_price_syp", "reason_code") == [
        ("1", None, "invalid_price"), ("2", Decimal("7.50"), None)]


@pytest.fixture
def dims(spark, warehouse):
    return {
        "dim_customer": spark.createDataFrame([(7, "AA", "1")], "customer_sk LONG, source_system STRING, source_customer_id STRING"),
        "dim_product": spark.createDataFrame([(8, "AA", "10")], "product_sk LONG, source_system STRING, source_product_id STRING"),
        **{k: warehouse.tables()[k] for k in ("dim_company", "dim_date")},
    }


def sales(spark, dims, table, heavy=None):
    feed = feeds(source_frames(spark, orders=table))[0]
    return conform.conform_sales(read_source_a(feed.reader)["orders"], feed.spec, dims["dim_customer"],
                                 dims["dim_product"], dims["dim_company"], dims["dim_date"], heavy)


def test_order_rules(spark, dims):
    import datetime as dt

    judged = sales(spark, dims, [
        ("ok", 1, 10, 2, 100, 200, DAY),
        ("both", 9, 99, 2, 100, 200, DAY),
        ("product", 1, 99, 2, 100, 200, DAY),
        ("date", 1, 10, 2, 100, 200, dt.datetime(1999, 1, 1)),
        ("zero", 1, 10, 0, 100, 0, DAY),
        ("null-customer", None, 10, 2, 100, 200, DAY),
        ("null-quantity", 1, 10, None, 100, 200, DAY),
        ("total", 1, 10, 2, 100, 201, DAY),
        ("bad-total", 9, 10, 2, 100, 201, DAY),
    ])
    assert {r.source_order_id: (r.reason_code, r.rejected) for r in judged.collect()} == {
        "ok": (None, False),
        "both": ("no_customer", True),
        "product": ("no_product", True),
        "date": ("date_not_in_calendar", True),
        "zero": ("invalid_quantity", True),
        "null-customer": ("no_customer", True),
        "null-quantity": ("invalid_quantity", True),
        "total": ("inconsistent_stored_total", False),
        "bad-total": ("no_customer", True),
    }


def test_wrong_total_is_loaded_and_reported(spark, dims):
    judged = sales(spark, dims, [("o", 1, 10, 2, 100, 201, DAY)])
    good, bad = conform.split_quarantine(judged)
    assert rows(good, "source_order_id", "total_amount_syp") == [("o", Decimal("200.00"))]
    assert rows(bad, "source_table", "reason") == [
        ("orders", "inconsistent_stored_total: stored=201, computed=200")]


@pytest.mark.parametrize("heavy", [None, {"customer_id": {"1": 5}, "product_id": {"10": 3}}])
def test_hot_and_missing_keys_resolve_alike(spark, dims, heavy):
    table = [(f"o{i}", [1, 1, None, 2][i % 4], 10, 1, 5, 5, DAY) for i in range(200)]
    plain = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with large dimensions
    try:
        judged = sales(spark, dims, table, heavy)
        counts = {r[0]: r[1] for r in judged.groupBy("customer_sk").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", plain)
    assert counts == {7: 100, None: 100}


def test_good_and_rejected_make_up_the_input(spark, city_maps):
    table = [(i, "n", "+9639" + "1" * (8 if i % 3 else 7), 1 + i % 3, DAY) for i in range(60)]
    judged = customers(spark, city_maps, table)
    good, bad = conform.split_quarantine(judged)
    assert good.count() + bad.count() == len(table)


def test_since_reaches_the_scan(spark, tmp_path):
    frames = source_frames(spark)
    frames["orders"].write.parquet(str(tmp_path / "orders"))
    stored = spark.read.parquet(str(tmp_path / "orders"))
    kept = since_filter(stored, "order_date", DAY.date().replace(month=4))
    assert rows(kept, "order_id") == [("o2",)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(order_date), GreaterThanOrEqual(order_date" in plan


def test_validate_total_of_null(spark):
    df = spark.createDataFrame([(None, Decimal("5.00")), (5, Decimal("5.00"))], "s LONG, c DECIMAL(14,2)")
    found = [r[0] for r in df.select(first_failure([conform.validate_total(F.col("s"), F.col("c"))])).collect()]
    assert found == ["inconsistent_stored_total", None]
