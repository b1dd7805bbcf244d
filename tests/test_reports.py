import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.functions.calendar import dim_date
from tallyloom.operators import checks
from tallyloom.operators.dims import dim_company
from tallyloom.plans import reports
from tallyloom.runtime import materialize
from tallyloom.specs import source_a

CODES = ["AA", "BB"]


@pytest.fixture(scope="module")
def companies(spark):
    return dim_company(spark, [("AA", "أ", "Company A"), ("BB", "ب", "Company B")])


@pytest.fixture(scope="module")
def calendar(spark):
    return dim_date(spark, dt.date(2024, 1, 1), dt.date(2025, 12, 31))


def facts(spark, table):
    """(date, customer, product, company, amount) as facts with quantity 1."""
    full = [(d, c, p, co, 1, Decimal(a), Decimal(a), str(i)) for i, (d, c, p, co, a) in enumerate(table)]
    return spark.createDataFrame(
        full, "date_sk INT, customer_sk LONG, product_sk LONG, company_sk INT, quantity INT, "
        "unit_price_syp DECIMAL(14,2), total_amount_syp DECIMAL(14,2), source_order_id STRING")


def customers(spark, cities):
    return spark.createDataFrame(
        [(sk, f"n{sk}", "AA", c) for sk, c in cities.items()],
        "customer_sk LONG, full_name STRING, source_system STRING, city STRING")


def test_shares_add_up(spark, companies):
    fact = facts(spark, [(20240101, 1, 1, 1, 100), (20240101, 2, 1, 2, 200)])
    got = reports.company_totals(fact, companies)
    assert rows(got, "company_code", "order_count", "share_pct") == [
        ("AA", 1, Decimal("33.33")), ("BB", 1, Decimal("66.67"))]
    more = reports.company_totals_with_customers(fact, companies)
    assert rows(more, "company_code", "customer_count", "avg_order_syp") == [
        ("AA", 1, Decimal("100.00")), ("BB", 1, Decimal("200.00"))]


def test_tie_at_the_last_place(spark, calendar):
    fact = facts(spark, [(20240101 + i % 9, i, 1, 1, 50) for i in range(30)])
    top = reports.top_customers(fact, customers(spark, {i: "North" for i in range(30)}), calendar)
    assert [r.customer_sk for r in top.collect()] == list(range(20))
    assert top.first().first_order_date == dt.date(2024, 1, 1)


def test_previous_month_is_the_previous_row(spark, companies, calendar):
    fact = facts(spark, [(20240105, 1, 1, 1, 0), (20240310, 1, 1, 1, 50), (20240411, 1, 1, 1, 75),
                         (20240412, 1, 1, 2, 9)])
    change = reports.monthly_change(reports.monthly_sales(fact, calendar, companies))
    assert rows(change.where("company_code = 'AA'"), "month", "prev_month_syp", "mom_change_pct") == [
        (1, None, None), (3, Decimal("0.00"), None), (4, Decimal("50.00"), Decimal("50.00"))]
    wide = reports.monthly_wide(reports.monthly_sales(fact, calendar, companies), ["AA", "BB", "CC"])
    assert rows(wide, "label", "aa", "bb", "cc") == [
        ("Apr 24", 75e-6, 9e-6, 0.0), ("Jan 24", 0.0, None, 0.0), ("Mar 24", 50e-6, None, 0.0)]


def indicators(spark, calendar, table, cities):
    return reports.decision_indicators(facts(spark, table), customers(spark, cities), calendar).first()


def test_last_three_months_end_on_a_shorter_month(spark, calendar):
    # three months before 31 May is 29 February: that day still belongs to the quarter before
    got = indicators(spark, calendar, [
        (20240531, 1, 1, 1, 10), (20240301, 1, 1, 1, 20), (20240229, 1, 1, 1, 40), (20231130, 1, 1, 1, 80),
        (20240101, 1, 1, 1, 5)], {1: "North", 2: "South"})
    assert (got.last_3m_revenue_syp, got.prior_3m_revenue_syp) == (30, 45)
    assert (got.cities_served, got.total_customers) == (2, 2)
    assert got.qoq_growth_pct == Decimal("-33.33")


def test_growth_without_a_quarter_before_is_null(spark, calendar):
    got = indicators(spark, calendar, [(20240531, i, 1, 1, 10) for i in range(11)], {0: "North"})
    assert got.qoq_growth_pct is None
    assert got.top_10pct_customer_revenue_share_pct == Decimal("18.18")  # two of eleven


def test_cities_and_governorates(spark, companies):
    fact = facts(spark, [(20240101, 1, 1, 1, 100), (20240102, 1, 1, 1, 100), (20240101, 2, 1, 2, 300),
                         (20240101, 3, 1, 2, 500)])
    cities = reports.city_sales(fact, customers(spark, {1: "North", 2: "North", 3: "Village"}), companies, CODES)
    assert rows(cities) == [
        ("North", Decimal(200), Decimal(300), Decimal(500), 2, 3),
        ("Village", Decimal(0), Decimal(500), Decimal(500), 1, 1)]
    regions = spark.createDataFrame([("n", "North", "ش", "North"), ("e", "Empty", "خ", "Empty")],
                                    "id STRING, name STRING, ar STRING, city STRING")
    gov = reports.governorates(cities, regions, CODES)
    assert rows(gov, "id", "customers", "orders", "avg_order", "share_pct", "rank") == [
        ("e", 0, 0, Decimal(0), Decimal(0), 2), ("n", 2, 3, Decimal("166.67"), Decimal("50.00"), 1)]
    panel = reports.governorate_panel(gov).first()
    assert (panel.total_customers, panel.top_region) == (2, "North")
    bars = reports.city_bars(cities, "AA")
    assert rows(bars) == [("North", Decimal("100.00"), Decimal("40.00")), ("Village", Decimal("100.00"), Decimal("0.00"))]
    names = spark.createDataFrame([("North", "شمال")], "key STRING, value STRING")
    assert rows(reports.city_millions(cities, CODES, names), "city", "city_ar", "total_m") == [
        ("North", "شمال", 0.0005), ("Village", "Village", 0.0005)]


def test_split_is_even_without_sales(spark, companies):
    fact = facts(spark, [(20240101, 1, 1, 1, 0), (20240101, 2, 1, 1, 5)])
    cities = reports.city_sales(fact, customers(spark, {1: "North", 2: "South"}), companies, CODES)
    assert rows(reports.city_bars(cities, "AA"), "city", "bar_pct", "split_pct") == [
        ("North", Decimal(0), Decimal(50)), ("South", Decimal(100), Decimal(100))]


def test_comparison_counts_distinct(spark, companies):
    fact = facts(spark, [(20240101, 1, 1, 1, 10), (20240101, 1, 2, 1, 20), (20240101, 2, 2, 1, 30),
                         (20240101, 3, 3, 2, 40)])
    products = spark.createDataFrame([(1, "a", "VOICE"), (2, "b", "BUNDLE"), (3, "c", "VOICE")],
                                     "product_sk LONG, product_name_en STRING, category STRING")
    people = customers(spark, {1: "North", 2: "North", 3: "South"})
    got = reports.company_comparison(fact, companies, people, products)
    assert rows(got, "company_code", "order_count", "customer_count", "cities_served", "categories_sold",
                "revenue_per_customer_syp") == [("AA", 3, 2, 1, 2, Decimal("30.00")), ("BB", 1, 1, 1, 1, Decimal("40.00"))]
    table = reports.products(fact, products)
    assert rows(reports.cheapest_products(table, 2), "name", "avg_order_value_syp", "order_count") == [
        ("a", Decimal(10), 1), ("b", Decimal(25), 2)]


def test_headline(spark, companies):
    fact = facts(spark, [(20240101, 1, 1, 1, 10), (20240101, 2, 1, 1, 21)])
    totals = reports.company_totals(fact, companies)
    indicators = fact.agg(F.sum("total_amount_syp").alias("total_revenue_syp"))
    segments = spark.createDataFrame([("At Risk", 3), ("Loyal", 2), ("Champions", 1)], "segment STRING, count LONG")
    assert tuple(reports.headline(totals, indicators, segments).first()) == (31, 2, Decimal("15.50"), 3, 3)


def test_checks_find_what_is_wrong(spark, companies, calendar):
    fact = facts(spark, [(20240101, 1, 1, 1, 10), (19990101, 1, 1, 1, 20), (20240101, 1, 1, 7, 40)]).withColumn(
        "quantity", F.when(F.col("company_sk") == 7, 2).otherwise(1))
    tables = {"fact_sales": fact, "dim_company": companies, "dim_date": calendar}
    got = {r.check: (r.passed, r.measured) for r in checks.run_checks(tables).collect()}
    assert got == {
        "totals_by_company": (False, 40.0), "totals_by_month": (False, 60.0), "date_sk_resolves": (False, 1.0),
        "company_sk_resolves": (False, 1.0), "total_is_quantity_times_price": (False, 1.0),
        "dim_company_rows": (True, 2.0), "dim_date_rows": (False, 731.0)}
    clean = {**tables, "fact_sales": fact.where("date_sk > 20000000 and company_sk < 7")}
    assert {r.check for r in checks.run_checks(clean).where("not passed").collect()} == {"dim_date_rows"}


def test_profile_of_a_source(spark):
    spec = source_a("AA")
    tables = {
        "cities": spark.createDataFrame([(1, "م")], "city_id INT, city_ar STRING"),
        "customers": spark.createDataFrame([(1, "+963911111111"), (2, "0911111111")], "customer_id INT, phone STRING"),
        "products": spark.createDataFrame([("باقة", "Internet", 5), ("Plan", "internet", 5)],
                                          "product_name STRING, category STRING, unit_price INT"),
        "orders": spark.createDataFrame([(5,)], "total_price INT"),
    }
    got = {r.dimension: r.observed or r.rate for r in checks.contract_profile(tables, spec, "cities").collect()}
    assert got == {
        "table_naming": "customers,products,orders", "key_type": "int", "city_column": "cities.city_ar:string",
        "price_type": "int", "total_column": "int", "date_shape": "missing", "phone_format": 0.5,
        "category_case": 0.5, "arabic_names": 0.5, "ascii_names": 0.5}


def test_sketches_of_customers_are_merged_for_any_range(spark):
    fact = spark.range(60_000).select(
        (20240101 + F.col("id") % 20).cast("int").alias("date_sk"), (F.col("id") % 2).cast("int").alias("company_sk"),
        (F.xxhash64("id") % 9000).alias("customer_sk"))
    sketches = materialize(reports.customer_sketches(fact), "sketches")
    assert sketches.count() == 20  # even days have one company, odd ones the other
    for first, last in ((None, None), (20240103, 20240109), (20240120, 20240120)):
        chosen = fact.where(F.col("date_sk").between(first or 0, last or 99999999))
        exact = {r[0]: r[1] for r in chosen.groupBy("company_sk").agg(F.countDistinct("customer_sk")).collect()}
        got = {r[0]: r[1] for r in reports.approximate_customers(sketches, first, last).collect()}
        assert got.keys() == exact.keys()
        assert all(abs(got[c] - n) <= 0.04 * n for c, n in exact.items())  # five standard deviations
