"""The analytical questions. Every function takes warehouse tables and returns a
DataFrame with exact decimals.

The facts are always combined by their own keys first (customer, product, or day
and company) and only the combined rows meet a dimension. The combination starts
before the shuffle, so no hot key travels whole, and the joins see one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions.calendar import month_label, month_start
from tallyloom.functions.money import millions, money_avg, pct
from tallyloom.operators.ranking import ROWS_PER_RANGE, rank_small, top_fraction_sum, top_k

AMOUNT = "total_amount_syp"


def _sales(*extra: Column) -> list[Column]:
    return [F.sum(AMOUNT).alias("_sales"), F.count(F.lit(1)).alias("_orders"), *extra]


# -- companies -----------------------------------------------------------
def company_totals(fact: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Sales, orders and share of all sales per company."""
    sums = fact.groupBy("company_sk").agg(*_sales()).join(dim_company, "company_sk")
    per_company = sums.groupBy("company_code", "company_name_en").agg(
        F.sum("_sales").alias("total_sales_syp"), F.sum("_orders").alias("order_count")
    )
    # one row per company: the window sees a handful of rows
    everything = F.sum("total_sales_syp").over(W.partitionBy())
    return per_company.withColumn("share_pct", pct(F.col("total_sales_syp"), everything)).orderBy(
        F.col("total_sales_syp").desc(), "company_code"
    )


def company_totals_with_customers(fact: DataFrame, dim_company: DataFrame) -> DataFrame:
    """``company_totals`` with distinct customers and the average order."""
    per_customer = fact.groupBy("company_sk", "customer_sk").agg(*_sales())
    sums = per_customer.groupBy("company_sk").agg(
        F.sum("_sales").alias("total_sales_syp"), F.sum("_orders").alias("order_count"),
        F.count("customer_sk").alias("customer_count"),
    )
    everything = F.sum("total_sales_syp").over(W.partitionBy())
    return (
        sums.join(dim_company, "company_sk")
        .select("company_code", "company_name_en", "total_sales_syp", "order_count", "customer_count")
        .withColumns({
            "share_pct": pct(F.col("total_sales_syp"), everything),
            "avg_order_syp": money_avg(F.col("total_sales_syp"), F.col("order_count")),
        })
        .orderBy(F.col("total_sales_syp").desc(), "company_code")
    )


def company_comparison(fact: DataFrame, dim_company: DataFrame, dim_customer: DataFrame,
                       dim_product: DataFrame) -> DataFrame:
    """Revenue, orders, customers, averages, cities and categories per company. Each
    distinct count is a count of already combined rows."""
    per_customer = fact.groupBy("company_sk", "customer_sk").agg(*_sales())
    per_city = per_customer.join(dim_customer.select("customer_sk", "city"), "customer_sk").groupBy(
        "company_sk", "city"
    ).agg(F.sum("_sales").alias("_sales"), F.sum("_orders").alias("_orders"),
          F.count(F.lit(1)).alias("_customers"))
    base = per_city.groupBy("company_sk").agg(
        F.sum("_sales").alias("total_revenue_syp"), F.sum("_orders").alias("order_count"),
        F.sum("_customers").alias("customer_count"), F.count("city").alias("cities_served"),
    )
    categories = (
        fact.select("company_sk", "product_sk").distinct()
        .join(dim_product.select("product_sk", "category"), "product_sk")
        .select("company_sk", "category").distinct()
        .groupBy("company_sk").agg(F.count("category").alias("categories_sold"))
    )
    total = F.col("total_revenue_syp")
    return (
        base.join(categories, "company_sk").join(dim_company, "company_sk")
        .select(
            "company_code", "company_name_en", "total_revenue_syp", "order_count", "customer_count",
            money_avg(total, F.col("order_count")).alias("avg_order_value_syp"),
            "cities_served", "categories_sold",
            money_avg(total, F.col("customer_count")).alias("revenue_per_customer_syp"),
        )
        .orderBy(total.desc(), "company_code")
    )


# -- customers -----------------------------------------------------------
def top_customers(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame,
                  k: int = 20) -> DataFrame:
    """The k customers with the highest spend; ties in key order."""
    per_customer = fact.groupBy("customer_sk").agg(
        F.sum(AMOUNT).alias("total_spent_syp"), F.count(F.lit(1)).alias("order_count"),
        F.min("date_sk").alias("_first"), F.max("date_sk").alias("_last"),
    )
    best = top_k(per_customer, k, [F.col("total_spent_syp").desc(), F.col("customer_sk")])
    first = dim_date.select(F.col("date_sk").alias("_first"), F.col("full_date").alias("first_order_date"))
    last = dim_date.select(F.col("date_sk").alias("_last"), F.col("full_date").alias("last_order_date"))
    return (
        best.join(dim_customer.select("customer_sk", "full_name", "source_system", "city"), "customer_sk")
        .join(first, "_first").join(last, "_last")
        .select(
            "customer_sk", "full_name", "source_system", "city", "total_spent_syp", "order_count",
            money_avg(F.col("total_spent_syp"), F.col("order_count")).alias("avg_order_syp"),
            "first_order_date", "last_order_date",
        )
        .orderBy(F.col("total_spent_syp").desc(), "customer_sk")
    )


# -- cities --------------------------------------------------------------
def city_sales(fact: DataFrame, dim_customer: DataFrame, dim_company: DataFrame,
               codes: Sequence[str]) -> DataFrame:
    """Sales per city of the customer, one column per company, with distinct
    customers and orders."""
    company = dim_company.select("company_sk", "company_code")  # one row per company
    split = {c: F.when(F.col("company_code") == c, F.col(AMOUNT)).otherwise(0) for c in codes}
    combined = fact.groupBy("customer_sk", "company_sk").agg(
        F.sum(AMOUNT).alias(AMOUNT), F.count(F.lit(1)).alias("_orders"))
    # one row per customer, so counting rows counts distinct customers
    one_row = combined.join(company, "company_sk").groupBy("customer_sk").agg(
        *[F.sum(col).alias(f"{c.lower()}_syp") for c, col in split.items()],
        F.sum(AMOUNT).alias("total_syp"), F.sum("_orders").alias("_orders"),
    )
    return (
        one_row.join(dim_customer.select("customer_sk", "city"), "customer_sk")
        .groupBy("city")
        .agg(
            *[F.sum(f"{c.lower()}_syp").alias(f"{c.lower()}_syp") for c in codes],
            F.sum("total_syp").alias("total_syp"),
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("_orders").alias("order_count"),
        )
        .orderBy(F.col("total_syp").desc(), "city")
    )


def city_millions(cities: DataFrame, codes: Sequence[str], names: DataFrame) -> DataFrame:
    """City table with amounts in millions and the local name from (key, value)
    ``names``; a city without one keeps its own."""
    local = names.select(F.col("key").alias("city"), F.col("value").alias("_local"))
    return cities.join(local, "city", "left").withColumns({
        **{f"{c.lower()}_m": millions(F.col(f"{c.lower()}_syp")) for c in codes},
        "total_m": millions(F.col("total_syp")),
        "city_ar": F.coalesce("_local", "city"),
    }).drop("_local")


def governorates(cities: DataFrame, regions: DataFrame, codes: Sequence[str]) -> DataFrame:
    """One row per governorate of ``regions`` (id, name, ar, city), zero without sales.
    Cities outside the list count in the national total only."""
    amounts = [f"{c.lower()}_m" for c in codes] + ["total_m"]
    # windows over one row per city
    summed = cities.withColumn("_sum", F.sum("total_syp").over(W.partitionBy()))
    shown = regions.join(summed, "city", "left").withColumn(
        "_national", F.max("_sum").over(W.partitionBy()))
    total = F.coalesce(F.col("total_syp"), F.lit(0))
    rows = shown.select(
        "id", "name", "ar",
        *[F.coalesce(millions(F.col(a[:-1] + "syp")), F.lit(0.0)).alias(a) for a in amounts],
        F.coalesce("unique_customers", F.lit(0)).alias("customers"),
        F.coalesce("order_count", F.lit(0)).alias("orders"),
        F.coalesce(money_avg(total, F.col("order_count")), F.lit(0)).alias("avg_order"),
        F.coalesce(pct(total, F.coalesce("_national", F.lit(0))), F.lit(0)).alias("share_pct"),
    )
    return rank_small(rows, [F.col("total_m").desc(), F.col("id")])


def city_bars(cities: DataFrame, code: str, k: int = 8) -> DataFrame:
    """The k largest cities: length in percent of the largest, and the share of one
    company in percent (50 for a city without sales)."""
    best = top_k(cities, k, [F.col("total_syp").desc(), F.col("city")])
    largest = F.max("total_syp").over(W.partitionBy())  # k rows
    return best.withColumn("_max", largest).select(
        "city",
        F.coalesce(pct(F.col("total_syp"), F.col("_max")), F.lit(0)).alias("bar_pct"),
        F.coalesce(pct(F.col(f"{code.lower()}_syp"), F.col("total_syp")), F.lit(50)).alias("split_pct"),
    )


def governorate_bars(governorates: DataFrame, code: str) -> DataFrame:
    """A bar for every governorate, those without sales too: length in percent of the
    largest, and the share of one company in percent (50 without sales)."""
    def amount(name: str) -> Column:
        return F.round(F.col(name) * 1e6, 2).cast("decimal(28,2)")

    largest = F.max(amount("total_m")).over(W.partitionBy())  # one row per governorate
    return governorates.withColumn("_max", largest).select(
        "id", "name", "rank",
        F.coalesce(pct(amount("total_m"), F.col("_max")), F.lit(0)).alias("bar_pct"),
        F.coalesce(pct(amount(f"{code.lower()}_m"), amount("total_m")), F.lit(50)).alias("split_pct"),
    )


def governorate_panel(governorates: DataFrame) -> DataFrame:
    """One row: revenue in millions, customers, region with the highest revenue."""
    return governorates.agg(
        F.sum("total_m").alias("total_m"), F.sum("customers").alias("total_customers"),
        F.min_by("name", "rank").alias("top_region"),
    )


# -- months --------------------------------------------------------------
def monthly_sales(fact: DataFrame, dim_date: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Sales and orders per month and company."""
    daily = fact.groupBy("date_sk", "company_sk").agg(*_sales())
    return (
        daily.join(dim_date.select("date_sk", "year", "month"), "date_sk")
        .join(dim_company.select("company_sk", "company_code"), "company_sk")
        .groupBy("year", "month", "company_code")
        .agg(F.sum("_sales").alias("sales_syp"), F.sum("_orders").alias("order_count"))
        .orderBy("company_code", "year", "month")
    )


def monthly_change(monthly: DataFrame) -> DataFrame:
    """Add the sales of the previous month with sales and the change in percent."""
    # one row per month: the window is as long as the calendar
    months = W.partitionBy("company_code").orderBy("year", "month")
    previous = F.lag("sales_syp").over(months)
    return monthly.withColumn("prev_month_syp", previous).withColumn(
        "mom_change_pct", pct(F.col("sales_syp") - F.col("prev_month_syp"), F.col("prev_month_syp"))
    ).orderBy("company_code", "year", "month")


def monthly_wide(monthly: DataFrame, codes: Sequence[str]) -> DataFrame:
    """One row per month with a column in millions per company. A company without
    any sales is 0 throughout; a month without sales of a company is null."""
    wide = monthly.groupBy("year", "month").pivot("company_code", list(codes)).agg(F.sum("sales_syp"))
    present = {c: F.count(F.col(c)).over(W.partitionBy()) > 0 for c in codes}  # one row per month
    period = month_start(F.col("year"), F.col("month"))
    return wide.select(
        "year", "month", period.alias("period"), month_label(period).alias("label"),
        *[F.when(present[c], millions(F.col(c))).otherwise(0.0).alias(c.lower()) for c in codes],
    ).orderBy("period")


# -- indicators ----------------------------------------------------------
def decision_indicators(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame,
                        per_customer: DataFrame | None = None,
                        rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row of headline numbers: revenue share of the top tenth of the customers,
    cities, customers, the last three months against the three before, total.

    ``per_customer`` (customer_sk, customer_total) is read several times; pass
    ``customer_totals`` stored by ``runtime.materialize``.
    """
    if per_customer is None:
        per_customer = customer_totals(fact)
    top = top_fraction_sum(per_customer, "customer_total", "customer_sk", 10, "_top", rows_per_range)
    total = per_customer.agg(F.sum("customer_total").alias("total_revenue_syp"))
    daily = fact.groupBy("date_sk").agg(F.sum(AMOUNT).alias("_sales")).join(
        dim_date.select("date_sk", "full_date"), "date_sk"
    )
    as_of = F.max("full_date").over(W.partitionBy())  # one row per day
    three, six = F.add_months("_as_of", -3), F.add_months("_as_of", -6)
    recent = F.col("full_date") > three
    before = (F.col("full_date") <= three) & (F.col("full_date") > six)
    trend = daily.withColumn("_as_of", as_of).agg(
        F.sum(F.when(recent, F.col("_sales")).otherwise(0)).alias("last_3m_revenue_syp"),
        F.sum(F.when(before, F.col("_sales")).otherwise(0)).alias("prior_3m_revenue_syp"),
    )
    base = dim_customer.groupBy("city").agg(F.count(F.lit(1)).alias("_n")).agg(
        F.count("city").alias("cities_served"), F.coalesce(F.sum("_n"), F.lit(0)).alias("total_customers")
    )
    last, prior = F.col("last_3m_revenue_syp"), F.col("prior_3m_revenue_syp")
    return top.crossJoin(total).crossJoin(trend).crossJoin(base).select(
        pct(F.col("_top"), F.col("total_revenue_syp")).alias("top_10pct_customer_revenue_share_pct"),
        "cities_served", "total_customers",
        pct(last - prior, prior).alias("qoq_growth_pct"),
        "last_3m_revenue_syp", "prior_3m_revenue_syp", "total_revenue_syp",
    )


def customer_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_sk").agg(F.sum(AMOUNT).alias("customer_total"))


def dashboard_indicators(indicators: DataFrame) -> DataFrame:
    """The six indicators a dashboard shows."""
    return indicators.select(
        F.col("top_10pct_customer_revenue_share_pct").alias("top_10pct_share"),
        "cities_served", "total_customers", "qoq_growth_pct", "last_3m_revenue_syp",
        "total_revenue_syp",
    )


def headline(companies: DataFrame, indicators: DataFrame, segments: DataFrame) -> DataFrame:
    """One row: total, orders, average order, at-risk and champions + loyal customers."""

    def size(*names: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("segment").isin(*names), F.col("count"))), F.lit(0))

    orders = companies.agg(F.sum("order_count").alias("total_orders"))
    groups = segments.agg(size("At Risk").alias("at_risk_count"),
                          size("Champions", "Loyal").alias("champ_loyal_count"))
    return indicators.select("total_revenue_syp").crossJoin(orders).crossJoin(groups).select(
        "total_revenue_syp", "total_orders",
        F.coalesce(money_avg(F.col("total_revenue_syp"), F.col("total_orders")), F.lit(0))
        .alias("avg_order_syp"),
        "at_risk_count", "champ_loyal_count",
    )


# -- products ------------------------------------------------------------
def products(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Average order total (whole units) and orders per canonical product, all
    companies together."""
    per_product = fact.groupBy("product_sk").agg(*_sales())
    return (
        per_product.join(dim_product.select("product_sk", "product_name_en", "category"), "product_sk")
        .groupBy(F.col("product_name_en").alias("name"), "category")
        .agg(money_avg(F.sum("_sales"), F.sum("_orders"), 0).alias("avg_order_value_syp"),
             F.sum("_orders").alias("order_count"))
    )


def cheapest_products(products: DataFrame, k: int = 12) -> DataFrame:
    """The k products with the lowest average order."""
    return top_k(products, k, [F.col("avg_order_value_syp"), F.col("name"), F.col("category")])


# -- distinct customers of any range, approximately ------------------------------
def customer_sketches(fact: DataFrame, lg_k: int = 14) -> DataFrame:
    """(date_sk, company_sk, sketch): the customers of each day and company as a HyperLogLog
    sketch of fixed size. Store it once; ranges are then counted without the facts."""
    return fact.groupBy("date_sk", "company_sk").agg(F.hll_sketch_agg("customer_sk", F.lit(lg_k)).alias("sketch"))


def approximate_customers(sketches: DataFrame, first: int | None = None, last: int | None = None,
                          by: Sequence[str] = ("company_sk",)) -> DataFrame:
    """Customers between two days, both included, from merged sketches: opt-in where an
    exact count is too dear. The relative error is 1.04 / sqrt(2**lg_k) as a standard
    deviation, 0.8% for the default size; the exact reports stay the default."""
    days = sketches.where(F.lit(True) if first is None else F.col("date_sk") >= first).where(
        F.lit(True) if last is None else F.col("date_sk") <= last)
    return days.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_customers"))
