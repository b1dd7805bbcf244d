"""Quality checks of the warehouse, and a profile of the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.facts import orphans
from tallyloom.runtime import literal_rows, materialize

AMOUNT = "total_amount_syp"
TOLERANCE = 0.01


def _result(df: DataFrame, name: str, passed: Column, measured: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check"), passed.alias("passed"),
                     measured.cast("double").alias("measured"))


def _zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def fact_profile(fact: DataFrame) -> DataFrame:
    """Facts combined per day and company: amount, rows, and rows whose total is not
    quantity * price. One scan serves every check of the facts."""
    gap = F.abs(F.col(AMOUNT) - F.col("quantity") * F.col("unit_price_syp"))
    return fact.groupBy("date_sk", "company_sk").agg(
        F.sum(AMOUNT).alias("_sales"), F.count(F.lit(1)).alias("_n"),
        F.count_if(gap > F.lit(TOLERANCE).cast("decimal(10,4)")).alias("_off"),
    )


def _matched(profile: DataFrame, dims: dict[str, DataFrame], name: str) -> DataFrame:
    """Does the total over joined rows equal the total over all rows?"""
    found = F.lit(True)
    for key, dim in dims.items():
        flag = f"_has_{key}"
        profile = profile.join(dim.select(key).withColumn(flag, F.lit(True)), key, "left")
        found &= F.coalesce(F.col(flag), F.lit(False))
    sums = profile.agg(F.sum("_sales").alias("_raw"), F.sum(F.when(found, F.col("_sales"))).alias("_found"))
    return _result(sums, name, F.col("_raw").eqNullSafe(F.col("_found")),
                   _zero_if_null("_raw") - _zero_if_null("_found"))


def _resolved(profile: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    missing = orphans(profile, dim, key).agg(F.sum("_n").alias("_n"))
    return _result(missing, f"{key}_resolves", _zero_if_null("_n") == 0, _zero_if_null("_n"))


def _consistent(profile: DataFrame) -> DataFrame:
    off = profile.agg(F.sum("_off").alias("_off"))
    return _result(off, "total_is_quantity_times_price", _zero_if_null("_off") == 0, _zero_if_null("_off"))


def totals_by_company(fact: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Per-company totals add up to the raw total; measured is the difference."""
    return _matched(fact_profile(fact), {"company_sk": dim_company}, "totals_by_company")


def totals_by_month(fact: DataFrame, dim_date: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Monthly totals add up to the raw total; fails if the calendar lacks a date."""
    dims = {"date_sk": dim_date, "company_sk": dim_company}
    return _matched(fact_profile(fact), dims, "totals_by_month")


def no_orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Every fact key has a dimension row; measured is the number of facts without."""
    return _resolved(fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), dim, key)


def total_consistent(fact: DataFrame) -> DataFrame:
    """Total within 0.01 of quantity * unit price; measured counts the others."""
    return _consistent(fact_profile(fact))


def row_count_is(df: DataFrame, name: str, n: int) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("_n"))
    return _result(counted, name, F.col("_n") == n, F.col("_n"))


def row_count_at_least(df: DataFrame, name: str, n: int) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("_n"))
    return _result(counted, name, F.col("_n") >= n, F.col("_n"))


def run_checks(tables: dict[str, DataFrame], companies: int = 2, min_days: int = 1825) -> DataFrame:
    """All checks as (check, passed, measured)."""
    # no longer than days times companies
    profile = materialize(fact_profile(tables["fact_sales"]), "fact-profile")
    dates, companies_table = tables["dim_date"], tables["dim_company"]
    parts = [
        _matched(profile, {"company_sk": companies_table}, "totals_by_company"),
        _matched(profile, {"date_sk": dates, "company_sk": companies_table}, "totals_by_month"),
        _resolved(profile, dates, "date_sk"),
        _resolved(profile, companies_table, "company_sk"),
        _consistent(profile),
        row_count_is(companies_table, "dim_company_rows", companies),
        row_count_at_least(dates, "dim_date_rows", min_days),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# -- contract profile ----------------------------------------------------
ARABIC = "[\\u0600-\\u06FF]"
NOT_ASCII = "[^\\x00-\\x7F]"
PROFILE = T.StructType([
    T.StructField("dimension", T.StringType()), T.StructField("observed", T.StringType()),
    T.StructField("rate", T.DoubleType()),
])


def _type_name(df: DataFrame | None, column: str) -> str:
    return df.schema[column].dataType.simpleString() if df is not None and column in df.columns else "missing"


def _share(condition: Column) -> Column:
    return F.round(F.avg(F.when(condition, 1.0).otherwise(0.0)), 6)


def contract_profile(tables: dict[str, DataFrame], spec, city_table: str) -> DataFrame:
    """(dimension, observed, rate): nine traits in which sources differ. Names and
    types come from the schemas, rates from all rows, one pass per table."""
    customers, products, orders = spec.customers, spec.products, spec.orders
    spark = tables[customers.table].sparkSession
    schema_part = [
        ("table_naming", ",".join(t for t in (customers.table, products.table, orders.table) if t in tables)),
        ("key_type", _type_name(tables.get(customers.table), customers.id)),
        ("city_column", f"{city_table}.{customers.city}:{_type_name(tables.get(city_table), customers.city)}"),
        ("price_type", _type_name(tables.get(products.table), products.price)),
        ("total_column", _type_name(tables.get(orders.table), orders.total or "")),
        ("date_shape", _type_name(tables.get(orders.table), orders.date)),
    ]
    fixed = literal_rows(spark, [(n, v, None) for n, v in schema_part], PROFILE)
    phones = F.regexp_replace(customers.phone, r"(?U)\s+", "").rlike(customers.phone_rule.pattern)
    people = tables[customers.table].agg(_share(phones).alias("phone_format"))
    name = F.col(products.name)
    goods = tables[products.table].agg(
        _share(F.col(products.category).isin(list(products.categories))).alias("category_case"),
        _share(name.rlike(ARABIC)).alias("arabic_names"),
        _share(~name.rlike(NOT_ASCII)).alias("ascii_names"),
    )

    def rates(row: DataFrame) -> DataFrame:
        return row.unpivot([], row.columns, "dimension", "rate").select(
            "dimension", F.lit(None).cast("string").alias("observed"), "rate"
        )

    return fixed.unionByName(rates(people)).unionByName(rates(goods)).withColumn(
        "company_code", F.lit(spec.code)
    )


VERDICT = T.StructType([
    T.StructField("check", T.StringType()), T.StructField("passed", T.BooleanType()),
    T.StructField("rate_a", T.DoubleType()), T.StructField("rate_b", T.DoubleType())])


def contract_verdict(tables_a: dict[str, DataFrame], spec_a, city_a: str, tables_b: dict[str, DataFrame], spec_b,
                     city_b: str, time_b: str, least: float = 0.9) -> DataFrame:
    """(check, passed, rate_a, rate_b): do two sources differ in the nine agreed ways? A
    rate is the share of all rows in the agreed form; it has to reach ``least``, and the
    other source's form must not occur. Checks of names and types have no rates."""
    spark = next(iter(tables_a.values())).sparkSession
    own = [{s.customers.table, s.products.table, s.orders.table} for s in (spec_a, spec_b)]
    named = (own[0] <= set(tables_a) and own[1] <= set(tables_b)
             and not own[1] & set(tables_a) and not own[0] & set(tables_b))

    def kind(tables: dict[str, DataFrame], table: str, column: str) -> str:
        return _type_name(tables.get(table), column)

    whole = {"tinyint", "smallint", "int", "bigint"}
    fixed = {
        "table_naming": named,
        "key_type": kind(tables_a, spec_a.customers.table, spec_a.customers.id) in whole
        and kind(tables_b, spec_b.customers.table, spec_b.customers.id) == "string",
        "price_type": kind(tables_a, spec_a.products.table, spec_a.products.price) in whole
        and kind(tables_b, spec_b.products.table, spec_b.products.price).startswith("decimal"),
        "total_column": kind(tables_a, spec_a.orders.table, spec_a.orders.total or "") != "missing"
        and spec_b.orders.total is None,
        "date_shape": kind(tables_a, spec_a.orders.table, spec_a.orders.date) == "timestamp"
        and kind(tables_b, spec_b.orders.table, spec_b.orders.date) == "date"
        and kind(tables_b, spec_b.orders.table, time_b) != "missing",
    }

    def shares(tables: dict[str, DataFrame], spec, other, city_table: str, local: bool) -> DataFrame:
        """One row: of each trait the share in this source's form and in the other's."""
        def in_form(column: Column) -> Column:
            return column.rlike(ARABIC) if local else ~column.rlike(NOT_ASCII)

        def not_in_form(column: Column) -> Column:
            return ~column.rlike(NOT_ASCII) if local else column.rlike(ARABIC)

        def both(name: str, good: Column, bad: Column) -> list[Column]:
            return [_share(good).alias(name), _share(bad).alias(f"{name}_other")]

        city, product = F.col(spec.customers.city), F.col(spec.products.name)
        phone, category = F.regexp_replace(spec.customers.phone, r"(?U)\s+", ""), F.col(spec.products.category)
        return (
            tables[city_table].agg(*both("city_language", in_form(city), not_in_form(city)))
            .crossJoin(tables[spec.customers.table].agg(*both(
                "phone_format", phone.rlike(spec.customers.phone_rule.pattern), phone.rlike(other.customers.phone_rule.pattern))))
            .crossJoin(tables[spec.products.table].agg(
                *both("category_case", category.isin(list(spec.products.categories)), category.isin(list(other.products.categories))),
                *both("name_language", in_form(product), not_in_form(product))))
        )  # one row each

    traits = ["city_language", "phone_format", "category_case", "name_language"]
    a = shares(tables_a, spec_a, spec_b, city_a, True)
    b = shares(tables_b, spec_b, spec_a, city_b, False)
    sides = a.select(*[F.col(c).alias(f"a_{c}") for c in a.columns]).crossJoin(
        b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns]))
    measured = sides.select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("check"),
                 F.coalesce((F.col(f"a_{t}") >= least) & (F.col(f"b_{t}") >= least)
                            & (F.col(f"a_{t}_other") == 0) & (F.col(f"b_{t}_other") == 0), F.lit(False)).alias("passed"),
                 F.col(f"a_{t}").alias("rate_a"), F.col(f"b_{t}").alias("rate_b"))
        for t in traits])))
    return literal_rows(spark, [(n, p, None, None) for n, p in fixed.items()], VERDICT).unionByName(measured)
