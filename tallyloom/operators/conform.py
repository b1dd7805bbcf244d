"""Bring the rows of one source into the shape of the warehouse.

Every function returns all rows of its input. A row that breaks a rule carries
``reason_code``, ``reason`` and its original content as JSON; ``rejected`` tells
whether it is kept out of the warehouse (a wrong stored total is only reported).
The rules are tried in order and the first one broken gives the reason.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.calendar import date_sk
from tallyloom.functions.money import line_total, to_money
from tallyloom.functions.text import Rule, failure_message, first_failure, in_domain, map_value
from tallyloom.functions.text import phone_e164
from tallyloom.operators.lookup import salted_lookup, with_position
from tallyloom.schemas import CATEGORIES, CUSTOMER_ATTRIBUTES, CUSTOMER_KEY, FACT_COLUMNS
from tallyloom.schemas import PRODUCT_ATTRIBUTES, PRODUCT_KEY
from tallyloom.specs import SourceSpec

VERDICT = ["source_system", "source_table", "source_row", "reason_code", "reason", "rejected"]


def row_payload(df: DataFrame, columns: list[str]) -> Column:
    """The row as JSON text; dates, decimals and other non-JSON types as strings."""
    plain = {"string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double"}
    types = dict(df.dtypes)
    fields = [
        F.col(c) if types[c] in plain else F.col(c).cast("string").alias(c) for c in columns
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def map_column(df: DataFrame, mapping: DataFrame, column: str, alias: str) -> DataFrame:
    """Add ``alias``: the value mapped to ``column``, null where it is unknown.

    No hint: a mapping below Spark's broadcast threshold is broadcast, a bigger
    one is joined by shuffle.
    """
    lookup = mapping.select(F.col("key").alias("_key"), F.col("value").alias(alias))
    return df.join(lookup, F.col(column) == F.col("_key"), "left").drop("_key")


def _text(col: Column) -> Column:
    return F.concat(F.lit("'"), F.coalesce(col.cast("string"), F.lit("null")), F.lit("'"))


def _message(text: str, col: Column) -> Column:
    return F.concat(F.lit(text + ": "), _text(col))


def _judge(df: DataFrame, raw: list[str], spec: SourceSpec, table: str,
           rules: list[Rule], warnings: list[Rule] | None = None) -> DataFrame:
    judged = df.withColumn("_failure", first_failure(rules))
    code = F.col("_failure")
    if warnings:
        code = F.coalesce(code, first_failure(warnings))
    judged = judged.withColumn("reason_code", code)
    return judged.withColumns({
        "source_system": F.lit(spec.code),
        "source_table": F.lit(table),
        "source_row": F.when(F.col("reason_code").isNotNull(), row_payload(df, raw)),
        "reason": failure_message(F.col("reason_code"), rules + (warnings or [])),
        "rejected": F.col("_failure").isNotNull(),
    }).drop("_failure")


def conform_customers(raw: DataFrame, spec: SourceSpec, city_map: DataFrame,
                      trim_names: bool = False) -> DataFrame:
    """Customers of one source; the city is tested before the phone."""
    at = spec.customers
    mapped = map_column(raw, city_map, at.city, "_city").withColumn(
        "_phone", phone_e164(F.col(at.phone), at.phone_rule)
    )
    rules: list[Rule] = [
        (F.col("_city").isNull(), "unknown_city", _message("unknown city", F.col(at.city))),
        (F.col("_phone").isNull(), "invalid_phone",
         _message(f"invalid phone for {spec.code}", F.col(at.phone))),
        (F.col(at.id).isNull(), "null_id", F.lit("customer id is null")),
        (F.col(at.name).isNull(), "null_name", F.lit("customer name is null")),
        (F.col(at.signup).isNull(), "null_signup", F.lit("signup date is null")),
        (F.col(at.signup).try_cast("date").isNull(), "invalid_signup",
         _message("signup is no date", F.col(at.signup))),
    ]
    name = F.trim(at.name) if trim_names else F.col(at.name)
    return _judge(mapped, raw.columns, spec, at.table, rules).select(
        F.col(at.id).cast("string").alias("source_customer_id"),
        name.alias("full_name"),
        F.col("_phone").alias("phone_e164"),
        F.col("_city").alias("city"),
        F.col(at.signup).try_cast("date").alias("signup_date"),
        *VERDICT,
    )


def canonical_name(df: DataFrame, catalog: DataFrame, column: str) -> DataFrame:
    """Add ``product_name_en``; a name outside the catalog stays as it is."""
    mapped = map_column(df, catalog, column, "_canonical")
    return mapped.withColumn(
        "product_name_en", F.coalesce("_canonical", F.col(column))
    ).drop("_canonical")


def conform_products(raw: DataFrame, spec: SourceSpec, catalog: DataFrame) -> DataFrame:
    """Products of one source; category case must match the source exactly."""
    at = spec.products
    mapped = canonical_name(raw, catalog, at.name).withColumns({
        "_category": map_value(F.col(at.category), at.categories),
        "_price": to_money(F.col(at.price)),
    })
    rules: list[Rule] = [
        (F.col("_category").isNull(), "unknown_category",
         _message(f"unknown category for {spec.code}", F.col(at.category))),
        (F.col("_price").isNull(), "invalid_price", _message("invalid price", F.col(at.price))),
        (~in_domain(F.col("_category"), CATEGORIES), "category_not_in_domain",
         _message("category not in domain", F.col("_category"))),
        (F.col(at.id).isNull(), "null_id", F.lit("product id is null")),
        (F.col("product_name_en").isNull(), "null_name", F.lit("product name is null")),
    ]
    return _judge(mapped, raw.columns, spec, at.table, rules).select(
        F.col(at.id).cast("string").alias("source_product_id"),
        "product_name_en",
        F.col("_category").alias("category"),
        F.col("_price").alias("unit_price_syp"),
        *VERDICT,
    )


def conform_unreadable(lines: DataFrame, spec: SourceSpec) -> DataFrame:
    """Lines (source_table, line, first_field) that could not be read, for the quarantine."""
    return lines.select(
        F.lit(spec.code).alias("source_system"), "source_table", F.col("line").alias("source_row"),
        F.lit("unreadable_line").alias("reason_code"),
        F.concat(F.lit(f"line cannot be read for {spec.code} "), "source_table", F.lit(": '"),
                 F.coalesce("first_field", F.lit("")), F.lit("'")).alias("reason"),
        F.lit(True).alias("rejected"),
    )


def resolve_sk(df: DataFrame, dim: DataFrame, system: str, column: str, natural: str,
               surrogate: str, heavy: dict | None = None) -> DataFrame:
    """Add the surrogate key of a natural key, null where the dimension lacks it.

    One customer or product may own a large share of the orders: give those keys as
    ``heavy`` and the join spreads them (see ``salted_lookup``).
    """
    keys = dim.where(F.col("source_system") == system).select(
        F.col(natural).alias("_natural"), surrogate
    )
    return salted_lookup(df, keys, column, "_natural", heavy)


def resolve_company(df: DataFrame, dim_company: DataFrame, code: str) -> DataFrame:
    """Add ``company_sk`` of a company code; null where it is unknown. The one key is
    looked up beforehand and is a constant of the plan."""
    key = dim_company.where(F.col("company_code") == code).agg(F.max("company_sk")).first()[0]
    return df.withColumn("company_sk", F.lit(key).cast(dim_company.schema["company_sk"].dataType))


def conform_sales(raw: DataFrame, spec: SourceSpec, dim_customer: DataFrame, dim_product: DataFrame,
                  dim_company: DataFrame, dim_date: DataFrame,
                  heavy: dict[str, dict] | None = None) -> DataFrame:
    """Order lines of one source in fact shape. ``heavy`` holds, by column,
    the customers and products that own a large share of the rows.

    Order of rules: customer, product, then the constraints of the fact table. A
    stored total that differs from quantity * price is reported, and the row is
    kept with the computed total.
    """
    at = spec.orders
    heavy = heavy or {}
    keyed = resolve_sk(with_position(raw), dim_customer, spec.code, at.customer,
                       "source_customer_id", "customer_sk", heavy.get(at.customer))
    keyed = resolve_sk(keyed, dim_product, spec.code, at.product,
                       "source_product_id", "product_sk", heavy.get(at.product))
    keyed = resolve_company(keyed, dim_company, spec.code)
    days = dim_date.select(F.col("date_sk").alias("_calendar_sk"))
    keyed = keyed.withColumns({
        "date_sk": date_sk(F.col(at.date)),
        "_quantity": F.col(at.quantity).try_cast("int"),
        "_price": to_money(F.col(at.price)),
        "_computed": line_total(F.col(at.quantity), F.col(at.price)),
    }).join(days, F.col("date_sk") == F.col("_calendar_sk"), "left")

    rules: list[Rule] = [
        (F.col("customer_sk").isNull(), "no_customer",
         _message(f"no customer_sk for {spec.code} {at.customer}", F.col(at.customer))),
        (F.col("product_sk").isNull(), "no_product",
         _message(f"no product_sk for {spec.code} {at.product}", F.col(at.product))),
        (F.col("company_sk").isNull(), "no_company", F.lit(f"no company_sk for {spec.code}")),
        (F.col("_calendar_sk").isNull(), "date_not_in_calendar",
         _message("date not in calendar", F.col(at.date))),
        (F.coalesce(F.col("_quantity") <= 0, F.lit(True)), "invalid_quantity",
         _message("quantity not positive", F.col(at.quantity))),
        (F.col("_computed").isNull(), "invalid_amount", _message("invalid amount", F.col(at.price))),
        (F.col(at.id).isNull(), "null_id", F.lit("order id is null")),
    ]
    warnings = [] if at.total is None else [validate_total(F.col(at.total), F.col("_computed"))]
    return _judge(keyed, raw.columns, spec, at.table, rules, warnings).select(
        "date_sk", "customer_sk", "product_sk", "company_sk",
        F.col("_quantity").alias("quantity"),
        F.col("_price").alias("unit_price_syp"),
        F.col("_computed").alias("total_amount_syp"),
        F.col(at.id).cast("string").alias("source_order_id"),
        *VERDICT,
    )


def validate_total(stored: Column, computed: Column) -> Rule:
    """Rule broken where a stored total is not the computed one."""
    amounts = F.concat(
        F.lit("inconsistent_stored_total: stored="), F.coalesce(stored.cast("string"), F.lit("null")),
        F.lit(", computed="), computed.cast("bigint").cast("string"),
    )
    differs = ~stored.try_cast("decimal(20,2)").eqNullSafe(computed)
    return differs, "inconsistent_stored_total", amounts


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def split_quarantine(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows for the warehouse, rows for the quarantine) of one conformed frame.

    A reported row that is not rejected is in both.
    """
    good = judged.where(~F.col("rejected")).drop(*[c for c in VERDICT if c != "source_system"])
    bad = judged.where(F.col("reason_code").isNotNull()).select(
        "source_system", "source_table", "source_row", "reason_code", "reason"
    )
    return good, bad


def good_customers(judged: DataFrame) -> DataFrame:
    return split_quarantine(judged)[0].select(*CUSTOMER_KEY, *CUSTOMER_ATTRIBUTES)


def good_products(judged: DataFrame) -> DataFrame:
    return split_quarantine(judged)[0].select(*PRODUCT_KEY, *PRODUCT_ATTRIBUTES)


def good_sales(judged: DataFrame) -> DataFrame:
    return split_quarantine(judged)[0].select(*FACT_COLUMNS)
