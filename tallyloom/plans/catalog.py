"""Every operator as a named query over a folder of test tables.

The results go through ``comparable``: exact decimals become doubles and counts
become long integers, so that another engine's types compare equal.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom import schemas
from tallyloom.functions.calendar import date_sk, dim_date, previous_sunday
from tallyloom.functions.money import line_total, short_money, to_money
from tallyloom.functions.text import in_domain, map_value, phone_e164, transliterate
from tallyloom.operators import audit, checks, conform, dims, facts, forecast, ranking, rfm
from tallyloom.operators.lookup import POSITION, heavy_keys, with_position
from tallyloom.plans import reports
from tallyloom.plans.batch import batch_counts, conform_orders, resolve_since, run_batch
from tallyloom.plans.testmart import CODE_A, CODE_B, CODES, COMPANIES, PRODUCT_PREFIX, Mart, city_maps
from tallyloom.plans.testmart import mart, regions, table
from tallyloom.plans.warehouse import DIMENSIONS
from tallyloom.runtime import COMPACT, literal_rows, materialize, scratch_dir
from tallyloom.schemas import CUSTOMER_ATTRIBUTES, CUSTOMER_KEY, PRODUCT_ATTRIBUTES, PRODUCT_KEY
from tallyloom.sources import results
from tallyloom.sources.mappings import judge_catalog, read_catalog, read_catalog_rows, read_city_map
from tallyloom.sources.operational import read_source_a, read_source_b, tolerant_csv_reader, unreadable_lines
from tallyloom.streaming.incremental import Landing, stream_orders, stream_sources

Query = Callable[[SparkSession, str], DataFrame]
LOADED_AT = dt.datetime(2002, 1, 1, tzinfo=dt.timezone.utc)
KEYS = ["company_code"]
WORDS = {"small": "صغير", "red": "أحمر", "ring": "خاتم", "widget": "قطعة"}


def comparable(df: DataFrame) -> DataFrame:
    def plain(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return col.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return col.cast("bigint").alias(field.name)
        return col

    return df.select(*[plain(f) for f in df.schema.fields])


def rounded(df: DataFrame, **scales: int) -> DataFrame:
    """Round doubles to the digits that two engines' float sums agree on."""
    return df.withColumns({name: F.round(name, scale) for name, scale in scales.items()})


_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable], Callable]:
    """Register a function of (spark, sf_dir) under a name."""

    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        _QUERIES[name] = lambda spark, sf_dir: comparable(fn(spark, sf_dir))
        return fn

    return register


def mart_query(name: str) -> Callable[[Callable], Callable]:
    """Register a function of the loaded mart."""

    def register(fn: Callable[[Mart], DataFrame]) -> Callable:
        _QUERIES[name] = lambda spark, sf_dir: comparable(fn(mart(spark, sf_dir)))
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def source_a_of(m: Mart, since: dt.date | None = None) -> dict[str, DataFrame]:
    return read_source_a(m.feeds[0].reader, since)


def source_b_of(m: Mart, since: dt.date | None = None) -> dict[str, DataFrame]:
    return read_source_b(m.feeds[1].reader, since)


# -- A: sources ----------------------------------------------------------
@mart_query("A1_source_a_customers")
def _(m):
    return source_a_of(m)["customers"]


@mart_query("A1_source_a_products")
def _(m):
    return source_a_of(m)["products"]


@mart_query("A2_source_b_clients")
def _(m):
    return source_b_of(m)["clients"]


@mart_query("A2_source_b_transactions")
def _(m):
    return source_b_of(m)["transactions"]


@mart_query("A3_orders_since")
def _(m):
    """Orders of both sources since a date, each with all its columns."""
    since, parts = dt.date(1998, 7, 1), []
    for feed, extract in zip(m.feeds, (source_a_of(m, since), source_b_of(m, since))):
        at, orders = feed.spec.orders, extract[feed.spec.orders.table]
        named = {"order_id": at.id, "customer_id": at.customer, "product_id": at.product, "quantity": at.quantity,
                 "unit_price": at.price, "stored_total": at.total, "order_date": at.date}
        wide = {"unit_price": "decimal(14,2)", "stored_total": "bigint"}
        parts.append(orders.select(
            F.lit(feed.spec.code).alias("source_system"),
            *[(F.col(c) if c else F.lit(None)).cast(wide.get(n, "string" if n.endswith("_id") else "date" if n == "order_date" else "int")).alias(n)
              for n, c in named.items()],
            (F.col("tx_time") if "tx_time" in orders.columns else F.lit(None).cast("string")).alias("order_time")))
    return conform.union_all(parts)


def runs_from_events(spark: SparkSession, sf_dir: str, ok: Column) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("batch_id"), "user_id",
        F.col("ts").cast("timestamp").alias("started_at"),
        F.when(ok, "succeeded").otherwise("failed").alias("status"))


@query("A4_resolve_since")
def _(spark, sf_dir):
    runs = runs_from_events(spark, sf_dir, F.col("event_type") != "error")
    last = runs.where(F.col("status") == "succeeded").agg(F.max("started_at")).first()[0]
    given = dt.date(1998, 7, 1)
    rows = [
        ("full", resolve_since(runs, "full")),
        ("since", resolve_since(runs, "since", given)),
        ("incremental", resolve_since(runs, "incremental")),
        ("weekly", resolve_since(runs, "weekly", now=last)),
    ]
    return spark.createDataFrame(rows, "mode STRING, since DATE")


@query("A5_previous_sunday")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", previous_sunday(F.col("ts")).alias("sunday"))


@query("A6_catchup_due")
def _(spark, sf_dir):
    """Catch-up per user of the event log, as if each were a loader of its own."""
    runs = runs_from_events(spark, sf_dir, F.col("event_type") == "purchase")
    now = runs.agg(F.max("started_at")).first()[0]
    return audit.catchup_due(runs, F.lit(now), by=["user_id"]).drop("last_success")


@mart_query("A6_catchup_per_feed")
def _(m):
    """Catch-up of each source by the run log, as the loader asks for it."""
    runs = m.warehouse.runs()
    now = runs.agg(F.max("started_at")).first()[0]
    moments = {"at_once": now, "in_nine_days": now + dt.timedelta(days=9)}
    parts = [
        audit.catchup_due(runs, F.lit(at), feed=code).select(
            F.lit(code).alias("company_code"), F.lit(when).alias("moment"), "age_seconds", "due")
        for code in [*CODES, "OPC"] for when, at in moments.items()
    ]
    return conform.union_all(parts)


@query("A7_city_map")
def _(spark, sf_dir):
    path = f"{scratch_dir(spark)}/city-map-{uuid.uuid4().hex}"
    lines = city_maps(spark, sf_dir)["ar"].select(
        F.concat(F.lit("  "), "key").alias("ar"), F.concat("value", F.lit(" ")).alias("en"))
    lines.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    maps = read_city_map(spark, path)
    return conform.union_all([df.withColumn("form", F.lit(form)) for form, df in maps.items()])


def written_catalog(spark: SparkSession, sf_dir: str) -> str:
    """A catalog file of the listed products, with prices and categories of both sources."""
    path = f"{scratch_dir(spark)}/catalog-{uuid.uuid4().hex}"
    listed = table(spark, sf_dir, "part").where(F.col("p_partkey") % 11 != 0)
    kind = F.col("p_partkey") % 3
    title = F.when(kind == 0, "Internet").when(kind == 1, "Voice").otherwise("Bundle")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    columns = {
        "offering_id": F.col("p_partkey").cast("string"), "category": title,
        "local_name": F.concat(F.lit(PRODUCT_PREFIX), F.col("p_partkey").cast("string")),
        "local_price": (F.floor(price) + F.when(F.col("p_partkey") % 17 == 0, 1).otherwise(0)).cast("string"),
        "mapped_category": F.when(F.col("p_partkey") % 19 == 0, title).otherwise(F.upper(title)),
        "english_name": F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string")),
        "english_price": price.cast("string"),
    }
    listed.select(*[c.alias(n) for n, c in columns.items()]).write.csv(path, header=True)
    return path


@query("A8_catalog")
def _(spark, sf_dir):
    """The offerings of both sources, and whether each is consistent."""
    return judge_catalog(read_catalog_rows(spark, written_catalog(spark, sf_dir)))


@query("A8_catalog_names")
def _(spark, sf_dir):
    forms = read_catalog(spark, written_catalog(spark, sf_dir))
    return conform.union_all([df.withColumn("form", F.lit(form)) for form, df in forms.items()])


@mart_query("A9_C5_company_keys")
def _(m):
    companies = dims.dim_company(m.spark, COMPANIES)
    parts = []
    for feed, extract in zip(m.feeds, (source_a_of(m), source_b_of(m))):
        code = feed.spec.code
        keyed = conform.resolve_company(extract[feed.spec.orders.table], companies, code)
        parts.append(keyed.groupBy(F.lit(code).alias("company_code"), "company_sk").agg(
            F.count(F.lit(1)).alias("lines")))
    return conform.union_all(parts).join(companies, ["company_sk", "company_code"])


@query("A10_dim_date")
def _(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    first, last = table(spark, sf_dir, "orders").agg(F.min(day), F.max(day)).first()
    return dim_date(spark, first, last)


def segmented_of(m: Mart) -> DataFrame:
    return rfm.segment_customers(stored_rfm(m))


@mart_query("A11_A13_rfm_store")
def _(m):
    path = f"{scratch_dir(m.spark)}/rfm-{uuid.uuid4().hex}"
    results.write_rfm(segmented_of(m), path)
    return results.read_rfm(m.spark, path)


@mart_query("A12_A14_forecast_store")
def _(m):
    path = f"{scratch_dir(m.spark)}/forecast-{uuid.uuid4().hex}"
    results.write_forecast(forecast.forecast_long(fit_of(m), KEYS), path)
    return rounded(results.read_forecast(m.spark, path)["metrics"], rmse=2, mape=6)


def result_folders(m: Mart, write: Callable[[str], None]) -> dict[str, str]:
    """Folders of a stored result, of none, and of one whose file is torn."""
    base = f"{scratch_dir(m.spark)}/results-{uuid.uuid4().hex}"
    folders = {case: f"{base}/{case}" for case in ("stored", "missing", "torn")}
    write(folders["stored"])
    # a text file where the result should be, with other columns than it has
    m.spark.range(1).selectExpr("'no,result' AS value").write.text(folders["torn"])
    return folders


@mart_query("A15_stored_or_computed")
def _(m):
    segmented = materialize(segmented_of(m), "segmented")
    folders = result_folders(m, lambda path: results.write_rfm(segmented, path))
    return conform.union_all([
        results.load_or_compute(lambda p=path: results.read_rfm(m.spark, p), lambda: rfm.segment_summary(segmented))
        .withColumn("case", F.lit(case)) for case, path in folders.items()])


@mart_query("A15_forecast_stored_or_computed")
def _(m):
    fit = fit_of(m)
    folders = result_folders(m, lambda path: results.write_forecast(forecast.forecast_long(fit, KEYS), path))
    found = conform.union_all([
        results.load_or_compute(
            lambda p=path: results.read_forecast(m.spark, p)["metrics"],
            lambda: forecast.forecast_metrics(forecast.fitted_rows(fit, KEYS), KEYS),
        ).select("company_code", "rmse", "mape", F.lit(case).alias("case")) for case, path in folders.items()])
    return rounded(found, rmse=2, mape=6)


# -- B: conformance ------------------------------------------------------
def conformed_customers(m: Mart) -> DataFrame:
    a, b = m.feeds
    return conform.union_all([
        conform.conform_customers(source_a_of(m)["customers"], a.spec, m.city_maps["ar"]),
        conform.conform_customers(source_b_of(m)["clients"], b.spec, m.city_maps["en"]),
    ])


def conformed_products(m: Mart) -> DataFrame:
    a, b = m.feeds
    return conform.union_all([
        conform.conform_products(source_a_of(m)["products"], a.spec, m.catalogs["local_name"]),
        conform.conform_products(source_b_of(m)["items"], b.spec, m.catalogs["english_name"]),
    ])


def conformed_sales(m: Mart, keep: Callable[[DataFrame], DataFrame] = lambda judged: judged) -> DataFrame:
    """As the loader does it: heavy keys of both dimensions spread, one feed after the other
    stored, of which ``keep`` says what is."""
    parts = [conform_orders([f], [x[f.spec.orders.table]], m.tables)
             for f, x in zip(m.feeds, (source_a_of(m), source_b_of(m)))]
    return conform.union_all([materialize(keep(judged), "sales", **COMPACT) for judged in parts])


@mart_query("B1_phone_e164")
def _(m):
    rule = m.feeds[0].spec.customers.phone_rule
    return source_a_of(m)["customers"].select(
        F.col("customer_id").alias("source_customer_id"), phone_e164(F.col("phone"), rule).alias("phone_e164"))


@mart_query("B2_phone_national")
def _(m):
    rule = m.feeds[1].spec.customers.phone_rule
    return source_b_of(m)["clients"].select(
        F.col("client_id").alias("source_customer_id"), phone_e164(F.col("msisdn"), rule).alias("phone_e164"))


@mart_query("B3_city_local")
def _(m):
    mapped = conform.map_column(source_a_of(m)["customers"], m.city_maps["ar"], "city_ar", "city")
    return mapped.select(F.col("customer_id").alias("source_customer_id"), "city")


@mart_query("B4_city_canonical")
def _(m):
    mapped = conform.map_column(source_b_of(m)["clients"], m.city_maps["en"], "city_en", "city")
    return mapped.select(F.col("client_id").alias("source_customer_id"), "city")


@mart_query("B5_conform_customers")
def _(m):
    return conformed_customers(m).drop("source_row")


@mart_query("B6_category_title")
def _(m):
    categories = m.feeds[0].spec.products.categories
    return source_a_of(m)["products"].select(
        F.col("product_id").alias("source_product_id"),
        map_value(F.col("category"), categories).alias("category"))


@mart_query("B7_category_domain")
def _(m):
    return source_b_of(m)["items"].select(
        "item_id", in_domain(F.col("item_type"), schemas.CATEGORIES).alias("in_domain"))


@mart_query("B8_canonical_name")
def _(m):
    a = conform.canonical_name(source_a_of(m)["products"], m.catalogs["local_name"], "product_name")
    b = conform.canonical_name(source_b_of(m)["items"], m.catalogs["english_name"], "item_name")
    return conform.union_all([
        a.select(F.lit(CODE_A).alias("source_system"), F.col("product_id").alias("source_product_id"), "product_name_en"),
        b.select(F.lit(CODE_B).alias("source_system"), F.col("item_id").alias("source_product_id"), "product_name_en"),
    ])


@query("B9_to_money")
def _(spark, sf_dir):
    text = F.when(F.col("p_partkey") % 13 == 0, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", to_money(text).alias("price"))


@mart_query("B10_conform_products")
def _(m):
    return conformed_products(m).drop("source_row")


@query("B11_date_sk")
def _(spark, sf_dir):
    ts = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", date_sk(ts).alias("from_timestamp"), date_sk(ts.cast("date")).alias("from_date"),
        date_sk(ts.cast("date").cast("string")).alias("from_text"))


@mart_query("B12_line_total")
def _(m):
    return source_b_of(m)["transactions"].select(
        "tx_id", line_total(F.col("qty"), F.col("price_at_tx")).alias("total"))


@mart_query("B13_stored_total")
def _(m):
    return conformed_sales(m, lambda judged: judged.where(F.col("reason_code") == "inconsistent_stored_total").select(
        "source_order_id", "total_amount_syp", "reason", "rejected"))


@mart_query("B14_conform_sales")
def _(m):
    return conformed_sales(m, lambda judged: judged.drop("source_row", "source_table"))


@mart_query("B15_split_quarantine")
def _(m):
    good, bad = conform.split_quarantine(conformed_sales(m))
    none = F.lit(None).cast("string").alias("reason_code")
    counts = [
        good.groupBy(F.lit("good").alias("side"), "source_system", none),
        bad.groupBy(F.lit("bad").alias("side"), "source_system", "reason_code"),
    ]
    return conform.union_all([c.agg(F.count(F.lit(1)).alias("n")) for c in counts])


@mart_query("B16_row_payload")
def _(m):
    """Quarantined rows of customers, products and orders of both sources, as they came."""
    def payloads(judged: DataFrame) -> DataFrame:
        return judged.where("reason_code IS NOT NULL").select("source_system", "source_table", "source_row")

    return conform.union_all([
        payloads(conformed_customers(m)), payloads(conformed_products(m)), conformed_sales(m, payloads)])


# -- C: load -------------------------------------------------------------
def two_batches(m: Mart) -> tuple[DataFrame, DataFrame]:
    """Customers of a first batch, and of a second that renames and adds."""
    good = conform.good_customers(conformed_customers(m))
    second = good.where(F.month("signup_date") >= 5)
    copies = second.withColumn("_line", F.lit(1)).unionByName(
        second.withColumns({"full_name": F.upper("full_name"), "_line": F.lit(2)}))
    return (good.where(F.month("signup_date") <= 8),
            dims.last_per_key(copies, CUSTOMER_KEY, [F.col("_line")]).drop("_line"))


def two_loads(m: Mart) -> tuple[DataFrame, DataFrame]:
    """The customer dimension after the first batch, and the second batch."""
    first, second = two_batches(m)
    empty = literal_rows(m.spark, [], schemas.DIM_CUSTOMER)
    return dims.upsert_scd1(empty, first, CUSTOMER_KEY, CUSTOMER_ATTRIBUTES, "customer_sk", "one", LOADED_AT), second


def store_twice(m: Mart, name: str, first: DataFrame, second: DataFrame, attributes: list[str]) -> DataFrame:
    """A dimension after two batches, the second of which writes the parts it touches."""
    fresh = m.new_warehouse(f"{name}-{uuid.uuid4().hex}")
    _, keys, sk = DIMENSIONS[name]
    for batch_id, rows in (("one", first), ("two", second)):
        def upsert(current, last, rows=rows, batch_id=batch_id):
            return dims.upsert_scd1(current, rows, keys, attributes, sk, batch_id, LOADED_AT, last=last)

        fresh.update_dimension(name, rows, batch_id, upsert)
        fresh.log(audit.close_run(m.spark, batch_id, "full", LOADED_AT, LOADED_AT, 0, 0, 0, "succeeded"))
    return fresh.tables()[name].drop("etl_loaded_at")


@mart_query("C1_upsert_customers")
def _(m):
    first, second = two_batches(m)
    return store_twice(m, "dim_customer", first, second, CUSTOMER_ATTRIBUTES)


@mart_query("C2_upsert_products")
def _(m):
    good = conform.good_products(conformed_products(m))
    dearer = good.where(F.col("category") == "VOICE").withColumn(
        "unit_price_syp", to_money(F.col("unit_price_syp") * 2))
    return store_twice(m, "dim_product", good, dearer, PRODUCT_ATTRIBUTES)


@mart_query("C3_assign_sk")
def _(m):
    stored, incoming = two_loads(m)
    return dims.assign_sk(incoming, stored, "customer_sk", CUSTOMER_KEY).select("customer_sk", *CUSTOMER_KEY)


@mart_query("C4_resolve_sk")
def _(m):
    """Surrogate keys of customer and product for the orders of both sources."""
    parts = []
    for feed, extract in zip(m.feeds, (source_a_of(m), source_b_of(m))):
        at, code = feed.spec.orders, feed.spec.code
        orders = extract[at.table].select(at.id, at.customer, at.product)
        keyed = with_position(orders)
        for column, dim, natural, sk in ((at.customer, "dim_customer", "source_customer_id", "customer_sk"),
                                         (at.product, "dim_product", "source_product_id", "product_sk")):
            keyed = conform.resolve_sk(keyed, m.tables[dim], code, column, natural, sk, heavy_keys(orders, column))
        parts.append(materialize(keyed.select(
            F.lit(code).alias("source_system"), F.col(at.id).alias("order_id"), F.col(at.customer).alias("customer"),
            F.col(at.product).alias("product"), "customer_sk", "product_sk"), "resolved", **COMPACT))
    return conform.union_all(parts)


@mart_query("C6_insert_absent")
def _(m):
    """New facts against a bucketed table that holds those before 1998."""
    fresh = m.new_warehouse(f"buckets-{uuid.uuid4().hex}")
    buckets, keys = fresh.layout()[0], schemas.FACT_KEY
    stored = m.tables["fact_sales"].where(F.col("date_sk") < 19980101)
    fresh.write_facts(stored.repartition(buckets, *keys), "old")
    new = conformed_sales(m, conform.good_sales)
    return facts.insert_absent(fresh.facts(["old"]), new, keys, schemas.FACT_ORDER, buckets).select(*schemas.FACT_COLUMNS)


@mart_query("C7_upsert_counts")
def _(m):
    stored, incoming = two_loads(m)
    return dims.upsert_counts(stored, incoming, CUSTOMER_KEY)


@query("C8_run_log")
def _(spark, sf_dir):
    """State of each run from an append-only log, here the event log by user."""
    status = F.when(F.col("event_type") == "error", "failed").when(
        F.col("event_type") == "view", "running").otherwise("succeeded")
    log = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("batch_id"), F.col("ts").alias("logged_at"), status.alias("status"),
        *[F.lit(None).alias(c) for c in schemas.ETL_RUNS.names
          if c not in ("batch_id", "logged_at", "status")])
    return audit.current_runs(log).select("batch_id", "status", "logged_at")


@mart_query("C9_constraints")
def _(m):
    """Every constraint of the star schema over all rows that come in, before the
    quarantine takes what breaks one."""
    t = m.tables
    sales = facts.check_constraints(
        conformed_sales(m, lambda judged: judged.select(*schemas.FACT_COLUMNS)),
        required=schemas.FACT_COLUMNS,
        predicates={"quantity > 0": F.col("quantity") > 0},
        foreign_keys={"date_sk": t["dim_date"], "customer_sk": t["dim_customer"],
                      "product_sk": t["dim_product"], "company_sk": t["dim_company"]},
        unique=schemas.FACT_KEY)
    customers = facts.check_constraints(
        conformed_customers(m), required=[*CUSTOMER_KEY, *CUSTOMER_ATTRIBUTES], unique=CUSTOMER_KEY)
    products = facts.check_constraints(
        conformed_products(m), required=[*PRODUCT_KEY, *PRODUCT_ATTRIBUTES],
        predicates={"category in domain": in_domain(F.col("category"), schemas.CATEGORIES)}, unique=PRODUCT_KEY)
    named = {"fact_sales": sales, "dim_customer": customers, "dim_product": products}
    return conform.union_all([df.withColumn("table", F.lit(name)) for name, df in named.items()])


@mart_query("C10_quarantine")
def _(m):
    return m.warehouse.errors().select("batch_id", "source_system", "source_table", "reason_code", "reason")


def write_lines(lines: DataFrame, names: str, path: str) -> None:
    """Text files of ``lines`` (value), a scan's; every file begins with the names of the columns."""
    # a partition is one file, and the position of its first row has nothing in the lower 33 bits
    first = F.col(POSITION).bitwiseAND((1 << 33) - 1) == 0
    both = F.when(first, F.array(F.lit(names), "value")).otherwise(F.array("value"))
    with_position(lines).select(F.explode(both).alias("value")).write.text(path)


@mart_query("C10_unreadable_lines")
def _(m):
    """A load of source A from text files, where some lines of the orders are torn."""
    root = f"{scratch_dir(m.spark)}/text-{uuid.uuid4().hex}"
    layout = {n: schemas.LAYOUT_A[n] for n in ("orders",)}
    for name, schema in layout.items():
        fields = [F.col(c).cast("string") for c in schema.names]
        torn = F.split_part("order_id", F.lit("-"), F.lit(1)).cast("bigint") % 97 == 5
        line = F.when(torn, F.concat_ws(",", *fields[:2])).otherwise(F.concat_ws(",", *fields))
        write_lines(m.feeds[0].reader(name).select(line.alias("value")), ",".join(schema.names), f"{root}/{name}")
    stored, text = m.feeds[0].reader, tolerant_csv_reader(m.spark, root, layout)
    feed = replace(m.feeds[0], reader=lambda t: text(t) if t in layout else stored(t),
                   unreadable=lambda: unreadable_lines(m.spark, root, layout, list(layout)), fixed=False)
    fresh = m.new_warehouse(f"text-{uuid.uuid4().hex}")
    run_batch(fresh, [feed], m.city_maps, m.catalogs, "full", batch_id="text")
    found = fresh.errors().where("reason_code = 'unreadable_line'").select("source_table", "source_row", "reason")
    loaded = fresh.tables()["fact_sales"].agg(F.count(F.lit(1)).cast("string").alias("source_row"))
    return found.unionByName(loaded.select(F.lit("fact_sales").alias("source_table"), "source_row", F.lit("rows loaded").alias("reason")))


@mart_query("C11_batch_counts")
def _(m):
    judged = [conformed_customers(m), conformed_products(m),
              conformed_sales(m, lambda judged: judged.select("reason_code"))]
    loaded = m.tables["fact_sales"].agg(F.count(F.lit(1)).alias("rows_loaded"))
    return batch_counts(judged).crossJoin(loaded).select(
        F.col("extracted").alias("rows_extracted"), "rows_loaded",
        F.col("quarantined").alias("rows_quarantined"))


@mart_query("C12_two_batches")
def _(m):
    """A partial load, then a full one that adds only what is absent."""
    fresh = m.new_warehouse(f"two-batches-{uuid.uuid4().hex}")
    run_batch(fresh, m.feeds, m.city_maps, m.catalogs, "since", dt.date(1999, 1, 1), batch_id="one")
    run_batch(fresh, m.feeds, m.city_maps, m.catalogs, "full", batch_id="two")
    return fresh.runs().select("mode", "rows_loaded", "status")


@mart_query("C12_load_life_cycle")
def _(m):
    """A stream of source A, then incremental batches of both sources, twice: every fact
    is there once, whatever came first."""
    name = f"life-cycle-{uuid.uuid4().hex}"
    fresh = run_dimensions_only(m, m.new_warehouse(name))
    feed = m.feeds[0]
    stream_orders(fresh, feed, schemas.LAYOUT_A["orders"], f"{m.sources_root}/{feed.spec.orders.table}",
                  f"{m.root}/{name}-checkpoint", name).awaitTermination()
    for _ in range(2):
        run_batch(fresh, m.feeds, m.city_maps, m.catalogs, "incremental")
    return fresh.tables()["fact_sales"].select(
        "company_sk", "source_order_id", "date_sk", "customer_sk", "product_sk", "quantity", "total_amount_syp")


# -- D: reports ----------------------------------------------------------
@mart_query("D1_company_totals")
def company_totals(m):
    return reports.company_totals(m.tables["fact_sales"], m.tables["dim_company"])


@mart_query("D2_company_totals_customers")
def _(m):
    return reports.company_totals_with_customers(m.tables["fact_sales"], m.tables["dim_company"])


@mart_query("D3_top_customers")
def _(m):
    t = m.tables
    return reports.top_customers(t["fact_sales"], t["dim_customer"], t["dim_date"])


def cities_of(m: Mart) -> DataFrame:
    t = m.tables
    return reports.city_sales(t["fact_sales"], t["dim_customer"], t["dim_company"], CODES)


@mart_query("D4_city_sales")
def _(m):
    return cities_of(m).drop("order_count")


@mart_query("D5_city_sales_orders")
def _(m):
    return cities_of(m)


def monthly_of(m: Mart) -> DataFrame:
    t = m.tables
    return reports.monthly_sales(t["fact_sales"], t["dim_date"], t["dim_company"])


@mart_query("D6_monthly_change")
def _(m):
    return reports.monthly_change(monthly_of(m))


@mart_query("D7_monthly_sales")
def _(m):
    return monthly_of(m)


@mart_query("D8_company_comparison")
def _(m):
    t = m.tables
    return reports.company_comparison(t["fact_sales"], t["dim_company"], t["dim_customer"], t["dim_product"])


def indicators_of(m: Mart) -> DataFrame:
    t = m.tables
    per_customer = materialize(reports.customer_totals(t["fact_sales"]), "customer-totals")
    return reports.decision_indicators(t["fact_sales"], t["dim_customer"], t["dim_date"], per_customer)


@mart_query("D9_decision_indicators")
def _(m):
    return indicators_of(m)


@mart_query("D9a_dashboard_indicators")
def _(m):
    return reports.dashboard_indicators(indicators_of(m))


def products_of(m: Mart) -> DataFrame:
    return reports.products(m.tables["fact_sales"], m.tables["dim_product"])


@mart_query("D10_products")
def _(m):
    return products_of(m)


@mart_query("D11_cheapest_products")
def _(m):
    return reports.cheapest_products(products_of(m))


@mart_query("D12_headline")
def _(m):
    companies = reports.company_totals(m.tables["fact_sales"], m.tables["dim_company"])
    return reports.headline(companies, indicators_of(m), rfm.segment_summary(segmented_of(m)))


@mart_query("D13_monthly_wide")
def _(m):
    return reports.monthly_wide(monthly_of(m), CODES)


@mart_query("D14_city_millions")
def _(m):
    names = regions(m.spark, m.sf_dir).select(F.col("city").alias("key"), F.col("ar").alias("value"))
    return reports.city_millions(cities_of(m), CODES, names)


def governorates_of(m: Mart) -> DataFrame:
    return reports.governorates(cities_of(m), regions(m.spark, m.sf_dir), CODES)


@mart_query("D15_governorates")
def _(m):
    return governorates_of(m)


@mart_query("D16_city_bars")
def _(m):
    return reports.city_bars(cities_of(m), CODE_A)


@mart_query("D16_governorate_bars")
def _(m):
    return reports.governorate_bars(governorates_of(m), CODE_A)


@mart_query("D17_governorate_panel")
def _(m):
    return rounded(reports.governorate_panel(governorates_of(m)), total_m=6)


@mart_query("D18_combined_forecast")
def _(m):
    months = forecast.combined_forecast(forecast.holt_forecast(fit_of(m), KEYS), CODES)
    return rounded(months, opa=2, opb=2, combined=2)


# -- E: customer segments ------------------------------------------------
def raw_rfm(m: Mart) -> DataFrame:
    t = m.tables
    return rfm.rfm_raw(t["fact_sales"], t["dim_customer"], t["dim_company"], t["dim_date"])


def stored_rfm(m: Mart) -> DataFrame:
    return materialize(raw_rfm(m), "rfm-raw")


@mart_query("E1_rfm_raw")
def _(m):
    return raw_rfm(m)


@mart_query("E2_rfm_ntile")
def _(m):
    return rfm.rfm_ntile(stored_rfm(m)).select("customer_sk", "r_score", "f_score", "m_score", "rfm_code")


@mart_query("E3_rfm_quintiles")
def _(m):
    return rfm.rfm_quintiles(stored_rfm(m)).select("customer_sk", "r_score", "f_score", "m_score", "rfm_code")


@mart_query("E4_segment")
def _(m):
    return segmented_of(m).select("customer_sk", "segment")


@mart_query("E5_segmented_customers")
def _(m):
    return segmented_of(m)


@mart_query("E6_segment_summary")
def _(m):
    return rfm.segment_summary(segmented_of(m))


@mart_query("E7_dominance")
def _(m):
    return rfm.dominance_check(rfm.segment_summary(segmented_of(m)))


@mart_query("E8_base_shares")
def _(m):
    return rfm.base_shares(rfm.segment_summary(segmented_of(m)), m.tables["dim_customer"])


# -- F: forecast ---------------------------------------------------------
def series_of(m: Mart) -> DataFrame:
    return forecast.drop_partial(forecast.monthly_series(monthly_of(m)), KEYS)


def fit_of(m: Mart) -> DataFrame:
    return materialize(forecast.holt_fit(series_of(m), KEYS), "holt-fit")


def fixed_holt(m: Mart) -> DataFrame:
    """Smoothing with given parameters, started at the first month without a trend."""
    first = F.element_at("points", 1)["y"]
    return forecast.holt(series_of(m), KEYS, 0.3, 0.1, first, 0.0)


@mart_query("F1_monthly_series")
def _(m):
    return forecast.monthly_series(monthly_of(m))


@mart_query("F2_drop_partial")
def _(m):
    return series_of(m)


@mart_query("F3_holt")
def _(m):
    rows = forecast.fitted_rows(fixed_holt(m), KEYS)
    return rounded(rows, fitted=4)


@mart_query("F4_holt_fit")
def _(m):
    fit = fit_of(m).select("company_code", "alpha", "beta", "level0", "trend0", "level", "trend")
    return rounded(fit, alpha=6, beta=6, level0=2, trend0=2, level=2, trend=2)


@mart_query("F5_holt_forecast")
def _(m):
    return rounded(forecast.holt_forecast(fit_of(m), KEYS), forecast=2)


@mart_query("F6_trend_forecast")
def _(m):
    return rounded(forecast.trend_forecast(series_of(m), KEYS), forecast=2)


@mart_query("F7_bands")
def _(m):
    return rounded(forecast.bands(fit_of(m), KEYS), forecast=2, lower=2, upper=2)


@mart_query("F8_metrics")
def _(m):
    metrics = forecast.forecast_metrics(forecast.fitted_rows(fixed_holt(m), KEYS), KEYS)
    return rounded(metrics, rmse=4, mape=8)


@mart_query("F9_forecast_check")
def _(m):
    series = series_of(m)
    actual = series.select("company_code", F.col("sales_syp").cast("double").alias("actual"))
    checked = forecast.forecast_check(forecast.trend_forecast(series, KEYS), actual, KEYS)
    return checked.select("company_code", "period", "status")


@mart_query("F10_forecast_long")
def _(m):
    return rounded(forecast.forecast_long(fit_of(m), KEYS), sales_syp=2)


@mart_query("F11_forecast_summary")
def _(m):
    summary = forecast.forecast_summary(fit_of(m), KEYS)
    values = {f"forecast_{i}": F.element_at("forecasts", i) for i in (1, 2, 3)}
    wide = summary.withColumns({"periods": F.array_join("periods", ","), **values}).drop("forecasts")
    return rounded(wide, forecast_1=2, forecast_2=2, forecast_3=2, rmse=2, mape=6)


# -- G: ranks ------------------------------------------------------------
@mart_query("G1_global_row_number")
def _(m):
    per_customer = m.tables["fact_sales"].groupBy("customer_sk").agg(F.count(F.lit(1)).alias("orders"))
    return ranking.global_row_number(materialize(per_customer, "orders-per-customer"),
                                     ["orders", "customer_sk"], rows_per_range=200)


@mart_query("G2_top_fraction_sum")
def _(m):
    totals = materialize(reports.customer_totals(m.tables["fact_sales"]), "customer-totals")
    return ranking.top_fraction_sum(totals, "customer_total", "customer_sk", 10, "top_total", rows_per_range=200)


@mart_query("G3_total_order")
def _(m):
    return m.tables["fact_sales"].select("company_sk", "date_sk", "source_order_id", "total_amount_syp").orderBy(
        "company_sk", "date_sk", "source_order_id")


@mart_query("G4_top_k")
def _(m):
    order = [F.col("total_amount_syp").desc(), F.col("company_sk"), F.col("source_order_id")]
    return ranking.top_k(m.tables["fact_sales"], 50, order).select("source_order_id", "total_amount_syp")


@mart_query("G5_rank_small")
def _(m):
    return ranking.rank_small(cities_of(m), [F.col("total_syp").desc(), F.col("city")]).select("city", "rank")


# -- I: checks -----------------------------------------------------------
@mart_query("I1_totals_by_company")
def _(m):
    return checks.totals_by_company(m.tables["fact_sales"], m.tables["dim_company"])


@mart_query("I2_totals_by_month")
def _(m):
    t = m.tables
    return checks.totals_by_month(t["fact_sales"], t["dim_date"], t["dim_company"])


@mart_query("I3_dates_resolve")
def _(m):
    return checks.no_orphans(m.tables["fact_sales"], m.tables["dim_date"], "date_sk")


@mart_query("I4_companies_resolve")
def _(m):
    return checks.no_orphans(m.tables["fact_sales"], m.tables["dim_company"], "company_sk")


@mart_query("I5_total_consistent")
def _(m):
    return checks.total_consistent(m.tables["fact_sales"])


@mart_query("I6_company_rows")
def _(m):
    selling = m.tables["fact_sales"].select("company_sk").distinct()
    companies = m.tables["dim_company"].join(selling, "company_sk", "left_semi")
    return checks.row_count_is(companies, "dim_company_rows", 2)


@query("I7_calendar_rows")
def _(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    first, last = table(spark, sf_dir, "orders").agg(F.min(day), F.max(day)).first()
    return checks.row_count_at_least(dim_date(spark, first, last), "dim_date_rows", 1825)


@mart_query("I8_all_checks")
def _(m):
    return checks.run_checks(m.tables)


@mart_query("I9_contract_profile")
def _(m):
    parts = []
    for feed, city_table, names in ((m.feeds[0], "cities", schemas.LAYOUT_A), (m.feeds[1], "clients", schemas.LAYOUT_B)):
        tables = {name: feed.reader(name) for name in names}
        parts.append(checks.contract_profile(tables, feed.spec, city_table))
    return conform.union_all(parts)


@mart_query("I9_contract_verdict")
def _(m):
    a, b = ({name: feed.reader(name) for name in names}
            for feed, names in zip(m.feeds, (schemas.LAYOUT_A, schemas.LAYOUT_B)))
    return checks.contract_verdict(a, m.feeds[0].spec, "cities", b, m.feeds[1].spec, "clients", "tx_time")


# -- J: text -------------------------------------------------------------
@query("J1_transliterate")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", transliterate(F.col("p_name"), WORDS).alias("name"))


@query("J2_short_money")
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    value = F.col("o_totalprice") * (1 + key % 3 * 10) / (1 + key % 2 * 1000)
    return table(spark, sf_dir, "orders").select("o_orderkey", short_money(value).alias("amount"))


# -- L: stream -----------------------------------------------------------
@mart_query("L1_stream_load")
def _(m):
    """Orders of both sources arrive as files and are loaded by the stream; a second call
    finds nothing new."""
    name = f"stream-{uuid.uuid4().hex}"
    fresh = run_dimensions_only(m, m.new_warehouse(name))
    for _ in range(2):
        stream_sources(fresh, landings(m), f"{m.root}/{name}-checkpoint", name).awaitTermination()
    return fresh.tables()["fact_sales"].select(
        "company_sk", "source_order_id", "date_sk", "customer_sk", "product_sk", "quantity", "total_amount_syp")


def landings(m: Mart) -> list[Landing]:
    return [
        Landing(feed, layout[feed.spec.orders.table], f"{m.sources_root}/{feed.spec.orders.table}")
        for feed, layout in zip(m.feeds, (schemas.LAYOUT_A, schemas.LAYOUT_B))
    ]


def run_dimensions_only(m: Mart, fresh):
    """Load dimensions, and the orders of no day, into a new warehouse."""
    after_all = dt.date(9999, 1, 1)
    run_batch(fresh, m.feeds, m.city_maps, m.catalogs, "since", after_all, batch_id="dimensions")
    return fresh
