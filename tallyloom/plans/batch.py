"""One load: extract, conform, load dimensions and facts, audit."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.functions.calendar import previous_sunday
from tallyloom.operators import audit, conform
from tallyloom.operators.dims import last_per_key, upsert_scd1
from tallyloom.operators.facts import insert_absent
from tallyloom.operators.lookup import heavy_keys
from tallyloom.plans.warehouse import DIMENSIONS, Warehouse, WriterBusy
from tallyloom.runtime import COMPACT, materialize, materialize_counted, released_shuffles, scratch_scope
from tallyloom.sources import operational
from tallyloom.sources.operational import Reader
from tallyloom.specs import SourceSpec, source_a, source_b

Extract = Callable[[Reader, dt.date | None], dict[str, DataFrame]]
ExtractOrders = Callable[[Reader, dt.date | None], DataFrame]
STALE_HOURS = 24  # a run still open after that is taken for dead


@dataclass(frozen=True)
class Feed:
    """One source to load: its layout, how it is extracted, where it is read, and which
    lines of its files cannot be read, as ``unreadable_lines``, if it is read from text.
    ``fixed``: nobody changes its tables during a load, so its orders are read where they
    lie, as often as needed, and not copied first."""

    spec: SourceSpec
    extract: Extract
    extract_orders: ExtractOrders
    reader: Reader
    unreadable: Callable[[], DataFrame] | None = None
    fixed: bool = False


def feed_a(code: str, reader: Reader, fixed: bool = False) -> Feed:
    return Feed(source_a(code), operational.read_source_a, operational.orders_a, reader, fixed=fixed)


def feed_b(code: str, reader: Reader, fixed: bool = False) -> Feed:
    return Feed(source_b(code), operational.read_source_b, operational.transactions_b, reader, fixed=fixed)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class BatchRefused(RuntimeError):
    """A load that would lose or repeat rows, and was not begun."""


def resolve_since(runs: DataFrame, mode: str = "incremental", since: dt.date | None = None,
                  now: dt.datetime | None = None, feed: str | None = None) -> dt.date | None:
    """Start date of a load. ``full``: none. ``since``: the given date. ``weekly``: the
    previous Sunday 02:00. ``incremental``: the day the last succeeded run started, so
    that no week is skipped; all data if there is none. With a feed, of the runs that
    extracted it: what another feed has loaded says nothing about this one."""
    if (since is not None) != (mode == "since"):
        raise ValueError("a date goes with mode 'since', and only with it")
    if mode == "full":
        return None
    if mode == "since":
        return since
    if mode == "weekly":
        moment = F.lit(now or _now())
        return runs.sparkSession.range(1).select(previous_sunday(moment).cast("date")).first()[0]
    if mode == "incremental":
        return audit.last_success(runs, feed).select(F.col("last_success").cast("date")).first()[0]
    raise ValueError(f"unknown mode: {mode}")


def stage_counts() -> dict[str, Column]:
    """Rows read and quarantine rows found, of one conformed frame."""
    return {"extracted": F.count(F.lit(1)), "quarantined": F.count("reason_code")}


def batch_counts(stages: list[DataFrame]) -> DataFrame:
    """One row: rows read and quarantine rows found, over stored conformed frames. A load
    takes the same counts while it writes its stages."""
    parts = [s.agg(*[c.alias(n) for n, c in stage_counts().items()]) for s in stages]
    return conform.union_all(parts).agg(
        F.sum("extracted").alias("extracted"), F.sum("quarantined").alias("quarantined")
    )


def conform_entities(feeds: list[Feed], extracts: list[dict[str, DataFrame]],
                     city_maps: dict[str, DataFrame], catalogs: dict[str, DataFrame]
                     ) -> tuple[DataFrame, DataFrame]:
    """Conformed customers and products of all feeds, good and rejected rows together."""
    customers = conform.union_all([
        conform.conform_customers(x[f.spec.customers.table], f.spec, city_maps[f.spec.customers.city_key])
        for f, x in zip(feeds, extracts)
    ])
    products = conform.union_all([
        conform.conform_products(x[f.spec.products.table], f.spec, catalogs[f.spec.products.catalog_key])
        for f, x in zip(feeds, extracts)
    ])
    return customers, products


def conform_orders(feeds: list[Feed], orders: list[DataFrame],
                   tables: dict[str, DataFrame], stored: bool = False) -> DataFrame:
    """Conformed order lines of all feeds against the given dimensions. Orders that are
    ``stored``, or of a ``fixed`` feed, are columns of a table that nobody changes."""
    judged = []
    for feed, raw in zip(feeds, orders):
        at = feed.spec.orders
        if not (stored or feed.fixed):  # read once: the source may move between passes
            raw = materialize(raw, "orders", **COMPACT)
        heavy = {column: heavy_keys(raw, column) for column in (at.customer, at.product)}
        judged.append(conform.conform_sales(
            raw, feed.spec, tables["dim_customer"], tables["dim_product"],
            tables["dim_company"], tables["dim_date"], heavy,
        ))
    return conform.union_all(judged)


def begin_run(warehouse: Warehouse, batch_id: str, mode: str, at: dt.datetime, codes: list[str]) -> None:
    """Take the writer's place and open a run in the log, or refuse it."""
    try:
        warehouse.lock(batch_id, STALE_HOURS)
    except WriterBusy as error:
        raise BatchRefused(str(error)) from error
    try:
        runs = warehouse.runs()
        if not runs.where((F.col("batch_id") == batch_id) & (F.col("status") == "succeeded")).isEmpty():
            raise BatchRefused(f"batch id {batch_id} has been loaded; give each load an id of its own")
        recent = F.col("logged_at") > F.lit(_now() - dt.timedelta(hours=STALE_HOURS))
        other = runs.where((F.col("batch_id") != batch_id) & (F.col("status") == "running") & recent)
        for row in other.select("batch_id", "started_at").limit(1).collect():
            raise BatchRefused(f"run {row.batch_id} of {row.started_at} is still open: one writer at a time")
        warehouse.log(audit.open_run(warehouse.spark, batch_id, mode, at, codes))
    except Exception:
        warehouse.unlock(batch_id)
        raise


@dataclass
class BatchResult:
    batch_id: str
    mode: str
    status: str
    extracted: int = 0
    loaded: int = 0
    quarantined: int = 0


def run_batch(warehouse: Warehouse, feeds: list[Feed], city_maps: dict[str, DataFrame],
              catalogs: dict[str, DataFrame], mode: str = "incremental",
              since: dt.date | None = None, dry_run: bool = False, batch_id: str | None = None,
              now: dt.datetime | None = None) -> BatchResult:
    """Load all feeds. A dry run conforms everything, orders included, and writes
    nothing to the warehouse. A failed run is logged, its quarantine rows are kept,
    and the error is raised again.

    A batch id that has succeeded is refused, as its facts would be overwritten; one
    that failed may be tried again. A load is refused while another one is open. Scratch
    tables and shuffles of the load are deleted once they have served.
    """
    with scratch_scope(warehouse.spark), released_shuffles(warehouse.spark):
        return _run_batch(warehouse, feeds, city_maps, catalogs, mode, since, dry_run, batch_id, now)


def _run_batch(warehouse: Warehouse, feeds: list[Feed], city_maps: dict[str, DataFrame],
               catalogs: dict[str, DataFrame], mode: str, since: dt.date | None, dry_run: bool,
               batch_id: str | None, now: dt.datetime | None) -> BatchResult:
    spark = warehouse.spark
    started = now or _now()
    codes = [f.spec.code for f in feeds]
    runs = warehouse.runs()
    starts = {code: resolve_since(runs, mode, since, started, code) for code in codes}
    result = BatchResult(batch_id or str(uuid.uuid4()), mode, "running")
    if not dry_run:
        begin_run(warehouse, result.batch_id, mode, started, codes)
    stages: list[DataFrame] = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        stored, counts = materialize_counted(df, name, **stage_counts())
        result.extracted += counts["extracted"]
        result.quarantined += counts["quarantined"]
        stages.append(stored)
        return stored

    def finish(status: str, notes: str | None = None) -> None:
        result.status = status
        if dry_run:
            return
        if stages:
            bad = conform.union_all([conform.split_quarantine(s)[1] for s in stages])
            warehouse.write_errors(audit.stamp_quarantine(bad, result.batch_id, started), result.batch_id)
        warehouse.log(audit.close_run(spark, result.batch_id, mode, started, _now(), result.extracted,
                                      result.loaded, result.quarantined, status, notes, codes))

    try:
        extracts = [f.extract(f.reader, starts[f.spec.code]) for f in feeds]
        torn = [conform.conform_unreadable(f.unreadable(), f.spec) for f in feeds if f.unreadable]
        if torn:
            stage(conform.union_all(torn), "unreadable")
        customers, products = conform_entities(feeds, extracts, city_maps, catalogs)
        customers, products = stage(customers, "customers"), stage(products, "products")
        tables = warehouse.tables()
        for judged, name, attributes in (
            (conform.good_customers(customers), "dim_customer", schemas.CUSTOMER_ATTRIBUTES),
            (conform.good_products(products), "dim_product", schemas.PRODUCT_ATTRIBUTES),
        ):
            _, keys, sk = DIMENSIONS[name]
            unique = last_per_key(judged, keys, [F.col(a) for a in attributes])

            def upsert(current: DataFrame, last: int | None) -> DataFrame:
                return upsert_scd1(current, unique, keys, attributes, sk, result.batch_id, started, last=last)

            if dry_run:
                tables[name] = materialize(upsert(tables[name], None), name)
            else:
                tables[name] = warehouse.update_dimension(name, judged, result.batch_id, upsert)
        # feed by feed: the shuffles of one are gone before those of the next
        sales = conform.union_all([
            stage(conform_orders([f], [x[f.spec.orders.table]], tables), "sales") for f, x in zip(feeds, extracts)])
        if not dry_run:
            new = insert_absent(tables["fact_sales"], conform.good_sales(sales), schemas.FACT_KEY,
                                schemas.FACT_ORDER, warehouse.layout()[0])
            new = new.withColumns({"etl_loaded_at": F.lit(started), "etl_batch_id": F.lit(result.batch_id)})
            result.loaded = warehouse.write_facts(new, result.batch_id)
        finish("succeeded")
    except Exception as error:
        notes = f"{type(error).__name__}: {error}"[:500]
        try:
            finish("failed", notes)
        except Exception as second:  # counting or quarantine fail too: the run must not stay open
            error.add_note(f"while closing the run: {second}")
            result.status = "failed"
            if not dry_run:
                warehouse.log(audit.close_run(spark, result.batch_id, mode, started, _now(), 0, 0, 0,
                                              "failed", notes, codes))
        raise
    finally:
        if not dry_run:
            warehouse.unlock(result.batch_id)
    return result
