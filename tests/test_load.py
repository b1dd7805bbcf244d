import datetime as dt
from decimal import Decimal

import pytest
from conftest import DAY, feeds, rows, source_frames
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import conform, dims, facts
from tallyloom.operators.audit import catchup_due, close_run, current_runs, open_run
from tallyloom.operators.lookup import heavy_keys
from tallyloom.plans.batch import BatchRefused, resolve_since, run_batch
from tallyloom.runtime import literal_rows
from tallyloom.sources.operational import frame_reader
from tallyloom.streaming.incremental import load_micro_batch

NOW = dt.datetime(2025, 1, 1, 12, tzinfo=dt.timezone.utc)
KEY = ["source_system", "source_customer_id"]


def load(warehouse, frames, city_maps, catalogs, mode="full", **kw):
    return run_batch(warehouse, feeds(frames), city_maps, catalogs, mode, **kw)


def test_batch_twice_inserts_once(spark, warehouse, city_maps, catalogs):
    frames = source_frames(spark)
    first = load(warehouse, frames, city_maps, catalogs, batch_id="one")
    before = rows(warehouse.tables()["fact_sales"])
    second = load(warehouse, frames, city_maps, catalogs, batch_id="two")
    assert (first.extracted, first.loaded, first.quarantined) == (10, 3, 0)
    assert (second.extracted, second.loaded, second.status) == (10, 0, "succeeded")
    assert rows(warehouse.tables()["fact_sales"]) == before
    runs = {r.batch_id: (r.mode, r.status, r.rows_loaded) for r in warehouse.runs().collect()}
    assert runs == {"one": ("full", "succeeded", 3), "two": ("full", "succeeded", 0)}


def test_input_order_does_not_matter(spark, warehouse, city_maps, catalogs, tmp_path):
    frames = source_frames(spark, orders=[
        ("o", 1, 10, q, 100, q * 100, DAY) for q in (5, 2, 9)] + [("p", 2, 11, 1, 50, 50, DAY)])
    load(warehouse, frames, city_maps, catalogs)
    got = rows(warehouse.tables()["fact_sales"], *schemas.FACT_COLUMNS)
    other = type(warehouse)(spark, str(tmp_path / "other"), warehouse.companies, warehouse.calendar)
    turned = {n: df.orderBy(F.desc(df.columns[0])).repartition(3) for n, df in frames.items()}
    load(other, turned, city_maps, catalogs)
    assert rows(other.tables()["fact_sales"], *schemas.FACT_COLUMNS) == got
    assert [r[4] for r in got if r[7] == "o"] == [2]  # one copy of the order, the first


def test_customer_moves_and_keeps_its_key(spark, warehouse, city_maps, catalogs):
    load(warehouse, source_frames(spark), city_maps, catalogs, batch_id="one")
    before = {r.source_customer_id: (r.customer_sk, r.city) for r in warehouse.tables()["dim_customer"].collect()}
    moved = source_frames(spark, customers=[
        (1, "Ann", "+963911111111", 2, DAY), (3, "New", "+963933333333", 1, DAY)])
    load(warehouse, moved, city_maps, catalogs, batch_id="two")
    after = {r.source_customer_id: (r.customer_sk, r.city, r.etl_batch_id)
             for r in warehouse.tables()["dim_customer"].collect()}
    assert before["1"] == (1, "North") and after["1"] == (1, "South", "two")
    assert after["2"] == (*before["2"], "one")
    assert after["3"][0] == 4  # follows the three keys of the first batch


def test_orders_of_quarantined_customers(spark, warehouse, city_maps, catalogs):
    bad = [(1, "Ann", "broken", 1, DAY)]
    load(warehouse, source_frames(spark, customers=bad), city_maps, catalogs, batch_id="one")
    reasons = {(r.source_table, r.reason_code) for r in warehouse.errors().collect()}
    assert reasons == {("customers", "invalid_phone"), ("orders", "no_customer")}
    # loaded once, the customer resolves even while its newest row is rejected
    load(warehouse, source_frames(spark), city_maps, catalogs, batch_id="two")
    later = source_frames(spark, customers=bad, orders=[("new", 1, 10, 1, 100, 100, DAY)])
    assert load(warehouse, later, city_maps, catalogs, batch_id="three").loaded == 1


def test_failed_batch_changes_nothing_for_readers(spark, warehouse, city_maps, catalogs, tmp_path):
    load(warehouse, source_frames(spark), city_maps, catalogs, batch_id="one")
    before = {n: rows(df) for n, df in warehouse.tables().items()}
    frames = source_frames(spark, customers=[(1, "Renamed", "+963911111111", 1, DAY), (5, "x", "bad", 1, DAY)])
    broken = tmp_path / "orders"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("this is no parquet file")
    frames["orders"] = spark.read.schema(schemas.LAYOUT_A["orders"]).parquet(str(broken))
    with pytest.raises(Exception):
        load(warehouse, frames, city_maps, catalogs, batch_id="two")
    assert {n: rows(df) for n, df in warehouse.tables().items()} == before
    run = warehouse.runs().where("batch_id = 'two'").first()
    assert run.status == "failed" and run.rows_quarantined == 1 and run.notes
    assert rows(warehouse.errors().where("batch_id = 'two'"), "reason_code") == [("invalid_phone",)]
    # the next batch goes on from the state before
    assert load(warehouse, source_frames(spark), city_maps, catalogs, batch_id="three").loaded == 0


def test_dry_run_reports_order_errors_and_writes_nothing(spark, warehouse, city_maps, catalogs):
    frames = source_frames(spark, orders=[("o", 99, 10, 1, 100, 100, DAY)])
    result = load(warehouse, frames, city_maps, catalogs, dry_run=True)
    assert (result.quarantined, result.loaded) == (1, 0)
    assert warehouse.runs().isEmpty() and warehouse.tables()["fact_sales"].isEmpty()


def test_looking_for_heavy_keys_changes_nothing(spark, warehouse, city_maps, catalogs, monkeypatch):
    monkeypatch.setattr("tallyloom.operators.lookup.PART_SHARE", 0.1)
    result = load(warehouse, source_frames(spark), city_maps, catalogs)
    assert (result.loaded, result.quarantined) == (3, 0)


def test_since_leaves_out_earlier_orders(spark, warehouse, city_maps, catalogs):
    frames = source_frames(spark)
    partial = load(warehouse, frames, city_maps, catalogs, "since", since=dt.date(2024, 4, 1))
    assert partial.loaded == 1
    assert load(warehouse, frames, city_maps, catalogs).loaded == 2


def test_corrected_order_is_not_changed(spark, warehouse, city_maps, catalogs):
    load(warehouse, source_frames(spark), city_maps, catalogs)
    corrected = source_frames(spark, orders=[("o1", 1, 10, 7, 100, 700, DAY)])
    load(warehouse, corrected, city_maps, catalogs)
    kept = warehouse.tables()["fact_sales"].where("source_order_id = 'o1'")
    assert rows(kept, "quantity") == [(2,)]


def run_log(spark, *lines):
    parts = []
    for batch_id, started, closed in lines:
        parts.append(open_run(spark, batch_id, "full", started))
        if closed:
            parts.append(close_run(spark, batch_id, "full", started, started, 1, 1, 0, closed))
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return current_runs(log)


def test_resolve_since(spark):
    old = NOW - dt.timedelta(days=20)
    runs = run_log(spark, ("a", old, "succeeded"), ("b", NOW, "failed"), ("c", NOW, None))
    assert resolve_since(runs, "full") is None
    assert resolve_since(runs, "incremental") == old.date()
    assert resolve_since(runs, "since", dt.date(2024, 5, 5)) == dt.date(2024, 5, 5)
    assert resolve_since(runs, "weekly", now=NOW) == dt.date(2024, 12, 29)
    for wrong in (dict(mode="full", since=old.date()), dict(mode="since"), dict(mode="other")):
        with pytest.raises(ValueError):
            resolve_since(runs, **wrong)


@pytest.mark.parametrize("age, due", [(None, True), (7.9, False), (8.1, True)])
def test_catch_up(spark, age, due):
    started = NOW if age is None else NOW - dt.timedelta(days=age)
    runs = run_log(spark, ("a", started, "failed" if age is None else "succeeded"))
    assert catchup_due(runs, F.lit(NOW)).first().due is due


def test_last_copy_of_a_dimension_key_wins(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 3, "new"), ("a", 2, "mid"), ("b", 1, "x")],
                               "k STRING, line INT, v STRING")
    assert rows(dims.last_per_key(df, ["k"], [F.col("line")]), "k", "v") == [("a", "new"), ("b", "x")]
    assert rows(dims.first_per_key(df, ["k"], [F.col("line")]), "k", "v") == [("a", "old"), ("b", "x")]


def test_hot_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = dims.first_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:]  # below the exchange


def test_upsert_counts(spark):
    current = spark.createDataFrame([("A", "1"), ("A", "2")], "source_system STRING, source_customer_id STRING")
    new = spark.createDataFrame([("A", "2"), ("A", "3"), ("A", "4")], current.schema)
    assert tuple(dims.upsert_counts(current, new, KEY).first()) == (2, 1)
    assert tuple(dims.upsert_counts(current, new.limit(0), KEY).first()) == (0, 0)


def test_company_rows_are_added_once(spark):
    first = dims.dim_company(spark, [("A", "أ", "a"), ("B", "ب", "b")])
    again = dims.dim_company(spark, [("B", "ب", "changed"), ("C", "ج", "c")], first)
    assert rows(again, "company_sk", "company_code", "company_name_en") == [
        (1, "A", "a"), (2, "B", "b"), (3, "C", "c")]


def test_insert_absent(spark):
    schema = "company_sk INT, source_order_id STRING, date_sk INT"
    current = spark.createDataFrame([(1, "a", 1)], schema)
    new = spark.createDataFrame([(1, "a", 9), (1, "b", 5), (1, "b", 4), (2, "a", 3)], schema)
    got = facts.insert_absent(current, new, schemas.FACT_KEY, ["date_sk"])
    assert rows(got) == [(1, "b", 4), (2, "a", 3)]


def test_constraints(spark):
    df = spark.createDataFrame([(1, 1, "a"), (0, 2, "b"), (None, 9, "b"), (5, None, "c")], "q INT, d INT, id STRING")
    dim = spark.createDataFrame([(1,), (2,)], "d INT")
    got = facts.check_constraints(df, ["q"], {"q > 0": F.col("q") > 0}, {"d": dim}, ["id"])
    assert dict(rows(got)) == {"q is not null": 1, "q > 0": 2, "d has a dimension row": 2, "id is unique": 1}


def test_heavy_keys(spark):
    df = spark.createDataFrame([("hot",)] * 40 + [(str(i),) for i in range(60)], "k STRING")
    assert heavy_keys(df, "k", 0.05, 0.1) == {"hot": 4}


def test_literal_rows_without_rows(spark):
    empty = literal_rows(spark, [], schemas.DIM_PRODUCT)
    assert empty.count() == 0 and empty.dtypes == spark.createDataFrame([], schemas.DIM_PRODUCT).dtypes


def test_money_survives_the_load(spark, warehouse, city_maps, catalogs):
    load(warehouse, source_frames(spark), city_maps, catalogs)
    sale = warehouse.tables()["fact_sales"].where("source_order_id = 't1'").first()
    assert (sale.unit_price_syp, sale.total_amount_syp) == (Decimal("100.50"), Decimal("301.50"))
    assert frame_reader({"x": 1})("x") == 1


# -- no rows are lost between loads ----------------------------------------------
def order_ids(warehouse):
    return [r[0] for r in rows(warehouse.tables()["fact_sales"], "source_order_id")]


def test_a_stream_does_not_move_the_watermark_of_batches(spark, warehouse, city_maps, catalogs):
    frames = source_frames(spark, orders=[], transactions=[])
    load(warehouse, frames, city_maps, catalogs, batch_id="dimensions", now=dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc))
    a, _ = feeds(frames)
    landed = spark.createDataFrame([("o1", 1, 10, 1, 100, 100, DAY)], schemas.LAYOUT_A["orders"])
    load_micro_batch(warehouse, a, landed, "stream-0")
    later = source_frames(spark, orders=[])  # a transaction of 2024-03-01 at source B
    load(warehouse, later, city_maps, catalogs, "incremental")
    assert order_ids(warehouse) == ["o1", "t1"]


def test_a_feed_that_comes_later_is_loaded_whole(spark, warehouse, city_maps, catalogs):
    frames = source_frames(spark)
    a, b = feeds(frames)
    run_batch(warehouse, [a], city_maps, catalogs, "incremental")
    assert order_ids(warehouse) == ["o1", "o2"]
    run_batch(warehouse, [a, b], city_maps, catalogs, "incremental")
    assert order_ids(warehouse) == ["o1", "o2", "t1"]


def test_a_loaded_batch_id_is_refused(spark, warehouse, city_maps, catalogs):
    frames = source_frames(spark)
    load(warehouse, frames, city_maps, catalogs, batch_id="x")
    with pytest.raises(BatchRefused):
        load(warehouse, frames, city_maps, catalogs, "since", since=dt.date(2025, 1, 1), batch_id="x")
    assert order_ids(warehouse) == ["o1", "o2", "t1"]
    assert {r.status for r in warehouse.runs().collect()} == {"succeeded"}


def test_a_second_writer_is_refused(spark, warehouse, city_maps, catalogs):
    now = dt.datetime.now(dt.timezone.utc)
    warehouse.log(open_run(spark, "other", "full", now))
    with pytest.raises(BatchRefused):
        load(warehouse, source_frames(spark), city_maps, catalogs)
    warehouse.log(close_run(spark, "other", "full", now, dt.datetime.now(dt.timezone.utc), 0, 0, 0, "failed"))
    assert load(warehouse, source_frames(spark), city_maps, catalogs).loaded == 3


def test_one_bad_row_is_quarantined(spark, warehouse, city_maps, catalogs):
    """A third source whose columns are all text."""
    text = lambda df: df.select(*[F.col(c).cast("string") for c in df.columns])
    frames = source_frames(spark, orders=[
        (f"o{i}", 1, 10, 1, 100, 100, DAY) for i in range(6)])
    raw = text(frames["orders"])
    ids, _, _, quantity, price, _, day = raw.columns
    for order_id, column, value in (("o1", quantity, "x"), ("o2", price, "n/a"), ("o3", price, "1e14"),
                                    ("o4", quantity, "99999999999"), ("o5", day, "no day")):
        raw = raw.withColumn(column, F.when(F.col(ids) == order_id, F.lit(value)).otherwise(F.col(column)))
    customers = text(frames["customers"])
    signup = customers.columns[-1]
    customers = customers.withColumn(signup, F.when(F.col(customers.columns[0]) == "2", F.lit("soon")).otherwise(F.col(signup)))
    a, _ = feeds(frames)
    judged = conform.conform_customers(customers.withColumn("city_ar", F.lit("مدينة 1")), a.spec, city_maps["ar"])
    assert rows(judged, "source_customer_id", "reason_code") == [("1", None), ("2", "invalid_signup")]
    load(warehouse, source_frames(spark), city_maps, catalogs)
    t = warehouse.tables()
    sales = conform.conform_sales(raw, a.spec, t["dim_customer"], t["dim_product"], t["dim_company"], t["dim_date"])
    got = {r.source_order_id: r.reason_code for r in sales.collect()}
    assert got == {"o0": None, "o1": "invalid_quantity", "o2": "invalid_amount", "o3": "invalid_amount",
                   "o4": "invalid_quantity", "o5": "date_not_in_calendar"}
