import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from conftest import DAY, feeds, rows, source_frames

from tallyloom import schemas
from tallyloom.operators import rfm
from tallyloom.plans.batch import feed_a, run_batch
from tallyloom.runtime import materialize, scratch_dir
from tallyloom.sources import results
from tallyloom.sources.mappings import read_catalog, read_city_map
from tallyloom.sources.operational import csv_reader, jdbc_reader, parquet_reader, read_source_a, read_source_b
from tallyloom.streaming import incremental
from tallyloom.streaming.incremental import Landing, OrderStream, load_micro_batch, stream_orders


def test_city_map_is_trimmed_and_the_last_line_wins(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text('ar,en\n" مدينة 1 ", North \nمدينة 2,South\nمدينة 1,Late\n', encoding="utf-8")
    maps = read_city_map(spark, str(path))
    assert rows(maps["ar"], "key", "value") == [("مدينة 1", "Late"), ("مدينة 2", "South")]
    assert rows(maps["en"], "key", "value") == [("Late", "Late"), ("North", "North"), ("South", "South")]


def test_catalog_by_either_name(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text("offering_id,category,a_name,a_price,b_category,b_name,b_price\n"
                    "1,Voice,دقائق,5000,VOICE,Minutes,5000.00\n", encoding="utf-8")
    maps = read_catalog(spark, str(path))
    assert rows(maps["local_name"], "key", "value") == [("دقائق", "Minutes")]
    assert rows(maps["english_name"], "key", "value") == [("Minutes", "Minutes")]


def test_customers_without_city_row_are_not_read(spark):
    frames = source_frames(spark, customers=[(1, "a", "x", 1, DAY), (2, "b", "x", 9, DAY)])
    got = read_source_a(feeds(frames)[0].reader)["customers"]
    assert rows(got, "customer_id", "city_ar", "signup_date") == [("1", "مدينة 1", dt.date(2024, 3, 1))]


@pytest.mark.parametrize("fmt, reader", [("parquet", parquet_reader), ("csv", csv_reader)])
def test_stored_sources_read_alike(spark, tmp_path, fmt, reader):
    frames = source_frames(spark)
    for name, df in frames.items():
        writer = df.write.option("header", True) if fmt == "csv" else df.write
        writer.format(fmt).save(str(tmp_path / name))
    direct = {**read_source_a(feeds(frames)[0].reader), **read_source_b(feeds(frames)[1].reader)}
    stored = {**read_source_a(reader(spark, str(tmp_path), schemas.LAYOUT_A)),
              **read_source_b(reader(spark, str(tmp_path), schemas.LAYOUT_B))}
    for name, df in direct.items():
        assert rows(stored[name]) == rows(df), name


def test_jdbc_needs_a_split_for_every_table(spark):
    with pytest.raises(KeyError):
        jdbc_reader(spark, {"url": "jdbc:none"}, {})("orders")


def segmented(spark):
    table = [(i, "name, with comma", "c", "AA", "A", "AA", i, i, Decimal(i)) for i in range(1, 11)]
    raw = spark.createDataFrame(table, "customer_sk LONG, full_name STRING, city STRING, source_system STRING, "
                                "company STRING, company_code STRING, recency_days INT, frequency LONG, monetary_syp DECIMAL(24,2)")
    return rfm.segment_customers(materialize(raw, "raw"))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_stored_segments(spark, tmp_path, fmt):
    done = segmented(spark)
    assert done.columns == rfm.RFM_COLUMNS and len(done.columns) == 14
    results.write_rfm(done, str(tmp_path / "rfm"), fmt)
    assert rows(results.read_rfm(spark, str(tmp_path / "rfm"), fmt)) == rows(rfm.segment_summary(done))


def test_load_or_compute(spark, tmp_path):
    there, missing = str(tmp_path / "there"), str(tmp_path / "missing")
    spark.range(3).write.parquet(there)
    assert results.load_or_compute(lambda: spark.read.parquet(there), lambda: spark.range(1)).count() == 3
    assert results.load_or_compute(lambda: spark.read.parquet(missing), lambda: spark.range(1)).count() == 1
    with pytest.raises(Exception):  # other errors are not swallowed
        results.load_or_compute(lambda: spark.range(1).select("no_column"), lambda: spark.range(1))


def test_scratch_lies_in_the_checkpoint_folder(spark):
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.fixture
def streaming(spark, warehouse, city_maps, catalogs, tmp_path):
    """A warehouse with dimensions, and a landing folder for orders of source A."""
    run_batch(warehouse, feeds(source_frames(spark, orders=[], transactions=[])), city_maps, catalogs,
              "full", batch_id="dimensions")
    feed = feed_a("AA", lambda name: None)
    landing = str(tmp_path / "landing")

    def land(*orders):
        spark.createDataFrame(list(orders), schemas.LAYOUT_A["orders"]).coalesce(1).write.mode("append").parquet(landing)

    def run(checkpoint="checkpoint"):
        stream_orders(warehouse, feed, schemas.LAYOUT_A["orders"], landing, str(tmp_path / checkpoint),
                      "orders-a", files_per_batch=1).awaitTermination()
        return rows(warehouse.tables()["fact_sales"], "source_order_id", "quantity")

    return land, run, feed, warehouse


def order(name, customer=1, quantity=1, day=DAY):
    return (name, customer, 10, quantity, 100, 100 * quantity, day)


def test_stream_loads_each_order_once(streaming):
    land, run, _, warehouse = streaming
    land(order("a"), order("b", quantity=2), order("x", customer=99))
    assert run() == [("a", 1), ("b", 2)]
    assert run() == [("a", 1), ("b", 2)]  # a restart adds nothing
    land(order("a", quantity=9), order("old", day=dt.datetime(2024, 1, 1)))  # known, and late
    assert run() == [("a", 1), ("b", 2), ("old", 1)]
    assert rows(warehouse.errors(), "reason_code") == [("no_customer",)]


def test_a_new_checkpoint_loses_no_file(streaming):
    land, run, _, warehouse = streaming
    land(order("a"))
    run()
    land(order("b"))
    assert run("second") == [("a", 1), ("b", 1)]
    assert {r.status for r in warehouse.runs().collect()} == {"succeeded"}


def test_a_failed_micro_batch_is_logged(spark, streaming):
    _, _, feed, warehouse = streaming
    broken = spark.createDataFrame([order("a")], schemas.LAYOUT_A["orders"]).withColumn(
        "order_id", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception):
        load_micro_batch(warehouse, feed, broken, "orders-a-x")
    assert rows(warehouse.runs().where("batch_id = 'orders-a-x'"), "status") == [("failed",)]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        applicationId, master = "app-1", "spark://host:7077"

    class Session:
        sparkContext, conf = Context, {}

    with pytest.raises(RuntimeError):
        scratch_dir(Session)
    Context.master = "local[2]"
    assert scratch_dir(Session) == scratch_dir(Session) and Session.conf == {}


def test_stream_equals_batch(spark, streaming, city_maps, catalogs, tmp_path):
    land, run, _, warehouse = streaming
    orders = [order(f"o{i}", 1 + i % 2, 1 + i % 4) for i in range(20)] + [order("o3", 1, 9)]
    for start in (0, 7, 14):
        land(*orders[start:start + 7])
    run()
    other = type(warehouse)(spark, str(tmp_path / "batch"), warehouse.companies, warehouse.calendar)
    run_batch(other, feeds(source_frames(spark, orders=orders, transactions=[])), city_maps, catalogs, "full")
    streamed, batched = (rows(w.tables()["fact_sales"], *[c for c in schemas.FACT_COLUMNS]) for w in (warehouse, other))
    assert len(streamed) == 20 and [r for r in streamed if r[7] != "o3"] == [r for r in batched if r[7] != "o3"]


def test_repeated_micro_batch_is_loaded_once(spark, streaming):
    _, _, feed, warehouse = streaming
    landed = spark.createDataFrame([order("a")], schemas.LAYOUT_A["orders"])
    for _ in range(2):
        load_micro_batch(warehouse, feed, landed, "orders-a-0")
    # the second time after facts were written but before the run was closed
    assert rows(warehouse.tables()["fact_sales"], "source_order_id") == [("a",)]


def test_only_keys_of_other_loads_are_fed_and_each_once(spark, streaming, city_maps, catalogs, tmp_path):
    """Loads of others between the calls, files that come twice and late, a broken-off call."""
    land, run, feed, warehouse = streaming
    stream = OrderStream(warehouse, [Landing(feed, schemas.LAYOUT_A["orders"], str(tmp_path / "landing"))],
                         str(tmp_path / "checkpoint"), "orders-a", 1)
    land(order("a"), order("x", customer=99))
    assert run() == [("a", 1)] and stream.foreign_batches() == []
    batch = source_frames(spark, orders=[order("a", quantity=5), order("b", quantity=2)], transactions=[])
    run_batch(warehouse, feeds(batch), city_maps, catalogs, "full", batch_id="nightly")
    assert stream.foreign_batches() == ["nightly"]
    land(order("b", quantity=9), order("c", day=dt.datetime(2024, 1, 1)))  # known from the nightly load, and late
    stream.conform(stream.landings[0]).awaitTermination()
    assert stream.feed_seeds() and not stream.feed_seeds() and stream.feed_rows()
    # the call breaks off before its rows are loaded; the next one takes them up
    land(order("c", quantity=7), order("x", customer=1))  # again, and now with a customer that is known
    assert run() == [("a", 1), ("b", 2), ("c", 1), ("x", 1)]
    assert stream.foreign_batches() == []
    state = list((tmp_path / "checkpoint" / "keys" / "state").rglob("*.zip")) + list(
        (tmp_path / "checkpoint" / "keys" / "state").rglob("*.changelog"))
    assert state  # what the RocksDB store keeps


def test_each_key_is_looked_up_once_in_the_state(spark, streaming, tmp_path, monkeypatch):
    """Also in a store that was begun with the settings of before; the session keeps its own."""
    land, run, feed, warehouse = streaming
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    land(order("a"), order("b", quantity=2))
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "STATE_STORE", {setting: incremental.STATE_STORE[setting]})
        assert run() == [("a", 1), ("b", 2)]
    land(order("a", quantity=9), order("c"), order("d"))
    stream = OrderStream(warehouse, [Landing(feed, schemas.LAYOUT_A["orders"], str(tmp_path / "landing"))],
                         str(tmp_path / "checkpoint"), "orders-a", 1)
    query = stream.start()
    query.awaitTermination()
    states = [s for p in query.recentProgress if p["numInputRows"] for s in p["stateOperators"]]
    assert sum(s["customMetrics"]["rocksdbGetCount"] for s in states) == 3
    assert run() == [("a", 1), ("b", 2), ("c", 1), ("d", 1)]
    assert spark.conf.get(setting) == before


def test_two_sources_in_one_stream(spark, warehouse, city_maps, catalogs, tmp_path):
    frames = source_frames(spark)
    run_batch(warehouse, feeds(source_frames(spark, orders=[], transactions=[])), city_maps, catalogs, "full")
    landings = []
    for feed, layout in zip(feeds(frames), (schemas.LAYOUT_A, schemas.LAYOUT_B)):
        path = str(tmp_path / feed.spec.code)
        frames[feed.spec.orders.table].write.parquet(path)
        landings.append(Landing(feed, layout[feed.spec.orders.table], path))
    for _ in range(2):
        OrderStream(warehouse, landings, str(tmp_path / "checkpoint"), "both").start().awaitTermination()
    assert rows(warehouse.tables()["fact_sales"], "source_order_id") == [("o1",), ("o2",), ("t1",)]
