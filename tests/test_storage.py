"""What is stored where: buckets of facts, parts of dimensions, the writer's file."""

import datetime as dt
import os
import re
import threading

import pyarrow.parquet as pq
import pytest
from conftest import COMPANIES, CALENDAR, rows
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import dims, facts
from tallyloom.operators.audit import close_run, open_run
from tallyloom.plans.batch import BatchRefused, begin_run
from tallyloom.plans.warehouse import Warehouse, WriterBusy

NOW = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "store"), COMPANIES, CALENDAR, buckets=4, parts=4)


def finish(store, batch_id):
    done = dt.datetime.now(dt.timezone.utc)
    store.log(open_run(store.spark, batch_id, "full", done))
    store.log(close_run(store.spark, batch_id, "full", done, done, 1, 1, 0, "succeeded"))


def fact_rows(spark, first, last, batch_id):
    return spark.range(first, last).select(
        F.lit(20240101).alias("date_sk"), F.lit(1).cast("long").alias("customer_sk"), F.lit(1).cast("long").alias("product_sk"),
        (F.col("id") % 2).cast("int").alias("company_sk"), F.lit(1).alias("quantity"),
        *[F.lit(1).cast("decimal(14,2)").alias(c) for c in ("unit_price_syp", "total_amount_syp")],
        F.col("id").cast("string").alias("source_order_id"), F.lit(NOW).alias("etl_loaded_at"),
        F.lit(batch_id).alias("etl_batch_id"))


def add_facts(store, first, last, batch_id):
    new = facts.insert_absent(store.facts(store.succeeded()), fact_rows(store.spark, first, last, batch_id),
                              schemas.FACT_KEY, schemas.FACT_ORDER, store.layout()[0])
    return store.write_facts(new, batch_id)


def test_stored_facts_are_not_shuffled(spark, store):
    for first, last, batch_id in ((0, 300, "one"), (200, 500, "two")):
        assert add_facts(store, first, last, batch_id) == (300 if batch_id == "one" else 200)
        finish(store, batch_id)
    for threshold in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            new = facts.insert_absent(store.facts(["one", "two"]), fact_rows(spark, 400, 700, "three"),
                                      schemas.FACT_KEY, schemas.FACT_ORDER, 4)
            plan = new._jdf.queryExecution().executedPlan().toString()
            assert new.count() == 200
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        if threshold == "-1":
            scan = next(line for line in plan.splitlines() if "FileScan" in line)
            assert "Bucketed: true" in scan and "PartitionFilters: [batch_id" in scan
            exchanges = [line for line in plan.splitlines() if "Exchange" in line]
            assert len(exchanges) == 2 and "REPARTITION_BY_NUM" in exchanges[0]  # both of the new rows
            assert plan.index("FileScan") > plan.rindex("Exchange")  # and none above the stored ones


def test_a_batch_that_is_written_again_replaces_its_own_rows(store):
    add_facts(store, 0, 50, "one")
    finish(store, "one")
    assert add_facts(store, 40, 80, "two") == 30  # and its run failed
    assert add_facts(store, 40, 60, "two") == 10
    finish(store, "two")
    found = store.tables()["fact_sales"]
    assert found.count() == 60 and found.select(*schemas.FACT_KEY).distinct().count() == 60
    assert Warehouse(store.spark, store.root, COMPANIES, CALENDAR, buckets=9).layout() == (4, 4)


def test_facts_are_in_one_file_a_bucket_with_bloom_filters(store):
    add_facts(store, 0, 400, "one")
    folder = store.path("fact_sales", "one")
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert sorted(re.search(r"_(\d{5})\.", f).group(1) for f in files) == ["00000", "00001", "00002", "00003"]
    for name in files:
        group = pq.ParquetFile(f"{folder}/{name}").metadata.row_group(0)
        column = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == "source_order_id")
        data = open(f"{folder}/{name}", "rb").read()
        assert len(data) > column.total_compressed_size + 1024  # a filter of a thousand bytes and more lies beside it


def customers(spark, ids, name):
    return spark.createDataFrame([("AA", str(i), name, "+1", "North", NOW.date()) for i in ids],
                                 "source_system STRING, source_customer_id STRING, full_name STRING, phone_e164 STRING, "
                                 "city STRING, signup_date DATE")


def update(store, ids, name, batch_id):
    new = customers(store.spark, ids, name)

    def upsert(current, last):
        return dims.upsert_scd1(current, new, schemas.CUSTOMER_KEY, schemas.CUSTOMER_ATTRIBUTES, "customer_sk",
                                batch_id, NOW, last=last)

    return store.update_dimension("dim_customer", new, batch_id, upsert)


def test_only_touched_parts_are_rewritten(spark, store):
    update(store, range(40), "first", "one")
    finish(store, "one")
    before = {r["source_customer_id"]: r["customer_sk"] for r in store.tables()["dim_customer"].collect()}
    assert sorted(before.values()) == list(range(1, 41))
    changed = update(store, [7], "second", "two")
    part = customers(spark, [7], "x").select(store.part_of("dim_customer")).first()[0]
    assert [f for f in os.listdir(store.path("dim_customer", "two")) if "=" in f] == [f"part={part}"]
    read = {f.split("batch_id=")[1].split("/")[0] + "/" + f.split("part=")[1].split("/")[0] for f in changed.inputFiles()}
    assert read == {f"one/{p}" for p in range(4) if p != part} | {f"two/{part}"}
    assert store.tables()["dim_customer"].where("full_name = 'second'").isEmpty()  # not yet for readers
    finish(store, "two")
    after = store.tables()["dim_customer"].collect()
    assert {r["source_customer_id"]: r["customer_sk"] for r in after} == before
    assert {r["source_customer_id"] for r in after if r["full_name"] == "second"} == {"7"}


def test_a_failed_update_and_its_retry(store):
    update(store, range(10), "first", "one")
    finish(store, "one")
    update(store, range(20), "lost", "two")  # its run never succeeds in this form
    update(store, [3, 50], "kept", "two")
    finish(store, "two")
    found = {r["source_customer_id"]: (r["customer_sk"], r["full_name"]) for r in store.tables()["dim_customer"].collect()}
    assert len(found) == 11 and found["3"][1] == "kept" and found["50"] == (11, "kept")
    assert {n for _, n in found.values()} == {"first", "kept"}


def test_of_two_writers_at_once_one_is_refused(store):
    results, start = [], threading.Barrier(2)

    def begin(name):
        start.wait()
        try:
            begin_run(store, name, "full", dt.datetime.now(dt.timezone.utc), ["AA"])
            results.append((name, "open"))
        except BatchRefused:
            results.append((name, "refused"))

    threads = [threading.Thread(target=begin, args=(n,)) for n in ("x", "y")]
    [t.start() for t in threads], [t.join() for t in threads]
    assert sorted(r for _, r in results) == ["open", "refused"]
    assert [r["batch_id"] for r in store.runs().collect()] == [n for n, r in results if r == "open"]


def test_the_writer_s_file(store):
    store.lock("x", 1)
    store.lock("x", 1)  # the same writer again, after a crash
    with pytest.raises(WriterBusy):
        store.lock("y", 1)
    store.unlock("y")
    with pytest.raises(WriterBusy):
        store.lock("y", 1)
    store.lock("y", 0)  # stale
    store.unlock("y")
    store.lock("z", 1)
    store.unlock("z")
