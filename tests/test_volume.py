"""What a load moves and stores: one shuffle of new facts, buckets by size, text files of many tasks."""

import glob
import os
from dataclasses import replace

import pytest
from conftest import CALENDAR, COMPANIES, feeds, source_frames
from pyspark.sql import functions as F
from test_storage import add_facts, fact_rows, finish

from tallyloom import schemas
from tallyloom.operators import facts
from tallyloom.plans import catalog, testmart
from tallyloom.plans.batch import conform_orders
from tallyloom.plans.warehouse import Warehouse
from tallyloom.runtime import scratch_dir, shuffle_partitions
from tallyloom.sources.operational import tolerant_csv_reader, unreadable_lines


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "store"), COMPANIES, CALENDAR, buckets=4, parts=4)


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_new_facts_are_shuffled_once(spark, store, monkeypatch):
    """The shuffle that finds first copies deals into the buckets too, while facts are written."""
    new = fact_rows(spark, 0, 300, "one").unionByName(fact_rows(spark, 0, 300, "one"))
    dealt = facts.insert_absent(None, new, schemas.FACT_KEY, schemas.FACT_ORDER, 4)
    assert shuffles(dealt) == 2
    seen, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr("tallyloom.plans.warehouse.shuffle_partitions",
                        lambda s, n: (seen.append(n), shuffle_partitions(s, n))[1])
    assert store.write_facts(dealt, "one") == 300 and seen == [4]
    with shuffle_partitions(spark, 4):
        assert shuffles(facts.insert_absent(None, new, schemas.FACT_KEY, schemas.FACT_ORDER, 4)) == 1
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    finish(store, "one")
    assert add_facts(store, 200, 500, "two") == 200


def test_buckets_and_parts_follow_the_sources(spark, tmp_path, monkeypatch):
    mart = testmart.Mart.__new__(testmart.Mart)
    mart.spark, mart.root, mart.sources_root = spark, str(tmp_path), str(tmp_path / "sources")
    for name in ("orders", "transactions", "customers", "clients", "products", "items"):
        spark.range(1000).write.parquet(f"{mart.sources_root}/{name}")
    assert mart.new_warehouse("small")._asked == (8, 8)
    monkeypatch.setattr(testmart, "BYTES_PER_BUCKET", 500)
    buckets, parts = mart.new_warehouse("large")._asked
    assert buckets > 8 and parts == pytest.approx(2 * buckets, abs=2)


def test_stored_orders_are_not_copied(spark, warehouse):
    frames = source_frames(spark)
    feed, tables = feeds(frames)[0], warehouse.tables()
    raw = feed.extract_orders(feed.reader, None)
    copies = lambda: len(glob.glob(f"{scratch_dir(spark)}/orders-*".removeprefix("file:")))
    before = copies()
    stored = conform_orders([feed], [raw], tables, stored=True).drop("source_row").collect()
    assert copies() == before
    assert sorted(map(str, conform_orders([feed], [raw], tables).drop("source_row").collect())) == sorted(map(str, stored))
    assert copies() == before + 1


def test_orders_of_a_fixed_feed_are_not_copied(spark, warehouse):
    frames = source_frames(spark)
    feed, tables = feeds(frames)[0], warehouse.tables()
    raw = feed.extract_orders(feed.reader, None)
    copies = lambda: len(glob.glob(f"{scratch_dir(spark)}/orders-*".removeprefix("file:")))
    before = copies()
    kept = conform_orders([replace(feed, fixed=True)], [raw], tables).drop("source_row").collect()
    assert copies() == before
    assert sorted(map(str, conform_orders([feed], [raw], tables).drop("source_row").collect())) == sorted(map(str, kept))
    mart = testmart.Mart.__new__(testmart.Mart)
    mart.spark, mart.sources_root = spark, ""
    assert all(f.fixed for f in mart.feeds)


def test_lines_of_many_tasks(spark, tmp_path):
    """Every task writes a file of its own that begins with the names of the columns."""
    layout = {"t": schemas.T.StructType([schemas.T.StructField("a", schemas.LONG), schemas.T.StructField("b", schemas.TEXT)])}
    line = F.when(F.col("id") % 10 == 3, F.lit("torn")).otherwise(F.concat_ws(",", "id", F.lit("x")))
    catalog.write_lines(spark.range(0, 100, numPartitions=5).select(line.alias("value")), "a,b", str(tmp_path / "t"))
    files = glob.glob(str(tmp_path / "t" / "part-*"))
    assert len(files) == 5 and all(open(f).readline() == "a,b\n" for f in files) and all(os.path.getsize(f) for f in files)
    assert len(tolerant_csv_reader(spark, str(tmp_path), layout)("t").collect()) == 90
    assert len(unreadable_lines(spark, str(tmp_path), layout, ["t"]).collect()) == 10
