"""What a load leaves on disk: no shuffle files of ended writes, no scratch tables."""

import glob
import os
import time
from dataclasses import replace
from types import SimpleNamespace

from conftest import feeds, rows, source_frames
from pyspark.sql import functions as F

from tallyloom import runtime
from tallyloom.plans import batch, catalog, testmart
from tallyloom.plans.batch import run_batch
from tallyloom.runtime import materialize, materialize_buckets, released_shuffles, scratch_dir, scratch_scope


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in files.mkString("\n").split("\n") if "/shuffle_" in name}


def left_over(spark, before):
    """Shuffle files that are there beside those of ``before``; they are deleted in the background."""
    for _ in range(40):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


def scratch(spark, name="*"):
    return set(glob.glob(f"{scratch_dir(spark)}/{name}".removeprefix("file:")))


def small_mart(spark, warehouse, city_maps, catalogs):
    fixed = [replace(f, fixed=True) for f in feeds(source_frames(spark))]
    run_batch(warehouse, fixed, city_maps, catalogs, "full", batch_id="one")
    return SimpleNamespace(spark=spark, feeds=fixed, tables=warehouse.tables(), city_maps=city_maps, catalogs=catalogs)


def test_shuffles_end_with_the_write_they_serve(spark):
    grouped = spark.range(0, 1000, numPartitions=4).groupBy(F.col("id") % 7).agg(F.count("*").alias("n"))
    before, setting = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    stored = materialize(grouped, "grouped")
    bucketed = materialize_buckets(grouped.repartition(3, "n"), "grouped", "n", 3)
    with released_shuffles(spark):
        grouped.write.format("noop").mode("overwrite").save()
    assert not left_over(spark, before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert rows(stored) == rows(bucketed) and len(rows(stored)) == 7


def test_scratch_tables_end_with_their_scope(spark):
    before = scratch(spark)
    with scratch_scope(spark):
        kept = materialize(spark.range(3), "inner")
        with scratch_scope(spark):
            materialize_buckets(spark.range(3), "innermost", "id", 2)
            assert len(scratch(spark) - before) == 2
        assert len(scratch(spark) - before) == 1 and kept.count() == 3
    assert scratch(spark) == before
    materialize(spark.range(3), "outside")
    assert len(scratch(spark) - before) == 1


def test_a_load_leaves_no_scratch_and_no_shuffles(spark, warehouse, city_maps, catalogs, monkeypatch):
    files, tables, staged = shuffle_files(spark), scratch(spark), []
    counted = runtime.materialize_counted
    monkeypatch.setattr(batch, "materialize_counted", lambda df, name, **c: (staged.append(name), counted(df, name, **c))[1])
    result = run_batch(warehouse, feeds(source_frames(spark)), city_maps, catalogs, "full", batch_id="one")
    assert (result.extracted, result.loaded, result.status) == (10, 3, "succeeded")
    assert staged == ["customers", "products", "sales", "sales"]  # feed by feed
    assert scratch(spark) == tables
    assert not left_over(spark, files)
    assert warehouse.tables()["fact_sales"].count() == 3 and warehouse.errors().count() == 0


def test_orders_are_conformed_feed_by_feed(spark, warehouse, city_maps, catalogs):
    """What a query keeps of them is stored, and nothing else."""
    m, before = small_mart(spark, warehouse, city_maps, catalogs), scratch(spark)
    kept = catalog.conformed_sales(m, lambda judged: judged.select("source_order_id", "quantity"))
    assert rows(kept) == [("o1", 2), ("o2", 1), ("t1", 3)]
    stored = scratch(spark) - before
    assert len(stored) == 2 and all(os.path.basename(s).startswith("sales-") for s in stored)
    assert all(spark.read.parquet(s).columns == ["source_order_id", "quantity"] for s in stored)
    assert catalog.conformed_sales(m).count() == 3


def test_sources_leave_no_joined_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(testmart, "project_sources", lambda s, d: {"orders": materialize(s.range(5).repartition(2), "lines")})
    monkeypatch.setattr(testmart, "city_maps", lambda s, d: {})
    monkeypatch.setattr(testmart, "catalogs", lambda s, d: {})
    files, tables = shuffle_files(spark), scratch(spark)
    mart = testmart.Mart(spark, "", str(tmp_path))
    assert scratch(spark) == tables and not left_over(spark, files)
    assert spark.read.parquet(f"{mart.sources_root}/orders").count() == 5
