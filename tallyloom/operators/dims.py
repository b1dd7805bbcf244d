"""Dimensions: fixed rows, and overwrite-in-place with stable surrogate keys."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.ranking import ROWS_PER_RANGE, global_row_number
from tallyloom.runtime import literal_rows, materialize
from tallyloom.schemas import DIM_COMPANY


def dim_company(spark: SparkSession, companies: Sequence[tuple[str, str, str]],
                current: DataFrame | None = None) -> DataFrame:
    """Fixed (code, local name, English name) rows with keys 1, 2, ...; codes that
    ``current`` holds stay as they are, new ones get the next keys."""
    rows = [(i, *company) for i, company in enumerate(companies, start=1)]
    new = literal_rows(spark, rows, DIM_COMPANY)
    if current is None:
        return new
    fresh = new.join(current, "company_code", "left_anti")
    last = current.agg(F.coalesce(F.max("company_sk"), F.lit(0)).alias("_last"))
    # a fixed list of companies: a handful of rows
    numbered = fresh.withColumn("_n", F.row_number().over(W.orderBy("company_sk"))).crossJoin(last)
    added = numbered.withColumn("company_sk", F.col("_last") + F.col("_n")).drop("_n", "_last")
    return current.select(*new.columns).unionByName(added)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Last row per key; ``order`` is ascending. Spark drops the other copies before
    the shuffle, so a key with very many copies costs one row per task."""
    return _one_per_key(df, keys, [c.desc() for c in order])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key, otherwise as ``last_per_key``."""
    return _one_per_key(df, keys, [c.asc() for c in order])


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def assign_sk(new: DataFrame, current: DataFrame, sk: str, keys: Sequence[str],
              rows_per_range: int = ROWS_PER_RANGE, last: int | None = None) -> DataFrame:
    """The rows of ``new`` whose key ``current`` lacks, with surrogate keys that follow
    the current maximum in key order. ``new`` has unique keys. Give the maximum as
    ``last`` where it is known or ``current`` is only the part that holds these keys."""
    fresh = materialize(new.join(current.select(*keys), list(keys), "left_anti"), f"new-{sk}")
    if last is None:
        last = current.agg(F.max(sk)).first()[0] or 0
    numbered = global_row_number(fresh, keys, sk, rows_per_range)
    return numbered.withColumn(sk, (F.col(sk) + F.lit(last)).cast("bigint"))


def upsert_scd1(current: DataFrame, new: DataFrame, keys: Sequence[str], attributes: Sequence[str],
                sk: str, batch_id: str, loaded_at: dt.datetime,
                rows_per_range: int = ROWS_PER_RANGE, last: int | None = None) -> DataFrame:
    """The dimension after a batch: attributes and audit columns of keys in ``new`` are
    overwritten, surrogate keys stay, new keys are added. ``new`` has unique keys. With
    the greatest key as ``last``, ``current`` may be the parts that can hold these keys."""
    audited = new.select(*keys, *attributes).withColumns(
        {"etl_loaded_at": F.lit(loaded_at), "etl_batch_id": F.lit(batch_id)}
    )
    values = [*attributes, "etl_loaded_at", "etl_batch_id"]
    incoming = audited.select(*keys, F.struct(*values).alias("_new"))
    stored = current.join(incoming, list(keys), "left").select(
        sk, *keys,
        *[F.when(F.col("_new").isNotNull(), F.col(f"_new.{v}")).otherwise(F.col(v)).alias(v)
          for v in values],
    )
    added = assign_sk(audited, current, sk, keys, rows_per_range, last)
    return stored.unionByName(added.select(*stored.columns))


def upsert_counts(current: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys of ``new`` that are inserted, rows of ``new`` that update."""
    known = current.select(*keys).withColumn("_known", F.lit(1))
    marked = new.groupBy(*keys).agg(F.count("*").alias("_rows")).join(known, list(keys), "left")
    inserted = F.coalesce(F.sum(F.when(F.col("_known").isNull(), 1)), F.lit(0)).cast("bigint")
    rows = F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint")
    return marked.agg(inserted.alias("inserted"), (rows - inserted).alias("updated"))
