"""Reading the operational tables of the two source layouts.

A *reader* is a function from table name to DataFrame, so the same extract code
runs over parquet, CSV, JDBC or frames already at hand.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Reader = Callable[[str], DataFrame]


def parquet_reader(spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]) -> Reader:
    return lambda table: spark.read.schema(schemas[table]).parquet(f"{root}/{table}")


def csv_reader(spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]) -> Reader:
    return lambda table: spark.read.csv(f"{root}/{table}", schema=schemas[table], header=True)


UNREADABLE = "_unreadable"


def _csv_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a CSV table, and of a line that is none the line itself. Every line is read
    with all its columns, so the same lines are unreadable whatever a query needs."""
    marked = T.StructType([*schema, T.StructField(UNREADABLE, T.StringType())])
    reader = spark.read.schema(marked).option("columnPruning", False)
    return reader.csv(path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=UNREADABLE)


def tolerant_csv_reader(spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]) -> Reader:
    """``csv_reader`` of the lines that can be read: ``unreadable_lines`` has the others."""
    def read(table: str) -> DataFrame:
        lines = _csv_lines(spark, f"{root}/{table}", schemas[table])
        return lines.where(F.col(UNREADABLE).isNull()).select(*schemas[table].names)

    return read


def unreadable_lines(spark: SparkSession, root: str, schemas: Mapping[str, T.StructType],
                     tables: Sequence[str]) -> DataFrame:
    """(source_table, line, first_field) of the lines with other fields than the table has,
    or fields of other types: torn, shifted or foreign ones."""
    parts = [
        _csv_lines(spark, f"{root}/{table}", schemas[table]).where(F.col(UNREADABLE).isNotNull())
        .select(F.lit(table).alias("source_table"), F.col(UNREADABLE).alias("line"),
                F.col(schemas[table].names[0]).cast("string").alias("first_field")) for table in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def frame_reader(frames: Mapping[str, DataFrame]) -> Reader:
    return lambda table: frames[table]


def jdbc_reader(
    spark: SparkSession,
    options: Mapping[str, str],
    splits: Mapping[str, tuple[str, object, object, int]],
) -> Reader:
    """Read over JDBC. ``splits`` gives (column, lower, upper, partitions) for every
    table, since without it a table would arrive whole in one task."""

    def read(table: str) -> DataFrame:
        column, lower, upper, partitions = splits[table]
        return (
            spark.read.format("jdbc")
            .options(**options)
            .option("dbtable", table)
            .option("partitionColumn", column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", partitions)
            .load()
        )

    return read


def since_filter(df: DataFrame, column: str, since: dt.date | None) -> DataFrame:
    """Rows dated on or after ``since``; all rows where it is None. It compares the
    stored column itself, so that the filter reaches the scan."""
    return df if since is None else df.where(F.col(column) >= F.lit(since))


# -- layout A -------------------------------------------------------------
def customers_a(reader: Reader) -> DataFrame:
    cities = reader("cities").select("city_id", "city_ar")
    return reader("customers").join(cities, "city_id").select(
        F.col("customer_id").cast("string").alias("customer_id"),
        "full_name", "phone", "city_ar",
        F.col("signup_date").cast("date").alias("signup_date"),
    )


def products_a(reader: Reader) -> DataFrame:
    return reader("products").select(
        F.col("product_id").cast("string").alias("product_id"),
        "product_name", "category", "unit_price",
    )


def orders_a(reader: Reader, since: dt.date | None = None) -> DataFrame:
    return since_filter(reader("orders"), "order_date", since).select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("product_id").cast("string").alias("product_id"),
        "quantity", "unit_price_at_sale", "total_price",
        F.col("order_date").cast("date").alias("order_date"),
    )


def read_source_a(reader: Reader, since: dt.date | None = None) -> dict[str, DataFrame]:
    """Customers with their city name, products, and orders since a date."""
    return {"customers": customers_a(reader), "products": products_a(reader),
            "orders": orders_a(reader, since)}


# -- layout B -------------------------------------------------------------
def clients_b(reader: Reader) -> DataFrame:
    return reader("clients").select(
        F.col("client_id").cast("string").alias("client_id"),
        "client_name", "msisdn", "city_en",
        F.col("registered_at").cast("date").alias("registered_at"),
    )


def items_b(reader: Reader) -> DataFrame:
    return reader("items").select(
        F.col("item_id").cast("string").alias("item_id"), "item_name", "item_type", "price_syp",
    )


def transactions_b(reader: Reader, since: dt.date | None = None) -> DataFrame:
    return since_filter(reader("transactions"), "tx_date", since).select(
        F.col("tx_id").cast("string").alias("tx_id"),
        F.col("client_id").cast("string").alias("client_id"),
        F.col("item_id").cast("string").alias("item_id"),
        "qty", "price_at_tx", "tx_date", "tx_time",
    )


def read_source_b(reader: Reader, since: dt.date | None = None) -> dict[str, DataFrame]:
    """Clients, items, and transactions since a date."""
    return {"clients": clients_b(reader), "items": items_b(reader),
            "transactions": transactions_b(reader, since)}
