"""Two operational sources that disagree, projected from TPC-H-like tables, and the
warehouse loaded from them.

Even customer keys belong to source A, odd ones to source B. Defects are placed by
key arithmetic: cities outside the mapping, broken phones, unknown categories and
products, wrong stored totals, zero quantities, dates after the calendar's end.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.plans.batch import Feed, feed_a, feed_b, run_batch
from tallyloom.plans.warehouse import BUCKETS, PARTS, Warehouse
from tallyloom.runtime import COMPACT, literal_rows, materialize, released_shuffles, scratch_dir, scratch_scope
from tallyloom.runtime import stored_bytes
from tallyloom.schemas import LAYOUT_A, LAYOUT_B
from tallyloom.sources.operational import parquet_reader

CODE_A, CODE_B = "OPA", "OPB"
CODES = [CODE_A, CODE_B]
COMPANIES = [(CODE_A, "المشغل أ", "Operator A"), (CODE_B, "المشغل ب", "Operator B")]
CALENDAR = (dt.date(1995, 1, 1), dt.date(2001, 6, 30))
CITY_PREFIX = "مدينة "
PRODUCT_PREFIX = "منتج "
MAPPED_CITIES = 23  # nations from this key on are not in the city map
LISTED_CITIES = 21  # nations from this key on are no governorate
BYTES_PER_BUCKET = 32_000_000  # of the sources: a task sorts its bucket in memory


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tagged(prefix: str, key: str) -> Column:
    return F.md5(F.concat(F.lit(prefix), F.col(key).cast("string")))


def _phone(prefix: str) -> Column:
    digits = F.lpad((F.col("c_custkey") % 100_000_000).cast("string"), 8, "0")
    remainder = F.col("c_custkey") % 97
    blanks = F.concat(F.lit(prefix + " "), F.substring(digits, 1, 4), F.lit(" "), F.substring(digits, 5, 4))
    return (
        F.when(remainder == 0, F.concat(F.lit(prefix), F.substring(digits, 2, 7)))
        .when(remainder == 1, blanks)
        .otherwise(F.concat(F.lit(prefix), digits))
    )


def _category(names: list[str], wrong: str) -> Column:
    kind = F.col("p_partkey") % 3
    return (
        F.when(F.col("p_partkey") % 101 == 0, wrong)
        .when(kind == 0, names[0]).when(kind == 1, names[1]).otherwise(names[2])
    )


def _english_name() -> Column:
    return F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string"))


def _local(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def project_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven operational tables of both sources."""
    customer = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    part = table(spark, sf_dir, "part")
    signup = F.date_add(F.lit(dt.date(1994, 1, 1)), (F.col("c_custkey") % 365).cast("int"))
    whole_price = F.floor("p_retailprice").cast("int")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    # joined once for both sources
    joined = (
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
        .join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
              F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
        .drop("o_orderkey", "p_partkey")
    )
    lines = (
        materialize(joined, "lines", **COMPACT)
        .withColumn("quantity", F.when(F.col("l_orderkey") % 89 == 3, 0).otherwise(F.col("l_quantity").cast("int")))
        .withColumn("line", F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                        F.col("l_linenumber").cast("string")))
    )
    even, odd = F.col("o_custkey") % 2 == 0, F.col("o_custkey") % 2 == 1
    surplus = F.when(F.col("l_orderkey") % 50 == 0, 1).otherwise(0)
    return {
        "cities": table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("city_id"), _local(CITY_PREFIX, "n_nationkey").alias("city_ar"),
            F.lit(True).alias("is_active"), F.lit(dt.datetime(1994, 1, 1)).alias("created_at")),
        "customers": customer.where(F.col("c_custkey") % 2 == 0).select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"),
            _phone("+9639").alias("phone"), F.col("c_nationkey").alias("city_id"),
            signup.cast("timestamp").alias("signup_date")),
        "products": part.select(
            F.col("p_partkey").alias("product_id"), _local(PRODUCT_PREFIX, "p_partkey").alias("product_name"),
            _category(["Internet", "Voice", "Bundle"], "internet").alias("category"),
            whole_price.alias("unit_price"), F.lit(True).alias("is_active")),
        "orders": lines.where(even).select(
            F.col("line").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("product_id"), "quantity", whole_price.alias("unit_price_at_sale"),
            (F.col("quantity").cast("bigint") * whole_price + surplus).alias("total_price"),
            F.col("o_orderdate").cast("timestamp").alias("order_date")),
        "clients": customer.where(F.col("c_custkey") % 2 == 1).select(
            _tagged("client-", "c_custkey").alias("client_id"), F.col("c_name").alias("client_name"),
            _phone("09").alias("msisdn"), F.col("n_name").alias("city_en"), signup.alias("registered_at"),
            signup.cast("timestamp").alias("inserted_ts")),
        "items": part.select(
            _tagged("item-", "p_partkey").alias("item_id"), _english_name().alias("item_name"),
            _category(["INTERNET", "VOICE", "BUNDLE"], "OTHER").alias("item_type"),
            price.alias("price_syp")),
        "transactions": lines.where(odd).select(
            F.md5("line").alias("tx_id"), _tagged("client-", "o_custkey").alias("client_id"),
            _tagged("item-", "l_partkey").alias("item_id"), F.col("quantity").alias("qty"),
            price.alias("price_at_tx"), F.col("o_orderdate").cast("date").alias("tx_date"),
            F.date_format("o_orderdate", "HH:mm:ss").alias("tx_time"),
            F.col("o_orderdate").cast("timestamp").alias("inserted_ts")),
    }


def city_maps(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    mapped = table(spark, sf_dir, "nation").where(F.col("n_nationkey") < MAPPED_CITIES)
    return {
        "ar": mapped.select(_local(CITY_PREFIX, "n_nationkey").alias("key"), F.col("n_name").alias("value")),
        "en": mapped.select(F.col("n_name").alias("key"), F.col("n_name").alias("value")),
    }


def catalogs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    listed = table(spark, sf_dir, "part").where(F.col("p_partkey") % 11 != 0)
    return {
        "local_name": listed.select(
            _local(PRODUCT_PREFIX, "p_partkey").alias("key"), _english_name().alias("value")),
        "english_name": listed.select(_english_name().alias("key"), _english_name().alias("value")),
    }


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Governorates: the first nations, and one more without sales."""
    listed = table(spark, sf_dir, "nation").where(F.col("n_nationkey") < LISTED_CITIES).select(
        F.lower("n_name").alias("id"), F.col("n_name").alias("name"),
        _local(CITY_PREFIX, "n_nationkey").alias("ar"), F.col("n_name").alias("city"))
    empty = literal_rows(spark, [("nowhere", "NOWHERE", CITY_PREFIX, "NOWHERE")], listed.schema)
    return listed.unionByName(empty)


class Mart:
    """Sources stored as parquet, and a warehouse loaded from them in one full batch."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        self.spark, self.sf_dir, self.root = spark, sf_dir, root
        self.sources_root = f"{root}/sources"
        with scratch_scope(spark), released_shuffles(spark):
            for name, df in project_sources(spark, sf_dir).items():
                df.write.mode("overwrite").options(**COMPACT).parquet(f"{self.sources_root}/{name}")
        self.city_maps = city_maps(spark, sf_dir)
        self.catalogs = catalogs(spark, sf_dir)
        self._loaded: Warehouse | None = None
        self._tables: dict[str, DataFrame] | None = None

    @property
    def feeds(self) -> list[Feed]:
        return [
            feed_a(CODE_A, parquet_reader(self.spark, self.sources_root, LAYOUT_A), fixed=True),
            feed_b(CODE_B, parquet_reader(self.spark, self.sources_root, LAYOUT_B), fixed=True),
        ]

    def new_warehouse(self, name: str) -> Warehouse:
        """An empty warehouse, with buckets and parts for the size of the sources."""
        buckets = max(BUCKETS, self._per_bucket("orders", "transactions"))
        parts = max(PARTS, self._per_bucket("customers", "clients", "products", "items"))
        return Warehouse(self.spark, f"{self.root}/{name}", COMPANIES, CALENDAR, buckets, parts)

    def _per_bucket(self, *names: str) -> int:
        return math.ceil(sum(stored_bytes(self.spark, f"{self.sources_root}/{n}") for n in names) / BYTES_PER_BUCKET)

    @property
    def warehouse(self) -> Warehouse:
        if self._loaded is None:
            loaded = self.new_warehouse("warehouse")
            run_batch(loaded, self.feeds, self.city_maps, self.catalogs, "full", batch_id="first")
            self._loaded = loaded
        return self._loaded

    @property
    def tables(self) -> dict[str, DataFrame]:
        if self._tables is None:
            self._tables = self.warehouse.tables()
        return self._tables


_MARTS: dict[tuple[str, str], Mart] = {}


def mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The mart of a data folder, built once per application in the scratch folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MARTS:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        _MARTS[key] = Mart(spark, sf_dir, f"{scratch_dir(spark)}/mart-{len(_MARTS)}")
    return _MARTS[key]
