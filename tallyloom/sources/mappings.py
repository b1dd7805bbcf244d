"""The two mapping files: city spellings and the product catalog.

Both are CSV files with a header. Where a key repeats, the last line wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.schemas import CATALOG, CITY_MAP

_LINE = "_line"


def _read_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    lines = spark.read.csv(path, schema=schema, header=True)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start",
                     F.monotonically_increasing_id())
    return lines.withColumn(_LINE, place)


def _last_per_key(lines: DataFrame, key: str, value: str) -> DataFrame:
    return (
        lines.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.max_by(F.col(value), F.col(_LINE)).alias("value"))
    )


def read_city_map(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Two (key, value) frames: ``ar`` maps local names to canonical ones, ``en``
    holds each canonical name as itself. Both columns are trimmed."""
    lines = _read_lines(spark, path, CITY_MAP).withColumns(
        {"ar": F.trim("ar"), "en": F.trim("en")}
    )
    return {"ar": _last_per_key(lines, "ar", "en"), "en": _last_per_key(lines, "en", "en")}


def read_catalog_rows(spark: SparkSession, path: str) -> DataFrame:
    """Offerings as they are listed: seven text columns, by position."""
    return spark.read.csv(path, schema=CATALOG, header=True)


def judge_catalog(rows: DataFrame) -> DataFrame:
    """The offerings and whether each is consistent: the same whole price in both sources,
    the category in title case in one and in capitals in the other."""
    whole = [F.floor(F.col(c).try_cast("decimal(14,2)")) for c in ("local_price", "english_price")]
    title, capitals = F.col("category"), F.col("mapped_category")
    return rows.withColumns({
        "prices_match": F.coalesce(whole[0] == whole[1], F.lit(False)),
        "case_differs": F.coalesce((title == F.initcap(title)) & (capitals == F.upper(title)) & (title != capitals), F.lit(False)),
    })


def read_catalog(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Two (key, value) frames giving the canonical English product name by local
    name and by English name. The file has seven text columns, by position."""
    lines = _read_lines(spark, path, CATALOG)
    return {
        "local_name": _last_per_key(lines, "local_name", "english_name"),
        "english_name": _last_per_key(lines, "english_name", "english_name"),
    }
