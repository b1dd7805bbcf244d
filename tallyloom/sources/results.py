"""Stored mining results: write them, read them back, or compute what is missing."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.forecast import forecast_metrics
from tallyloom.operators.rfm import RFM_COLUMNS, segment_summary
from tallyloom.runtime import materialize

RFM_SCHEMA = (
    "customer_sk BIGINT, full_name STRING, city STRING, source_system STRING, company STRING, "
    "company_code STRING, recency_days INT, frequency BIGINT, monetary_syp DECIMAL(24,2), "
    "r_score INT, f_score INT, m_score INT, rfm_code STRING, segment STRING"
)
FORECAST_SCHEMA = "period STRING, type STRING, sales_syp DOUBLE, company_code STRING"


def write_rfm(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Scored customers, 14 columns, as CSV with header or parquet."""
    _write(df.select(*RFM_COLUMNS).write, path, fmt)


def write_forecast(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Long forecast table, one folder per company."""
    rows = df.select("period", "type", "sales_syp", "company_code")
    # a few hundred rows per company: one file each
    _write(rows.repartition("company_code").write.partitionBy("company_code"), path, fmt)


def _write(writer, path: str, fmt: str) -> None:
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.mode("overwrite").format(fmt).save(path)


def _read(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame:
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":  # a file of other columns, or a line that is none, is an error, not a row of nulls
        reader = reader.options(header=True, enforceSchema=False, mode="FAILFAST")
    return reader.load(path)


def read_rfm(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Segment distribution of a stored segmentation."""
    return segment_summary(_read(spark, path, RFM_SCHEMA, fmt))


def read_forecast(spark: SparkSession, path: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Stored forecast rows split by type, and the metrics computed from them again."""
    rows = _read(spark, path, FORECAST_SCHEMA, fmt).withColumn(
        "period", F.to_date(F.concat("period", F.lit("-01")))
    )
    parts = {
        kind: rows.where(F.col("type") == kind).select("company_code", "period", "sales_syp")
        for kind in ("actual", "fitted", "forecast")
    }
    pairs = rows.groupBy("company_code", "period").agg(
        F.max(F.when(F.col("type") == "actual", F.col("sales_syp"))).alias("actual"),
        F.max(F.when(F.col("type") == "fitted", F.col("sales_syp"))).alias("fitted"),
    )
    in_sample = pairs.where(F.col("actual").isNotNull() & F.col("fitted").isNotNull())
    parts["metrics"] = forecast_metrics(in_sample, ["company_code"])
    return parts


#: Errors of a stored result that is not there or cannot be read.
_UNUSABLE = ("PATH_NOT_FOUND", "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "MALFORMED_RECORD_IN_PARSING")


def _conditions(error: Exception) -> list[str]:
    """Error conditions of an error and of what caused it inside Spark."""
    if isinstance(error, PySparkException):
        return [error.getCondition() or ""]
    found, cause = [], error.java_exception
    while cause is not None:
        if hasattr(cause, "getCondition") and "SparkThrowable" in str([i.getName() for i in cause.getClass().getInterfaces()]):
            found.append(cause.getCondition() or "")
        cause = cause.getCause()
    return found


def load_or_compute(load: Callable[[], DataFrame], compute: Callable[[], DataFrame]) -> DataFrame:
    """The stored result where it exists and can be read, else the computed one. The stored
    one is read to the end first, as a file that is torn is found out only then: use it for
    results of a few rows. Other errors are raised."""
    try:
        return materialize(load(), "loaded")
    except (PySparkException, Py4JJavaError) as error:
        if not any(c.startswith(_UNUSABLE) for c in _conditions(error)):
            raise
        return compute()
