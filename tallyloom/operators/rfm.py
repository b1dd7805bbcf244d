"""Recency, frequency, monetary value: scores and segments per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions.text import map_value
from tallyloom.operators.ranking import ROWS_PER_RANGE, count_reached, tile_starts
from tallyloom.operators.selection import rows_at_ranks

RFM_COLUMNS = [
    "customer_sk", "full_name", "city", "source_system", "company", "company_code",
    "recency_days", "frequency", "monetary_syp",
    "r_score", "f_score", "m_score", "rfm_code", "segment",
]
# Segments in rule order, with their local labels.
SEGMENT_LABELS = {
    "Champions": "أبطال",
    "Loyal": "مخلصون",
    "At Risk": "معرضون للخطر",
    "New": "جدد",
    "Lost": "مفقودون",
    "Other": "أخرى",
}
DOMINANCE_PCT = 80


def rfm_raw(fact: DataFrame, dim_customer: DataFrame, dim_company: DataFrame,
            dim_date: DataFrame) -> DataFrame:
    """Days since the last order (counted from the newest order of all), number of
    orders and spend per customer with orders.

    The facts are combined per customer before anything is joined.
    """
    per_customer = fact.groupBy("customer_sk", "company_sk").agg(
        F.max("date_sk").alias("date_sk"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("total_amount_syp").alias("monetary_syp"),
    ).join(dim_date.select("date_sk", "full_date"), "date_sk")
    # a scan of the date column alone; combined it is no longer than the calendar
    as_of = fact.select("date_sk").distinct().join(dim_date, "date_sk").agg(F.max("full_date")).first()[0]
    return (
        per_customer
        .join(dim_customer.select("customer_sk", "full_name", "city", "source_system"), "customer_sk")
        .join(dim_company.select("company_sk", "company_code",
                                 F.col("company_name_en").alias("company")), "company_sk")
        .select(
            "customer_sk", "full_name", "city", "source_system", "company", "company_code",
            F.date_diff(F.lit(as_of).cast("date"), "full_date").alias("recency_days"), "frequency", "monetary_syp",
        )
    )


def _rfm_code(df: DataFrame) -> DataFrame:
    return df.withColumn("rfm_code", F.concat(*[
        F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")
    ]))


def rfm_ntile(raw: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """NTILE(5) scores; ties in customer key order. ``raw`` is read several times."""
    measures = {"_oldest_first": "r_score", "frequency": "f_score", "monetary_syp": "m_score"}
    scored = raw.withColumn("_oldest_first", -F.col("recency_days"))
    rows, at = rows_at_ranks(scored, list(measures), "customer_sk",
                             lambda n: dict.fromkeys(measures, tile_starts(n, 5)), rows_per_range)
    scored = scored.withColumns({
        name: count_reached([m, "customer_sk"], at[m], tile_starts(rows, 5)) + 1 for m, name in measures.items()})
    return _rfm_code(scored.drop("_oldest_first"))


def _quintile_ranks(rows: int) -> tuple[list[int], list[int]]:
    """First ranks of the scores above 1, rising, and the ranks of recency that end a score."""
    steps = [s * (rows - 1) // 5 for s in (1, 2, 3, 4)]
    return [step + 2 for step in steps], [rows - step for step in steps]


def rfm_quintiles(raw: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Scores 1 to 5 by equal-width cuts of the rank; ties in customer key order.

    Row k of n has the score ceil(5 * (k - 1) / (n - 1)), at least 1; for recency
    the ranks count from the other end. A lone customer scores 1, 1, 1. The score is
    a comparison with four exact cut rows per measure, so no customer is moved.
    """
    def ranks(n: int) -> dict[str, list[int]]:
        rising, falling = _quintile_ranks(n)
        return {"recency_days": falling, "frequency": rising, "monetary_syp": rising}

    rows, at = rows_at_ranks(raw, ["recency_days", "frequency", "monetary_syp"], "customer_sk", ranks, rows_per_range)
    rising, falling = _quintile_ranks(rows)
    return _rfm_code(raw.withColumns({
        "f_score": count_reached(["frequency", "customer_sk"], at["frequency"], rising) + 1,
        "m_score": count_reached(["monetary_syp", "customer_sk"], at["monetary_syp"], rising) + 1,
        "r_score": F.lit(5) - count_reached(["recency_days", "customer_sk"], at["recency_days"], falling),
    }))


def segment(scored: DataFrame) -> DataFrame:
    """Add the segment: first rule that holds."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumn(
        "segment",
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r >= 4) & (f == 1), "New")
        .when((r == 1) & (f <= 2), "Lost")
        .otherwise("Other"),
    )


def segment_customers(raw: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Scored and segmented customers, 14 columns."""
    return segment(rfm_quintiles(raw, rows_per_range)).select(*RFM_COLUMNS)


def segment_summary(segmented: DataFrame) -> DataFrame:
    """Customers per segment, share in percent (one decimal) and local label."""
    counts = segmented.groupBy("segment").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(W.partitionBy())  # one row per segment
    return counts.select(
        "segment", "count",
        F.round(F.col("count") / total * 100, 1).alias("pct"),
        map_value(F.col("segment"), SEGMENT_LABELS).alias("segment_ar"),
    )


def dominance_check(summary: DataFrame, limit: float = DOMINANCE_PCT) -> DataFrame:
    """One row: the largest share, and whether it is above the limit."""
    total, largest = F.sum("count"), F.max("count")
    return summary.agg((largest / total * 100).alias("max_pct")).select(
        F.round("max_pct", 1).alias("max_pct"), (F.col("max_pct") > limit).alias("dominated")
    )


def base_shares(summary: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """One row: at-risk and champions + loyal customers, with their share of all
    customers of the dimension, those without orders included."""

    def size(*names: str):
        return F.coalesce(F.sum(F.when(F.col("segment").isin(*names), F.col("count"))), F.lit(0))

    base = dim_customer.agg(F.count(F.lit(1)).alias("total_customers"))
    groups = summary.agg(size("At Risk").alias("at_risk_count"),
                         size("Champions", "Loyal").alias("champ_loyal_count"))
    whole = F.nullif(F.col("total_customers"), F.lit(0))
    return groups.crossJoin(base).select(
        "at_risk_count", "champ_loyal_count", "total_customers",
        F.coalesce(F.round(F.col("at_risk_count") / whole * 100, 2), F.lit(0.0)).alias("at_risk_pct"),
        F.coalesce(F.round(F.col("champ_loyal_count") / whole * 100, 2), F.lit(0.0))
        .alias("champ_loyal_pct"),
    )
