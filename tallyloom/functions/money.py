"""Exact decimal arithmetic on amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.schemas import MONEY


def to_money(col: Column) -> Column:
    """Amount at scale 2; null where the value is not numeric or out of range."""
    return col.try_cast(MONEY)


def line_total(quantity: Column, price: Column) -> Column:
    """quantity * price, exact at scale 2; null where it does not fit an amount."""
    return (quantity.try_cast("decimal(10,0)") * to_money(price)).try_cast(MONEY)


def money_avg(total: Column, count: Column, scale: int = 2) -> Column:
    """total / count, rounded half away from zero; null for an empty group."""
    quotient = total.cast("decimal(28,2)") / F.nullif(count, F.lit(0)).cast("decimal(20,0)")
    return F.round(quotient, scale)


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """100 * part / whole, rounded; null where the whole is zero."""
    base = F.nullif(whole.cast("decimal(28,2)"), F.lit(0).cast("decimal(28,2)"))
    return F.round(part.cast("decimal(28,2)") * 100 / base, scale)


def millions(col: Column) -> Column:
    return col.cast("double") / 1e6


def short_money(col: Column) -> Column:
    """``702M``, ``25K``, plain below a thousand; ties go to the even digit."""
    value = col.cast("double")
    return (
        F.when(value >= 1e6, F.concat(F.bround(value / 1e6, 0).cast("bigint").cast("string"), F.lit("M")))
        .when(value >= 1e3, F.concat(F.bround(value / 1e3, 0).cast("bigint").cast("string"), F.lit("K")))
        .otherwise(value.cast("bigint").cast("string"))
    )
