"""Facts: insert what is absent, and the constraints of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.dims import first_per_key


def insert_absent(current: DataFrame | None, new: DataFrame, keys: Sequence[str],
                  order: Sequence[str], buckets: int | None = None) -> DataFrame:
    """The rows of ``new`` to append: first copy per key, keys not stored yet.

    Where ``current`` is bucketed by the keys, give its number of buckets: the new rows
    are dealt in the same way and nothing of the stored table moves. They come back
    dealt, ready to be written in buckets.
    """
    first = first_per_key(new, keys, [F.col(c) for c in order])
    if buckets:
        first = first.repartition(buckets, *keys)
    if current is None:
        return first
    # not an anti join: that one is moved below the dealing, back to where the sizes differ
    stored = current.select(*keys, F.lit(True).alias("_stored"))
    return first.join(stored, list(keys), "left").where(F.col("_stored").isNull()).select(*first.columns)


def orphans(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the dimension."""
    return df.join(dim.select(key), key, "left_anti")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def check_constraints(df: DataFrame, required: Sequence[str] = (),
                      predicates: dict[str, Column] | None = None,
                      foreign_keys: dict[str, DataFrame] | None = None,
                      unique: Sequence[str] = ()) -> DataFrame:
    """(constraint, violations) for not-null columns, row predicates, foreign keys and
    a unique key. Row rules are counted in one pass."""
    rules = {f"{c} is not null": F.col(c).isNotNull() for c in required}
    rules.update(predicates or {})
    parts = []
    if rules:
        names = list(rules)
        broken = [
            F.count_if(~F.coalesce(rules[n], F.lit(False))).alias(f"r{i}") for i, n in enumerate(names)
        ]
        pairs = F.array(*[
            F.struct(F.lit(n).alias("constraint"), F.col(f"r{i}").alias("violations"))
            for i, n in enumerate(names)
        ])
        parts.append(df.agg(*broken).select(F.inline(pairs)))
    for key, dim in (foreign_keys or {}).items():
        # keys are combined before the shuffle, so a hot key costs one row per task
        counted = df.groupBy(key).agg(F.count("*").alias("n"))
        missing = orphans(counted, dim, key)
        parts.append(missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
            F.lit(f"{key} has a dimension row").alias("constraint"), "violations"))
    if unique:
        repeated = duplicates(df, unique)
        parts.append(repeated.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
                     .select(F.lit(", ".join(unique) + " is unique").alias("constraint"), "violations"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
