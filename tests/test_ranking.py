import random
from decimal import Decimal

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators import ranking, rfm
from tallyloom.runtime import materialize


@pytest.fixture(scope="module")
def tied(spark):
    """Four values and nulls over 3,000 rows; one value has a third of them."""
    picks = [None, 1, 2, 2, 3, 2]
    random.seed(7)
    table = [(i, random.choice(picks)) for i in range(3000)]
    return materialize(spark.createDataFrame(table, "id LONG, v INT"), "tied")


@pytest.mark.parametrize("per_range", [100, 700, 10_000])
def test_global_row_number(spark, tied, per_range):
    got = ranking.global_row_number(tied, ["v", "id"], "n", per_range)
    wanted = tied.withColumn("n", F.row_number().over(W.orderBy("v", "id")))
    assert rows(got, "id", "n") == rows(wanted, "id", "n")


def test_equal_values_are_divided(spark, tied):
    order = ["v", "id"]
    _, starts = ranking.stored_ranges(tied, order, 3000, 100)
    sizes = [r["_n"] for r in starts.collect()]
    assert len(sizes) > 20 and max(sizes) < 400 and sum(sizes) == 3000


def test_many_ranges(spark):
    df = materialize(spark.range(20_000).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(5))), "many")
    got = ranking.global_row_number(df, ["v", "id"], "n", 8)  # 2,500 ranges
    wanted = df.withColumn("n", F.row_number().over(W.orderBy("v", "id")))
    assert got.exceptAll(wanted).isEmpty()


@pytest.mark.parametrize("per_range", [100, 10_000])
def test_rows_at(spark, tied, per_range):
    wanted = {r.n: (r.v, r.id) for r in
              tied.withColumn("n", F.row_number().over(W.orderBy("v", "id"))).collect()}
    ranks = [1, 2, 500, 1501, 3000, 0, 3001]
    got = ranking.rows_at(tied, ["v", "id"], ranks, 3000, per_range)
    assert got == {r: wanted[r] for r in ranks if 1 <= r <= 3000}


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9, 10, 11, 12, 57])
def test_ntile(spark, n):
    df = materialize(spark.range(n).withColumn("v", F.col("id") % 3), "ntile")
    got = ranking.ntile(df, ["v", "id"], 5, "tile", rows_per_range=10)
    wanted = df.withColumn("tile", F.ntile(5).over(W.orderBy("v", "id")))
    assert rows(got, "id", "tile") == rows(wanted, "id", "tile")
    counts = [r[1] for r in got.groupBy("tile").count().collect()]
    assert max(counts) - min(counts) <= 1


@pytest.mark.parametrize("n", [1, 9, 10, 11, 203])
def test_top_fraction_sum(spark, n):
    values = [Decimal((i * 37) % 50) for i in range(n)]
    df = materialize(spark.createDataFrame(list(enumerate(values)), "id LONG, v DECIMAL(14,2)"), "top")
    got = ranking.top_fraction_sum(df, "v", "id", 10, "s", rows_per_range=20).first().s
    assert got == sum(sorted(values, reverse=True)[: -(-n // 10)])


def raw_rfm(spark, table):
    schema = ("customer_sk LONG, full_name STRING, city STRING, source_system STRING, company STRING, "
              "company_code STRING, recency_days INT, frequency LONG, monetary_syp DECIMAL(24,2)")
    full = [(sk, "n", "c", "AA", "A", "AA", r, f, Decimal(m)) for sk, r, f, m in table]
    return materialize(spark.createDataFrame(full, schema), "rfm")


def pandas_scores(table):
    df = pd.DataFrame(table, columns=["sk", "r", "f", "m"]).sort_values("sk")

    def cut(series):
        return pd.qcut(series, 5, labels=[1, 2, 3, 4, 5]).astype(int)

    r, f, m = cut(-df.r.rank(method="first")), cut(df.f.rank(method="first")), cut(df.m.rank(method="first"))
    return list(zip(df.sk, r, f, m))


@pytest.mark.parametrize("n", [2, 5, 11, 12, 13, 14, 101, 640])
@pytest.mark.parametrize("ties", [False, True])
def test_quintiles_equal_ranked_qcut(spark, n, ties):
    random.seed(n)
    table = [(sk, *(7 if ties else random.randint(0, 30) for _ in range(3))) for sk in range(1, n + 1)]
    got = rfm.rfm_quintiles(raw_rfm(spark, table), rows_per_range=50)
    assert rows(got, "customer_sk", "r_score", "f_score", "m_score") == pandas_scores(table)


def test_lone_customer_scores_one(spark):
    got = rfm.rfm_quintiles(raw_rfm(spark, [(1, 0, 5, 100)])).first()
    assert got.rfm_code == "111"


def test_ntile_scores(spark):
    random.seed(3)
    table = [(sk, random.randint(0, 9), random.randint(1, 4), random.randint(1, 99)) for sk in range(1, 78)]
    raw = raw_rfm(spark, table)
    got = rfm.rfm_ntile(raw, rows_per_range=10)

    def tile(*order):
        return F.ntile(5).over(W.orderBy(*order))

    wanted = raw.select("customer_sk", tile(F.desc("recency_days"), "customer_sk").alias("r"),
                        tile("frequency", "customer_sk").alias("f"), tile("monetary_syp", "customer_sk").alias("m"))
    assert rows(got, "customer_sk", "r_score", "f_score", "m_score") == rows(wanted)


def test_first_segment_rule_wins(spark):
    table = [(5, 5, 5, "Champions"), (4, 4, 3, "Loyal"), (3, 3, 1, "Loyal"), (2, 3, 5, "At Risk"), (1, 5, 5, "At Risk"),
             (4, 1, 5, "New"), (1, 2, 5, "Lost"), (1, 1, 1, "Lost"), (3, 2, 5, "Other"), (5, 2, 1, "Other"), (2, 2, 2, "Other")]
    df = spark.createDataFrame(table, "r_score INT, f_score INT, m_score INT, wanted STRING")
    assert rfm.segment(df).where("segment <> wanted").isEmpty()


def test_segment_shares(spark):
    df = spark.createDataFrame([("Loyal",)] * 5 + [("Lost",)] * 1, "segment STRING")
    summary = rfm.segment_summary(df)
    assert rows(summary, "segment", "count", "pct") == [("Lost", 1, 16.7), ("Loyal", 5, 83.3)]
    check = rfm.dominance_check(summary).first()
    assert (check.max_pct, check.dominated) == (83.3, True)
    base = spark.range(10)  # ten customers, six of them with orders
    shares = rfm.base_shares(summary, base).first()
    assert (shares.at_risk_count, shares.champ_loyal_count, shares.champ_loyal_pct) == (0, 5, 50.0)
