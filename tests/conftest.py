import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom import schemas  # noqa: E402
from tallyloom.plans.batch import feed_a, feed_b  # noqa: E402
from tallyloom.plans.warehouse import Warehouse  # noqa: E402
from tallyloom.runtime import literal_rows, session  # noqa: E402
from tallyloom.sources.operational import frame_reader  # noqa: E402

COMPANIES = [("AA", "أ", "Company A"), ("BB", "ب", "Company B")]
CALENDAR = (dt.date(2024, 1, 1), dt.date(2025, 12, 31))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": 2,
            "spark.default.parallelism": 2,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


def rows(df, *columns):
    """Rows as sorted tuples."""
    found = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


@pytest.fixture
def city_maps(spark):
    names = [("مدينة 1", "North"), ("مدينة 2", "South")]
    return {
        "ar": spark.createDataFrame(names, "key STRING, value STRING"),
        "en": spark.createDataFrame([(e, e) for _, e in names], "key STRING, value STRING"),
    }


@pytest.fixture
def catalogs(spark):
    names = [("باقة 1", "Small Plan"), ("باقة 2", "Large Plan")]
    return {
        "local_name": spark.createDataFrame(names, "key STRING, value STRING"),
        "english_name": spark.createDataFrame([(e, e) for _, e in names], "key STRING, value STRING"),
    }


DAY = dt.datetime(2024, 3, 1)


def source_frames(spark, customers=None, products=None, orders=None, clients=None, items=None,
                  transactions=None):
    """Both sources with a few good rows; any table can be replaced."""
    given = {
        "cities": [(1, "مدينة 1", True, DAY), (2, "مدينة 2", True, DAY), (3, "مدينة 3", True, DAY)],
        "customers": customers if customers is not None else [
            (1, "Ann", "+963911111111", 1, DAY), (2, "Bob", "+963922222222", 2, DAY)],
        "products": products if products is not None else [
            (10, "باقة 1", "Internet", 100, True), (11, "باقة 9", "Voice", 50, True)],
        "orders": orders if orders is not None else [
            ("o1", 1, 10, 2, 100, 200, DAY), ("o2", 2, 11, 1, 50, 50, DAY + dt.timedelta(days=40))],
        "clients": clients if clients is not None else [
            ("c1", "Cat", "0933333333", "North", DAY.date(), DAY)],
        "items": items if items is not None else [
            ("i1", "Small Plan", "INTERNET", "100.50"), ("i2", "Other Plan", "BUNDLE", "10.00")],
        "transactions": transactions if transactions is not None else [
            ("t1", "c1", "i1", 3, "100.50", DAY.date(), "10:00:00", DAY)],
    }
    layouts = {**schemas.LAYOUT_A, **schemas.LAYOUT_B}

    return {name: literal_rows(spark, table, layouts[name]) for name, table in given.items()}


def feeds(frames):
    reader = frame_reader(frames)
    return [feed_a("AA", reader), feed_b("BB", reader)]


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), COMPANIES, CALENDAR)
