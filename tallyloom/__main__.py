"""Start a load: ``spark-submit`` this file with the library shipped (``--py-files``).

Sources are parquet folders laid out as ``schemas.LAYOUT_A`` and ``LAYOUT_B``. Exit code
0 after a load that succeeded, 1 after one that failed or was refused.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.errors import PySparkException

from tallyloom import schemas
from tallyloom.plans.batch import BatchRefused, feed_a, feed_b, run_batch
from tallyloom.plans.warehouse import Warehouse
from tallyloom.runtime import drop_scratch, session
from tallyloom.sources.mappings import read_catalog, read_city_map
from tallyloom.sources.operational import parquet_reader


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tallyloom", description=__doc__)
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--source-a", metavar="CODE=PATH")
    parser.add_argument("--source-b", metavar="CODE=PATH")
    parser.add_argument("--company", action="append", required=True, metavar="CODE=LOCAL=ENGLISH")
    parser.add_argument("--cities", required=True, help="CSV of city names")
    parser.add_argument("--catalog", required=True, help="CSV of products")
    parser.add_argument("--calendar", nargs=2, type=dt.date.fromisoformat, required=True, metavar=("FIRST", "LAST"))
    parser.add_argument("--batch-id")
    parser.add_argument("--dry-run", action="store_true", help="conform everything, write nothing")
    mode = parser.add_mutually_exclusive_group()
    mode.add_argument("--full", action="store_true", help="all data")
    mode.add_argument("--weekly", action="store_true", help="since the previous Sunday 02:00")
    mode.add_argument("--since", type=dt.date.fromisoformat, metavar="DATE")
    return parser.parse_args(argv)


def main(argv: list[str]) -> int:
    given = arguments(argv)
    spark = session("tallyloom-load")
    warehouse = Warehouse(spark, given.warehouse, [tuple(c.split("=", 2)) for c in given.company],
                          tuple(given.calendar))
    feeds = []
    for named, make, layout in ((given.source_a, feed_a, schemas.LAYOUT_A), (given.source_b, feed_b, schemas.LAYOUT_B)):
        if named:
            code, path = named.split("=", 1)
            feeds.append(make(code, parquet_reader(spark, path, layout)))
    mode = "full" if given.full else "weekly" if given.weekly else "since" if given.since else "incremental"
    try:
        result = run_batch(warehouse, feeds, read_city_map(spark, given.cities), read_catalog(spark, given.catalog),
                           mode, given.since, given.dry_run, given.batch_id)
    except (BatchRefused, PySparkException) as error:
        print(f"failed: {error}", file=sys.stderr)
        return 1
    finally:
        drop_scratch(spark)
    print(f"{result.batch_id} {result.mode} {result.status}: {result.extracted} rows read, {result.loaded} loaded, "
          f"{result.quarantined} in quarantine")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
