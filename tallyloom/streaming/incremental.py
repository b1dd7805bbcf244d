"""Incremental load of order files as they land.

The stream reads by arrival (file source and checkpoint), not by order date, so an
order that lands late is loaded however old it is. A call works in two queries:

1. One query per source conforms what has landed, micro-batch by micro-batch: bad rows go
   to the quarantine, good ones are staged under the checkpoint.
2. One query keeps the keys of all loaded facts in a state store (RocksDB) and lets each
   key through once. Stored facts are not read for it: only the keys of batches that
   others have loaded since the last call are fed to it first, each batch once.

Batch ids are made from the query name, the checkpoint's own query id and the micro-batch
number: after a restart the same micro-batch overwrites its own folders and closes its own
run, and nothing is loaded twice; with a new checkpoint the numbers begin again, under
other ids, and all stored keys are fed to its empty state.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom import schemas
from tallyloom.operators import audit, conform
from tallyloom.operators.dims import first_per_key
from tallyloom.operators.facts import insert_absent
from tallyloom.plans.batch import Feed, begin_run, conform_orders, stage_counts
from tallyloom.plans.warehouse import Warehouse
from tallyloom.runtime import COMPACT, literal_rows, materialize, materialize_counted, released_shuffles, scratch_scope
from tallyloom.sources.operational import frame_reader

#: How the query that starts with them keeps its keys: rows of the store are not counted, as
#: that looks each written key up once more, and a micro-batch leaves the keys it has written
#: in a log; whole copies of the store are made beside it.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
CANDIDATE = T.StructType([schemas.FACT_SALES[c] for c in schemas.FACT_COLUMNS]).add("seed", T.BooleanType())
FED = T.StructType([T.StructField("batch_id", T.StringType())])

#: Rows extracted, loaded and quarantined.
Counts = tuple[int, int, int]


@dataclass(frozen=True)
class Landing:
    """A source whose order files land in a folder."""

    feed: Feed
    schema: T.StructType
    path: str


def _logged(warehouse: Warehouse, batch_id: str, codes: list[str], load: Callable[[dt.datetime], Counts]) -> None:
    """Run one load under a batch id, unless that has succeeded. A failed one is logged as
    such before the error is raised again."""
    started = dt.datetime.now(dt.timezone.utc)
    if not warehouse.runs().where((F.col("batch_id") == batch_id) & (F.col("status") == "succeeded")).isEmpty():
        return
    begin_run(warehouse, batch_id, "stream", started, codes)
    counts, status, notes = (0, 0, 0), "failed", None
    try:
        with scratch_scope(warehouse.spark):  # copies of what landed serve this load alone
            counts = load(started)
        status = "succeeded"
    except Exception as error:
        notes = f"{type(error).__name__}: {error}"[:500]
        raise
    finally:
        extracted, loaded, quarantined = counts
        warehouse.log(audit.close_run(warehouse.spark, batch_id, "stream", started, dt.datetime.now(dt.timezone.utc),
                                      extracted, loaded, quarantined, status, notes, codes))
        warehouse.unlock(batch_id)


def _judge(warehouse: Warehouse, feed: Feed, landed: DataFrame, batch_id: str, started: dt.datetime,
           tables: dict[str, DataFrame]) -> tuple[DataFrame, dict[str, int]]:
    """Good rows of one set of raw orders; the others are in the quarantine."""
    stored = materialize(landed, "landed", **COMPACT)
    orders = feed.extract_orders(frame_reader({feed.spec.orders.table: stored}), None)
    judged, counts = materialize_counted(conform_orders([feed], [orders], tables, stored=True), "sales", **stage_counts())
    bad = conform.split_quarantine(judged)[1]
    warehouse.write_errors(audit.stamp_quarantine(bad, batch_id, started), batch_id)
    return conform.good_sales(judged), counts


def _stamped(new: DataFrame, batch_id: str, started: dt.datetime) -> DataFrame:
    return new.withColumns({"etl_loaded_at": F.lit(started), "etl_batch_id": F.lit(batch_id)})


def load_micro_batch(warehouse: Warehouse, feed: Feed, landed: DataFrame, batch_id: str) -> None:
    """Load one set of raw order rows by itself, without a stream's state; safe to repeat
    with the same id."""

    def load(started: dt.datetime) -> Counts:
        tables = warehouse.tables()
        good, counts = _judge(warehouse, feed, landed, batch_id, started, tables)
        new = insert_absent(tables["fact_sales"], good, schemas.FACT_KEY, schemas.FACT_ORDER, warehouse.layout()[0])
        loaded = warehouse.write_facts(_stamped(new, batch_id, started), batch_id)
        return counts["extracted"], loaded, counts["quarantined"]

    _logged(warehouse, batch_id, [feed.spec.code], load)


class OrderStream:
    """The two queries of one checkpoint."""

    def __init__(self, warehouse: Warehouse, landings: Sequence[Landing], checkpoint: str, name: str,
                 files_per_batch: int | None = None):
        self.warehouse, self.landings, self.name = warehouse, landings, name
        self.spark, self.root, self.files_per_batch = warehouse.spark, checkpoint.rstrip("/"), files_per_batch
        self.codes = [at.feed.spec.code for at in landings]

    def _query_id(self) -> str:
        """The id that the checkpoint keeps: Spark sets it on the thread of each micro-batch."""
        return self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")

    # -- conform ---------------------------------------------------------
    def conform(self, at: Landing) -> StreamingQuery:
        """Judge what has landed of one source; good rows are staged."""
        reader, code = self.spark.readStream.schema(at.schema), at.feed.spec.code
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)

        def judge(landed: DataFrame, epoch: int) -> None:
            batch_id = f"{self.name}-{code}-{self._query_id()}-{epoch}"

            def load(started: dt.datetime) -> Counts:
                good, counts = _judge(self.warehouse, at.feed, landed, batch_id, started, self.warehouse.tables())
                staged = good.select(*schemas.FACT_COLUMNS, F.lit(epoch).cast("long").alias("epoch"))
                staged.write.mode("overwrite").options(**COMPACT).parquet(f"{self.root}/staged/batch_id={batch_id}")
                return counts["extracted"], 0, counts["quarantined"]

            _logged(self.warehouse, batch_id, [code], load)

        return (
            reader.parquet(at.path).writeStream.queryName(f"{self.name}-{code}")
            .option("checkpointLocation", f"{self.root}/conform-{code}")
            .trigger(availableNow=True).foreachBatch(judge).start()
        )

    # -- feed ------------------------------------------------------------
    def _fed(self) -> DataFrame:
        return self.warehouse._read(f"{self.root}/fed", FED)

    def _mark_fed(self, batches: Sequence[str]) -> None:
        rows = literal_rows(self.spark, [(b,) for b in batches], FED)
        rows.coalesce(1).write.mode("append").parquet(f"{self.root}/fed")

    def _own_prefix(self) -> str | None:
        """How the ids of this checkpoint's loads begin; none before its first."""
        found = self.warehouse._existing_text(f"{self.root}/keys/metadata")
        return f"{self.name}-load-{json.loads(found)['id']}-" if found else None

    def _not_fed(self, ids: DataFrame) -> list[str]:
        return sorted(r[0] for r in ids.join(self._fed(), "batch_id", "left_anti").collect())

    def foreign_batches(self) -> list[str]:
        """Succeeded batches of others whose keys the state has not been fed."""
        prefix, runs = self._own_prefix(), self.warehouse.runs()
        others = runs.where((F.col("status") == "succeeded") & (F.col("rows_loaded") > 0))
        if prefix:
            others = others.where(~F.col("batch_id").startswith(prefix))
        return self._not_fed(others.select("batch_id"))

    def feed_seeds(self) -> bool:
        """Hand the keys that others have loaded to the key query."""
        batches = self.foreign_batches()
        if not batches:
            return False
        keys = self.warehouse.facts(batches).select(*schemas.FACT_KEY)
        self._candidates(keys, True)
        self.let_new_keys_through().awaitTermination()
        self._mark_fed(batches)
        return True

    def feed_rows(self) -> bool:
        """Hand the staged rows to the key query: of several copies that landed between two
        calls the one of the earliest micro-batch, there the first by ``FACT_ORDER``."""
        schema = T.StructType([*[schemas.FACT_SALES[c] for c in schemas.FACT_COLUMNS],
                               T.StructField("epoch", T.LongType()), T.StructField("batch_id", T.StringType())])
        staged = self.warehouse._read(f"{self.root}/staged", schema)
        batches = self._not_fed(staged.select("batch_id").distinct())
        if not batches:
            return False
        rows = staged.where(F.col("batch_id").isin(batches))
        order = [F.col(c) for c in ("epoch", *schemas.FACT_ORDER)]
        self._candidates(first_per_key(rows, schemas.FACT_KEY, order), False)
        self._mark_fed(batches)
        return True

    def _candidates(self, rows: DataFrame, seed: bool) -> None:
        columns = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                   for f in CANDIDATE if f.name != "seed"]
        marked = rows.select(*columns, F.lit(seed).alias("seed"))
        with released_shuffles(self.spark):
            marked.write.options(**COMPACT).parquet(f"{self.root}/candidates/{uuid.uuid4().hex}")

    # -- load ------------------------------------------------------------
    def let_new_keys_through(self) -> StreamingQuery:
        """Load the candidates whose key the state has not seen."""
        warehouse, buckets = self.warehouse, self.warehouse.layout()[0]
        arrived = self.spark.readStream.schema(CANDIDATE).parquet(f"{self.root}/candidates/*")

        def load(unseen: DataFrame, epoch: int) -> None:
            batch_id = f"{self.name}-load-{self._query_id()}-{epoch}"

            def write(started: dt.datetime) -> Counts:
                new = unseen.where(~F.col("seed")).repartition(buckets, *schemas.FACT_KEY)
                return 0, warehouse.write_facts(_stamped(new, batch_id, started), batch_id), 0

            _logged(warehouse, batch_id, self.codes, write)

        before = {setting: self.spark.conf.get(setting, None) for setting in STATE_STORE}
        for setting, value in STATE_STORE.items():  # taken over by the query when it starts
            self.spark.conf.set(setting, value)
        try:
            return (
                arrived.dropDuplicates(schemas.FACT_KEY).writeStream.queryName(self.name)
                .option("checkpointLocation", f"{self.root}/keys")
                .trigger(availableNow=True).foreachBatch(load).start()
            )
        finally:
            for setting, value in before.items():
                if value is None:
                    self.spark.conf.unset(setting)
                else:
                    self.spark.conf.set(setting, value)

    def start(self) -> StreamingQuery:
        """Conform what has landed, then start the query that loads it."""
        for at in self.landings:
            self.conform(at).awaitTermination()
        self.drain()
        self.feed_seeds()
        self.feed_rows()
        return self.let_new_keys_through()

    def drain(self) -> None:
        """Finish what a call that broke off had handed over: its rows must not meet newer
        seeds in one micro-batch."""
        if self.warehouse._existing(f"{self.root}/candidates/*", CANDIDATE) is not None:
            self.let_new_keys_through().awaitTermination()


def stream_sources(warehouse: Warehouse, landings: Sequence[Landing], checkpoint: str, name: str,
                   files_per_batch: int | None = None) -> StreamingQuery:
    """Load what has landed of all sources since the last call, then stop."""
    return OrderStream(warehouse, landings, checkpoint, name, files_per_batch).start()


def stream_orders(warehouse: Warehouse, feed: Feed, schema: T.StructType, landing: str,
                  checkpoint: str, name: str, files_per_batch: int | None = None) -> StreamingQuery:
    """``stream_sources`` of one source."""
    return stream_sources(warehouse, [Landing(feed, schema, landing)], checkpoint, name, files_per_batch)
