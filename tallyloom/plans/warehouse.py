"""The stored warehouse: parquet folders, made visible by the run log.

Every batch writes its own folders (``<table>/batch_id=<id>``), so a batch that fails half
way changes nothing for readers, who see the rows of succeeded batches.

- Facts of a batch lie in hash buckets of the fact key. Readers declare all batches as one
  bucketed table, so a join on that key moves nothing of what is stored.
- Dimensions lie in hash parts of the natural key. A batch writes the parts that it touches
  and lists them in ``dim_parts`` with their greatest surrogate key; a reader takes the
  newest version of every part. The others stay as they are.

How many buckets and parts there are is fixed when the warehouse is made (``layout``).
One writer at a time: it holds the file ``writer``, made without overwriting.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom import schemas
from tallyloom.functions.calendar import dim_date
from tallyloom.operators.audit import current_runs
from tallyloom.operators.dims import dim_company
from tallyloom.runtime import COMPACT, literal_rows, released_shuffles, shuffle_partitions

DIMENSIONS = {
    "dim_customer": (schemas.DIM_CUSTOMER, schemas.CUSTOMER_KEY, "customer_sk"),
    "dim_product": (schemas.DIM_PRODUCT, schemas.PRODUCT_KEY, "product_sk"),
}
PART = "part"
BUCKETS, PARTS = 8, 8
LAYOUT = T.StructType([T.StructField("buckets", T.IntegerType()), T.StructField("parts", T.IntegerType())])
DIM_PARTS = T.StructType([
    T.StructField("batch_id", T.StringType()), T.StructField("table", T.StringType()),
    T.StructField(PART, T.IntegerType()), T.StructField("max_sk", T.LongType())])


class WriterBusy(RuntimeError):
    """Another writer holds the warehouse."""


class Warehouse:
    """A warehouse at ``root``. ``buckets`` (of facts) and ``parts`` (of dimensions) hold for
    a new one; an existing one keeps its own."""

    def __init__(self, spark: SparkSession, root: str, companies: Sequence[tuple[str, str, str]],
                 calendar: tuple[dt.date, dt.date], buckets: int = BUCKETS, parts: int = PARTS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.companies = companies
        self.calendar = calendar
        self._asked = (buckets, parts)
        self._layout: tuple[int, int] | None = None

    # -- layout ----------------------------------------------------------
    def layout(self) -> tuple[int, int]:
        """(buckets, parts), written down by the first writer."""
        if self._layout is None:
            stored = self._read(f"{self.root}/layout", LAYOUT).first()
            if stored is None:
                return self._asked
            self._layout = tuple(stored)
        return self._layout

    def _keep_layout(self) -> None:
        if self._layout is None and self._existing(f"{self.root}/layout", LAYOUT) is None:
            literal_rows(self.spark, [self._asked], LAYOUT).write.parquet(f"{self.root}/layout")
        self.layout()

    def part_of(self, table: str) -> Column:
        """Part of a dimension row, by its natural key."""
        keys = [F.col(c).cast("string") for c in DIMENSIONS[table][1]]
        return F.pmod(F.xxhash64(*keys), F.lit(self.layout()[1])).cast("int")

    # -- one writer ------------------------------------------------------
    def _file(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def lock(self, writer: str, stale_hours: float) -> None:
        """Take the writer's file, or raise ``WriterBusy``. A file older than
        ``stale_hours``, or of the same writer, is taken over."""
        files, path = self._file("writer")
        files.mkdirs(path.getParent())
        for _ in range(2):
            if self._create(files, path, writer):
                return
            holder, age = self._holder(files, path)
            if holder != writer and age < stale_hours * 3600:
                raise WriterBusy(f"{holder} is writing: one writer at a time")
            files.delete(path, False)
        raise WriterBusy("another writer took over at the same time")

    def _create(self, files, path, writer: str) -> bool:
        try:
            if path.toUri().getScheme() in (None, "file"):  # Hadoop's local create looks first and makes then
                nio, uri = self.spark.sparkContext._jvm.java.nio.file, files.makeQualified(path).toUri()
                nio.Files.createFile(nio.Paths.get(uri), self._none(nio.attribute.FileAttribute))
                nio.Files.writeString(nio.Paths.get(uri), writer, self._none(nio.OpenOption))
            else:
                out = files.create(path, False)
                out.write(bytearray(writer.encode()))
                out.close()
            return True
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise

    def _none(self, kind):
        return self.spark.sparkContext._gateway.new_array(kind, 0)

    def _holder(self, files, path) -> tuple[str | None, float]:
        """(writer, seconds since it wrote) of the file; nobody if it is gone meanwhile."""
        try:
            since = files.getFileStatus(path).getModificationTime() / 1000
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(files.open(path), "UTF-8")
            return text, dt.datetime.now().timestamp() - since
        except Py4JJavaError as error:
            if "FileNotFound" in error.java_exception.getClass().getName():
                return None, float("inf")
            raise

    def unlock(self, writer: str) -> None:
        files, path = self._file("writer")
        if files.exists(path) and self._holder(files, path)[0] == writer:
            files.delete(path, False)

    # -- run log ---------------------------------------------------------
    def log(self, line: DataFrame) -> None:
        line.coalesce(1).write.mode("append").parquet(f"{self.root}/etl_runs")

    def runs(self) -> DataFrame:
        return current_runs(self._read(f"{self.root}/etl_runs", schemas.ETL_RUNS))

    def succeeded(self) -> list[str]:
        """Succeeded batch ids, oldest first (one per run of the loader)."""
        done = self.runs().where(F.col("status") == "succeeded").orderBy("finished_at", "batch_id")
        return [row.batch_id for row in done.select("batch_id").collect()]

    # -- tables ----------------------------------------------------------
    def path(self, table: str, batch_id: str) -> str:
        return f"{self.root}/{table}/batch_id={batch_id}"

    def tables(self) -> dict[str, DataFrame]:
        """The star schema as of the batches that have succeeded by now."""
        batches = self.succeeded()
        versions = self._versions(batches)
        return {
            "dim_company": dim_company(self.spark, self.companies),
            "dim_date": dim_date(self.spark, *self.calendar),
            **{name: self._parts(name, {p: b for p, (b, _) in versions.get(name, {}).items()}) for name in DIMENSIONS},
            "fact_sales": self.facts(batches),
        }

    def errors(self) -> DataFrame:
        """Quarantine rows of every batch, failed ones included."""
        batches = [r.batch_id for r in self.runs().select("batch_id").collect()]
        stored = self._read(f"{self.root}/etl_errors", schemas.ETL_ERRORS)
        return stored.where(F.col("batch_id").isin(batches)).select(*schemas.ETL_ERRORS.names)

    def write_errors(self, df: DataFrame, batch_id: str) -> None:
        rows = df.select(*schemas.ETL_ERRORS.names)
        rows.write.mode("overwrite").options(**COMPACT).parquet(self.path("etl_errors", batch_id))

    # -- facts -----------------------------------------------------------
    def _declared(self) -> str:
        """The batches' folders as one bucketed table of this session."""
        name = f"tallyloom_facts_{hashlib.md5(self.root.encode()).hexdigest()[:16]}"
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.FACT_SALES)
            setting, keys = "spark.sql.hive.manageFilesourcePartitions", ", ".join(schemas.FACT_KEY)
            before = self.spark.conf.get(setting)
            self.spark.conf.set(setting, "false")  # folders are listed, not registered one by one
            try:
                self.spark.sql(
                    f"CREATE TABLE {name} ({columns}, batch_id STRING) USING parquet PARTITIONED BY (batch_id) "
                    f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.layout()[0]} BUCKETS "
                    f"LOCATION '{self.root}/fact_sales'")
            finally:
                self.spark.conf.set(setting, before)
        self.spark.catalog.refreshTable(name)
        return name

    def facts(self, batches: Sequence[str]) -> DataFrame:
        """Facts of the given batches: other folders are not read."""
        if not batches or self._existing(f"{self.root}/fact_sales", schemas.FACT_SALES) is None:
            return literal_rows(self.spark, [], schemas.FACT_SALES)
        stored = self.spark.table(self._declared())
        return stored.where(F.col("batch_id").isin(list(batches))).select(*schemas.FACT_SALES.names)

    def write_facts(self, df: DataFrame, batch_id: str) -> int:
        """Write the facts of a batch in buckets; the number of rows, counted on the way.
        Rows that are dealt by bucket already (``insert_absent``) make one file each; where a
        shuffle by the keys comes before the dealing, it is into buckets and serves for both. The
        order ids of a file are in a Bloom filter, so a look-up skips what lacks them."""
        self._keep_layout()
        buckets, keys = self.layout()[0], list(schemas.FACT_KEY)
        counted = Observation()
        rows = df.select(*schemas.FACT_SALES.names).observe(counted, F.count(F.lit(1)).alias("n"))
        name = f"tallyloom_batch_{hashlib.md5(f'{self.root}/{batch_id}'.encode()).hexdigest()[:16]}"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        # of the rows' own session: that of a stream's micro-batch is another one
        with shuffle_partitions(self.spark, buckets), released_shuffles(df.sparkSession):
            (rows.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").mode("overwrite").options(**COMPACT)
             .option("parquet.bloom.filter.enabled#source_order_id", "true")
             .option("path", self.path("fact_sales", batch_id)).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")  # a table with a path of its own: the files stay
        return counted.get["n"]

    def written_facts(self, batch_id: str) -> DataFrame:
        """What one batch wrote, whether or not it has succeeded yet."""
        return self.spark.read.schema(schemas.FACT_SALES).parquet(self.path("fact_sales", batch_id))

    # -- dimensions ------------------------------------------------------
    def _versions(self, batches: Sequence[str]) -> dict[str, dict[int, tuple[str, int]]]:
        """{table: {part: (batch of its newest version, greatest key)}}: one row per part."""
        listed = self._read(f"{self.root}/dim_parts", DIM_PARTS)
        order = literal_rows(self.spark, list(enumerate(batches)), T.StructType(
            [T.StructField("place", T.LongType()), T.StructField("batch_id", T.StringType())]))
        newest = listed.join(order, "batch_id").groupBy("table", PART).agg(
            F.max_by("batch_id", "place").alias("batch_id"), F.max("max_sk").alias("max_sk"))
        found: dict[str, dict[int, tuple[str, int]]] = {}
        for row in newest.collect():
            found.setdefault(row["table"], {})[row[PART]] = (row["batch_id"], row["max_sk"])
        return found

    def _parts(self, table: str, versions: dict[int, str]) -> DataFrame:
        schema = DIMENSIONS[table][0]
        if not versions:
            return literal_rows(self.spark, [], schema)
        paths = [f"{self.path(table, b)}/{PART}={p}" for p, b in sorted(versions.items())]
        return self.spark.read.schema(schema).parquet(*paths)

    def update_dimension(self, table: str, incoming: DataFrame, batch_id: str, upsert) -> DataFrame:
        """Write the parts that the keys of ``incoming`` lie in and return the dimension with
        them. ``upsert(current rows of those parts, greatest key so far)`` gives their rows."""
        self._keep_layout()
        sk = DIMENSIONS[table][2]
        versions = self._versions([b for b in self.succeeded() if b != batch_id]).get(table, {})
        part = self.part_of(table)
        touched = [r[0] for r in incoming.select(part.alias(PART)).distinct().collect()]  # as many as parts at most
        current = self._parts(table, {p: versions[p][0] for p in touched if p in versions})
        last = max((m for _, m in versions.values() if m is not None), default=0)
        # one task per part: their number follows the dimension, as is fixed in the layout
        rows = upsert(current, last).withColumn(PART, part).repartition(self.layout()[1], PART)
        with released_shuffles(self.spark):
            rows.write.mode("overwrite").partitionBy(PART).parquet(self.path(table, batch_id))
        if touched:
            written = self.spark.read.schema(rows.schema).parquet(self.path(table, batch_id))
            listed = written.groupBy(PART).agg(F.max(sk).alias("max_sk"))
            listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path('dim_parts', batch_id)}/table={table}")
        return self._parts(table, {**{p: b for p, (b, _) in versions.items()}, **dict.fromkeys(touched, batch_id)})

    # -- reading ---------------------------------------------------------
    def _read(self, path: str, schema) -> DataFrame:
        found = self._existing(path, schema)
        return literal_rows(self.spark, [], schema) if found is None else found

    def _there(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return bool(files.globStatus(at))

    def _existing(self, path: str, schema) -> DataFrame | None:
        return self.spark.read.schema(schema).parquet(path) if self._there(path) else None

    def _existing_text(self, path: str) -> str | None:
        return "\n".join(r[0] for r in self.spark.read.text(path).collect()) if self._there(path) else None
