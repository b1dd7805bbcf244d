"""Session defaults and the one way this package cuts lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def session(app: str = "tallyloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the package relies on; a cluster's own
    settings (executors, shuffle partitions, checkpoint folder) are left alone."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in defaults.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: below ``spark.checkpoint.dir``, which every
    executor can reach. Only in local mode, where that may be unset, one is made; on a
    cluster each executor would write to a disk of its own and rows would be lost."""
    base, application = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.applicationId
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        if application not in _local_scratch:
            _local_scratch[application] = tempfile.mkdtemp(prefix="tallyloom-")
        base = _local_scratch[application]
    return f"{base.rstrip('/')}/tallyloom-{application}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. Frames that were read back
    from them can no longer be used."""
    _delete(spark, scratch_dir(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_scope = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch tables that this thread writes inside are deleted at the end: for work whose
    results are stored elsewhere. Frames that read them can no longer be used then."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        paths, _scope.paths = _scope.paths, outer
        for path in paths:
            _delete(spark, path)


def _scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_dir(spark)}/{name}"
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    return path


#: For wide rows of orders: text keys take half the bytes that they take by default.
COMPACT = {"compression": "zstd"}


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once as a scratch table, with options of the writer, and read it back.

    The copy is columnar, so later passes prune columns, and it outlives the
    executors that wrote it. Use it for a frame that several jobs read.
    """
    path = _scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with released_shuffles(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_buckets(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``materialize``, compact, in hash buckets of ``key``: frames that lie in as many
    buckets meet by it without a shuffle. The catalog keeps no name of it."""
    spark, number = df.sparkSession, uuid.uuid4().hex
    table = f"{name.replace('-', '_')}_{number}"
    with released_shuffles(spark):
        (df.write.bucketBy(buckets, key).sortBy(key).format("parquet").options(**COMPACT)
         .option("path", _scratch_path(spark, f"{name}-{number}")).saveAsTable(table))
    stored = spark.table(table)
    stored.schema  # resolved before the name is dropped; the files stay
    spark.sql(f"DROP TABLE {table}")
    return stored


def discard(stored: DataFrame) -> None:
    """Delete the files of a scratch table that nothing reads any more."""
    spark = stored.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in stored.inputFiles()}:
        if f"/tallyloom-{spark.sparkContext.applicationId}/" not in folder:
            raise ValueError(f"{folder} is not a scratch table")
        _delete(spark, folder)


def materialize_counted(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``materialize``, compact, and aggregates of the rows taken while they are written."""
    seen = Observation()
    stored = materialize(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), name, **COMPACT)
    return stored, seen.get


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path``."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


@contextmanager
def _set(spark: SparkSession, setting: str, value: str) -> Iterator[None]:
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


@contextmanager
def shuffle_partitions(spark: SparkSession, number: int) -> Iterator[None]:
    """Plan what is run inside with this number of shuffle partitions."""
    with _set(spark, "spark.sql.shuffle.partitions", str(number)):
        yield


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query that is run inside when it ends. Otherwise they
    lie on the executors' disks until the driver's garbage collector finds the plan, which a
    driver with room to spare hardly does. For writes, whose plans are not run again."""
    with _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """A few fixed rows as part of the plan. Spark sees that they are small, whereas
    it takes ``createDataFrame`` of a list for a table of unknown, huge size."""
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
