"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession

T, R = TypeVar("T"), TypeVar("R")


def build_session(app: str = "vitrine", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs expect; `conf` adds or overrides (dots written as `__`)."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Splits a hot key even where that costs one more exchange further up.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # HTML pages vary in size by orders of magnitude: small batches bound the Python workers' memory.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`; only a local session gets one of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def spread(scan: DataFrame) -> DataFrame:
    """A scan dealt out evenly to all cores, or to as many tasks as it has splits. Splits do not tell how the rows lie: a
    Parquet row group is read by one of them, the others are empty."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(max(cores, scan.rdd.getNumPartitions()))


def in_parallel(spark: SparkSession, work: Callable[[T], R], inputs: Iterable[T]) -> list[R]:
    """Run independent jobs side by side, so that short stages of one fill the executors another leaves idle."""
    inputs = list(inputs)
    with ThreadPoolExecutor(max_workers=max(len(inputs), 1)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), inputs))


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaned, _cleaning = {"writers": 0, "before": "false"}, Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin and end inside leave no shuffle files; other queries of the session keep theirs for a later action."""
    with _cleaning:
        if not _cleaned["writers"]:
            _cleaned["before"] = spark.conf.get(SHUFFLE_CLEANUP, "false")
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _cleaned["writers"] += 1
    try:
        yield
    finally:
        with _cleaning:
            _cleaned["writers"] -= 1
            if not _cleaned["writers"]:
                spark.conf.set(SHUFFLE_CLEANUP, _cleaned["before"])


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, lets several consumers share one computation, and
    gives the planner the exact size: a small result is then broadcast by Spark's own size check
    (`spark.sql.autoBroadcastJoinThreshold`), a large one is shuffled.
    """
    return measured(df, label)[0]


def measured(df: DataFrame, label: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """As `stored`, with aggregate metrics taken while writing. Nothing reads the shuffles of a written table again: their
    files go when it is written."""
    path, seen = scratch_path(df.sparkSession, label), Observation()
    with shuffles_removed(df.sparkSession):
        (df.observe(seen, *metrics) if metrics else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), dict(seen.get) if metrics else {}


def removed(*tables: DataFrame) -> None:
    """Delete what `stored` wrote for these tables; only for what nothing reads again, a lost executor's tasks included."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
