"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Spark's setting that removes the shuffle files of an execution at its end.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

_LOCAL_DIRS: dict[str, str] = {}


def build_spark(app: str = "zoneflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by `spark.checkpoint.dir`.

    A local master may leave the setting out and gets a temporary folder, which
    goes when the application ends; a cluster may not, because executors do not share a machine's disk.
    """
    app_id = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if app_id not in _LOCAL_DIRS:
            _LOCAL_DIRS[app_id] = tempfile.mkdtemp(prefix="zoneflow-")
            atexit.register(shutil.rmtree, _LOCAL_DIRS[app_id], ignore_errors=True)
        base = _LOCAL_DIRS[app_id]
    return f"{base.rstrip('/')}/zoneflow/{app_id}"


def save_table(df: DataFrame, name: str) -> str:
    """Write `df` as Parquet under a new name in the shared folder; returns its path.

    Later reads take the table, so its shuffle files go as soon as it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    kept = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES, kept) if kept is not None else spark.conf.unset(DROP_SHUFFLES)
    return path


def write_table(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write `df` once to the shared folder and return the stored table.

    The result survives lost executors and is the same on every read, which
    partition numbers and sampled range bounds are not before they are stored.
    With `keep` the table outlives the `scratch` block it is written in.
    """
    path, open_ = save_table(df, name), _SCRATCH.get()
    if keep and len(open_) > 1:
        open_[-2].append(path)
    elif open_ and not keep:
        open_[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Paths of the tables stored in each `scratch` block that is open, the innermost last.
_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that `write_table` stores inside the block at its end, but for those it keeps.

    What leaves the block must be read from kept tables alone. Of nested blocks
    a table kept by an inner one goes with the outer one.
    """
    own: list[str] = []
    token = _SCRATCH.set((*_SCRATCH.get(), own))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in own:
            _delete(spark, path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give `checkpoint()` a folder where the session has none, which only a local master may lack."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_dir(spark)}/checkpoint")


_ONCE: dict[tuple[str, ...], str] = {}


def once(spark: SparkSession, key: tuple[str, ...], write: Callable[[], str]) -> str:
    """Path that `write` returned for this key in this application; `release` forgets it."""
    own = (spark.sparkContext.applicationId, *key)
    if own not in _ONCE:
        _ONCE[own] = write()
    return _ONCE[own]


def release(spark: SparkSession) -> None:
    """Remove the tables this application wrote to the shared folder, once nothing reads them, and forget their paths."""
    for key in [k for k in _ONCE if k[0] == spark.sparkContext.applicationId]:
        del _ONCE[key]
    _delete(spark, shared_dir(spark))


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
