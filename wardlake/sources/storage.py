"""Tables written part way through a job, in the folder shared by all executors."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Stored(NamedTuple):
    """A written table and the number of rows counted while it was written."""

    frame: DataFrame
    rows: int


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Where none is set, one below the session's warehouse, if all machines see that: in local
    mode, or when the warehouse's address names another file system than a machine's own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    scheme = warehouse.partition("://")[0] if "://" in warehouse else "file"
    if not spark.sparkContext.master.startswith("local") and (scheme == "file" or warehouse.startswith("file:")):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{warehouse}/_steps"


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody has used yet.

    All paths of an application lie in one folder, which is deleted when the session's file
    systems close, at the end of the application.
    """
    base = f"{shared_dir(spark)}/wardlake/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{base}/{name}-{uuid.uuid4().hex}"


#: The codec of large texts: on those of the test tables a third less than Spark's default.
TEXT_CODEC = "zstd"

#: For a write: the files of its shuffles go when it ends, not when the driver next collects its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_lock = threading.Lock()
_held: dict[tuple, list] = {}  # by session and setting: users at present, and the value found by the first


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session while a write is planned and run. Users at the same time share
    them; the last one restores what the first one found."""
    keys = {(spark._jsparkSession.sessionUUID(), name): name for name in values}
    with _lock:
        for key, name in keys.items():
            if key not in _held:
                _held[key] = [0, spark._jsparkSession.sessionState().conf().settings().get(name)]  # None where the default holds
                spark.conf.set(name, values[name])
            _held[key][0] += 1
    try:
        yield
    finally:
        with _lock:
            for key, name in keys.items():
                _held[key][0] -= 1
                if not _held[key][0]:
                    found = _held.pop(key)[1]
                    spark.conf.unset(name) if found is None else spark.conf.set(name, found)


_passing: ContextVar[list[str] | None] = ContextVar("_passing", default=None)


@contextmanager
def passing_steps(spark: SparkSession) -> Iterator[None]:
    """Delete the steps this thread publishes inside, at the end: what was made of them is written by then."""
    paths: list[str] = []
    token = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(token)
        for address in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(address)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def publish(df: DataFrame, name: str, codec: str | None = None) -> Stored:
    """Write the frame once and go on from the written table.

    This cuts the lineage (a lost executor costs a re-read, not a recomputation), makes
    several readers share one computation, and gives the planner real file sizes, so that
    Spark broadcasts the table in a join only when its size is known to be small.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if (paths := _passing.get()) is not None:
        paths.append(path)
    seen = Observation()
    with settings(spark, FREE_SHUFFLES):
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path, compression=codec)
    return Stored(spark.read.schema(df.schema).parquet(path), seen.get["rows"])
