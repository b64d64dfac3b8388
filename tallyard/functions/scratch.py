"""Working folders that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own_dir: str | None = None
_freeing = threading.Lock()
#: A setting of Spark: files of a query's exchanges go when it ends, not when the driver happens to collect its garbage.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``); where it is unset, a temporary one, on a local master only."""
    global _own_dir
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return "file://" + _own_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below :func:`scratch_dir` that Hadoop's file system removes when the driver ends."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder once, for queries that would evaluate it several times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_apart(df: DataFrame, name: str, by: str | None = None, slices: int = 1) -> DataFrame:
    """As :func:`written`, but the disk that its exchanges took is free afterwards; such frames are written one at a time.

    ``slices``: rows are written in so many goes, by a hash of the column ``by``, each of which reads the sources again and takes
    its share of that disk.
    """
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    with _freeing:
        before = conf.get(_FREED, "false")
        conf.set(_FREED, "true")
        try:
            for k in range(slices):
                rows = df if slices == 1 else df.where(F.pmod(F.xxhash64(by), F.lit(slices)) == k)
                rows.write.mode("append").parquet(path)
        finally:
            conf.set(_FREED, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, *make: Callable[[], DataFrame]) -> list[DataFrame]:
    """What the functions return; their jobs run side by side, since small ones leave most of a cluster idle."""
    with ThreadPoolExecutor(len(make)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(m)) for m in make]]
