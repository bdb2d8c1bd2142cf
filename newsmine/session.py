"""Session helpers: shared scratch folder, lineage cuts, input spreading."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and working tables.

    Read from the session; only a local-mode session (tests, bench) without one
    gets a folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="newsmine-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and drop its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{checkpoint_dir(spark)}/work/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: a lineage cut with column pruning."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deleted(spark: SparkSession, path: str) -> None:
    """Remove a working table that nothing will read again."""
    if not path.startswith(f"{checkpoint_dir(spark)}/work/"):
        raise ValueError(f"{path} is no working table")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def opened(path: str) -> tuple[fs.FileSystem, str] | None:
    """The file system and the path in it by which Python tasks open a file; None where pyarrow has none for its scheme."""
    try:
        return fs.FileSystem.from_uri(path)
    except (pa.ArrowException, OSError):
        return None


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that end in this block go with them, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a small scan enough tasks for CPU-heavy column work.

    A table that already comes in at least one partition per core (any table of
    real size) is returned untouched, so no raw text is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *[F.col(k) for k in keys])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
