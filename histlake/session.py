"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings a job wants on a cluster; `spark.sql.shuffle.partitions` is left to the
# deployment because adaptive execution merges small partitions from any high start.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM does not compile methods beyond 8000 bytes of code. Rule and cast
    # projections over many columns exceed that when generated as one method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and work tables that every executor can reach.

    The cluster names it in `spark.checkpoint.dir`. Only a local session without
    one (tests) gets a folder of its own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if folder:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(folder)
        return folder
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="histlake-checkpoint-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, *measures: Column, into: Observation | None = None) -> DataFrame:
    """Write `df` as a work table in the shared folder and continue from it.

    Survives lost executors like a checkpoint. As Parquet it also keeps column
    pruning and tells the planner its true size, which decides about broadcasts.
    `measures` are aggregates of all rows, taken `into` an observation while they are
    written, which saves reading them for that.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/histlake-work/{uuid.uuid4().hex}"
    if _owners:
        _owners[-1].append(path)
    (df.observe(into, *measures) if into else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_owners: list[list[str]] = []


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Own the work tables that are written inside, and remove them at the end."""
    _owners.append([])
    try:
        yield
    finally:
        for path in _owners.pop():
            remove(spark, path)


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _file_system(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority."""
    return _file_system(spark, path).makeQualified(_path(spark, path)).toString()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder if it is there."""
    _file_system(spark, path).delete(_path(spark, path), True)


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder in one step; false if the target is there already."""
    jvm = spark.sparkContext._jvm
    fs = _file_system(spark, target)
    fs.mkdirs(_path(spark, target).getParent())
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(fs.makeQualified(_path(spark, source)), fs.makeQualified(_path(spark, target)), none)
    except Exception:
        if fs.exists(_path(spark, target)):
            return False
        raise
    return True


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it isn't there."""
    fs = _file_system(spark, path)
    if not fs.exists(_path(spark, path)):
        return []
    return [f.getPath().getName() for f in fs.listStatus(_path(spark, path)) if f.isDirectory()]
