"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
#: Folders of the scratch blocks that are open, the innermost last.
_scratch: list[str] = []


def build_session(app: str = "sentloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for. Sizes are left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Lets a join on (shard, id) keep a partitioning on shard alone.
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a local one only where all tasks are local too."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and all executors of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_dirs[app]


def new_path(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A new name in the shared folder, or in the open scratch folder unless ``lasting``."""
    folder = shared_dir(spark) if lasting or not _scratch else _scratch[-1]
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged while the block runs are deleted at its end, when what was made of them must be written."""
    folder = new_path(spark, "scratch", lasting=True)
    _scratch.append(folder)
    try:
        yield
    finally:
        _scratch.remove(folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Delete the shuffle files of each query that the block runs as soon as the query ends.

    They would lie on the disks of the executors until the driver collects its garbage, those of all steps of a job together.
    """
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def listed_together(spark: SparkSession) -> AbstractContextManager[None]:
    """List the folders of a table in a few tasks for each core while the block runs, instead of a task for each folder."""
    tasks = max(32, 4 * spark.sparkContext.defaultParallelism)
    return _set(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and return a scan of it.

    Cuts the lineage and survives lost executors; later readers prune columns and rows. Zstandard takes less room than the
    default, mostly of texts and ids, and as little without the dictionaries of Parquet, which cost time.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
