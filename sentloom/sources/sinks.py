"""Writers of shards, documents and published datasets."""

from __future__ import annotations

import gzip
import os
import shutil
import uuid
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom.functions.names import dataset_name, node_of
from sentloom.session import shuffles_removed

#: What Spark calls the folder of a null.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
GZIP_LEVEL = 5


def write_rows(df: DataFrame, path: str, total_nodes: int, mode: str = "errorifexists") -> None:
    """Flat rows as Parquet, one directory per node and each shard whole in one file.

    This is the form the jobs read back: columns and nodes are pruned, and no file is nested.
    """
    routed = df.withColumn("node", node_of("shard", total_nodes))
    placed = routed.repartition("shard").sortWithinPartitions("node", "shard")
    with shuffles_removed(df.sparkSession):
        placed.write.mode(mode).option("compression", "zstd").partitionBy("node").parquet(path)


def write_payloads(df: DataFrame, root: str, kind: str, total_nodes: int, mode: str = "errorifexists") -> None:
    """Nested shards as compressed JSON, one directory per node and shard. A row is a whole shard and stays where it is.

    On a local disk, or one that all share, the tasks write the files themselves, as Hadoop starts three processes there for each
    shard: for its directory, its file and the checksum of that.
    """
    routed = df.withColumn("node", node_of("shard", total_nodes))
    target = f"{root}/{kind}"
    local = _local_path(df.sparkSession, target)
    with shuffles_removed(df.sparkSession):
        # Without its rows, Spark's writer makes the folder as ``mode`` has it, or fails.
        if local is None or not (mode == "ignore" and os.path.exists(local)):
            written = routed if local is None else routed.where(F.lit(False))
            written.write.mode(mode).option("compression", "gzip").partitionBy("node", "shard").json(target)
            if local is not None:
                _write_local(routed, local)


def _local_path(spark: SparkSession, path: str) -> str | None:
    """The path for Python if it is in the local file system, else None."""
    named = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(named).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _write_local(routed: DataFrame, target: str) -> None:
    """Add the rows to the folder ``target``, as Spark's JSON writer lays them out.

    Each attempt of a task writes below a folder of its own, and what the attempts that count have written is moved
    into place when all have ended, so nothing is seen of a job that fails.
    """
    job = uuid.uuid4().hex
    work = f"{target}/_temporary/{job}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = f"{work}/{uuid.uuid4().hex}"
        name = f"part-{TaskContext.get().partitionId():05d}-{job}.json.gz"
        for batch in batches:
            for node, shard, row in zip(batch["node"].to_pylist(), batch["shard"].to_pylist(), batch["row"], strict=True):
                place = "/".join(f"{k}={NO_VALUE if v is None else v}" for k, v in (("node", node), ("shard", shard)))
                os.makedirs(f"{attempt}/{place}", exist_ok=True)
                # Further rows of a shard follow as further members of the file.
                with open(f"{attempt}/{place}/{name}", "ab") as file:
                    file.write(gzip.compress(row.as_buffer(), GZIP_LEVEL))
                    file.write(gzip.compress(b"\n", GZIP_LEVEL))
        yield pa.record_batch({"attempt": pa.array([attempt])})

    rows = F.to_json(F.struct(*[c for c in routed.columns if c not in ("node", "shard")])).alias("row")
    try:
        for done in routed.select("node", "shard", rows).mapInArrow(run, "attempt string").collect():
            for folder, _, files in os.walk(done["attempt"]):
                if files:
                    place = folder.replace(done["attempt"], target, 1)
                    os.makedirs(place, exist_ok=True)
                    for file in files:
                        os.rename(f"{folder}/{file}", f"{place}/{file}")
    finally:
        shutil.rmtree(f"{target}/_temporary", ignore_errors=True)


def publish_rows(
    rows: DataFrame, dest: str, subset: str, at: datetime | None = None
) -> str | None:
    """Write the published rows under a time-stamped name; nothing is written when there are none."""
    if rows.isEmpty():
        return None
    path = f"{dest}/{dataset_name(subset, at)}"
    with shuffles_removed(rows.sparkSession):
        rows.write.parquet(path)
    return path


def retire_inputs(spark: SparkSession, root: str, kind: str, committed: DataFrame) -> int:
    """Delete the shard directories whose ``node, shard`` are in ``committed``.

    ``committed`` comes from the finished output, never from a plan, so nothing is deleted that was not
    written. In a local file system the tasks delete; else paths stream through the driver one partition at a time. For steady
    operation let the streaming source delete its inputs instead (``clean='delete'`` in :mod:`sentloom.streaming.drain`).
    """
    local = _local_path(spark, f"{root}/{kind}")
    if local is not None:
        return _retire_local(committed.select("node", "shard").distinct(), local)
    jvm = spark.sparkContext._jvm
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for entry in committed.select("node", "shard").distinct().toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{kind}/node={entry['node']}/shard={entry['shard']}")
        removed += bool(path.getFileSystem(configuration).delete(path, True))
    return removed


def _retire_local(shards: DataFrame, target: str, tasks: int = 64) -> int:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folders = [f"{target}/node={n}/shard={s}" for n, s in zip(batch["node"].to_pylist(), batch["shard"].to_pylist(), strict=True)]
            there = [folder for folder in folders if os.path.isdir(folder)]
            for folder in there:
                shutil.rmtree(folder)
            yield pa.record_batch({"removed": pa.array([len(there)], pa.int64())})

    removed = shards.repartition(tasks, "node", "shard").mapInArrow(run, "removed long")
    return removed.agg(F.coalesce(F.sum("removed"), F.lit(0)).alias("removed")).first()["removed"]


def delete_files(files: DataFrame, tasks: int = 64) -> DataFrame:
    """Delete the files of ``files(file_path, …)`` in tasks: their rows with ``removed``, false where the file was gone before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed = []
            for uri in batch["file_path"].to_pylist():
                where, path = fs.FileSystem.from_uri(uri)
                there = where.get_file_info(path).type == fs.FileType.File
                if there:
                    where.delete_file(path)
                removed.append(there)
            yield pa.record_batch({"file_path": batch["file_path"], "removed": pa.array(removed)})

    return files.select("file_path").repartition(tasks, "file_path").mapInArrow(run, "file_path string, removed boolean")


def committed_shards(spark: SparkSession, path: str, kept: bool = False) -> DataFrame:
    """``node, shard`` of a finished flat output without unresolved rows.

    A row is resolved when its ``status`` is ``ok``, or, with ``kept``, when the output holds its ``input_ids`` or, where the
    tokenizer failed, its sentence, so that it can be translated later. An output without ``status`` has no unresolved rows.
    """
    rows = spark.read.parquet(path)
    resolved = F.col("status") == "ok" if "status" in rows.columns else F.lit(True)
    if kept and "input_ids" in rows.columns:
        resolved = resolved | F.col("input_ids").isNotNull()
        if "untokenized" in rows.columns:
            resolved = resolved | F.col("untokenized").isNotNull()
    return (
        rows.groupBy(F.col("node").cast("long").alias("node"), "shard")
        .agg(F.bool_and(F.coalesce(resolved, F.lit(False))).alias("resolved"))
        .where("resolved")
        .select("node", "shard")
    )
