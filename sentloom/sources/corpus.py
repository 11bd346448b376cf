"""Scans of the raw corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom.constants import BROADCAST_FILES
from sentloom.functions.names import file_number
from sentloom.operators.rows import ranked
from sentloom.sources.schemas import CORPUS


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan that yields fewer tasks than there are cores, as small files do.

    A large corpus has more splits than cores and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * 4) if df.rdd.getNumPartitions() < cores else df


def _numbered(df: DataFrame) -> DataFrame:
    """Add the row number in the file, which the Parquet reader knows."""
    return df.select("*", F.col("_metadata.row_index").alias("row"))


def read_corpus(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """A named subset, as a table or as a stream of its files.

    A table gets ``file_no``, the place of the file in name order, and ``row``. A stream gets
    ``file_path_read`` and ``row``; its files are numbered as they arrive.
    """
    if streaming:
        reader = spark.readStream.schema(CORPUS)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return _numbered(reader.parquet(path)).withColumn("file_path_read", F.col("_metadata.file_path"))
    scanned = _numbered(spark.read.schema(CORPUS).parquet(path)).withColumn("scanned", F.col("_metadata.file_path"))
    return number_files(scanned, "scanned")


def number_files(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``file_no``, the place of their file in name order, in place of the column ``path``.

    The names are sorted over all tasks and staged; the rows look the number up by a hash of the name, so the
    table that is shipped has two numbers per file and the rows stay where they are up to ``BROADCAST_FILES``
    files. Beyond that, or if two names had one hash, they are joined by name.
    """
    # One row per file; the scan behind it reads no columns.
    files = ranked(rows.select(path).distinct(), path, "file_no")
    counted = files.agg(F.count("*").alias("files"), F.countDistinct(F.xxhash64(path)).alias("hashes")).first()
    if counted["files"] <= BROADCAST_FILES and counted["files"] == counted["hashes"]:
        keyed = files.select(F.xxhash64(path).alias("file_hash"), "file_no")
        return rows.withColumn("file_hash", F.xxhash64(path)).join(F.broadcast(keyed), "file_hash").drop("file_hash", path)
    return rows.join(files, path).drop(path)


def read_corpus_files(
    spark: SparkSession, root: str, subset: str, total_files: int, start: int = 0, stop: int | None = None
) -> DataFrame:
    """Numbered files ``train-00000-of-00099.parquet`` of a subset, with ``file_no`` and ``row``."""
    paths = [
        f"{root}/data/{subset}/train-{number:05d}-of-{total_files:05d}.parquet"
        for number in range(start, total_files if stop is None else stop)
    ]
    corpus = spark.read.schema(CORPUS).parquet(*paths)
    return _numbered(corpus).withColumn("file_no", file_number("_metadata.file_path"))


def documents_as_corpus(documents: DataFrame, files: int = 1) -> DataFrame:
    """A ``documents(doc_id, text, lang, source)`` table in the shape of a corpus of ``files`` files."""
    doc_id = F.col("doc_id")
    return documents.select(
        F.pmod(doc_id, F.lit(files)).cast("long").alias("file_no"),
        F.floor(doc_id / files).cast("long").alias("row"),
        doc_id.cast("string").alias("id"),
        "text",
        F.col("source").alias("dump"),
        F.concat(F.lit("doc://"), doc_id).alias("url"),
        F.concat_ws("/", "source", "lang").alias("file_path"),
    )

