"""Readers and listings of shard files.

Two layouts are read: the one written here, ``{root}/{kind}/node=3/shard=17/part-….json``, and plain
files ``{root}/3/{kind}/17.json``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from sentloom.functions.names import node_of_path, shard_of_path
from sentloom.session import listed_together
from sentloom.sources.schemas import MERGED, OUTPUTS, PROGRESS, TOKENIZED

KINDS = {"tokenized": TOKENIZED, "translated": OUTPUTS, "output": MERGED}
LAYOUTS = ("hive", "plain")


def _load(
    spark: SparkSession, reader: DataFrameReader, root: str, kind: str, nodes: Iterable[int] | None, layout: str, file_path: bool = False
) -> DataFrame:
    """Shard files with ``node`` and ``shard``; of the layout written here both are partition columns, so a filter on
    them keeps files from being read."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    chosen = None if nodes is None else list(nodes)
    # As the reader spells it, so that the names of two scans are equal.
    more = [F.col("_metadata.file_path").alias("file_path")] if file_path else []
    if layout == "hive":
        with listed_together(spark):
            files = reader.load(f"{root}/{kind}")
        if not {"node", "shard"} <= set(files.columns):  # nothing was written
            files = files.withColumns({"node": F.lit(None).cast("long"), "shard": F.lit(None).cast("long")}).where("false")
        files = files.select("*", *more)
        return files if chosen is None else files.where(F.col("node").isin(chosen))
    # The node choice is part of the path, so other nodes are not listed.
    some = "*" if chosen is None else "{" + ",".join(map(str, chosen)) + "}"
    with listed_together(spark):
        files = reader.option("recursiveFileLookup", "true").load(f"{root}/{some}/{kind}/*.json")
    path = F.col("_metadata.file_path")
    named = shard_of_path(path)
    return files.select("*", *more, node_of_path(path).alias("node"), named.alias("named")).withColumn(
        "shard", F.coalesce("shard", "named") if "shard" in files.columns else F.col("named")
    ).drop("named")


def _absent(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def read_payloads(
    spark: SparkSession, root: str, kind: str, nodes: Iterable[int] | None = None, layout: str = "hive", file_path: bool = False
) -> DataFrame:
    """Nested shards of some nodes, with ``node``, and on request with ``file_path``. Nodes without a directory give no rows."""
    schema = KINDS[kind]
    read = f"{schema}, node bigint" if layout == "hive" else schema
    reader = spark.read.format("json").schema(read).option("ignoreMissingFiles", "true")
    try:
        return _load(spark, reader, root, kind, nodes, layout, file_path)
    except AnalysisException as error:
        if not _absent(error):
            raise
        return spark.createDataFrame([], f"{schema}, node bigint" + (", file_path string" if file_path else ""))


def read_tokens(spark: SparkSession, root: str, node: int | None = None, layout: str = "hive") -> DataFrame:
    """Nested tokenized shards of one node or of all."""
    return read_payloads(spark, root, "tokenized", None if node is None else [node], layout)


def list_shards(
    spark: SparkSession, root: str, node: int | None = None, kind: str = "tokenized", layout: str = "hive"
) -> DataFrame:
    """``node, shard`` of the shard files, in numeric order, from their names alone."""
    try:
        files = _load(spark, spark.read.format("binaryFile"), root, kind, None if node is None else [node], layout)
    except AnalysisException as error:
        if not _absent(error):
            raise
        return spark.createDataFrame([], "node bigint, shard bigint")
    return (
        files.select(F.col("node").cast("long").alias("node"), F.col("shard").cast("long").alias("shard"))
        .where(F.col("shard").isNotNull())
        .distinct()
        .orderBy("shard")
    )


def read_outputs(
    spark: SparkSession, root: str, start: int, end: int | None = None, layout: str = "hive"
) -> DataFrame:
    """Nested translated shards ``start`` to ``end`` or to the last; empty ones are skipped.

    Shard numbers may have gaps and exceed the number of shards.
    """
    chosen = F.col("shard") >= start if end is None else F.col("shard").between(start, end)
    return read_payloads(spark, root, "translated", layout=layout).where(chosen & (F.size("outputs") > 0))


def list_files(spark: SparkSession, root: str, kind: str, nodes: Iterable[int], layout: str = "hive") -> DataFrame:
    """``file_path, node, shard`` of the shard files of some nodes, from their names alone."""
    try:
        files = _load(spark, spark.read.format("binaryFile"), root, kind, nodes, layout, file_path=True)
    except AnalysisException as error:
        if not _absent(error):
            raise
        return spark.createDataFrame([], "file_path string, node bigint, shard bigint")
    return files.select("file_path", F.col("node").cast("long").alias("node"), F.col("shard").cast("long").alias("shard"))


def read_documents(
    spark: SparkSession, root: str, node_start: int, node_end: int, layout: str = "hive", ordered: bool = False, file_path: bool = False
) -> DataFrame:
    """Nested merged shards of an inclusive node range; absent nodes are passed over.

    Sorted by node and shard on request only.
    """
    merged = read_payloads(spark, root, "output", range(node_start, node_end + 1), layout, file_path)
    return merged.orderBy("node", "shard") if ordered else merged


def progress(spark: SparkSession, root: str) -> DataFrame:
    """Audit rows of the streaming jobs; none if nothing ran yet."""
    try:
        return spark.read.schema(PROGRESS).parquet(f"{root}/progress")
    except AnalysisException as error:
        if not _absent(error):
            raise
        return spark.createDataFrame([], PROGRESS)
