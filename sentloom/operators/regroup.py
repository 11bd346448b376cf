"""Translated sentences back to documents with their metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def find_islands(sentences: DataFrame) -> DataFrame:
    """Number the runs of equal ids inside each shard; an id that returns starts a new run."""
    in_order = Window.partitionBy("shard").orderBy("pos")
    starts = ~F.col("id").eqNullSafe(F.lag("id").over(in_order)) | (F.row_number().over(in_order) == 1)
    return sentences.withColumn("starts", starts.cast("long")).withColumn(
        "island", F.sum("starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - 1
    ).drop("starts")


def _ordered(order: str) -> list[F.Column]:
    """The sentences that are there, in order, and how many are missing."""
    there = F.col("sentence").isNotNull()
    items = F.array_sort(F.collect_list(F.when(there, F.struct(order, "sentence"))))
    return [
        F.transform(items, lambda item: item["sentence"]).alias("text"),
        F.count_if(~there).alias("missing_sentences"),
    ]


def group_islands(islands: DataFrame) -> DataFrame:
    """One row per run: ``shard, island, uuid, text array<string>, missing_sentences``."""
    return islands.groupBy("shard", "island", F.col("id").alias("uuid")).agg(*_ordered("pos"))


def last_meta(meta: DataFrame) -> DataFrame:
    """One metadata row per shard and id; the last one listed wins."""
    return meta.groupBy("shard", "id").agg(F.max_by("meta", "ord").alias("meta"))


def attach_meta(documents: DataFrame, meta: DataFrame, strict: bool = True) -> DataFrame:
    """Look the metadata of each document up by shard and id.

    A document without metadata is an error when ``strict``, except in a shard that has no metadata at
    all, where the lookup is skipped. Otherwise its ``meta`` is null.

    The flag of a shard, one row each, meets the documents where they are; the metadata meets them by shard
    and id, so the metadata of a crowded shard is spread over all tasks.
    """
    if strict:
        described = meta.groupBy("shard").agg(F.lit(True).alias("described"))
        documents = documents.join(described, "shard", "left")
    # Placed by both keys first; else the join would bring all metadata of a shard to the place of its documents.
    placed = documents.repartition("shard", "uuid")
    found = placed.join(last_meta(meta).withColumnRenamed("id", "uuid"), ["shard", "uuid"], "left")
    if not strict:
        return found
    message = F.concat(F.lit("no metadata for document "), F.col("uuid"), F.lit(" in shard "), F.col("shard"))
    missing = F.col("meta").isNull() & F.coalesce("described", F.lit(False))
    checked = F.when(missing, F.raise_error(message).cast(found.schema["meta"].dataType)).otherwise(F.col("meta"))
    return found.withColumn("meta", checked).drop("described")


def _source_documents(sentences: DataFrame, meta: DataFrame, strict: bool) -> DataFrame:
    """The document of each source row with the metadata of that row.

    Both sides are keyed by the source row, so the join keeps the placement of the grouping.
    """
    key = ["file_no", "row"]
    grouped = sentences.groupBy(*key).agg(
        F.first("id").alias("uuid"), F.min("shard").alias("shard"), *_ordered("sent_idx")
    )
    # A document cut by a boundary is listed once per shard, with the same metadata.
    found = grouped.join(meta.groupBy(*key).agg(F.max_by("meta", "shard").alias("meta")), key, "left")
    if not strict:
        return found
    message = F.concat(F.lit("no metadata for row "), F.col("row"), F.lit(" of file "), F.col("file_no"))
    missing = F.raise_error(message).cast(found.schema["meta"].dataType)
    return found.withColumn("meta", F.coalesce("meta", missing))


def regroup(sentences: DataFrame, meta: DataFrame, scope: str = "corpus", strict: bool = True) -> DataFrame:
    """Documents from sentences in shards.

    ``shard`` groups runs of equal ids inside a shard and looks the metadata up by id, so a document cut
    by a boundary comes in parts: ``shard, island, uuid, text, meta``. ``corpus`` joins the parts of each
    source row again, whatever its id, and takes the metadata of that row:
    ``file_no, row, shard, uuid, text, meta``, with the first of its shards.

    A row with a null ``sentence`` is a sentence that did not arrive: its document is listed, with
    ``missing_sentences`` and ``complete``.
    """
    kept = ["uuid", "text", "meta", "missing_sentences", (F.col("missing_sentences") == 0).alias("complete")]
    if scope == "shard":
        return attach_meta(group_islands(find_islands(sentences)), meta, strict).select(
            "shard", "island", *kept
        )
    if scope == "corpus":
        return _source_documents(sentences, meta, strict).select("file_no", "row", "shard", *kept)
    raise ValueError(f"scope must be 'corpus' or 'shard', not {scope!r}")
