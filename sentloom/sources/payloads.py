"""Flat rows to nested shard files and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.constants import MASK_PAD, PAD_ID, SHARD_SIZE
from sentloom.functions.arrays import left_pad
from sentloom.functions.binding import bind
from sentloom.operators.rows import zip_longest, zip_shortest
from sentloom.sources.schemas import META, TOKENIZED


def _in_order(key: str | Column, *fields: str) -> Column:
    return F.array_sort(F.collect_list(F.struct(key, *fields)))


def _sort_by(items: str, key: str) -> Column:
    """Sort by one field; the other fields may hold maps, which have no order."""
    return F.array_sort(items, lambda a, b: F.signum(a[key] - b[key]).cast("int"))


def _pluck(items: str, field: str) -> Column:
    return F.transform(items, lambda item: item[field])


def _meta_parts(meta: DataFrame, part_size: int) -> DataFrame:
    """Metadata arrays of a shard in parts of bounded size.

    Part 0 lists the documents with sentences, at most one per sentence of the shard. Any number of
    documents without sentences may follow one another, so those fill further parts.
    """
    part = F.when(F.col("has_text"), F.lit(0)).otherwise(F.floor(F.col("ord") / part_size) + 1)
    return (
        meta.withColumn("part", part.cast("long"))
        .groupBy("shard", "part")
        .agg(_in_order("ord", "meta").alias("listed"))
        .select("shard", "part", _pluck("listed", "meta").alias("meta_data"))
    )


def nest_tokens(batched: DataFrame, meta: DataFrame, watermarks: DataFrame, part_size: int = SHARD_SIZE) -> DataFrame:
    """Nested tokenized shards, padded to the longest sequence of each batch.

    One row per shard; a shard with many documents without sentences gets further rows that only
    carry their metadata. ``batched`` has ``shard, batch_id, pos, id, input_ids, attention_mask, entities``.
    """
    def padded(field: str, pad: int) -> Column:
        longest = F.array_max(F.transform("rows", lambda r: F.size(r[field])))
        return bind(
            lambda arrays, longest: F.transform(arrays, lambda ids: left_pad(ids, longest, pad)),
            arrays=_pluck("rows", field),
            longest=longest,
        ).alias(field)

    batches = (
        batched.select("shard", "batch_id", "pos", "id", "input_ids", "attention_mask", "entities")
        .repartition("shard")
        .groupBy("shard", "batch_id")
        .agg(F.collect_list(F.struct("pos", "id", "input_ids", "attention_mask", "entities")).alias("rows"))
        .withColumn("rows", _sort_by("rows", "pos"))
        .select(
            "shard",
            "batch_id",
            F.struct(
                F.struct(padded("input_ids", PAD_ID), padded("attention_mask", MASK_PAD)).alias("batch"),
                _pluck("rows", "entities").alias("placeholder_entity_maps"),
            ).alias("inputs"),
            _pluck("rows", "id").alias("batch_ids"),
        )
        .groupBy("shard")
        .agg(F.collect_list(F.struct("batch_id", "inputs", "batch_ids")).alias("batches"))
        .withColumn("batches", _sort_by("batches", "batch_id"))
        .select(
            "shard",
            _pluck("batches", "inputs").alias("tokenized_inputs"),
            _pluck("batches", "batch_ids").alias("ids"),
        )
    )
    parts = _meta_parts(meta, part_size)
    # Every join is on the shard alone, as the batches are already placed.
    whole = batches.join(parts.where("part = 0").drop("part"), "shard", "left")
    further = parts.where("part > 0").select("shard", "meta_data")
    types = {name: kind for name, kind in (field.split(" ", 1) for field in TOKENIZED.split(", "))}
    return (
        whole.unionByName(further, allowMissingColumns=True)
        .join(watermarks, "shard", "left")
        .select(
            *[
                F.coalesce(F.col(name), F.array()).cast(types[name]).alias(name)
                for name in ("tokenized_inputs", "ids", "meta_data")
            ],
            "row",
            "shard",
        )
    )


def nest_outputs(translated: DataFrame) -> DataFrame:
    """Nested translated shards from the rows that succeeded, without metadata."""
    batches = (
        translated.where(F.col("status") == "ok")
        .repartition("shard")
        .groupBy("shard", "batch_id")
        .agg(F.collect_list(F.struct("pos", "id", "output_ids", "entities")).alias("rows"))
        .withColumn("rows", _sort_by("rows", "pos"))
        .groupBy("shard")
        .agg(F.collect_list(F.struct("batch_id", "rows")).alias("batches"))
        .withColumn("batches", _sort_by("batches", "batch_id"))
    )

    def nested(field: str) -> Column:
        return F.transform("batches", lambda b: F.transform(b["rows"], lambda r: r[field]))

    return batches.select(
        nested("output_ids").alias("outputs"),
        nested("entities").alias("placeholder_entity_maps"),
        nested("id").alias("ids"),
        F.array().cast(f"array<{META}>").alias("meta_data"),
        F.lit(None).cast("long").alias("row"),
        "shard",
    )


def nest_documents(documents: DataFrame, watermarks: DataFrame | None = None) -> DataFrame:
    """Nested merged shards from ``shard, island, uuid, text, meta``, the parts of documents in each shard.

    Whole documents come with ``file_no, row`` instead: each lies in the shard it begins in, in the order of the corpus, so
    a payload has no more documents than a shard has sentences.
    """
    order = "island" if "island" in documents.columns else F.struct("file_no", "row").alias("place")
    nested = (
        documents.groupBy("shard")
        .agg(_in_order(order, "uuid", "text", "meta").alias("docs"))
        .select(
            _pluck("docs", "text").alias("text"),
            _pluck("docs", "uuid").alias("uuid"),
            "shard",
            # A shard without any metadata has an empty list.
            F.when(F.exists("docs", lambda d: d["meta"].isNotNull()), _pluck("docs", "meta"))
            .otherwise(F.array().cast(f"array<{META}>"))
            .alias("meta_data"),
        )
    )
    if watermarks is None:
        return nested.withColumn("row", F.lit(None).cast("long"))
    return nested.join(watermarks, "shard", "left")


def flatten_outputs(payloads: DataFrame) -> DataFrame:
    """Nested translated shards to one row per sentence."""
    columns = {"id": "ids", "output_ids": "outputs", "entities": "placeholder_entity_maps"}
    return (
        payloads.select("shard", *[F.flatten(source).alias(name) for name, source in columns.items()])
        .select("shard", F.posexplode(F.arrays_zip(*columns)).alias("pos", "item"))
        .select("shard", F.col("pos").cast("long").alias("pos"), "item.*")
    )


def flatten_meta(payloads: DataFrame) -> DataFrame:
    """Metadata rows of nested shards: ``shard, ord, id, meta``."""
    return payloads.select("shard", F.posexplode("meta_data").alias("ord", "meta")).select(
        "shard", F.col("ord").cast("long").alias("ord"), F.col("meta.id").alias("id"), "meta"
    )


def document_rows(merged: DataFrame, compat: bool = False) -> DataFrame:
    """Nested merged shards to ``text, uuid, meta_data`` rows.

    ``compat`` publishes only positions present in all three lists, so a shard without metadata gives
    no rows; by default it gives its documents with null metadata.
    """
    zipped = zip_shortest if compat else zip_longest
    return zipped(merged.select("text", "uuid", "meta_data"), "text", "uuid", "meta_data")
