"""Micro-batches of a shard: numbering, padding and rejection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentloom.constants import BATCH_SIZE, MASK_PAD, MAX_PAD, PAD_ID
from sentloom.functions.arrays import left_pad


def assign_batches(tokens: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    return tokens.withColumn("batch_id", F.floor(F.col("pos") / size).cast("long"))


def batch_lengths(batched: DataFrame) -> DataFrame:
    """Longest sequence and number of rows of each batch."""
    return batched.groupBy("shard", "batch_id").agg(
        F.max(F.size("input_ids")).cast("long").alias("longest"), F.count("*").alias("batch_rows")
    )


def pad_batches(batched: DataFrame, max_pad: int | None = MAX_PAD, devices: int = 1) -> DataFrame:
    """Left-pad to the longest sequence of the batch and label each row.

    ``status`` is ``ok``, ``over_length`` when the longest sequence exceeds ``max_pad``, or ``ragged``
    when the batch does not divide evenly among the devices. Rejected rows keep their unpadded
    arrays. One pass gives both outcomes: see :func:`accepted` and :func:`quarantined`.
    """
    batch = Window.partitionBy("shard", "batch_id")
    status = (
        F.when(F.col("longest") > max_pad if max_pad is not None else F.lit(False), "over_length")
        .when(F.col("batch_rows") % devices != 0, "ragged")
        .otherwise("ok")
    )
    ok = F.col("status") == "ok"
    return (
        batched.withColumn("longest", F.max(F.size("input_ids")).over(batch))
        .withColumn("batch_rows", F.count("*").over(batch))
        .withColumn("status", status)
        .withColumn(
            "attention_mask",
            F.when(ok, left_pad("attention_mask", F.col("longest"), MASK_PAD)).otherwise(F.col("attention_mask")),
        )
        .withColumn(
            "input_ids", F.when(ok, left_pad("input_ids", F.col("longest"), PAD_ID)).otherwise(F.col("input_ids"))
        )
        .drop("longest", "batch_rows")
    )


def accepted(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("status") == "ok")


def quarantined(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("status") != "ok")
