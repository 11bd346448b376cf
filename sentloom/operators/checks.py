"""Alignment audit and run report."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Result = TypeVar("Result")

STEPS = (
    "step string, rows long, kept long, set_aside long, batches long, kept_batches long, truncated long, "
    "started_at timestamp, elapsed_s double, error string"
)


def audit_alignment(tokens: DataFrame) -> DataFrame:
    """Per shard: rows, non-null ids, inputs, masks and maps, and whether they all agree."""
    fields = {"ids": "id", "inputs": "input_ids", "masks": "attention_mask", "maps": "entities"}
    agree = F.lit(True)
    for name in fields:
        agree = agree & (F.col(name) == F.col("rows"))
    equal_lengths = F.size("input_ids") == F.size("attention_mask")
    counts = tokens.groupBy("shard").agg(
        F.count("*").alias("rows"),
        *[F.count(column).alias(name) for name, column in fields.items()],
        F.sum((~F.coalesce(equal_lengths, F.lit(False))).cast("long")).alias("uneven"),
    )
    return counts.withColumn("ok", agree & (F.col("uneven") == 0))


def run_report(translated: DataFrame) -> DataFrame:
    """Rows, batches and, where they are marked, cut sentences of each shard by outcome."""
    cut = F.count_if("truncated") if "truncated" in translated.columns else F.lit(None).cast("long")
    per_batch = translated.groupBy("shard", "status", "batch_id").agg(F.count("*").alias("rows"), cut.alias("truncated"))
    return per_batch.groupBy("shard", "status").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("batches"), F.sum("truncated").alias("truncated")
    )


def loss_report(documents: DataFrame) -> DataFrame:
    """One row: documents, those that lack sentences, and how many sentences they lack."""
    return documents.agg(
        F.count("*").alias("documents"),
        F.count_if(~F.col("complete")).alias("incomplete"),
        F.coalesce(F.sum("missing_sentences"), F.lit(0)).alias("missing_sentences"),
    )


class RunLog:
    """Counts and elapsed time of the steps of a run, gathered by the very jobs that do the work.

    >>> log = RunLog(spark)
    >>> log.run("translate", translated, lambda df: df.write.parquet(path), batch_size=256)
    >>> log.report().show()
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.steps: list[tuple] = []

    def run(
        self, step: str, df: DataFrame, action: Callable[[DataFrame], Result], batch_size: int | None = None
    ) -> Result:
        """The result of ``action(df)``, which has to run ``df`` once, as a write does.

        Rows count as kept unless a ``status`` other than ``ok`` sets them aside. With ``batch_size``, batches are
        counted by their first rows, as :func:`~sentloom.operators.batches.assign_batches` numbers them. A step that
        fails is logged with its error, without counts.
        """
        observation = Observation(f"{step}-{uuid.uuid4().hex}")
        observed = df.observe(observation, *_step_counts(df, batch_size))
        started_at, started = datetime.now(timezone.utc), time.monotonic()
        try:
            result = action(observed)
        except Exception as error:
            self.steps.append((step, *[None] * 6, started_at, time.monotonic() - started, str(error)[:1000]))
            raise
        elapsed = time.monotonic() - started
        counts = observation.get
        named = [counts[c] for c in ("rows", "kept", "set_aside", "batches", "kept_batches", "truncated")]
        self.steps.append((step, *named, started_at, elapsed, None))
        return result

    def report(self) -> DataFrame:
        """One row per step, in order; it can be appended to a log of many runs."""
        return self.spark.createDataFrame(self.steps, STEPS).coalesce(1)


def _step_counts(df: DataFrame, batch_size: int | None) -> list[Column]:
    kept = F.coalesce(F.col("status") == "ok", F.lit(False)) if "status" in df.columns else F.lit(True)
    first = F.col("pos") % batch_size == 0 if batch_size else None
    absent = F.max(F.lit(None).cast("long"))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(kept).alias("kept"),
        F.count_if(~kept).alias("set_aside"),
        (absent if first is None else F.count_if(first)).alias("batches"),
        (absent if first is None else F.count_if(first & kept)).alias("kept_batches"),
        (F.count_if("truncated") if "truncated" in df.columns else absent).alias("truncated"),
    ]
