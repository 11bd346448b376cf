"""What is left to do, and who does it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Numbers generated by one row when a range of shards is listed.
_CHUNK = 4_096


def pending(shards: DataFrame, done: DataFrame) -> DataFrame:
    """Shards without a finished output."""
    return shards.join(done.select("shard"), "shard", "left_anti")


def newcomers(current: DataFrame, seen: DataFrame) -> DataFrame:
    """Shards that appeared since the last pass."""
    return pending(current, seen)


def frontier(shards: DataFrame, done: DataFrame) -> DataFrame:
    """The first unfinished shard, or the one after the last: one row ``shard``."""
    flagged = shards.select("shard").join(
        done.select("shard").distinct().withColumn("done", F.lit(True)), "shard", "left"
    )
    first = F.min(F.when(F.col("done").isNull(), F.col("shard")))
    return flagged.agg(F.coalesce(first, F.max("shard") + 1).alias("shard"))


def shard_bounds(shards: DataFrame) -> DataFrame:
    return shards.agg(F.min("shard").alias("lowest"), F.max("shard").alias("highest"))


def plan_work(shards: DataFrame, workers: int, done: DataFrame | None = None) -> DataFrame:
    """Assign every number from the lowest to the highest shard, gaps included, to workers in turn.

    ``worker, shard``; the finished ones are left out.
    """
    lowest, highest = F.col("lowest"), F.col("highest")
    begin = F.col("begin")
    numbers = (
        shard_bounds(shards)
        .where(lowest.isNotNull())
        .select("lowest", "highest", F.explode(F.sequence(lowest, highest, F.lit(_CHUNK).cast("long"))).alias("begin"))
        # The one row of the bounds makes the chunks, and all tasks their numbers.
        .repartition("begin")
        .select("lowest", F.explode(F.sequence(begin, F.least(begin + (_CHUNK - 1), highest))).alias("shard"))
    )
    todo = numbers if done is None else pending(numbers, done)
    return todo.select(F.pmod(F.col("shard") - lowest, F.lit(workers)).cast("long").alias("worker"), "shard")
