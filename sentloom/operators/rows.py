"""Positional zip of array columns into rows, and ranks of sorted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentloom.session import stage


def zip_shortest(df: DataFrame, *arrays: str) -> DataFrame:
    """One row per position that all arrays have. A null array counts as empty."""
    shortest = F.least(*[F.coalesce(F.size(a), F.lit(0)) for a in arrays])
    cut = [F.slice(a, F.lit(1), F.greatest(shortest, F.lit(0))).alias(a) for a in arrays]
    others = [c for c in df.columns if c not in arrays]
    return df.select(*others, *cut).select(*others, F.inline(F.arrays_zip(*arrays)))


def zip_longest(df: DataFrame, *arrays: str) -> DataFrame:
    """One row per position that any array has; the others are null there."""
    filled = [F.coalesce(F.col(a), F.array().cast(df.schema[a].dataType)).alias(a) for a in arrays]
    others = [c for c in df.columns if c not in arrays]
    return df.select(*others, *filled).select(*others, F.inline(F.arrays_zip(*arrays)))


def ranked(df: DataFrame, order: str | list[Column | str], name: str) -> DataFrame:
    """``df`` with ``name``, the rank from 0 in this order, sorted over all tasks.

    The sorted rows are staged with their place in their partition; the rank is that place plus the size of the
    partitions before it. Only one row per partition is summed in one task.
    """
    # The id generator puts the partition number above bit 33 and the row in the partition below.
    slots = df.orderBy(order).withColumn("slot", F.monotonically_increasing_id())
    placed = stage(slots, name).withColumns(
        {"part": F.shiftright("slot", 33), "place": F.col("slot").bitwiseAND((1 << 33) - 1)}
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before")
    )
    return placed.join(parts, "part").select(*df.columns, (F.col("before") + F.col("place")).alias(name))
