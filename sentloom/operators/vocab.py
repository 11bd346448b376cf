"""Vocabulary of a corpus: tokens ranked by frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentloom.constants import FIRST_TOKEN_ID, HOT_KEY_BYTES, HOT_ROWS
from sentloom.functions.text import whitespace_tokens
from sentloom.operators.rows import ranked
from sentloom.session import stage


def token_counts(sentences: DataFrame, column: str = "sentence") -> DataFrame:
    return (
        # The outer form keeps Spark from testing the array first, which would split each text twice.
        sentences.select(F.explode_outer(whitespace_tokens(column)).alias("token"))
        .where(F.col("token").isNotNull())
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )


def build_vocab(
    sentences: DataFrame, min_count: int = 1, max_size: int | None = None, column: str = "sentence"
) -> DataFrame:
    """``token, n, token_id``: the most frequent token first, ties by token, ids after the special ones.

    With ``max_size``, the number of tokens of each count, a small table, tells from which count on all fit; only
    those and the tokens of the next count are sorted, over all tasks. Only one row per partition or per
    count is summed in one task.
    """
    counts = token_counts(sentences, column).where(F.col("n") >= min_count)
    if max_size is not None:
        counts = stage(counts, "token-counts")
        classes = counts.groupBy("n").agg(F.count("*").alias("tokens"))
        above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
        reached = classes.withColumn("before", F.coalesce(F.sum("tokens").over(above), F.lit(0)))
        # The lowest count of which some token is among the first max_size.
        lowest = reached.where(F.col("before") < max_size).agg(F.min("n")).first()[0]
        counts = counts.where(F.col("n") >= (lowest or 0))
    placed = ranked(counts, [F.desc("n"), F.col("token")], "vocab_rank")
    vocab = placed.select("token", "n", (F.col("vocab_rank") + FIRST_TOKEN_ID).cast("int").alias("token_id"))
    return vocab if max_size is None else vocab.where(F.col("token_id") < FIRST_TOKEN_ID + max_size)


def hot_tokens() -> Column:
    """A bounded part of a vocabulary: the most frequent tokens of ordinary length."""
    return (F.col("token_id") < FIRST_TOKEN_ID + HOT_ROWS) & (F.octet_length("token") <= HOT_KEY_BYTES)
