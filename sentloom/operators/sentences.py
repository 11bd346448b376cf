"""Documents to ordered, clean sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentloom.functions.text import sentence_array

META_FIELDS = ("id", "dump", "url", "file_path")


def doc_meta() -> Column:
    """Metadata of a document as one struct."""
    return F.struct(*META_FIELDS).alias("meta")


def split_documents(docs: DataFrame, method: str = "regex", dedup: bool = False) -> DataFrame:
    """Replace ``text`` by ``sentences array<string>`` and its size, one row per document.

    ``dedup`` keeps the first of equal sentences of a document; it is off by default.
    """
    sentences = sentence_array("text", method)
    if dedup:
        sentences = F.array_distinct(sentences)
    return (
        docs.withColumn("sentences", sentences)
        .drop("text")
        .withColumn("n_sentences", F.size("sentences").cast("long"))
    )


def explode_sentences(split: DataFrame) -> DataFrame:
    """One row per sentence, numbered from zero inside its document.

    The outer form keeps Spark from testing the array first, which would split each text twice.
    """
    exploded = split.select("file_no", "row", "id", F.posexplode_outer("sentences").alias("sent_idx", "sentence"))
    return exploded.where(F.col("sentence").isNotNull()).withColumn("sent_idx", F.col("sent_idx").cast("long"))


def sentences(docs: DataFrame, method: str = "regex", dedup: bool = False) -> DataFrame:
    """Ordered clean sentences of raw documents: ``file_no, row, id, sent_idx, sentence``."""
    return explode_sentences(split_documents(docs, method, dedup))


def sentence_counts(split: DataFrame) -> DataFrame:
    """Sentences per document id."""
    return split.groupBy("id").agg(F.sum("n_sentences").alias("n_sentences"))


def skip_done_files(docs: DataFrame, log: DataFrame, compat: bool = False) -> DataFrame:
    """Rows still to do of ``docs(file_no, row, …)`` under ``log(file_no, done_rows, batch_id)``.

    The log only grows: the newest row of a file tells how many of its rows are done; a file without one is still to do as a
    whole. ``compat`` processes the last done row again in the first file that is not finished, as the rule this
    replaces does.
    """
    newest = log.groupBy("file_no").agg(F.max_by("done_rows", F.struct("batch_id", "done_rows")).alias("done_rows"))
    marked = docs.join(newest, "file_no", "left").withColumn("done_rows", F.coalesce("done_rows", F.lit(0)))
    rest = marked.where(F.col("row") >= F.col("done_rows"))
    if compat:
        # One number; the files before it are done.
        first = rest.agg(F.min("file_no").alias("first"))
        again = marked.join(first, F.col("file_no") == F.col("first")).where((F.col("row") == F.col("done_rows") - 1)).drop("first")
        rest = rest.unionByName(again)
    return rest.select(docs.columns)


def skip_done(docs: DataFrame, done_rows: int, compat: bool = False) -> DataFrame:
    """Rows still to do when ``done_rows`` rows of the file are done.

    ``compat`` processes the last done row again, as the rule this replaces does.
    """
    first = max(done_rows - 1, 0) if compat else done_rows
    return docs.where(F.col("row") >= first)
