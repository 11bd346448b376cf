"""Deterministic shards of a fixed number of sentences, in corpus order.

The ordinal of a sentence is the number of sentences before it. It is computed on three levels, so
that no task ever holds more than a bucket of documents: totals of buckets of consecutive rows,
summed in order inside each file; totals of files, summed in order over the files; and documents,
summed in order inside their bucket. The tables of the first two levels hold a few numbers per bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentloom.constants import BUCKET_ROWS, SHARD_SIZE, SHARDS_PER_FILE
from sentloom.functions.names import shard_base
from sentloom.operators.sentences import doc_meta
from sentloom.session import stage

NUMBERINGS = ("corpus", "file2500", "file_dense")
TAILS = ("flush", "drop")


def _before(window: Window, column: str) -> F.Column:
    """Sum of ``column`` over the rows that precede the current one."""
    preceding = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(preceding), F.lit(0))


def _bucket_offsets(counts: DataFrame, shard_size: int, numbering: str, tail: str) -> DataFrame:
    """Per bucket: sentences and documents before it, the total of its scope and its first shard."""
    totals = stage(
        counts.groupBy("file_no", "bucket").agg(
            F.sum("n_sentences").alias("bucket_sentences"),
            F.count("*").alias("bucket_docs"),
            F.max("row").alias("bucket_last"),
        ),
        "bucket-totals",
    )
    in_file = Window.partitionBy("file_no").orderBy("bucket")
    buckets = totals.withColumns(
        {
            "sentences_before": _before(in_file, "bucket_sentences"),
            "docs_before": _before(in_file, "bucket_docs"),
        }
    )
    # One row per corpus file from here on.
    over_files = Window.orderBy("file_no")
    everywhere = over_files.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    files = (
        totals.groupBy("file_no")
        .agg(
            F.sum("bucket_sentences").alias("file_sentences"),
            F.sum("bucket_docs").alias("file_docs"),
            (F.max("bucket_last") + 1).alias("file_rows"),
        )
        .withColumn("file_docs_before", _before(over_files, "file_docs"))
    )
    if numbering == "corpus":
        files = (
            files.withColumn("file_sentences_before", _before(over_files, "file_sentences"))
            .withColumn("scope_sentences", F.sum("file_sentences").over(everywhere))
            .withColumn("scope_rows", F.last("file_rows").over(everywhere))
            .withColumn("first_shard", F.lit(1).cast("long"))
        )
    else:
        rounding = F.ceil if tail == "flush" else F.floor
        files = (
            files.withColumn("file_sentences_before", F.lit(0).cast("long"))
            .withColumn("scope_sentences", F.col("file_sentences"))
            .withColumn("scope_rows", F.col("file_rows"))
            .withColumn("file_shards", rounding(F.col("file_sentences") / shard_size).cast("long"))
        )
        if numbering == "file2500":
            message = F.concat(
                F.lit("file "), F.col("file_no"), F.lit(" needs "), F.col("file_shards"),
                F.lit(f" shards, only {SHARDS_PER_FILE} numbers are reserved per file"),
            )
            first = F.when(F.col("file_shards") > SHARDS_PER_FILE, F.raise_error(message).cast("long")).otherwise(
                shard_base("file_no")
            )
        else:
            first = _before(over_files, "file_shards") + 1
        files = files.withColumn("first_shard", first).drop("file_shards")
    return buckets.join(files, "file_no").select(
        "file_no",
        "bucket",
        (F.col("file_sentences_before") + F.col("sentences_before")).alias("sentences_before"),
        (F.col("file_docs_before") + F.col("docs_before")).alias("docs_before"),
        "scope_sentences",
        "scope_rows",
        "first_shard",
    )


def locate(
    split: DataFrame,
    shard_size: int = SHARD_SIZE,
    numbering: str = "corpus",
    tail: str = "flush",
    bucket_rows: int = BUCKET_ROWS,
    earlier: tuple[int, int] = (0, 0),
) -> DataFrame:
    """Add to each document its ordinal, the ordinal of its first sentence and its shard scope.

    ``split`` is read for its counts at once, and for its rows when the result is used; stage it first
    when the split is expensive. The offsets, a few numbers per bucket, are staged, so that every use
    shares them and a file with too many shards is an error here. The documents move once, to their
    bucket. ``earlier`` holds the sentences and documents that came before this table, when a corpus
    arrives in pieces.
    """
    if numbering not in NUMBERINGS:
        raise ValueError(f"numbering must be one of {NUMBERINGS}, not {numbering!r}")
    if tail not in TAILS:
        raise ValueError(f"tail must be one of {TAILS}, not {tail!r}")
    bucketed = split.withColumn("bucket", F.floor(F.col("row") / bucket_rows).cast("long"))
    counts = bucketed.select("file_no", "bucket", "row", "n_sentences")
    offsets = stage(_bucket_offsets(counts, shard_size, numbering, tail), "offsets")
    in_bucket = Window.partitionBy("file_no", "bucket").orderBy("row")
    rounding = F.ceil if tail == "flush" else F.floor
    earlier_sentences, earlier_docs = earlier
    return (
        bucketed.withColumn("start", _before(in_bucket, "n_sentences"))
        .withColumn("ord", F.row_number().over(in_bucket) - 1)
        .join(offsets, ["file_no", "bucket"])
        .withColumn("start", F.col("start") + F.col("sentences_before") + earlier_sentences)
        .withColumn("ord", F.col("ord") + F.col("docs_before") + earlier_docs)
        .withColumn("scope_sentences", F.col("scope_sentences") + earlier_sentences)
        .withColumn("scope_shards", rounding(F.col("scope_sentences") / shard_size).cast("long"))
        .withColumn("shard_size", F.lit(shard_size).cast("long"))
        .drop("bucket", "sentences_before", "docs_before")
    )


def shard_sentences(located: DataFrame) -> DataFrame:
    """One row per sentence of a located document, with its shard and position in the shard."""
    ordinal = F.col("start") + F.col("sent_idx")
    size = F.col("shard_size")
    return (
        located.select(
            "file_no", "row", "id", "start", "shard_size", "scope_shards", "first_shard",
            F.posexplode("sentences").alias("sent_idx", "sentence"),
        )
        .withColumn("local_shard", F.floor(ordinal / size).cast("long"))
        .where(F.col("local_shard") < F.col("scope_shards"))
        .select(
            (F.col("first_shard") + F.col("local_shard")).alias("shard"),
            (ordinal - F.col("local_shard") * size).alias("pos"),
            "file_no",
            "row",
            "id",
            F.col("sent_idx").cast("long").alias("sent_idx"),
            "sentence",
        )
    )


def assign_shards(
    split: DataFrame,
    shard_size: int = SHARD_SIZE,
    numbering: str = "corpus",
    tail: str = "flush",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Consecutive chunks of ``shard_size`` sentences.

    ``numbering``: one sequence over the corpus from 1; a reserved range per file; or dense numbers,
    file after file. ``tail`` keeps or drops the last, unfilled shard of each sequence.
    """
    return shard_sentences(locate(split, shard_size, numbering, tail, bucket_rows))


def _doc_shards(located: DataFrame, *columns: str) -> DataFrame:
    """One row per document and shard it has a part in, or is listed in when it has no sentences."""
    size = F.col("shard_size")
    first = F.floor(F.col("start") / size)
    last = F.when(F.col("n_sentences") > 0, F.floor((F.col("start") + F.col("n_sentences") - 1) / size))
    return (
        located.withColumn("local_shard", F.explode(F.sequence(first, F.coalesce(last, first))))
        .where(F.col("local_shard") < F.col("scope_shards"))
        .select((F.col("first_shard") + F.col("local_shard")).alias("shard"), "local_shard", *columns)
    )


def shard_meta(located: DataFrame) -> DataFrame:
    """Metadata rows of each shard, in document order: ``shard, ord, file_no, row, id, has_text, meta``.

    A document cut by a boundary is listed in both shards; one without sentences in the shard that
    was open at its row.
    """
    return _doc_shards(
        located.withColumn("meta", doc_meta()).withColumn("has_text", F.col("n_sentences") > 0),
        "ord", "file_no", "row", "id", "has_text", "meta",
    ).drop("local_shard")


def shard_watermarks(located: DataFrame) -> DataFrame:
    """Rows of the file consumed when each shard was cut: ``shard, row``.

    A flushed, unfilled last shard has consumed the whole file.
    """
    filled = (F.col("local_shard") + 1) * F.col("shard_size") <= F.col("scope_sentences")
    reached = F.when(filled, F.col("row") + 1).otherwise(F.col("scope_rows"))
    return (
        _doc_shards(
            located.where(F.col("n_sentences") > 0), "ord", "row", "shard_size", "scope_sentences", "scope_rows"
        )
        .groupBy("shard")
        .agg(F.max_by(reached, "ord").alias("row"))
    )
