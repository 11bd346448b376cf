"""Prepare a corpus that arrives file by file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sentloom.constants import SHARD_SIZE, TOKENIZE_BATCH
from sentloom.operators import tokens as tk
from sentloom.operators.batches import assign_batches
from sentloom.operators.sentences import split_documents
from sentloom.operators.shards import locate, shard_meta, shard_sentences
from sentloom.operators.tokens import Tokenizer
from sentloom.session import stage
from sentloom.sources.corpus import read_corpus
from sentloom.sources.schemas import PROGRESS
from sentloom.sources.shards import progress


def _reached(spark: SparkSession, out: str, batch_id: int) -> dict[str, int]:
    """Running counts before a micro-batch. A replayed one sees what its first attempt saw."""
    before = progress(spark, out).where(F.col("batch_id") < batch_id)
    counts = ("file_no", "row", "sentences")
    row = before.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counts]).first()
    return {c: row[c] for c in counts}


def _begun(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a stream has started with this checkpoint."""
    try:
        return not spark.read.text(f"{checkpoint}/metadata").isEmpty()
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise
        return False


def _file_numbers(batch: DataFrame, earlier: int) -> DataFrame:
    """Number the files of one micro-batch in name order; one row per file."""
    files = batch.select("file_path_read").distinct()
    return files.withColumn(
        "file_no", F.row_number().over(Window.orderBy("file_path_read")).cast("long") - 1 + earlier
    )


def prepare_stream(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    shard_size: int = SHARD_SIZE,
    max_files: int | None = None,
    dedup: bool = False,
    tokenizer: Tokenizer | None = None,
    languages: tuple[str, str] | None = None,
    batch_size: int = TOKENIZE_BATCH,
) -> StreamingQuery:
    """Cut the sentences of all files that have arrived into shards numbered from 1, then stop.

    Files count in order of arrival. The only state carried over is one row of running counts, written
    with the output, so a shard may begin in one micro-batch and fill in a later one. Every write is
    keyed by the micro-batch and overwrites itself, so a replay after a failure changes nothing.
    Written under ``out``: ``sentences``, ``meta``, the log ``files`` and the audit table ``progress``, and with a
    ``tokenizer`` and the ``languages`` (source and target) also ``tokens``, as the batch job has them: the tokenizer is given, as
    a vocabulary of the corpus is not known before its end. A new checkpoint over an ``out``
    that holds output is refused, as its batches would take the place of earlier ones.
    """
    if (tokenizer is None) != (languages is None):
        raise ValueError("a tokenizer needs the languages, and the languages a tokenizer")
    if not _begun(spark, checkpoint) and not progress(spark, out).isEmpty():
        raise ValueError(f"{out} holds the output of another checkpoint than {checkpoint}")

    def run(batch: DataFrame, batch_id: int) -> None:
        reached = _reached(spark, out, batch_id)
        # A row per file of this micro-batch; by a shuffle on the path all rows of a file would meet in one task.
        numbers = F.broadcast(_file_numbers(batch, reached["file_no"]))
        # Dealt anew, as a file may come in few row groups, each of which one task would split.
        tasks = max(spark.sparkContext.defaultParallelism * 4, batch.rdd.getNumPartitions())
        numbered = batch.repartition(tasks).join(numbers, "file_path_read").drop("file_path_read")
        split = stage(split_documents(numbered, dedup=dedup), "split")
        located = locate(split, shard_size, earlier=(reached["sentences"], reached["row"]))
        key = f"batch_id={batch_id}"
        shard_sentences(located).write.mode("overwrite").parquet(f"{out}/sentences/{key}")
        if tokenizer is not None:
            written = spark.read.parquet(f"{out}/sentences/{key}")
            tagged = tk.tag_language(tk.mask_entities(written), *languages)
            assign_batches(tokenizer.encode(tagged), batch_size).write.mode("overwrite").parquet(f"{out}/tokens/stream_{key}")
        shard_meta(located).write.mode("overwrite").parquet(f"{out}/meta/{key}")
        # Files are numbered as they arrive, so a file is in one micro-batch only.
        done = split.groupBy("file_no").agg(F.count("*").alias("done_rows"), F.sum("n_sentences").alias("sentences"))
        done.join(numbers, "file_no").select("file_no", F.col("file_path_read").alias("file_path"), "done_rows", "sentences").write.mode(
            "overwrite"
        ).parquet(f"{out}/files/{key}")
        # Last, so that the counts only cover what is written.
        counts = split.agg(
            F.countDistinct("file_no").alias("files"),
            F.count("*").alias("rows"),
            F.coalesce(F.sum("n_sentences"), F.lit(0)).alias("sentences"),
        ).first()
        total = reached["sentences"] + counts["sentences"]
        row = (
            batch_id, reached["file_no"] + counts["files"], reached["row"] + counts["rows"], total,
            total // shard_size + 1,
        )
        spark.createDataFrame([row], PROGRESS).coalesce(1).drop("batch_id").write.mode("overwrite").parquet(
            f"{out}/progress/{key}"
        )

    stream = read_corpus(spark, source, streaming=True, max_files=max_files)
    query = (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def filled_tokens(spark: SparkSession, out: str, finished: bool = False) -> DataFrame:
    """Token rows of the shards that are full; with ``finished``, of the open one too."""
    return filled_sentences(spark, out, finished, "tokens")


def filled_sentences(spark: SparkSession, out: str, finished: bool = False, kind: str = "sentences") -> DataFrame:
    """Rows of the shards that are full; with ``finished``, of the open one too.

    A micro-batch counts through its record in ``progress``, written last: what a failed one has left behind is not seen.
    """
    log = progress(spark, out)
    committed = log.select(F.col("batch_id").cast("long").alias("batch_id"))
    key = "stream_batch_id" if kind == "tokens" else "batch_id"  # token rows have a batch_id of their own
    rows = spark.read.parquet(f"{out}/{kind}").withColumn(key, F.col(key).cast("long"))
    rows = rows.join(committed.withColumnRenamed("batch_id", key), key, "left_semi").drop(key)
    if finished:
        return rows
    still_open = log.agg(F.coalesce(F.max("shard"), F.lit(1)).alias("shard")).first()["shard"]
    return rows.where(F.col("shard") < still_open)


def file_progress(spark: SparkSession, out: str) -> DataFrame:
    """``batch_id, file_no, file_path, done_rows, sentences`` of the files that committed micro-batches have read."""
    committed = progress(spark, out).select(F.col("batch_id").cast("long").alias("batch_id"))
    if committed.isEmpty():
        return spark.createDataFrame([], "batch_id long, file_no long, file_path string, done_rows long, sentences long")
    log = spark.read.parquet(f"{out}/files").withColumn("batch_id", F.col("batch_id").cast("long"))
    return log.join(committed, "batch_id", "left_semi")
