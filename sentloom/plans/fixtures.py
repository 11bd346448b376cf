"""Tables the registered queries share, derived from the given tables by the earlier jobs.

Each is written once per session and input folder and then scanned, so that a query measures its own
operator. Everything covers the whole of the given tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom.constants import FIRST_TOKEN_ID, PAD_ID, SHARDS_PER_FILE
from sentloom.functions.names import node_of
from sentloom.operators import tokens as tk
from sentloom.operators.batches import accepted, assign_batches
from sentloom.operators.callables import CallableTokenizer
from sentloom.operators.regroup import regroup
from sentloom.operators.sentences import split_documents
from sentloom.operators.shards import locate, shard_meta, shard_sentences, shard_watermarks
from sentloom.operators.translate import translate
from sentloom.operators.vocab import build_vocab
from sentloom.session import new_path, scratch, stage
from sentloom.sources.corpus import documents_as_corpus, spread
from sentloom.sources.payloads import nest_documents, nest_outputs, nest_tokens
from sentloom.sources.sinks import write_payloads, write_rows
from sentloom.streaming.prepare import prepare_stream

SHARD_SIZE = 1_000
BATCH_SIZE = 256
TOKENIZE_BATCH = 64
NODES = 4
FILES = 4
DEVICES = 8
SMALL_PAD = 20


def corpus(spark: SparkSession, sf_dir: str, files: int = 1) -> DataFrame:
    """The documents table as a corpus of ``files`` files."""
    columns = ("doc_id", "text", "lang", "source")
    return documents_as_corpus(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)), files)


def arrive(tokens: DataFrame, source: str) -> None:
    """Add token rows to the inbox ``source``, in files that hold whole shards.

    There are as many files as tasks run at once, whatever their size: a drain takes a fixed number of files per micro-batch,
    and each micro-batch has a cost of its own.
    """
    files = tokens.sparkSession.sparkContext.defaultParallelism
    tokens.repartition(files, "shard").write.mode("append").parquet(source)


def lexicon_of(vocab: DataFrame) -> DataFrame:
    """A lexicon over a vocabulary: two thirds of the tokens become their neighbour in rank."""
    token_id = F.col("token_id")
    neighbour = (token_id - FIRST_TOKEN_ID).bitwiseXOR(F.lit(1)) + FIRST_TOKEN_ID
    return vocab.where(token_id % 3 != 0).select(
        token_id.alias("src_id"), neighbour.cast("int").alias("tgt_id")
    )


def load_reversing():
    """A translator that returns the real tokens of each row in reverse."""
    return lambda ids, mask: [row[row != PAD_ID][::-1] for row in ids]


def load_faltering():
    """The same, but it fails on batches whose width is even."""

    def run(ids: np.ndarray, mask: np.ndarray) -> list[np.ndarray]:
        if ids.shape[1] % 2 == 0:
            raise RuntimeError("even width")
        return [row[row != PAD_ID][::-1] for row in ids]

    return run


def load_measuring():
    """A tokenizer that states the length of a sentence and its number of blanks."""
    return lambda texts: [[FIRST_TOKEN_ID + len(t) % 1000, FIRST_TOKEN_ID + t.count(" ")] for t in texts]


def load_refusing():
    """The same, but it fails on every batch that has an ñ in it."""
    measure = load_measuring()

    def run(texts: list[str]) -> list[list[int]]:
        if any("ñ" in t for t in texts):
            raise RuntimeError("refused")
        return measure(texts)

    return run


def load_spelling():
    return lambda sequences: [" ".join(map(str, ids)) for ids in sequences]


class Fixtures:
    """Derived tables of one input folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _kept(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Stage what ``build`` returns, without the tables that it stages on the way. Those of this class stay."""
        with scratch(self.spark):
            return stage(build(), name, new_path(self.spark, name, lasting=True))

    @cached_property
    def split(self) -> DataFrame:
        return self._kept("split", lambda: split_documents(corpus(self.spark, self.sf_dir)))

    @cached_property
    def split_files(self) -> DataFrame:
        return self._kept("split-files", lambda: split_documents(corpus(self.spark, self.sf_dir, FILES)))

    @cached_property
    def split_reserved(self) -> DataFrame:
        """The same in as many files as it takes for each to have the shards that are reserved for it."""
        files, reserved = FILES, SHARDS_PER_FILE * SHARD_SIZE
        counts = self.split_files.select(F.col("id").cast("long").alias("doc_id"), "n_sentences")
        documents = counts.count()

        def fullest(files: int) -> int:
            per_file = counts.groupBy(F.pmod("doc_id", F.lit(files))).agg(F.sum("n_sentences").alias("n"))
            return per_file.agg(F.max("n")).first()[0] or 0

        while files < documents and fullest(files) > reserved:
            files *= 2
        if files == FILES:
            return self.split_files
        return self._kept("split-files", lambda: split_documents(corpus(self.spark, self.sf_dir, files)))

    def located(self, numbering: str = "corpus", tail: str = "flush") -> DataFrame:
        split = {"corpus": "split", "file2500": "split_reserved"}.get(numbering, "split_files")
        split = getattr(self, split)
        return locate(split, SHARD_SIZE, numbering, tail, bucket_rows=128)

    @cached_property
    def sentences(self) -> DataFrame:
        return self._kept("sentences", lambda: shard_sentences(self.located()))

    @cached_property
    def meta(self) -> DataFrame:
        return self._kept("meta", lambda: shard_meta(self.located()))

    @cached_property
    def watermarks(self) -> DataFrame:
        return self._kept("watermarks", lambda: shard_watermarks(self.located()))

    @cached_property
    def vocab(self) -> DataFrame:
        return self._kept("vocab", lambda: build_vocab(self.sentences))

    @cached_property
    def tokens(self) -> DataFrame:
        """Token rows with entities kept aside, batched for tokenizing and routed to nodes."""

        def build() -> DataFrame:
            encoded = tk.encode(self.sentences.withColumn("entities", F.expr("map(id, sentence)")), self.vocab)
            return assign_batches(encoded, TOKENIZE_BATCH).withColumn("node", node_of("shard", NODES))

        return self._kept("tokens", build)

    @cached_property
    def lexicon(self) -> DataFrame:
        return self._kept("lexicon", lambda: lexicon_of(self.vocab))

    @cached_property
    def translated(self) -> DataFrame:
        """Every sentence, as one device divides every batch."""
        return self._kept("translated", lambda: translate(assign_batches(self.tokens, BATCH_SIZE), self.lexicon, max_pad=None))

    @cached_property
    def uneven(self) -> DataFrame:
        """The same on several devices, with the batches that do not divide among them set aside."""
        return self._kept(
            "uneven", lambda: translate(assign_batches(self.tokens, BATCH_SIZE), self.lexicon, max_pad=None, devices=DEVICES)
        )

    @cached_property
    def decoded(self) -> DataFrame:
        """The sentences on their way back, with the columns by which they are grouped."""
        placed = ("shard", "pos", "file_no", "row", "id", "sent_idx", "output_ids")
        return self._kept("decoded", lambda: tk.decode(accepted(self.translated).select(*placed), self.vocab))

    @cached_property
    def documents(self) -> DataFrame:
        return self._kept("documents", lambda: regroup(self.decoded, self.meta, "shard"))

    @cached_property
    def tokenized_root(self) -> str:
        root = new_path(self.spark, "json", lasting=True)
        write_payloads(nest_tokens(self.tokens, self.meta, self.watermarks, SHARD_SIZE), root, "tokenized", NODES)
        return root

    @cached_property
    def translated_root(self) -> str:
        root = new_path(self.spark, "json", lasting=True)
        write_payloads(nest_outputs(self.translated), root, "translated", NODES)
        return root

    @cached_property
    def merged_root(self) -> str:
        root = new_path(self.spark, "json", lasting=True)
        write_payloads(nest_documents(self.documents, self.watermarks), root, "output", NODES)
        return root

    @cached_property
    def corpus_root(self) -> str:
        """The documents as numbered Parquet files of a subset."""
        root = new_path(self.spark, "files", lasting=True)
        docs = corpus(self.spark, self.sf_dir, FILES)
        for number in range(FILES):
            name = f"{root}/data/whole/train-{number:05d}-of-{FILES:05d}.parquet"
            docs.where(F.col("file_no") == number).orderBy("row").drop("file_no", "row").coalesce(1).write.parquet(name)
        return root

    @cached_property
    def token_rows(self) -> str:
        path = new_path(self.spark, "token-rows", lasting=True)
        write_rows(self.tokens, path, NODES)
        return path

    @cached_property
    def streamed_root(self) -> str:
        """Output of a streamed prepare over a corpus of four files, two per micro-batch."""
        source, out, checkpoint = (new_path(self.spark, name, lasting=True) for name in ("corpus", "prepared", "checkpoint"))
        corpus(self.spark, self.sf_dir).drop("file_no", "row").coalesce(4).write.parquet(source)
        prepare_stream(self.spark, source, out, checkpoint, SHARD_SIZE, max_files=2)
        return out

    @cached_property
    def whole_root(self) -> str:
        """Whole documents, nested by the shard they begin in."""
        root = new_path(self.spark, "json", lasting=True)
        write_payloads(nest_documents(regroup(self.decoded, self.meta)), root, "output", NODES)
        return root

    @cached_property
    def refused(self) -> DataFrame:
        """Token rows of a tokenizer that refuses some sentences."""
        sentences = self.sentences.withColumn("entities", F.create_map().cast("map<string,string>"))
        return self._kept("refused", lambda: CallableTokenizer(load_refusing).encode(sentences))

    @cached_property
    def streamed_tokens_root(self) -> str:
        """Output of a streamed prepare with its tokens, a file per micro-batch."""
        source, out, checkpoint = (new_path(self.spark, name, lasting=True) for name in ("corpus", "prepared", "checkpoint"))
        corpus(self.spark, self.sf_dir).drop("file_no", "row").coalesce(3).write.parquet(source)
        prepare_stream(
            self.spark, source, out, checkpoint, SHARD_SIZE, max_files=1, tokenizer=CallableTokenizer(load_measuring),
            languages=("eng_Latn", "hin_Deva"), batch_size=TOKENIZE_BATCH,
        )
        return out

    def done_shards(self) -> DataFrame:
        """Shards with a finished output in the planning queries: all up to 7, then every third."""
        return self.sentences.select("shard").distinct().where("shard <= 7 or shard % 3 = 0")


_known: dict[tuple[str, str], Fixtures] = {}


def fixtures(spark: SparkSession, sf_dir: str) -> Fixtures:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _known:
        _known[key] = Fixtures(spark, sf_dir)
    return _known[key]
