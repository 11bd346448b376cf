"""Token ids as directly addressable codes.

An id is cut into chunks of ``CHUNK_BITS`` bits, lowest first. Level 0 holds the first chunk of every id, level 1
the second chunk of those that have one, and so on. A bitmap at each level says which ids go on, and a rank
directory over the bitmap turns a position at one level into the position at the next one, so the id at any
position is read in as many steps as it has chunks, without decoding its neighbours.

``write_token_codes`` sorts documents by ``doc_id`` over all tasks, encodes them where they end up, and writes one
binary file for every ``segment_tokens`` ids. A file has a header, its documents with their first positions, and the
levels. The files go through Spark's writer, so they are committed like any other output and can lie in any store.

Defined results: a null or empty text is a document of the end id alone; a null ``doc_id`` sorts first and stays
null; equal ids keep the order of the scan; repeated rows stay; an empty table gives no document; other columns are
ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentloom.llm.encoding import encoder
from sentloom.session import new_path, stage

CHUNK_BITS = 8
RANK_BITS = 512
#: Magic, place of the task, place in the task, documents, ids, levels.
HEADER = "<4sqqqqq"
LEVEL = "<qqq"
MAGIC = b"DAC1"


def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, packed continuation bits and ones before each block of ``RANK_BITS``, level by level."""
    levels, values = [], ids.astype(np.uint32)
    while True:
        rest = values >> CHUNK_BITS
        goes_on = rest > 0
        padded = np.zeros(-(-len(values) // RANK_BITS) * RANK_BITS, dtype=bool)
        padded[: len(values)] = goes_on
        ones = padded.reshape(-1, RANK_BITS).sum(axis=1, dtype=np.int64)
        ranks = np.concatenate([np.zeros(1, np.int64), np.cumsum(ones)[:-1]])[: len(ones)].astype("<u4")
        levels.append((values.astype(np.uint8), np.packbits(padded, bitorder="little"), ranks))
        if not goes_on.any():
            return levels
        values = rest[goes_on]


class CodeFile:
    """One binary file: its documents, random access to an id, and a whole decode."""

    def __init__(self, content: bytes):
        magic, self.task, self.place, self.n_docs, self.n_ids, n_levels = struct.unpack_from(HEADER, content)
        if magic != MAGIC:
            raise ValueError("not a token code file")
        at = struct.calcsize(HEADER)

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(content, dtype, n, at)
            at += out.nbytes
            return out

        self.known = take("<u1", self.n_docs)
        self.doc_ids = take("<i8", self.n_docs)
        self.bounds = take("<i8", self.n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            sizes = struct.unpack_from(LEVEL, content, at)
            at += struct.calcsize(LEVEL)
            self.levels.append(tuple(take(t, n) for t, n in zip(("<u1", "<u1", "<u4"), sizes, strict=True)))

    def __getitem__(self, i: int) -> int:
        """The id at position ``i`` of the file; reads one chunk, one bit and one rank a level."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        out = 0
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out |= int(chunks[i]) << (CHUNK_BITS * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            first = block * RANK_BITS // 8
            before = int(np.bitwise_count(bits[first : i >> 3]).sum())
            i = int(ranks[block]) + before + int(bits[i >> 3] & ((1 << (i & 7)) - 1)).bit_count()
        return out

    def decode(self) -> np.ndarray:
        values = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            goes_on = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            out = chunks.astype(np.uint32)
            out[goes_on] |= values << CHUNK_BITS
            values = out
        return values

    @staticmethod
    def pack(task: int, place: int, docs: list[int | None], bounds: list[int], ids: np.ndarray) -> bytes:
        levels = encode_levels(ids)
        parts = [
            struct.pack(HEADER, MAGIC, task, place, len(docs), len(ids), len(levels)),
            np.array([d is not None for d in docs], "<u1").tobytes(),
            np.array([d or 0 for d in docs], "<i8").tobytes(),
            np.array(bounds, "<i8").tobytes(),
        ]
        for level in levels:
            parts.append(struct.pack(LEVEL, *map(len, level)))
            parts += [x.tobytes() for x in level]
        return b"".join(parts)


def write_token_codes(
    docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 1, segment_tokens: int = 4_000_000
) -> None:
    """Write the ids of ``docs(doc_id, text)`` in ascending ``doc_id`` order to binary files under ``path``."""
    end = struct.pack("<I", end_id)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, place = encoder(tokenizer).encode_all, TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        bounds, ids = [0], []

        def close() -> pa.RecordBatch:
            whole = np.frombuffer(b"".join(ids), "<u4")
            return pa.record_batch({"content": [CodeFile.pack(task, place, names, bounds, whole)]})

        for batch in batches:
            texts = (text.as_py() or "" for text in batch["text"])
            for name, encoded in zip(batch["doc_id"].to_pylist(), encode(texts), strict=True):
                names.append(name)
                ids.append(encoded + end)
                bounds.append(bounds[-1] + len(ids[-1]) // 4)
                if bounds[-1] >= segment_tokens:
                    yield close()
                    place += 1
                    names, bounds, ids = [], [0], []
        if names:
            yield close()

    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "row")
        .sortWithinPartitions("doc_id", "row")
        .select("doc_id", "text")
        .mapInArrow(segments, "content binary")
        .select(F.col("content").cast("string"))
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )


def read_token_codes(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of the files: ``doc_id, start, n_tokens, ids_crc32`` and where it lies."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                raw = content.as_py()
                if not raw:
                    continue
                file = CodeFile(raw)
                ids, bounds = file.decode().astype("<u4"), file.bounds
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                n = file.n_docs
                yield pa.record_batch(
                    {
                        "doc_id": pa.array(file.doc_ids, mask=file.known == 0),
                        "in_file": pa.array(bounds[:-1]),
                        "n_tokens": pa.array(np.diff(bounds)),
                        "ids_crc32": pa.array(crc, pa.int64()),
                        "task": pa.array(np.full(n, file.task)),
                        "place": pa.array(np.full(n, file.place)),
                    }
                )

    rows = stage(
        spark.read.format("binaryFile")
        .load(path)
        .select("content")
        .mapInArrow(
            documents, "doc_id long, in_file long, n_tokens long, ids_crc32 long, task long, place long"
        ),
        "token-code-rows",
    )
    # One row per file.
    files = rows.groupBy("task", "place").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("task", "place").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("task", "place", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("file_start"))
    return rows.join(files, ["task", "place"]).select(
        "doc_id",
        (F.col("file_start") + F.col("in_file")).alias("start"),
        "n_tokens",
        "ids_crc32",
        F.col("task").alias("file_task"),
        F.col("place").alias("file_place"),
        "in_file",
    )


def token_codes(docs: DataFrame, tokenizer: str, *, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write the files and read the documents back from them."""
    path = path or new_path(docs.sparkSession, "token-codes")
    write_token_codes(docs, path, tokenizer, end_id=end_id)
    return read_token_codes(docs.sparkSession, path)
