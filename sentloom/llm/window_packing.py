"""Packing documents into fixed windows with a bounded number of open ones.

Each task keeps ``open_windows`` windows. A document is cut into full windows first; what remains goes to the
window that it fits best. When none fits and all places are taken, the fullest window is completed with the head
of the document (unless that head would be shorter than ``min_piece``) and emitted. At its end a task hands over its
open windows, and they are packed by the same rule in groups of ``FAN_IN`` tasks, level by level, until one group
is left, whose windows are filled one after another. Only open windows move, so a level moves at most
``open_windows`` windows a task; no text is shuffled.

Defined results: a null or empty text is one piece of the end id; null and repeated ``doc_id`` values stay as they
are, each row being a document of its own; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentloom.llm.encoding import encoder
from sentloom.llm.worker import lean, small_batches
from sentloom.session import stage

FAN_IN = 16
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "ids binary, open boolean, task long"
)
COLUMNS = [x.split()[0] for x in SCHEMA.split(", ")]
FIELDS = pa.schema(
    [(c, pa.bool_() if c == "open" else pa.binary() if c == "ids" else pa.int64()) for c in COLUMNS]
)


class Packer:
    """Windows of one task. A piece is ``(doc_id, start, ids as bytes, tokens of its document)``."""

    def __init__(self, size: int, places: int, min_piece: int, first_id: int, keep_ids: bool):
        self.size, self.places, self.min_piece, self.keep_ids = size, places, min_piece, keep_ids
        self.next_id, self.windows, self.rows = first_id, [], []

    def emit(self, pieces: list[tuple], open_: bool) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            kept = ids if open_ or self.keep_ids else None
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset, kept, open_, 0))
            offset += n
        self.next_id += 1

    def add(self, doc, start: int, ids: bytes, total: int) -> None:
        size = self.size
        while len(ids) >= 4 * size:
            self.emit([(doc, start, ids[: 4 * size], total)], False)
            ids, start = ids[4 * size :], start + size
        while ids:
            n, best, fullest = len(ids) // 4, None, None
            for w in self.windows:
                if w[0] >= n and (best is None or w[0] < best[0]):
                    best = w
                if fullest is None or w[0] < fullest[0]:
                    fullest = w
            if best is None and len(self.windows) < self.places:
                best = [size, []]
                self.windows.append(best)
            if best is not None:
                best[1].append((doc, start, ids, total))
                best[0] -= n
                if not best[0]:
                    self.windows.remove(best)
                    self.emit(best[1], False)
                return
            self.windows.remove(fullest)
            free = fullest[0]
            if free >= self.min_piece:
                fullest[1].append((doc, start, ids[: 4 * free], total))
                ids, start = ids[4 * free :], start + free
            self.emit(fullest[1], False)

    def hand_over(self) -> None:
        for _, pieces in self.windows:
            self.emit(pieces, True)
        self.windows = []

    def fill_up(self) -> None:
        """Close the windows that are left, filling each before the next one."""
        pieces = [p for w in sorted(self.windows, key=lambda w: w[0]) for p in w[1]]
        self.windows, now, free = [], [], self.size
        for doc, start, ids, total in pieces:
            while ids:
                head = ids[: 4 * free]
                now.append((doc, start, head, total))
                ids, start, free = ids[len(head) :], start + len(head) // 4, free - len(head) // 4
                if not free:
                    self.emit(now, False)
                    now, free = [], self.size
        if now:
            self.emit(now, False)

    def take(self, task: int) -> list[list]:
        rows, self.rows = self.rows, []
        return [list(c) for c in zip(*(r[:9] + (task,) for r in rows), strict=True)] or [[] for _ in COLUMNS]


def _first_id(level: int, task: int) -> int:
    return level << 56 | task << 26


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    size: int = 2048,
    end_id: int = 1,
    open_windows: int = 16,
    min_piece: int = 16,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` with their place in sequences; ``keep_ids`` adds their ids as bytes."""
    end = struct.pack("<I", end_id)

    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encode = TaskContext.get().partitionId(), encoder(tokenizer).encode_all
        packer = Packer(size, open_windows, min_piece, _first_id(0, task), keep_ids)
        for batch in batches:
            texts = (text.as_py() or "" for text in batch["text"])
            for doc, encoded in zip(batch["doc_id"].to_pylist(), encode(texts), strict=True):
                ids = encoded + end
                packer.add(doc, 0, ids, len(ids) // 4)
                if len(packer.rows) >= 10_000:
                    yield pa.record_batch(packer.take(task), schema=FIELDS)
        packer.hand_over()
        yield pa.record_batch(packer.take(task), schema=FIELDS)

    def merger(level: int, last: bool):
        def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            packer = Packer(size, open_windows, min_piece, _first_id(level, int(key[0])), keep_ids)
            group = group.sort_values(["length", "task", "sequence_id", "offset"], ascending=[False, True, True, True])
            docs = group["doc_id"].astype(object).where(group["doc_id"].notna(), None)
            for doc, start, ids, total in zip(
                docs, group["start"], group["ids"], group["doc_tokens"], strict=True
            ):
                packer.add(None if doc is None else int(doc), int(start), bytes(ids), int(total))
            (packer.fill_up if last else packer.hand_over)()
            return pa.table(packer.take(int(key[0])), schema=FIELDS).to_pandas(integer_object_nulls=True)

        return merge

    documents = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        made = stage(documents.mapInArrow(lean(pack_task), SCHEMA), "packed")
    closed, level = made.filter("NOT open"), 0
    groups = made.agg(F.max("task")).first()[0]
    groups = 0 if groups is None else groups + 1
    while groups:
        level, last, groups = level + 1, groups <= FAN_IN, -(-groups // FAN_IN)
        merged = (
            made.filter("open")
            .withColumn("group", F.floor(F.col("task") / FAN_IN))
            .groupBy("group")
            .applyInPandas(merger(level, last), SCHEMA)
        )
        if last:
            closed = closed.unionByName(merged)
            break
        made = stage(merged, "packed")
        closed = closed.unionByName(made.filter("NOT open"))
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return closed.select(*kept, *["ids"] * keep_ids)


def sequences(pieces: DataFrame, *, size: int = 2048, pad_id: int = 0) -> DataFrame:
    """Windows as arrays: ids padded to ``size`` and, for each position, the piece it belongs to (0: padding).

    ``pieces`` comes from ``pack(..., keep_ids=True)``.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = [], []
            for pieces_ in batch["pieces"].to_pylist():
                at, row, part = 0, np.full(size, pad_id, np.int32), np.zeros(size, np.int32)
                for k, piece in enumerate(sorted(pieces_, key=lambda p: p["offset"]), 1):
                    values = np.frombuffer(piece["ids"], "<u4")
                    row[at : at + len(values)], part[at : at + len(values)] = values, k
                    at += len(values)
                ids.append(row)
                parts.append(part)
            yield pa.record_batch(
                {
                    "sequence_id": batch["sequence_id"],
                    "input_ids": pa.array(ids, pa.list_(pa.int32())),
                    "piece": pa.array(parts, pa.list_(pa.int32())),
                }
            )

    return (
        pieces.groupBy("sequence_id")
        .agg(F.collect_list(F.struct("offset", "ids")).alias("pieces"))
        .mapInArrow(build, "sequence_id long, input_ids array<int>, piece array<int>")
    )
