"""Tokenizers given as functions, with failures isolated row by row."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructType

from sentloom.constants import MAX_TOKENS, TOKENIZE_BATCH
from sentloom.operators.translate import OUTPUT_TYPE, deadline

#: Take a batch of sentences and return one sequence of ids for each, or the other way round.
Encode = Callable[[list[str]], Sequence[Sequence[int]]]
Decode = Callable[[list[list[int]]], Sequence[str]]


def isolated(
    call: Callable[[list], Sequence], items: list, convert: Callable[[object], object], deadline_s: float | None = None, on_error: str = "quarantine"
) -> tuple[list, list[str], list[str | None]]:
    """The results of ``call`` over a batch, with a status and an error for each item.

    A batch that raises, is late or returns the wrong number of results is halved, and so are its halves, until the guilty
    items stand alone; all others get their results.
    """
    out: list = [None] * len(items)
    status, errors = ["ok"] * len(items), [None] * len(items)
    todo = [(0, len(items))] if items else []
    while todo:
        a, b = todo.pop()
        try:
            with deadline(deadline_s):
                got = list(call(items[a:b]))
            if len(got) != b - a:
                raise ValueError(f"{len(got)} results for {b - a} items")
            out[a:b] = [convert(x) for x in got]
        except Exception as reason:
            if on_error == "fail":
                raise
            if b - a > 1:
                middle = (a + b) // 2
                todo += [(middle, b), (a, middle)]
            else:
                status[a] = "timeout" if isinstance(reason, TimeoutError) else "failed"
                errors[a] = f"{type(reason).__name__}: {reason}"
    return out, status, errors


def _ids(sequence: object) -> np.ndarray:
    ids = np.asarray(sequence)
    if ids.ndim != 1 or ids.size and ids.dtype.kind not in "iu":
        raise TypeError("a sequence of ids is expected")
    return ids.astype(np.int32)


def _text(value: object) -> str:
    if not isinstance(value, str):
        raise TypeError("a text is expected")
    return value


class CallableTokenizer:
    """A :class:`~sentloom.operators.tokens.Tokenizer` made of functions that take batches.

    ``load_encode`` and ``load_decode`` run once per task and return the functions, so that a model is loaded where it is
    used. Each call gets ``batch_size`` rows at most and has ``deadline_s`` seconds. With ``on_error='quarantine'`` rows that
    fail on their own are set aside: ``encode`` gives them ``token_status`` ``failed`` or ``timeout``, the error, null ids
    and their sentence in ``untokenized`` (see :func:`retokenizable`); ``decode`` gives them a null ``sentence``, which counts
    as one that did not arrive. ``on_error='fail'`` ends the job instead.
    """

    def __init__(
        self,
        load_encode: Callable[[], Encode],
        load_decode: Callable[[], Decode] | None = None,
        batch_size: int = TOKENIZE_BATCH,
        deadline_s: float | None = None,
        max_length: int | None = MAX_TOKENS,
        on_error: str = "quarantine",
    ):
        if on_error not in ("quarantine", "fail"):
            raise ValueError(f"on_error must be 'quarantine' or 'fail', not {on_error!r}")
        self.load_encode, self.load_decode = load_encode, load_decode
        self.batch_size, self.deadline_s, self.max_length, self.on_error = batch_size, deadline_s, max_length, on_error

    def _isolated(self, call: Encode | Decode, items: list, convert: Callable[[object], object]) -> tuple[list, list, list]:
        """:func:`isolated` in calls of ``batch_size`` items."""
        parts = [
            isolated(call, items[at : at + self.batch_size], convert, self.deadline_s, self.on_error)
            for at in range(0, len(items), self.batch_size)
        ]
        return tuple([x for part in parts for x in part[i]] for i in range(3))

    def encode(self, df: DataFrame) -> DataFrame:
        """Replace ``sentence`` by ``input_ids``, ``attention_mask``, ``truncated``, ``token_status``, ``token_error`` and
        ``untokenized``. A null sentence is an empty one."""
        passed = [f for f in df.schema.fields if f.name != "sentence"]
        names = [f.name for f in passed]
        load, longest, apart = self.load_encode, self.max_length, self._isolated

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            call = None
            for batch in stream:
                call = call or load()
                texts = [t or "" for t in batch["sentence"].to_pylist()]
                ids, status, errors = apart(call, texts, _ids)
                kept = [x if x is None or longest is None else x[:longest] for x in ids]
                columns = {
                    "input_ids": pa.array(kept, OUTPUT_TYPE),
                    "attention_mask": pa.array([None if x is None else np.ones(len(x), np.int32) for x in kept], OUTPUT_TYPE),
                    "truncated": pa.array([x is not None and longest is not None and len(x) > longest for x in ids], pa.bool_()),
                    "token_status": pa.array(status, pa.string()),
                    "token_error": pa.array(errors, pa.string()),
                    "untokenized": pa.array([t if x is None else None for t, x in zip(texts, ids, strict=True)], pa.string()),
                }
                yield pa.record_batch([*(batch[n] for n in names), *columns.values()], names=[*names, *columns])

        schema = StructType(passed)
        for name, kind in (("input_ids", ArrayType(IntegerType())), ("attention_mask", ArrayType(IntegerType())), ("truncated", BooleanType())):
            schema = schema.add(name, kind)
        for name in ("token_status", "token_error", "untokenized"):
            schema = schema.add(name, StringType())
        return df.mapInArrow(run, schema)

    def decode(self, df: DataFrame) -> DataFrame:
        """Replace ``output_ids`` by ``sentence``; null ids and rows that fail have a null one."""
        if self.load_decode is None:
            raise ValueError("this tokenizer has no load_decode")
        passed = [f for f in df.schema.fields if f.name not in ("output_ids", "sentence")]
        names = [f.name for f in passed]
        load, apart = self.load_decode, self._isolated

        def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            call = None
            for batch in stream:
                call = call or load()
                ids = batch["output_ids"].to_pylist()
                there = [i for i, x in enumerate(ids) if x is not None]
                texts: list[str | None] = [None] * len(ids)
                for i, text in zip(there, apart(call, [ids[i] for i in there], _text)[0], strict=True):
                    texts[i] = text
                yield pa.record_batch([*(batch[n] for n in names), pa.array(texts, pa.string())], names=[*names, "sentence"])

        return df.mapInArrow(run, StructType(passed).add("sentence", StringType()))


def retokenizable(tokens: DataFrame) -> DataFrame:
    """The rows that a tokenizer has set aside, as sentences that can be encoded again."""
    aside = tokens.where(F.col("token_status") != "ok").withColumn("sentence", F.col("untokenized"))
    return aside.drop("input_ids", "attention_mask", "truncated", "token_status", "token_error", "untokenized", "batch_id")
