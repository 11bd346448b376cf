"""Run a translator over padded batches, with failures set aside instead of lost."""

from __future__ import annotations

import signal
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from sentloom.constants import FIRST_TOKEN_ID, HOT_ROWS, MAX_PAD
from sentloom.functions.arrays import strip_special
from sentloom.operators.batches import pad_batches
from sentloom.operators.lookup import replace_elements

# Takes two-dimensional arrays of ids and mask, returns one sequence of ids per row.
Translator = Callable[[np.ndarray, np.ndarray], object]

OUTPUT_TYPE = pa.list_(pa.int32())


def translate_lexicon(labelled: DataFrame, lexicon: DataFrame, ship: bool | None = None) -> DataFrame:
    """Token-by-token translation through ``lexicon(src_id, tgt_id)``; unknown ids are copied.

    Rows whose ``status`` is not ``ok`` get no output and keep their ``input_ids``.
    """
    ok = F.col("status") == "ok"
    kept = labelled.withColumns(
        {"source_ids": F.when(ok, strip_special("input_ids")), "input_ids": F.when(~ok, F.col("input_ids"))}
    ).drop("attention_mask")
    done = replace_elements(
        kept, "source_ids", "output_ids", lexicon, "src_id", "tgt_id",
        hot=F.col("src_id") < FIRST_TOKEN_ID + HOT_ROWS, ship=ship, keep_source=False,
    )
    return done.withColumn("error", F.lit(None).cast("string"))


@contextmanager
def deadline(seconds: float | None) -> Iterator[None]:
    """Raise ``TimeoutError`` in the block after ``seconds``; needs the main thread of the worker."""
    if not seconds:
        yield
        return
    if threading.current_thread() is not threading.main_thread():
        raise RuntimeError("a deadline needs the main thread of the worker")

    def expire(signum: int, frame: object) -> None:
        raise TimeoutError(f"batch exceeded {seconds} s")

    previous = signal.signal(signal.SIGALRM, expire)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, previous)


def _translate_one(model: Translator, batch: pa.Table, deadline_s: float | None) -> pa.Array:
    rows = batch.num_rows
    ids, mask = (
        batch[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
        for name in ("input_ids", "attention_mask")
    )
    with deadline(deadline_s):
        outputs = [np.asarray(sequence, dtype=np.int32) for sequence in model(ids, mask)]
    if len(outputs) != rows:
        raise ValueError(f"translator returned {len(outputs)} sequences for {rows} rows")
    return pa.array(outputs, OUTPUT_TYPE)


def _kept_ids(batch: pa.Table, status: str) -> pa.Array:
    """The ids of the rows of a batch that was set aside, without padding; nulls where it succeeded."""
    if status == "ok":
        return pa.nulls(batch.num_rows, OUTPUT_TYPE)
    ids, mask = (batch[name].combine_chunks().to_pylist() for name in ("input_ids", "attention_mask"))
    kept = [None if i is None else i if m is None else [x for x, on in zip(i, m, strict=True) if on] for i, m in zip(ids, mask, strict=True)]
    return pa.array(kept, OUTPUT_TYPE)


def replayable(translated: DataFrame) -> DataFrame:
    """The rows that were set aside as token rows, ready to be batched and translated again."""
    aside = translated.where((F.col("status") != "ok") & F.col("input_ids").isNotNull())
    mask = F.transform("input_ids", lambda _: F.lit(1))
    return aside.drop("status", "output_ids", "error", "batch_id").withColumn("attention_mask", mask)


def _whole_batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Cut a sorted stream of record batches into one table per ``(shard, batch_id)``."""
    carried: pa.Table | None = None
    for part in stream:
        table = pa.Table.from_batches([part])
        table = table if carried is None else pa.concat_tables([carried, table])
        keys = [table[name].to_numpy() for name in ("shard", "batch_id")]
        cuts = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])) + 1
        edges = [0, *cuts.tolist()]
        for begin, end in zip(edges, edges[1:], strict=False):
            yield table.slice(begin, end - begin)
        carried = table.slice(edges[-1])
    if carried is not None and carried.num_rows:
        yield carried


def translate_batches(
    labelled: DataFrame,
    load: Callable[[], Translator],
    deadline_s: float | None = None,
    on_error: str = "quarantine",
) -> DataFrame:
    """Apply a translator to each batch of :func:`pad_batches`.

    ``load`` runs once per task and returns the translator. A batch that raises, returns the wrong
    number of sequences or exceeds ``deadline_s`` gets ``status`` ``failed`` or ``timeout`` with the
    error text, or ends the job with ``on_error='fail'``. Rows that are not ``ok`` keep their unpadded
    ``input_ids``, so that :func:`replayable` can send them again. The frame must come straight from
    ``pad_batches``, whose window keeps each batch whole in one partition; only a local sort is added.
    """
    if on_error not in ("quarantine", "fail"):
        raise ValueError(f"on_error must be 'quarantine' or 'fail', not {on_error!r}")
    passed = [f for f in labelled.schema.fields if f.name not in ("input_ids", "attention_mask", "status")]
    names = [f.name for f in passed]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Translator | None = None
        for batch in _whole_batches(stream):
            rows = batch.num_rows
            status, error, outputs = batch["status"][0].as_py(), None, pa.nulls(rows, OUTPUT_TYPE)
            if status == "ok":
                model = model or load()
                try:
                    outputs = _translate_one(model, batch, deadline_s)
                except Exception as reason:
                    if on_error == "fail":
                        raise
                    status = "timeout" if isinstance(reason, TimeoutError) else "failed"
                    error = f"{type(reason).__name__}: {reason}"
            result = batch.select(names).append_column("input_ids", _kept_ids(batch, status))
            result = result.append_column("status", pa.array([status] * rows, pa.string()))
            result = result.append_column("output_ids", outputs)
            result = result.append_column("error", pa.array([error] * rows, pa.string()))
            yield from result.combine_chunks().to_batches()

    schema = labelled.select(*names).schema.add("input_ids", ArrayType(IntegerType())).add("status", StringType())
    schema = schema.add("output_ids", ArrayType(IntegerType())).add("error", StringType())
    return labelled.sortWithinPartitions("shard", "batch_id", "pos").mapInArrow(run, schema)


def translate(
    batched: DataFrame,
    translator: DataFrame | Callable[[], Translator],
    max_pad: int | None = MAX_PAD,
    devices: int = 1,
    deadline_s: float | None = None,
    on_error: str = "quarantine",
) -> DataFrame:
    """Pad, reject and translate batches; ``status`` tells ``ok`` rows from quarantined ones.

    ``translator`` is a lexicon frame or a function that loads a callable in the worker.
    """
    labelled = pad_batches(batched, max_pad, devices)
    if isinstance(translator, DataFrame):
        return translate_lexicon(labelled, translator)
    return translate_batches(labelled, translator, deadline_s, on_error)
