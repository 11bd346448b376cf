"""Replace the elements of an array column through a lookup table.

A table of checked, bounded size is shipped to the tasks and applied to whole Arrow batches, so rows
are neither exploded nor shuffled. Of a larger table, the hot part, bounded by construction, is shipped
in the same way. The elements it lacks are joined with the rest of the table, each different one once per chunk of
consecutive rows. What is found is shipped as well if it is within the bound; beyond that it goes back to its chunk, and only
the rows that lack something move, once, to meet it. All ways give the same result for any rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentloom.constants import BROADCAST_BYTES, BROADCAST_ROWS
from sentloom.session import stage

#: Columns of a row while its elements are looked up: what the hot part gives, the elements it lacks in their order, and the chunk of the row.
FOUND, MISSES, CHUNK = "_lookup_found", "_lookup_misses", "_lookup_chunk"
#: A chunk has two to this power of rows, which one task holds at a time.
CHUNK_BITS = 12

_ARROW_TYPES = {T.StringType(): pa.string(), T.IntegerType(): pa.int32(), T.LongType(): pa.int64()}


def table_size(table: DataFrame, key: str, value: str) -> tuple[int, int]:
    """Rows and bytes of a lookup table."""
    width = F.octet_length(F.col(key).cast("string")) + F.octet_length(F.col(value).cast("string"))
    size = table.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return size["n"], size["bytes"]


def fits_broadcast(table: DataFrame, key: str, value: str) -> bool:
    rows, size = table_size(table, key, value)
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def _ship(table: DataFrame) -> Broadcast:
    return table.sparkSession.sparkContext.broadcast([table.select("key", "value").toArrow()])


def _objects(column: pa.Array | pa.ChunkedArray) -> list:
    """The values of a column; through an array of objects, which takes a small part of the time of a value after the other."""
    return column.to_pylist() if column.null_count else _one(column).to_numpy(zero_copy_only=False).tolist()


def _entries(table: pa.Table) -> dict:
    return dict(zip(*(_objects(table[name]) for name in ("key", "value")), strict=True))


def _table(entries: Broadcast) -> dict:
    holder = entries.value
    if len(holder) == 1:
        # Built once per worker process, which keeps the broadcast value between tasks.
        holder.append(_entries(holder[0]))
    return holder[1]


def _looked_up(table: dict, elements: pa.Array, kind: pa.DataType, missing: str, default: object) -> pa.Array:
    """The entries of the elements. Each different one is looked up once; a null stays null."""
    encoded = elements.dictionary_encode()
    keys = _objects(encoded.dictionary)
    return pa.array(list(map(table.get, keys, keys if missing == "copy" else repeat(default))), kind).take(encoded.indices)


def _one(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.Array):
        return column
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _lengths(arrays: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False)


def _as_lists(arrays: pa.Array, lengths: np.ndarray, flat: pa.Array) -> pa.Array:
    """``flat`` cut as ``arrays`` are, with their nulls."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, flat, mask=arrays.is_null() if arrays.null_count else None)


def _lists(entries: Broadcast, kind: T.DataType, missing: str, default: object = None) -> Callable[[pa.Array], pa.Array]:
    """A function that replaces the elements of lists.

    ``missing`` is ``default``, ``copy`` or ``null``: what becomes of an element without an entry.
    """
    arrow_type = _ARROW_TYPES[kind]

    def replace(arrays: pa.Array) -> pa.Array:
        return _as_lists(arrays, _lengths(arrays), _looked_up(_table(entries), arrays.flatten(), arrow_type, missing, default))

    return replace


def _shipped(entries: Broadcast, kind: T.DataType, missing: str, default: object = None) -> Callable[[Column], Column]:
    """The same as a function of an array column."""
    look_up = _lists(entries, kind, missing, default)

    @F.arrow_udf(T.ArrayType(kind))
    def replace(arrays: pa.Array) -> pa.Array:
        return look_up(arrays)

    return replace


def _begun(entries: Broadcast, key_kind: T.DataType, kind: T.DataType) -> Callable[[Column], Column]:
    """A function that looks the elements of an array column up in the hot part: the values, and the elements where these are null."""
    look_up = _lists(entries, kind, "null")

    @F.arrow_udf(T.StructType([T.StructField("value", T.ArrayType(kind)), T.StructField("misses", T.ArrayType(key_kind))]))
    def begin(arrays: pa.Array) -> pa.Array:
        values = look_up(arrays)
        row = np.repeat(np.arange(len(arrays)), _lengths(arrays))
        missing = np.flatnonzero(values.flatten().is_null().to_numpy(zero_copy_only=False))
        ends = np.cumsum(np.bincount(row[missing], minlength=len(arrays)))
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        misses = pa.ListArray.from_arrays(offsets, arrays.flatten().take(pa.array(missing)))
        return pa.StructArray.from_arrays([values, misses], ["value", "misses"])

    return begin


def _patched(values: pa.Array, misses: pa.Array, table: dict, missing: str, default: object) -> pa.Array:
    """The lists ``values`` with the elements where they are null looked up in ``table``; a null element stays null."""
    flat = values.flatten()
    new = _looked_up(table, misses.flatten(), flat.type, missing, default)
    return _as_lists(values, _lengths(values), pc.replace_with_mask(flat, flat.is_null(), new))


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different misses of each chunk in a batch."""
    for batch in batches:
        misses = batch["misses"]
        chunks = np.repeat(batch["chunk"].to_numpy(), _lengths(misses))
        pairs = pa.table({"chunk": chunks, "key": misses.flatten()}).drop_null()
        yield from pairs.group_by(["chunk", "key"]).aggregate([]).combine_chunks().to_batches()


def _few(found: DataFrame) -> bool:
    """Whether the different entries that were found are within the bound; counted only where an estimate leaves that open."""
    if found.agg(F.approx_count_distinct("key")).first()[0] > 1.5 * BROADCAST_ROWS:
        return False
    return fits_broadcast(found.select("key", "value").distinct(), "key", "value")


def _joined(
    df: DataFrame, source: str, target: str, hot: DataFrame, cold: DataFrame, kind: T.DataType,
    missing: str, default: object, ship_found: bool | None, keep_source: bool,
) -> DataFrame:
    others = [c for c in df.columns if c != target and (keep_source or c != source)]
    key_kind = df.schema[source].dataType.elementType
    # Staged, because the rows are read several times below and their numbers must not change.
    begun = stage(
        df.withColumn(FOUND, _begun(_ship(hot), key_kind, kind)(F.col(source))).select(
            *others,
            F.col(FOUND)["value"].alias(target),
            F.col(FOUND)["misses"].alias(MISSES),
            # The rows of a chunk come from one task, where the numbers are consecutive.
            F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS).alias(CHUNK),
        ),
        "lookup",
    )
    open_ = F.coalesce(F.size(MISSES), F.lit(0)) > 0
    keys = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("key", key_kind)])
    wanted = begun.where(open_).select(F.col(CHUNK).alias("chunk"), F.col(MISSES).alias("misses")).mapInArrow(_different, keys)
    # Neither side has a bound, so none is shipped to all tasks, however small its files are. A key is there once per chunk.
    found = stage(wanted.join(cold.hint("merge"), "key").select("chunk", "key", "value"), "found")
    if _few(found) if ship_found is None else ship_found:
        shipped = _ship(found.select("key", "value").distinct())

        @F.arrow_udf(T.ArrayType(kind))
        def patch(values: pa.Array, misses: pa.Array) -> pa.Array:
            return _patched(values, misses, _table(shipped), missing, default)

        return begun.select(*others, patch(F.col(target), F.col(MISSES)).alias(target))

    def complete(rows: pa.Table, own: pa.Table) -> pa.Table:
        table, rows = _entries(own), rows.combine_chunks()
        values, misses = (_one(rows[name]) for name in (target, MISSES))
        return rows.select(others).append_column(target, _patched(values, misses, table, missing, default))

    schema = begun.select(*others, target).schema
    completed = begun.where(open_).groupBy(CHUNK).cogroup(found.groupBy(F.col("chunk").alias(CHUNK))).applyInArrow(complete, schema)
    return begun.where(~open_).select(*others, target).unionByName(completed)


def replace_elements(
    df: DataFrame,
    source: str,
    target: str,
    table: DataFrame,
    key: str,
    value: str,
    default: object = None,
    hot: Column | None = None,
    ship: bool | None = None,
    ship_found: bool | None = None,
    keep_source: bool = True,
) -> DataFrame:
    """Add ``target``: the array ``source`` with each element looked up in ``table``.

    The keys of ``table`` are unique. An element without an entry becomes ``default``, or stays as it is
    when that is ``None``. ``hot`` selects a bounded part of the table with its most frequent keys.
    ``ship`` and ``ship_found`` override the checks of the size of the table and of its part that was looked up. Without
    ``keep_source`` the source column is dropped, and does not move.
    """
    kind = table.schema[value].dataType
    is_hot = F.lit(False) if hot is None else hot
    entries = table.select(F.col(key).alias("key"), F.col(value).alias("value"), is_hot.alias("hot"))
    if fits_broadcast(table, key, value) if ship is None else ship:
        shipped = _shipped(_ship(entries), kind, "copy" if default is None else "default", default)
        done = df.withColumn(target, shipped(F.col(source)))
        return done if keep_source else done.drop(source)
    near, far = entries.where("hot").drop("hot"), entries.where("not hot").drop("hot")
    missing = "copy" if default is None else "default"
    return _joined(df, source, target, near, far, kind, missing, default, ship_found, keep_source)
