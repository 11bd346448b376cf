"""Helpers of the vector searches: valid vectors, copies as one vector, blocks of vectors, and the final ranking.

Equal vectors are one vector with its smallest ids, as many as a query can need, so copies cost nothing in a search
however many there are. A block holds up to ``BLOCK`` vectors that follow each other in the order of an index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024
BLOCK_COLUMNS = "n int, dim int, firsts array<long>, ids array<array<long>>, matrix binary"


def valid(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows whose vector is there, not empty, and finite in each component."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & fine).select(F.col("vec_id").cast("long"), v.alias("vector"))


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """``vector, ids``: each different vector once with its ``k + 1`` smallest ids, a null id last."""
    order = Window.partitionBy("vector").orderBy(F.asc_nulls_last("vec_id"))
    kept = vectors.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("place", "vec_id"))), lambda x: x["vec_id"])
    return kept.groupBy("vector").agg(ids.alias("ids"))


def query_vectors(vectors: DataFrame, every: int) -> tuple[DataFrame, DataFrame]:
    """Queries are the rows whose id ``every`` divides, an id once. Their different vectors, and which one each has."""
    rows = vectors.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return rows.groupBy("vector").agg(F.min("vec_id").alias("query")), rows.withColumnRenamed("vec_id", "query_id")


def matrix(vectors: pa.Array) -> np.ndarray:
    """A batch of vectors of one length."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def by_length(batch: pa.RecordBatch, column: str = "vector") -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose vectors have one length."""
    lengths = np.diff(batch[column].offsets.to_numpy())
    for n in np.unique(lengths):
        yield batch if (lengths == n).all() else batch.filter(pa.array(lengths == n))


def pack_blocks(keys: list[str], measures: list[str] | None = None, block: int = BLOCK, carried: str | None = None):
    """A function for ``mapInArrow`` over sorted rows ``*keys, *measures, vector, ids``: blocks of rows with equal keys.

    For each measure, a block has the least and the largest value, and of the column ``carried`` all values.
    """
    measures = measures or []

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def make(table: pa.Table) -> pa.RecordBatch:
            rows = table.combine_chunks().to_batches()[0]
            values = matrix(rows["vector"])
            out = {k: rows[k].slice(0, 1) for k in keys}
            for m in measures:
                x = rows[m].to_numpy()
                out |= {f"{m}_least": pa.array([x.min()]), f"{m}_most": pa.array([x.max()])}
            if carried:
                out |= {carried: pa.array([rows[carried].to_pylist()], pa.list_(pa.float64()))}
            ids = rows["ids"]
            return pa.record_batch(
                out
                | {
                    "n": pa.array([len(values)], pa.int32()),
                    "dim": pa.array([values.shape[1]], pa.int32()),
                    "firsts": pa.array([[x[0] for x in ids.to_pylist()]], pa.list_(pa.int64())),
                    "ids": pa.array([ids.to_pylist()], pa.list_(pa.list_(pa.int64()))),
                    "matrix": pa.array([np.ascontiguousarray(values, "<f8").tobytes()], pa.binary()),
                }
            )

        def groups(table: pa.Table) -> list[tuple[int, int]]:
            change = np.zeros(max(table.num_rows - 1, 0), bool)
            for k in keys:
                x = table[k].to_numpy()
                change |= x[1:] != x[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
            return [(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            table = pa.Table.from_batches(held)
            spans = groups(table)
            for i, (a, b) in enumerate(spans):
                while b - a >= block:
                    yield make(table.slice(a, block))
                    a += block
                if a < b and (last or i < len(spans) - 1):
                    yield make(table.slice(a, b - a))
                    a = b
                held = table.slice(a, b - a).to_batches() if a < b else []

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(x.num_rows for x in held) >= block:
                    yield from flush(False)
        if held:
            yield from flush(True)

    return pack


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row by row inner products, summed from the first component on, so that equal vectors get equal scores."""
    out = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        out += queries[:, d] * vectors[:, d]
    return out


def best_of_pairs(k: int, score_type: str = "double"):
    """A function for ``mapInArrow`` over pairs of a block (``firsts, ids, matrix, dim``) and a query block
    (``q_firsts, q_matrix`` and perhaps ``q_floor``): the ``k + 1`` best vectors of each query in the block.

    A query's rows that cannot be among its best in this task, given what the task has seen, are left out.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor: dict[int, list[tuple[float, float]]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch["dim"][i].as_py()
                x = np.frombuffer(batch["matrix"][i].as_buffer(), "<f8").reshape(-1, dim)
                q = np.frombuffer(batch["q_matrix"][i].as_buffer(), "<f8").reshape(-1, dim)
                names = batch["q_firsts"][i].values.to_numpy()
                firsts = batch["firsts"][i].values.to_numpy(zero_copy_only=False).astype(float)
                scores = q @ x.T
                slack = 1e-9 * (1 + abs(scores).max(initial=0.0))
                least = np.full(len(q), -np.inf)
                if "q_floor" in batch.schema.names:
                    least = batch["q_floor"][i].values.to_numpy(zero_copy_only=False).astype(float)
                if x.shape[0] > k + 1:
                    least = np.maximum(least, np.partition(scores, -(k + 1), axis=1)[:, -(k + 1)])
                known = np.array([floor[n][-1][0] if len(floor.get(n, ())) > k else -np.inf for n in names.tolist()])
                row, col = np.nonzero(scores >= (np.maximum(least, known) - slack)[:, None])
                exact = exact_scores(q[row], x[col])
                order = np.lexsort((firsts[col], -exact, row))
                row, col, exact = row[order], col[order], exact[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                keep = place <= k
                row, col, exact = row[keep], col[keep], exact[keep]
                good = np.ones(len(row), bool)
                if len(floor) > 1_000_000:
                    floor.clear()
                for r in np.unique(row).tolist():
                    a, b = np.searchsorted(row, [r, r + 1])
                    name = int(names[r])
                    had = floor.get(name, [])
                    mine = [(s, -f) for s, f in zip(exact[a:b].tolist(), np.nan_to_num(firsts[col[a:b]], nan=np.inf).tolist(), strict=True)]
                    if len(had) > k:
                        good[a:b] = [m > had[k] for m in mine]
                    floor[name] = sorted({*had, *mine}, reverse=True)[: k + 1]
                row, col, exact = row[good], col[good], exact[good]
                ids = batch["ids"][i].values.take(pa.array(col))
                yield pa.record_batch(
                    {
                        "query": pa.array(names[row]),
                        "score": pa.array(exact if score_type == "double" else np.rint(exact).astype(np.int64)),
                        "first": batch["firsts"][i].values.take(pa.array(col)),
                        "ids": ids,
                    }
                )

    return search


def ranked(found: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best for every row of ``asked(query_id, query)``, its own id left out.

    ``found(query, score, first, ids)`` may name a vector several times.
    """
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    rows = found.select("query", "score", F.explode("ids").alias("vec_id")).distinct()
    rows = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    best = rows.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "score", "vec_id"))).alias("best"))
    others: Column = F.slice(F.filter("best", lambda x: ~x["vec_id"].eqNullSafe(F.col("query_id"))), 1, k)
    return (
        asked.join(best, "query")
        .select("query_id", F.posexplode(others).alias("rank", "one"))
        .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "one.vec_id", "one.score")
    )
