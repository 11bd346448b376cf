"""Exact top-k search by inner product with a pivot-distance index.

Vectors are keyed by their nearest pivot and the distance to it, sorted by that key over all tasks, and cut into
annuli of up to ``BLOCK`` vectors. For a query ``q`` and an annulus of pivot ``p`` with distances ``[a, b]``, no vector
in it is nearer to ``q`` than ``max(a - |qp|, |qp| - b, 0)``, so with the largest norm of the annulus its inner
products have an upper bound. The first annulus that a query opens, the fullest one around its own distance to its
nearest pivot, gives its k-th best score so far; then it opens every annulus whose bound reaches that score. Nothing
else is skipped, so results are exact. Queries go in blocks too, and an annulus is opened for the queries of a block
that need it.

Pivots are chosen farthest-first from at most ``SAMPLE`` rows; they affect the work, never the result.

Defined results: vectors that are null, empty or hold a null or non-finite component take no part; a query meets
vectors of its own length only; rows with an equal id and vector count once; an id stated with different vectors is
a query with the smallest of them; null ids are candidates that lose every tie; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentloom.llm.vectors import BLOCK_COLUMNS, best_of_pairs, by_length, distinct_vectors, matrix, pack_blocks, query_vectors, ranked, valid
from sentloom.session import stage

SAMPLE = 4096
PIVOTS = 16


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> list[np.ndarray]:
    """For each length in the sample, vectors that are far from each other."""
    total = vectors.count()
    share = int(1_000_000 * min(1.0, sample / max(total, 1)))
    rows = vectors.select("vector").filter(F.pmod(F.xxhash64("vector"), F.lit(1_000_000)) < share).limit(2 * sample).collect()
    out = []
    for dim in sorted({len(r[0]) for r in rows}):
        x = np.array(sorted(r[0] for r in rows if len(r[0]) == dim))
        chosen = [x[0]]
        nearest = ((x - chosen[0]) ** 2).sum(axis=1)
        while len(chosen) < min(pivots, len(x)) and nearest.max() > 0:
            chosen.append(x[int(nearest.argmax())])
            nearest = np.minimum(nearest, ((x - chosen[-1]) ** 2).sum(axis=1))
        out.append(np.array(chosen))
    return out


def keyed(vectors: DataFrame, pivots: list[np.ndarray], columns: str) -> DataFrame:
    """Adds ``pivot``, ``distance`` and the squared ``norm``. Lengths outside the sample have the origin as pivot."""
    number = {}
    for p in pivots:
        number[p.shape[1]] = (sum(len(x) for d, x in ((y.shape[1], y) for y in pivots) if d < p.shape[1]), p)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_length(whole) if whole.num_rows else ():
                x = matrix(batch["vector"])
                first, p = number.get(x.shape[1], (-x.shape[1], np.zeros((1, x.shape[1]))))
                squares = np.stack([((x - one) ** 2).sum(axis=1) for one in p], axis=1)
                at = squares.argmin(axis=1)
                extra = {
                    "pivot": pa.array((at + first).astype(np.int64)),
                    "distance": pa.array(np.sqrt(squares[np.arange(len(x)), at])),
                    "norm": pa.array((x * x).sum(axis=1)),
                }
                yield pa.record_batch({c: batch[c] for c in batch.schema.names} | extra)

    return vectors.mapInArrow(key, f"{columns}, pivot long, distance double, norm double")


def top_k(table: DataFrame, *, k: int = 5, every: int = 50, scale: float = 256.0, vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id ``every`` divides, over ``floor(scale * component)``."""
    rows = valid(table, vector)
    whole = F.transform("vector", lambda x: F.floor(F.lit(scale) * x).cast("double"))
    rows = stage(rows.select("vec_id", whole.alias("vector")), "vectors")
    queries, asked = query_vectors(rows, every)
    pivots = choose_pivots(rows)
    index = stage(
        keyed(distinct_vectors(rows, k), pivots, "vector array<double>, ids array<long>")
        .withColumn("first", F.element_at("ids", 1))
        .repartitionByRange("pivot", "distance", "first")
        .sortWithinPartitions("pivot", "distance", "first")
        .select("pivot", "distance", "norm", "vector", "ids")
        .mapInArrow(
            pack_blocks(["pivot"], ["distance", "norm"]),
            f"pivot long, distance_least double, distance_most double, norm_least double, norm_most double, {BLOCK_COLUMNS}",
        )
        .withColumn("annulus", F.monotonically_increasing_id()),
        "annuli",
    )
    blocks = stage(
        keyed(queries.select("vector", F.array("query").alias("ids")), pivots, "vector array<double>, ids array<long>")
        .repartitionByRange("pivot", "distance", F.element_at("ids", 1))
        .sortWithinPartitions("pivot", "distance", F.element_at("ids", 1))
        .select("pivot", "distance", "norm", "vector", "ids")
        .mapInArrow(
            pack_blocks(["pivot"], ["distance", "norm"]),
            f"pivot long, distance_least double, distance_most double, norm_least double, norm_most double, {BLOCK_COLUMNS}",
        )
        .select(
            F.monotonically_increasing_id().alias("q_block"), F.col("pivot").alias("q_pivot"), "dim",
            F.col("distance_least").alias("q_least"), F.col("distance_most").alias("q_most"),
            F.col("norm_most").alias("q_norm"), F.col("firsts").alias("q_firsts"), F.col("matrix").alias("q_matrix"),
        ),
        "query-blocks",
    )
    bounds = index.select("annulus", "pivot", "distance_least", "distance_most", "norm_most", "n", F.col("dim").alias("a_dim"))
    search = best_of_pairs(k, "long")
    found_columns = "query long, score long, first long, ids array<long>"
    content = index.select("annulus", "dim", "n", "firsts", "ids", "matrix")

    # The first annulus of each query block.
    home = (
        blocks.select("q_block", "q_pivot", "q_least", "q_most")
        .join(bounds, (F.col("q_pivot") == F.col("pivot")) & (F.col("distance_least") <= F.col("q_most")) & (F.col("distance_most") >= F.col("q_least")))
        .groupBy("q_block")
        .agg(F.max_by("annulus", F.struct("n", "annulus")).alias("annulus"))
    )
    inside = home.join(content, "annulus").join(blocks.select("q_block", "q_firsts", "q_matrix"), "q_block")
    first = stage(inside.mapInArrow(search, found_columns), "found")
    floors = (
        ranked(first, first.select("query").distinct().withColumn("query_id", F.col("query")), k)
        .groupBy("query_id")
        .agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
        .select(F.col("query_id").alias("query"), "floor")
    )

    # Distances from each query block to all pivots of its length, and the least of its k-th scores.
    number = []
    for p in pivots:
        number += [(p.shape[1], len(number) + i, row.tolist()) for i, row in enumerate(p)]

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                q = np.frombuffer(row["q_matrix"], "<f8").reshape(-1, row["dim"])
                near = [(n, np.sqrt(((q - np.array(p)) ** 2).sum(axis=1))) for d, n, p in number if d == row["dim"]]
                for n, d in near or [(-row["dim"], np.sqrt((q * q).sum(axis=1)))]:
                    out.append((row["q_block"], n, float(d.min()), float(d.max())))
            yield pa.record_batch([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=["q_block", "pivot", "near", "far"])

    members = blocks.select("q_block", F.posexplode("q_firsts").alias("at", "query")).join(floors, "query", "left")
    of_block = members.groupBy("q_block").agg(
        F.array_sort(F.collect_list(F.struct("at", "floor"))).alias("all"),
        F.when(F.count("floor") == F.count("*"), F.min("floor")).alias("floor"),
    )
    of_block = of_block.select("q_block", "floor", F.transform("all", lambda x: F.coalesce(x["floor"].cast("double"), F.lit(float("-inf")))).alias("q_floor"))
    asking = (
        blocks.select("q_block", "dim", "q_matrix")
        .mapInArrow(reach, "q_block long, pivot long, near double, far double")
        .join(blocks.select("q_block", "q_norm"), "q_block")
        .join(of_block.select("q_block", "floor"), "q_block")
    )
    # |q - x|^2 = |q|^2 + |x|^2 - 2 q.x, so a score of floor or more is within this distance.
    square = F.col("q_norm") + F.col("norm_most") - 2 * F.col("floor")
    within = F.sqrt(F.greatest(square, F.lit(0.0))) * (1 + 1e-9) + 1e-6
    nearest = F.greatest(F.col("distance_least") - F.col("far"), F.col("near") - F.col("distance_most"), F.lit(0.0))
    wanted = (
        asking.join(bounds, "pivot")
        .filter(F.col("floor").isNull() | ((square >= -1e-6) & (nearest <= within)))
        .select("q_block", "annulus")
        .join(home, ["q_block", "annulus"], "left_anti")
    )
    rest = (
        wanted.join(content, "annulus")
        .join(blocks.select("q_block", "q_firsts", "q_matrix"), "q_block")
        .join(of_block.select("q_block", "q_floor"), "q_block")
        .mapInArrow(search, found_columns)
    )
    return ranked(first.unionByName(rest), asked.join(queries, "vector").select("query_id", "query"), k)
