"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``TABLES`` tables hashes a vector by ``HASHES`` projections on Gaussian directions, cut into slots of width
``WIDTH``. Inner products become distances on the sphere first: a vector is divided by the largest norm and gets one
more component that completes it to length 1, a query is normalised. A query visits the buckets around its own in
the order of the estimated probability that a neighbour at distance ``r`` lies there, until that probability adds up
so that all tables together reach ``RECALL``. The most likely bucket of each table gives a score that the k-th neighbour
has at least, and the other buckets only hand over what reaches it. The distance ``r`` of the k-th neighbour is estimated for each length of a
vector from the inner products of about ``SAMPLE`` different vectors (shared by the lengths, at least 200 each), so copies
do not count; every row is indexed. A query that has met at most ``k`` different vectors then searches all blocks of its
length, so results are short only where candidates are. Candidates of all tables are ranked by exact inner products.

Buckets are cut into blocks of up to 1024 vectors and probes into blocks of queries, so a crowded bucket is many
pairs of blocks. Copies are one vector with its smallest ids.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no part; a query
meets vectors of its own length only; rows with an equal id and vector count once; an id stated with different
vectors is a query with the smallest of them; null ids are candidates that lose every tie; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentloom.llm.vectors import BLOCK, BLOCK_COLUMNS, best_of_pairs, by_length, distinct_vectors, matrix, pack_blocks, query_vectors, ranked, valid
from sentloom.session import stage

TABLES, HASHES, WIDTH = 2, 4, 3.0
RECALL = 0.95
SAMPLE = 2000
#: Blocks of the index, if full, that a copy of a block of lacking queries meets.
PART = 4
STEPS = (-1, 0, 1)


def directions(dim: int, tables: int, hashes: int, width: float, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = np.random.default_rng([seed, dim])
    return [(rng.standard_normal((dim + 1, hashes)), rng.random(hashes) * width) for _ in range(tables)]


def bucket_ids(slots: np.ndarray, dim: int) -> np.ndarray:
    """Slots to one number; lengths have buckets of their own."""
    out = np.full(slots.shape[:-1], dim, np.int64)
    for i in range(slots.shape[-1]):
        out = out * np.int64(1_000_003) + slots[..., i].astype(np.int64)
    return out


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    """The normal distribution function by a table, to four places."""
    grid = np.linspace(-8, 8, 4001)
    table = np.array([NormalDist().cdf(g) for g in grid])
    return np.interp(x, grid, table)


def probes(inside: np.ndarray, width: float, r: float, mass: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Perturbations for queries ``inside`` their slots: query numbers, places in the order of success, steps per hash."""
    n, hashes = inside.shape
    chance, steps = np.ones((n, 1)), np.zeros((1, 0), np.int64)
    for i in range(hashes):
        one = np.stack(
            [_normal_cdf((width * (s + 1) - inside[:, i]) / r) - _normal_cdf((width * s - inside[:, i]) / r) for s in STEPS], axis=1
        )
        chance = (chance[:, :, None] * one[:, None, :]).reshape(n, -1)
        steps = np.concatenate([np.repeat(steps, len(STEPS), axis=0), np.tile(np.array(STEPS)[:, None], (len(steps), 1))], axis=1)
    order = np.argsort(-chance, axis=1, kind="stable")
    reached = np.cumsum(np.take_along_axis(chance, order, axis=1), axis=1)
    count = np.minimum((reached < mass).sum(axis=1) + 1, order.shape[1])
    query = np.repeat(np.arange(n), count)
    place = np.arange(len(query)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return query, place, steps[order[query, place]]


def neighbour_distance(x: np.ndarray, k: int, largest: float, total: int) -> float:
    """The distance that the k-th neighbour has on the sphere, from the spread of inner products of sampled vectors."""
    if not len(x):
        return 1.0
    q = x[:200] / np.linalg.norm(x[:200], axis=1)[:, None]
    scores = (q @ (x / largest).T)[~np.eye(len(q), len(x), dtype=bool)]
    if not len(scores):
        return 1.0
    tail = min(max(1 - k / max(total, 1), 0.5), 1 - 1e-12)
    kth = scores.mean() + scores.std() * NormalDist().inv_cdf(tail)
    return math.sqrt(2 - 2 * min(max(kth, -1.0), 0.995))


def sampled(distinct: DataFrame, shares: dict[int, float]) -> dict[int, np.ndarray]:
    """Of each length in ``shares``, about that share of the different vectors, by their hash."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = np.array([shares.get(n, 0.0) for n in np.diff(batch["vector"].offsets.to_numpy()).tolist()])
            yield batch.filter(pa.array(batch["place"].to_numpy() < 1_000_000 * least)).select(["vector"])

    rows = distinct.select("vector", F.pmod(F.xxhash64("vector"), F.lit(1_000_000)).alias("place")).mapInArrow(pick, "vector array<double>").collect()
    return {n: np.array([r[0] for r in rows if len(r[0]) == n]) for n in {len(r[0]) for r in rows}}


def nearest(
    table: DataFrame,
    *,
    k: int = 20,
    every: int = 20,
    vector: str = "embedding",
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    recall: float = RECALL,
    seed: int = 1,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id ``every`` divides, by largest inner product."""
    rows = valid(table, vector).filter(F.exists("vector", lambda x: x != 0))
    rows = stage(rows, "vectors")
    distinct = stage(distinct_vectors(rows, k), "distinct")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    # One row for each length of a vector.
    lengths = distinct.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"), F.max(norm).alias("largest")).collect()
    total, largest = sum(x["n"] for x in lengths), max((x["largest"] for x in lengths), default=1.0)
    many = {x["dim"]: x["n"] for x in lengths if x["n"] > k + 1}
    sample = sampled(distinct, {d: min(1.0, max(SAMPLE // len(many), 200) / n) for d, n in many.items()})
    near = {d: neighbour_distance(x, k, largest, many[d]) for d, x in sample.items()}
    mass = 1 - (1 - recall) ** (1 / tables)

    def hashed(x: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        full = np.concatenate([x, last[:, None]], axis=1)
        for t, (a, b) in enumerate(directions(x.shape[1], tables, hashes, width, seed)):
            yield t, (full @ a + b) / width

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_length(whole) if whole.num_rows else ():
                x = matrix(batch["vector"]) / largest
                for t, h in hashed(x, np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))):
                    ids = pa.array(bucket_ids(np.floor(h), x.shape[1]))
                    yield pa.record_batch({"table": pa.array(np.full(len(x), t, np.int32)), "bucket": ids, "vector": batch["vector"], "ids": batch["ids"]})

    def probe(first: bool):
        """Entries for the most likely bucket of each table, or for the others, with the score to reach."""

        def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in by_length(whole) if whole.num_rows else ():
                    x = matrix(batch["vector"])
                    x = x / np.linalg.norm(x, axis=1)[:, None]
                    for cut in range(0, len(x), 2000):
                        part = batch.slice(cut, 2000)
                        for t, h in hashed(x[cut : cut + 2000], np.zeros(part.num_rows)):
                            slot = np.floor(h)
                            query, place, steps = probes((h - slot) * width, width, near.get(x.shape[1], 1.0), mass)
                            use = (place == 0) == first
                            query, steps = query[use], steps[use]
                            ids = pa.array(bucket_ids(slot[query] + steps, x.shape[1]))
                            of = part.take(pa.array(query))
                            yield pa.record_batch(
                                {"table": pa.array(np.full(len(query), t, np.int32)), "bucket": ids, "vector": of["vector"], "ids": of["ids"], "q_floor": of["q_floor"]}
                            )

        return enter

    hashed_columns = "table int, bucket long, vector array<double>, ids array<long>"

    def blocks(entries: DataFrame, *carried: str) -> DataFrame:
        return (
            entries.withColumn("first", F.element_at("ids", 1))
            .repartitionByRange("table", "bucket", "first")
            .sortWithinPartitions("table", "bucket", "first")
            .select("table", "bucket", "vector", "ids", *carried)
            .mapInArrow(
                pack_blocks(["table", "bucket"], carried=carried[0] if carried else None),
                f"table int, bucket long, {'q_floor array<double>, ' if carried else ''}{BLOCK_COLUMNS}",
            )
        )

    queries, asked = query_vectors(rows, every)
    indexed = stage(blocks(distinct.mapInArrow(index, hashed_columns)).withColumn("block", F.monotonically_increasing_id()), "buckets")

    def visit(asking: DataFrame, first: bool) -> DataFrame:
        entries = asking.select("vector", F.array("query").alias("ids"), "q_floor").mapInArrow(probe(first), f"{hashed_columns}, q_floor double")
        asked_blocks = blocks(entries, "q_floor").select("table", "bucket", F.col("firsts").alias("q_firsts"), F.col("matrix").alias("q_matrix"), "q_floor")
        return (
            indexed.join(asked_blocks, ["table", "bucket"])
            .select("dim", "firsts", "ids", "matrix", "q_firsts", "q_matrix", "q_floor")
            .mapInArrow(best_of_pairs(k), "query long, score double, first long, ids array<long>")
        )

    likely = stage(visit(queries.withColumn("q_floor", F.lit(float("-inf"))), True), "found")
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    floors = (
        likely.select("query", "score", "first").distinct()
        .withColumn("place", F.row_number().over(order)).filter(F.col("place") == k + 1)
        .select("query", F.col("score").alias("q_floor"))
    )
    others = queries.join(floors, "query", "left").withColumn("q_floor", F.coalesce("q_floor", F.lit(float("-inf"))))
    visited = stage(likely.unionByName(visit(others, False)), "visited")

    # Queries that met fewer different vectors than they may need search all blocks of their length, which one table has.
    met = visited.select("query", "score", "first").distinct().groupBy("query").agg(F.count("*").alias("met"))
    lacking = queries.join(met, "query", "left").filter(F.coalesce("met", F.lit(0)) <= k)
    parts = max(1, total // (PART * BLOCK))
    asked_blocks = (
        blocks(lacking.select(F.lit(0).alias("table"), F.size("vector").cast("long").alias("bucket"), "vector", F.array("query").alias("ids")))
        .select("dim", F.col("firsts").alias("q_firsts"), F.col("matrix").alias("q_matrix"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    )
    rest = (
        indexed.filter("table = 0").withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
        .join(asked_blocks, ["dim", "part"])
        .select("dim", "firsts", "ids", "matrix", "q_firsts", "q_matrix")
        .mapInArrow(best_of_pairs(k), "query long, score double, first long, ids array<long>")
    )
    found = visited.unionByName(rest)
    return ranked(found, asked.join(queries, "vector").select("query_id", "query"), k)
