"""Whitening of embeddings by the principal components of their distinct vectors.

Vectors are scaled to integers and equal ones are grouped with their multiplicity. The fit weighs each distinct vector
with one or with its count (``weights``): exact integer sums give the mean, tasks multiply their centred rows into
partial covariances (weighted GEMM), and the partial rows are summed by a shuffle on the row number. Each distinct
vector is whitened once and joined back to its rows. Vectors with a thousandth of all rows or more, at most a thousand
of them, are joined by broadcast, so that no task gets all rows of a hot vector.

Defined results: rows whose vector is null, or holds a null or a non-finite entry, are dropped; an empty vector has no
components and gives no row; vectors of different lengths are spaces of their own, with ``identity_error`` the largest of
all. Repeated rows and null ids are kept as rows. A direction without variance whitens to 0 (the pseudo-inverse), has
``explained`` 0 and is left out of ``identity_error``; where nothing varies, ``identity_error`` is 0. Scaled entries beyond
64 bits saturate; a ``deviation`` beyond 64 bits is null. An empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentloom.session import stage

#: A vector is hot when it has this share of all rows; so there are at most as many hot vectors as its inverse.
HOT_SHARE = 1 / 1000
#: Numbers of the models that are sent to the tasks at once. Lengths beyond it are worked on one after another.
MODEL_NUMBERS = 1_000_000
#: Centred entries multiplied at once.
BLOCK = 1 << 22
_LONG = 1 << 63


def scaled(table: DataFrame, vector: str, scale: float) -> DataFrame:
    """``vec_id, x array<long>`` of the rows whose vector is there and finite."""
    entries = F.col(vector).cast("array<double>")
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    least, most = -float(_LONG), float(_LONG)

    def whole(c):
        c = c * F.lit(float(scale))
        return F.when(c >= most, F.lit(_LONG - 1)).when(c <= least, F.lit(-_LONG)).otherwise(F.floor(c))

    kept = table.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & fine)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(entries, whole).alias("x"))


def matrices(batch: pa.RecordBatch, step: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and matrix of the vectors ``x`` of each length in a batch, few rows at a time."""
    offsets = batch["x"].offsets.to_numpy()
    values = batch["x"].values.to_numpy()
    lengths = np.diff(offsets)
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        size = max(1, (step or BLOCK) // d)
        for a in range(0, len(rows), size):
            part = rows[a : a + size]
            yield d, part, values[offsets[part][:, None] + np.arange(d)]


def weighted_sums(fit: DataFrame, weight: str) -> DataFrame:
    """``d, i, n, s``: of each length and dimension, the sum of the weights and the exact weighted sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            weights = batch[weight].to_numpy()
            for d, rows, x in matrices(batch):
                w = weights[rows]
                n, sums = total.setdefault(d, [0, [0] * d])
                bound = int(abs(x).max()) * int(w.sum()) if len(w) and x.min() > -_LONG else _LONG
                if bound < _LONG:
                    add = (w[:, None] * x).sum(axis=0).tolist()
                else:
                    add = (w.astype(object)[:, None] * x.astype(object)).sum(axis=0).tolist()
                total[d] = [n + int(w.sum()), [a + int(b) for a, b in zip(sums, add, strict=True)]]
        for d, (n, sums) in total.items():
            yield pa.record_batch(
                {
                    "d": pa.array([d] * d, pa.int32()),
                    "i": pa.array(range(d), pa.int32()),
                    "n": pa.array([n] * d, pa.int64()),
                    "high": pa.array([s >> 64 for s in sums], pa.int64()),
                    "middle": pa.array([s >> 32 & 0xFFFFFFFF for s in sums], pa.int64()),
                    "low": pa.array([s & 0xFFFFFFFF for s in sums], pa.int64()),
                }
            )

    parts = fit.mapInArrow(run, "d int, i int, n long, high long, middle long, low long")
    return parts.groupBy("d", "i").agg(*(F.sum(c).alias(c) for c in ("n", "high", "middle", "low")))


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``d, i, row`` to one row per ``d, i`` with the sum of the arrays."""
    at, total = None, None

    def out() -> pa.RecordBatch:
        return pa.record_batch({"d": pa.array([at[0]], pa.int32()), "i": pa.array([at[1]], pa.int32()), "row": pa.array([total], pa.list_(pa.float64()))})

    for batch in batches:
        for k in range(batch.num_rows):
            key = batch["d"][k].as_py(), batch["i"][k].as_py()
            row = batch["row"][k].values.to_numpy()
            if key == at:
                total = total + row
                continue
            if at is not None:
                yield out()
            at, total = key, row
    if at is not None:
        yield out()


def covariance(fit: DataFrame, weight: str, means: dict[int, np.ndarray], n: dict[int, int]) -> DataFrame:
    """``d, i, row``: the rows of each length's covariance, centred before multiplying."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch[weight].to_numpy()
            for d, rows, x in matrices(batch):
                centred = x.astype(float) - means[d]
                total.setdefault(d, np.zeros((d, d)))
                total[d] += centred.T @ (centred * (weights[rows] / n[d])[:, None])
        for d, c in total.items():
            for a in range(0, d, max(1, BLOCK // d)):
                part = c[a : a + max(1, BLOCK // d)]
                yield pa.record_batch(
                    {
                        "d": pa.array([d] * len(part), pa.int32()),
                        "i": pa.array(range(a, a + len(part)), pa.int32()),
                        "row": pa.array(list(part), pa.list_(pa.float64())),
                    }
                )

    kind = "d int, i int, row array<double>"
    return fit.mapInArrow(run, kind).repartition("d", "i").sortWithinPartitions("d", "i").mapInArrow(_add_rows, kind)


def principal(rows: DataFrame, components: int) -> DataFrame:
    """``d, component, variance, trace, direction`` of the covariances: one matrix, bounded by its length, per task."""

    def run(table: pa.Table) -> pa.Table:
        d = table["d"][0].as_py()
        order = np.argsort(table["i"].to_numpy())
        c = table["row"].combine_chunks().values.to_numpy().reshape(-1, d)[order]
        values, vectors = np.linalg.eigh((c + c.T) / 2)
        k = min(components, d)
        values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k].T
        largest = vectors[np.arange(k), abs(vectors).argmax(axis=1)]
        vectors = vectors * np.where(largest < 0, -1.0, 1.0)[:, None]
        trace = float(np.trace(c))
        return pa.table(
            {
                "d": pa.array([d] * k, pa.int32()),
                "component": pa.array(range(1, k + 1), pa.int32()),
                # What rounding leaves of a direction without variance is none.
                "variance": pa.array(np.where(values > trace * d * 2.0**-50, values, 0.0)),
                "trace": pa.array([trace] * k, pa.float64()),
                "direction": pa.array(list(vectors), pa.list_(pa.float64())),
            }
        )

    return rows.groupBy("d").applyInArrow(run, "d int, component int, variance double, trace double, direction array<double>")


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sums over the dimensions of ``(n * x - s) ** 2``."""
    most = max(n * max(-int(x.min()), int(x.max()), 0) + max(map(abs, sums)), 1)
    if most * most * x.shape[1] < _LONG:
        return (((n * x - np.array(sums)) ** 2).sum(axis=1)).tolist()
    exact = (((x.astype(object) * n - np.array(sums, object)) ** 2).sum(axis=1)).tolist()
    return [v if v < _LONG else None for v in exact]


def _whitened(fit: DataFrame, weight: str, lengths: list[int], components: int) -> DataFrame:
    """The vectors of some lengths with ``w, share array<double>, n, deviation``."""
    chosen = fit.filter(F.size("x").isin(lengths))
    n: dict[int, int] = {}
    sums: dict[int, list[int]] = {d: [0] * d for d in lengths}
    for r in weighted_sums(chosen, weight).toLocalIterator():
        n[r["d"]] = r["n"]
        sums[r["d"]][r["i"]] = (r["high"] << 64) + (r["middle"] << 32) + r["low"]
    means = {d: np.array([s / n[d] for s in sums[d]]) for d in lengths}
    models: dict[int, tuple] = {}
    for r in sorted(principal(covariance(chosen, weight, means, n), components).collect(), key=lambda r: (r["d"], r["component"])):
        over = 1 / np.sqrt(r["variance"]) if r["variance"] > 0 else 0.0
        share = r["variance"] / r["trace"] if r["trace"] > 0 else 0.0
        directions, shares = models.setdefault(r["d"], ([], []))
        directions.append(np.array(r["direction"]) * over)
        shares.append(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in matrices(batch):
                directions, shares = models[d]
                at = pa.array(rows)
                yield pa.record_batch(
                    {
                        "x": batch["x"].take(at),
                        "copies": batch["copies"].take(at),
                        "n": pa.array([n[d]] * len(rows), pa.int64()),
                        "deviation": pa.array(deviations(x, n[d], sums[d]), pa.int64()),
                        "w": pa.array(list((x.astype(float) - means[d]) @ np.array(directions).T), pa.list_(pa.float64())),
                        "share": pa.array([shares] * len(rows), pa.list_(pa.float64())),
                    }
                )

    return chosen.mapInArrow(run, "x array<long>, copies long, n long, deviation long, w array<double>, share array<double>")


def identity_error(whitened: DataFrame, weight: str, components: int) -> float:
    """The largest absolute entry of the covariance of ``w`` over the fit list, minus the identity."""
    w = [F.get("w", F.lit(i)) for i in range(components)]
    of = F.size("x").alias("d")
    means = whitened.groupBy(of).agg(*((F.sum(c * F.col(weight)) / F.sum(weight)).alias(f"m{i}") for i, c in enumerate(w)))
    centred = whitened.withColumn("d", F.size("x")).join(F.broadcast(means), "d")
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    entries = centred.groupBy("d").agg(
        *((F.sum(F.col(weight) / F.col("n") * (w[i] - F.col(f"m{i}")) * (w[j] - F.col(f"m{j}")))).alias(f"c{i}_{j}") for i, j in pairs),
        F.first("share").alias("share"),
    )
    worst = 0.0
    for r in entries.collect():
        for i, j in pairs:
            there = j < len(r["share"]) and r["share"][i] > 0 and r["share"][j] > 0
            worst = max(worst, abs(r[f"c{i}_{j}"] - (i == j))) if there else worst
    return worst


def whiten(table: DataFrame, *, vector: str = "embedding", scale: float = 256.0, components: int = 4, weights: str = "one") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each row and its first components.

    Entries become ``floor(scale * entry)``. ``weights``: each distinct vector counts once (``one``) or as often as it
    occurs (``count``) in the fit.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"weights must be 'one' or 'count', not {weights!r}")
    rows = scaled(table, vector, scale)
    fit = rows.groupBy("x").agg(F.count("*").alias("copies")).withColumn("one", F.lit(1).cast("long"))
    fit = stage(fit, "distinct-vectors")
    weight = "one" if weights == "one" else "copies"
    lengths = [(r["d"], r["rows"]) for r in fit.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("rows")).collect()]
    parts: list[DataFrame] = []
    block: list[int] = []
    for d, _ in sorted(lengths):
        if block and (sum(block) + d) * (components + 2) > MODEL_NUMBERS:
            parts.append(_whitened(fit, weight, block, components))
            block = []
        block.append(d)
    if not block:
        return rows.select(
            "vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            *(F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")),
        ).filter("false")
    parts.append(_whitened(fit, weight, block, components))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    whitened = stage(whole.withColumn("one", F.lit(1).cast("long")), "whitened-vectors")
    error = identity_error(whitened, weight, components)

    found = ["n", "deviation", "w", "share"]
    is_hot = F.col("copies") >= F.lit(HOT_SHARE * sum(count for _, count in lengths))
    hot = F.broadcast(whitened.filter(is_hot).select("x", *found))
    common = rows.join(hot, "x").select("vec_id", *found)
    others = rows.join(hot.select("x"), "x", "left_anti").join(whitened.filter(~is_hot).select("x", *found), "x").select("vec_id", *found)
    return common.unionByName(others).select(
        "vec_id", "n", "deviation", F.posexplode(F.arrays_zip("w", "share")).alias("place", "one")
    ).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("one.w").alias("whitened"), F.col("one.share").alias("explained"), F.lit(error).alias("identity_error"),
    )
