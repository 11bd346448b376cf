"""Vector searches against all pairs."""

import numpy as np
import pytest

from sentloom.llm.multiprobe import nearest, probes
from sentloom.llm.pivot_search import top_k

SCHEMA = "vec_id long, embedding array<float>, vector string, ids int, query int, `table` int, pivot int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2, 3, 4) for i, v in rows], SCHEMA).repartition(3)


def odd_rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, dim)) * 0.5
    x = (centres[rng.integers(0, 8, n)] + rng.standard_normal((n, dim)) * 0.3).astype(np.float32)
    x[::7] *= 3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(n + i, x[0].tolist()) for i in range(60)]  # copies
    rows += [(n + 100, None), (n + 101, []), (n + 102, [0.0] * dim), (n + 103, [float("nan")] + [0.0] * (dim - 1)), (n + 104, [None] + [1.0] * (dim - 1)),
             (n + 105, [float("inf")] * dim), (None, x[1].tolist()), (n + 106, [1.0, 2.0]), (n + 150, [0.5, 2.0]), (3, x[3].tolist())]
    return rows


def brute(rows, k, every, of, zero):
    seen, out = {}, {}
    for i, v in rows:
        if v and all(c is not None and np.isfinite(c) for c in v) and (zero or any(v)):
            seen.setdefault((i, tuple(v)), of(np.array(v, np.float32).astype(float)))
    for (i, _), q in seen.items():
        if i is not None and i % every == 0:
            found = [(-float(q @ x), j is None, j) for (j, _), x in seen.items() if j != i and len(x) == len(q)]
            out[i] = [(j, -s) for s, _, j in sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k]]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for rows in out.values():
        rows.sort()
        assert [r for r, _, _ in rows] == list(range(1, len(rows) + 1))
    return {q: [(v, s) for _, v, s in rows] for q, rows in out.items()}


@pytest.mark.parametrize(("dim", "seed"), [(8, 1), (24, 2)])
def test_pivot_search_is_exact(spark, dim, seed):
    rows = odd_rows(700, dim, seed)
    want = brute(rows, 5, 50, lambda v: np.floor(256 * v), True)
    got = found(top_k(table(spark, rows)))
    assert got == {q: [(v, int(s)) for v, s in r] for q, r in want.items() if r}


def test_multiprobe_recall_and_scores(spark):
    rows = odd_rows(1500, 16, 3)
    want = brute(rows, 20, 20, lambda v: v, False)
    got = found(nearest(table(spark, rows)))
    share = []
    for q, best in want.items():
        if not best:
            continue
        mine = got[q]
        assert mine == sorted(mine, key=lambda m: (-m[1], m[0] is None, m[0] or 0)) and all(v != q for v, _ in mine)
        share.append(len({v for v, _ in mine} & {v for v, _ in best}) / len(best))
    assert np.mean(share) >= 0.9
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows if v and None not in v and i is not None}
    for q, mine in got.items():
        assert all(v is None or s == pytest.approx(float(vectors[q] @ vectors[v]), rel=1e-9) for v, s in mine)


def test_multiprobe_recall_beside_a_hot_vector(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1200, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1200 + i, x[7].tolist()) for i in range(600)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    want = {q: w for q, w in brute(rows, 20, 20, lambda v: v, False).items() if q < 1200}
    got = found(nearest(table(spark, rows)))
    share = np.mean([len({v for v, _ in got.get(q, ())} & {v for v, _ in w}) / 20 for q, w in want.items()])
    assert share >= 0.9


def test_multiprobe_has_all_of_few_candidates(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((8, 16))
    many = (centres[rng.integers(0, 8, 600)] + 0.2 * rng.standard_normal((600, 16))).astype(np.float32)
    few, rare = rng.standard_normal((10, 8)).astype(np.float32), rng.standard_normal((15, 24)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(few)] + [(20 + i, v.tolist()) for i, v in enumerate(rare)] + [(100 + i, v.tolist()) for i, v in enumerate(many)]
    want = brute(rows[:25], 20, 1, lambda v: v, False)
    got = found(nearest(table(spark, rows), every=1))
    for q, best in want.items():
        assert [v for v, _ in got[q]] == [v for v, _ in best]
    assert all(len(got[i]) == 20 for i, _ in rows[25:])


def test_probes_come_in_order_of_success():
    query, place, steps = probes(np.array([[0.1, 2.9], [1.5, 1.5]]), 3.0, 1.0, 0.9)
    assert steps[query == 0][0].tolist() == [-1, 0] or steps[query == 0][0].tolist() == [0, 0]
    assert steps[query == 1][0].tolist() == [0, 0]
    assert place[query == 1].tolist() == list(range((query == 1).sum()))


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert top_k(empty).count() == 0 and nearest(empty).count() == 0
    assert top_k(table(spark, [(50, [1.0])])).count() == 0
    assert found(nearest(table(spark, [(0, [1.0]), (1, [2.0])]))) == {0: [(1, 2.0)]}
