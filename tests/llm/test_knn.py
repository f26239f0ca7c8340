"""Exact top-k search against all inner products."""

import math
import random

import pytest

from grainmill.llm import knn

SCHEMA = "vec_id long, embedding array<float>, label int, score string, id int"


def plain(rows, every=100, k=10):
    def ints(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * x) for x in v]

    vectors = [(i, ints(v)) for i, v in rows]
    vectors = [(i, v) for i, v in vectors if v is not None]
    asks = {}
    for i, v in vectors:
        if i is not None and i % every == 0:
            asks[i] = min(asks.get(i, v), v)
    out = []
    for q, v in asks.items():
        best = sorted((-sum(x * y for x, y in zip(v, w)), i is None, i) for i, w in vectors if i != q)[:k]  # noqa: B905
        out += [(q, n + 1, i, -s) for n, (s, _, i) in enumerate(best)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash", 1) for i, v in rows], SCHEMA)


def result(frame):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in frame.collect())


def f32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


@pytest.mark.parametrize("sizes", [{}, {"n_pivots": 5, "n_probes": 12, "block_rows": 7, "block_queries": 2}, {"n_pivots": 1, "n_probes": 1}])
def test_clusters_copies_and_ties(spark, sizes):
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [f32(x + rng.gauss(0, 0.05)) for x in rng.choice(centres)]) for i in range(450)]
    rows += [(1000 + i, rows[100][1]) for i in range(250)]
    got = knn.exact_neighbours(table(spark, rows), every=50, **sizes)
    assert result(got) == plain(rows, every=50)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (100, [0.25]), (200, []), (300, None), (400, [None, 1.0]), (500, [float("nan")]), (600, [float("inf"), 1.0])]
    rows += [(7, [2.0, 2.0, 9.0]), (7, [2.0, 2.0, 9.0]), (8, [-1.0, -1.0]), (0, [0.5, 3.0])]
    key = sorted
    got = key(map(str, result(knn.exact_neighbours(table(spark, rows)))))
    assert got == key(map(str, plain(rows)))
    lost = [(None, [4.0, 4.0]), (None, [4.0, 4.0]), (3, [4.0, 4.0]), (0, [1.0, 1.0])]
    got = [(r["rank"], r.vec_id) for r in knn.exact_neighbours(table(spark, lost)).orderBy("rank").collect()]
    assert got == [(1, 3), (2, None), (3, None)]


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**18 + i), float(2**17)]) for i in range(0, 40)]
    wide = [(i, v * 8) for i, v in rows]
    assert result(knn.exact_neighbours(table(spark, wide), every=10)) == plain(wide, every=10)


def test_far_rings_are_not_visited(spark):
    rows = [(i, [10.0 if i % 2 else -10.0, f32(i / 1000)]) for i in range(400)]
    frame = table(spark, rows).select(knn.F.col("vec_id").alias("id"), knn.scaled("embedding").alias("v"))
    cells = knn.Cells(knn.matrix(frame.where("id in (0, 1)").toArrow()["v"]))
    x = knn.matrix(frame.toArrow()["v"])
    ring, far = cells.place(x)
    summary = [{"ring": r, "k": int((ring == r).sum()), "far": far[ring == r].max(), "norm": knn.norms(x)[ring == r].max()} for r in sorted(set(ring.tolist()))]
    cells = cells.with_summary(summary)
    _, high = cells.bounds(x[:1])
    assert 0 < (high >= cells.least(x[:1], 10)[:, None]).sum() < len(summary)


def test_empty(spark):
    assert result(knn.exact_neighbours(table(spark, []))) == []
    assert result(knn.exact_neighbours(table(spark, [(1, [1.0])]))) == []
    assert result(knn.exact_neighbours(table(spark, [(100, [1.0])]))) == []
