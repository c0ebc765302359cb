from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwright.llm import topk


def brute(rows, k, is_query, scale=1024.0):
    ok = [(i, np.floor(scale * np.array(v, float)).astype(object)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out, seen = [], set()
    for i, v in ok:
        if not is_query(i) or (i, tuple(v)) in seen:
            continue
        seen.add((i, tuple(v)))
        best = sorted((-int((v * w).sum()) if len(v) else 0, j) for j, w in ok if j != i and len(w) == len(v))[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def run(spark, rows, k=5, modulus=10, **kw):
    table = spark.createDataFrame([(*r, 0, 1.0) for r in rows], "vec_id long, embedding array<double>, query int, score double").repartition(5)
    return sorted(tuple(r) for r in topk.top_products(table, F.col("vec_id") % modulus == 0, k, **kw).collect())


@pytest.mark.parametrize("kind", ["clustered", "spread", "ties"])
def test_equals_brute_force(spark, kind, monkeypatch):
    rng = np.random.default_rng(7)
    if kind == "clustered":
        vectors = rng.normal(size=(12, 8))[rng.integers(0, 12, 700)] * 3 + rng.normal(size=(700, 8)) * 0.05
    elif kind == "spread":
        vectors = rng.normal(size=(700, 16))
    else:
        vectors = rng.integers(-1, 2, size=(700, 3)).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 10 == 0)
    assert run(spark, rows, query_block=16) == brute(rows, 5, lambda i: i % 10 == 0)


def test_nulls_repeats_lengths_and_huge_components(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, 0.5]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [9.0, 9.0]),
            (5, [1.0, 1.0]), (5, [1.0, 1.0]), (6, [1.0]), (10, []), (7, []), (20, [2.0]), (30, [1.0, 2.0, 3.0]), (8, [-1e-9, 0.9999])]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 10 == 0)
    huge = [(0, [1e6, 1e5]), (1, [1e5, 0.001]), (2, [1e30, 1.0]), (3, [-1e30, 1.0]), (4, [1e5, 0.002])]
    top, product = (1 << 63) - 1, 1024 * 10**6 * 1024 * 10**5
    found = [(r[2], r[3]) for r in run(spark, huge, k=4)]
    assert found == [(2, top), (4, product + 1024 * 10**5 * 2), (1, product + 1024 * 10**5), (3, -top - 1)]


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert topk.top_products(rows, F.col("vec_id") % 10 == 0).count() == 0
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_cover_tree_covers_and_separates():
    points = np.random.default_rng(2).normal(size=(600, 5))
    tree = topk.cover_tree(points)
    assert sorted(tree.order) == list(range(600))
    for node, (first, last) in enumerate(tree.child):
        members = tree.order[tree.start[node] : tree.stop[node]]
        far = np.sqrt(np.square(points[members] - points[tree.center[node]]).sum(axis=1))
        assert far.max() <= tree.radius[node] + 1e-9
        if last:
            children = range(first, last)
            assert tree.center[first] == tree.center[node] and sum(tree.stop[c] - tree.start[c] for c in children) == len(members)
            centers = points[[tree.center[c] for c in children]]
            gaps = np.sqrt(np.square(centers[:, None] - centers[None]).sum(axis=2))[np.triu_indices(len(centers), 1)]
            assert not len(gaps) or gaps.min() > tree.radius[node] / topk.SHRINK - 1e-9


def test_pairs_are_pruned(monkeypatch):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(20, 6))[np.repeat(np.arange(20), 100)] * 20 + rng.normal(size=(2000, 6)) * 0.1
    done = []
    monkeypatch.setattr(topk, "multiply", lambda a, b: done.append(len(a) * len(b)) or (a @ b.T).astype(np.int64))
    best = topk.Best.empty(200, 5)
    points = np.floor(points * 1000)
    queries = topk.cover_tree(points[:200])
    topk.search(queries, np.arange(200), topk.cover_tree(points), np.arange(2000), best)
    assert sum(done) < 0.3 * 200 * 2000


def test_query_blocks_stay_small_though_one_id_has_most_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(0 if i < 120 else i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 4)))]
    sizes, send = [], type(spark.sparkContext).broadcast

    def counted(context, value):
        sizes.append(len(value))
        return send(context, value)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", counted)
    assert run(spark, rows, query_block=20) == brute(rows, 5, lambda i: i % 10 == 0)
    assert sum(sizes) == 138 and max(sizes) < 60


def test_components_of_any_size(spark):
    """Distances of such vectors overflow; scores are those of whole numbers, cut off to longs."""
    rng = np.random.default_rng(8)
    rows = [(i, (rng.choice([-1, 1], 4) * 10.0 ** rng.uniform(0, top, 4)).tolist()) for i, top in enumerate([300, 160, 155, 120, 3, 0.5] * 40)]
    rows += [(900, [1.7e308, -1.7e308, 1e308, 1.0]), (901, [1e160, 1e160, 1e160, 1e160]), (910, [0.0] * 4)]
    limit = (1 << 63) - 1
    largest = int(np.finfo(np.float64).max)
    whole = {i: [max(-largest, min(largest, math.floor(x * 1024) if abs(x) < 1e304 else int(math.copysign(min(abs(x) * 1024, float(largest)), x)))) for x in v] for i, v in rows}
    wanted = []
    for q in whole:
        if q % 10 == 0:
            scores = [(max(-limit - 1, min(limit, sum(a * b for a, b in zip(whole[q], v)))), c) for c, v in whole.items() if c != q]
            wanted += [(q, i + 1, c, s) for i, (s, c) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:5])]
    assert sorted(run(spark, rows)) == sorted(wanted)
