"""Exact top-k search against brute force, and on rows with everything that may be wrong with them."""

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from tidefeed.llm import kdtree

SMALL = kdtree.Sizes(shard_bytes=2048, leaf=4, block=3, sample_rows=64, per_cell=4)
DDL = "vec_id long, embedding array<double>, rank int, score string, `row` int, v int"


def brute_force(data, every, k, scale):
    out = []
    whole = [
        None if v is None or any(x is None or not np.isfinite(x) for x in v) else [int(np.floor(scale * x)) for x in v]
        for _, v in data
    ]
    for i, (query, _) in enumerate(data):
        if query is None or query % every or whole[i] is None:
            continue
        scored = [
            (-sum(a * b for a, b in zip(whole[i], v)), data[j][0] is None, data[j][0] or 0)
            for j, v in enumerate(whole)
            if j != i and v is not None and len(v) == len(whole[i])
        ]
        out += [(query, r + 1, None if no else n, -s) for r, (s, no, n) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


def found(rows, data, every=4, k=3, scale=8, sizes=SMALL):
    df = rows(DDL, *[(*d, 1, "s", 5, 6) for d in data])
    return values(kdtree.top_k(df, F.col("vec_id") % every == 0, k, scale, sizes))


def test_against_brute_force_with_small_shards(rows):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(5, 6))
    data = [(i, [float(x) for x in centres[i % 5] * (1 + i % 3) + rng.normal(size=6) * 0.3]) for i in range(150)]
    assert found(rows, data) == brute_force(data, 4, 3, 8)


def test_copies_ties_and_repeated_ids(rows):
    same = [(i, [1.0, -2.0, 0.5]) for i in range(60)]  # one vector holds most rows, queries among them
    data = same + [(i, [0.5, 0.5, 0.5]) for i in range(3)] * 2 + [(8, [9.0, 1.0, 0.0]), (None, [9.0, 1.0, 0.0]), (None, [1.0, -2.0, 0.5])]
    assert found(rows, data, k=70) == brute_force(data, 4, 70, 8)  # more than there are others


def test_messy_vectors(rows):
    nan, inf = float("nan"), float("inf")
    wrong = [(4, None), (8, [1.0, None]), (12, [nan, 1.0]), (16, [inf, 1.0]), (20, [-inf, 0.0])]
    data = wrong + [(24, []), (28, []), (32, [1.0]), (36, [0.0, 0.0]), (40, [1.0, 1.0]), (41, [-1.0, -0.01]), (43, [2.0, 1.0])]
    beyond = [(44, [1e30, 0.0])]  # no score with it fits a long
    assert found(rows, data + beyond) == brute_force(data, 4, 3, 8)
    assert found(rows, []) == []
    assert found(rows, [(1, [1.0])]) == [] and found(rows, [(4, [1.0])]) == []


@pytest.mark.parametrize("size", [1, 10**4, 3 * 10**8])  # single, double, whole numbers
def test_scores_are_exact(size):
    rng = np.random.default_rng(3)
    points = rng.integers(-size, size + 1, (300, 4))
    tree, queries = kdtree.build(points, 8), points[:20]
    floor = np.full(20, kdtree.NO_SCORE)
    hits = kdtree.best_first(points[tree.order], tree.order, tree.order, tree.lo, tree.hi, 8, queries, floor, 6)
    for q in range(20):
        scores = [sum(int(a) * int(b) for a, b in zip(points[q], p)) for p in points]
        want = sorted(range(300), key=lambda j: (-scores[j], j))[:6]
        assert [(int(r[2]), int(r[1])) for r in hits[hits[:, 0] == q]] == [(j, scores[j]) for j in want]


def test_trees_hold_tight_boxes_and_prune():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-50, 50, (100, 3)) + c for c in ([0, 0, 0], [900, 0, 0], [0, 900, 0])])
    tree = kdtree.build(points, 16)
    depth = kdtree.depth_of(len(points), 16)
    for (a, b), lo, hi in zip(kdtree.spans_of(len(points), depth), tree.lo[-(1 << depth) :], tree.hi[-(1 << depth) :]):
        mine = points[tree.order[a:b]]
        assert (mine.min(0) == lo).all() and (mine.max(0) == hi).all() and len(mine) <= 16
    queries = np.array([[1, 0, 0], [0, 1, 0]])
    bounds = kdtree.box_bounds(queries, tree.lo, tree.hi)
    assert (bounds[:, 0] == (queries @ points.T).max(1)).all()
    floor = np.sort(queries @ points.T, axis=1)[:, -5]
    assert (bounds[:, -(1 << depth) :] < floor[:, None]).mean() > 0.5
    hits = kdtree.best_first(points[tree.order], tree.order, tree.order, tree.lo, tree.hi, 16, queries, floor, 5)
    assert all(sorted(hits[hits[:, 0] == q][:, 1]) == sorted(queries[q] @ points.T)[-5:] for q in (0, 1))
