"""Hard negatives against brute force, and what the tree's bounds spare."""

import math

import numpy as np
from pyspark.sql import functions as F

from strandflow.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score long, key string"


def plain(rows, positives=5, negatives=10):
    """(anchor, positive, rank, negative, both scores), rows being distinct (id, vector, label)."""
    good = {(i, tuple(v), label) for i, v, label in rows if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)}
    ints = {r: [math.floor(256 * x) for x in r[1]] for r in good}
    out = []
    for a in good:
        if a[0] % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(ints[a], ints[b], strict=True)), b[0], b) for b in good if b != a and len(b[1]) == len(a[1]))
        best = [x for x in scored if x[2][2] == a[2]][:positives]
        for p in best:
            lowest, highest = 30 * -p[0], 90 * -p[0]
            held = [x for x in scored if x[2][2] != a[2] and lowest <= -100 * x[0] <= highest][:negatives]
            out += [(a[0], p[1], k + 1, n[1], -p[0], -n[0]) for k, n in enumerate(held)]
    return sorted(out)


def mined(spark, rows, **k):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hn.mine(df.repartition(3), F.col("vec_id") % 100 == 0, **k).collect())


def made(n, dims, seed, centres=6, spread=0.2):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, dims))
    own = rng.integers(0, centres, n)
    v = (middle[own] + spread * rng.standard_normal((n, dims))).astype(np.float32)
    labels = np.where(rng.random(n) < 0.6, own % 4, rng.integers(0, 4, n))
    return [(int(i) * 5, [float(x) for x in v[i]], int(labels[i])) for i in range(n)]


def test_equal_to_brute_force_with_odd_rows(spark):
    rows = made(700, 6, 1)
    hot = rows[0][1]
    rows += [(10_000 + i, hot, i % 3) for i in range(300)]  # a third of one vector: only ids tell them apart
    rows += [rows[20], rows[20], rows[40], (rows[20][0], rows[41][1], 2)]  # repeated rows, and an id of two vectors
    nan, inf = float("nan"), float("inf")
    rows += [(None, hot, 1), (1, None, 1), (100, hot, None), (200, [nan] * 6, 1), (300, [None] * 6, 1), (2, [inf] * 6, 1)]
    rows += [(400, [0.0] * 6, 1), (3, [0.5, 0.25], 1), (500, [0.5, 0.5], 1), (7, [0.25, 0.5], 2), (8, [0.2, 0.1], 2), (600, [], 1), (9, [], 1), (12, [], 2)]
    got = mined(spark, rows)
    assert got == plain(rows) and len(got) > 500


def test_many_groups_and_parts_meet(spark, monkeypatch):
    for name, value in (("GROUP", 4), ("GROUPS_PER_TASK", 2), ("CHUNK_ROWS", 150)):
        monkeypatch.setattr(hn, name, value)
    rows = [(i * 4, v, label) for (i, v, label) in ((k, *r[1:]) for k, r in enumerate(made(800, 5, 2)))]
    assert mined(spark, rows, positives=3, negatives=4) == plain(rows, 3, 4)


def test_large_components_are_added_up_as_integers(spark):
    rng = np.random.default_rng(4)
    rows = [(i * 20, [float(x) for x in (rng.standard_normal(4) * 20_000).astype(np.float32)], int(i % 3)) for i in range(60)]
    assert mined(spark, rows) == plain(rows) != []


def test_nothing_to_mine(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1)]) == [] and mined(spark, [(100, [1.0], 1), (1, [1.0], 1)]) == []


def test_the_tree_spans_and_its_bounds_spare_scores():
    v = np.floor(256 * np.array([r[1] for r in made(400, 8, 3, spread=0.02)]))
    order, parents, edges = hn.spanning_tree(v[:60])
    assert sorted(order) == list(range(60)) and all(p < i for i, p in enumerate(parents)) and (parents == -1).any()
    tree = {"ids": np.arange(60), "keys": np.zeros(60, int), "labels": np.zeros(60, int), "vectors": v[:60][order], "parents": parents, "edges": edges}
    for i, (p, e) in enumerate(zip(parents, edges, strict=True)):
        from_parent = tree["vectors"][i] - (tree["vectors"][p] if p >= 0 else 0)
        assert abs(np.sqrt((from_parent**2).sum()) - e) < 1e-6
    walk = hn.Positives([tree], 5)
    for at in range(0, 400, 50):
        ids = np.arange(1000 + at, 1050 + at)
        walk.block({"ids": ids, "keys": ids, "labels": np.zeros(50, int), "vectors": v[at : at + 50]}, True)
    assert walk.scored < 0.6 * walk.seen
    best = -np.sort(-(v @ tree["vectors"].T), axis=0)[:5].T
    assert all((walk.held[0, j][0] == best[j]).all() for j in range(60))
