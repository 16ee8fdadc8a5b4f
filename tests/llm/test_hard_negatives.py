import math
import random

import numpy as np
import pytest

from cabflow.llm import hard_negatives as m

SCHEMA = "vec_id long, embedding array<float>, label int, row string, dim string, cell string, parts string, pack string, score long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x", 1) for r in rows], SCHEMA)


def brute(rows):
    v = []
    for vec_id, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        v.append((vec_id, label, [math.floor(256 * float(np.float32(c))) for c in x]))
    out = []
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for a, la, xa in v:
        if a is None or a % 50:
            continue
        scored = [
            (sum(p * q for p, q in zip(xa, xb)), b, la == lb)
            for b, lb, xb in v
            if b != a and len(xa) == len(xb)
        ]
        positives = sorted((s for s in scored if s[2]), key=key)[:5]
        rest = sorted((s for s in scored if not s[2]), key=key)
        for ps, p, _ in positives:
            fit = [(s, n) for s, n, _ in rest if 50 * ps <= 100 * s <= 95 * ps][:3]
            out += [(a, p, i, n, ps, s) for i, (s, n) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def vectors(n, dim, seed, grain=None):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(10)]
    out = []
    for i in range(n):
        label = rng.randrange(10)
        x = [c + rng.gauss(0, 0.7) for c in centre[label]]
        out.append((i, [round(c * grain) / grain for c in x] if grain else x, label))
    return out


@pytest.mark.parametrize("grain", [None, 1])  # coarse components give many ties
def test_equals_brute_force(spark, grain):
    rows = vectors(700, 12, 3, grain)
    assert got(m.mine(table(spark, rows))) == brute(rows)


def test_small_cells_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(m, "LEAST_ROWS", 64)
    monkeypatch.setattr(m, "PACK", 4)
    monkeypatch.setattr(m, "STEP", 16)
    rows = vectors(900, 6, 5, 2)
    small = m.mine(table(spark, rows).repartition(5), row_bytes=6 * 8 * 90, anchor_bytes=6 * 8 * 5)
    assert got(small) == brute(rows)


def test_awkward_rows(spark):
    rows = vectors(260, 5, 9)
    rows += [(1000, None, 1), (1001, [1.0, None, 0.0, 0.0, 0.0], 2), (1050, [float("nan")] * 5, 2)]
    rows += [(1100, [float("inf")] * 5, 1), (1150, [0.0] * 5, 3), (1200, [], 4), (1201, [], 5), (1202, [], 4)]
    rows += [(1250, [1.0, 2.0], 6), (1251, [1.0, 1.0], 6), (1252, [0.5, 0.9], 7), (1300, [1.0] * 5, None)]
    rows += [(None, [1.0] * 5, 3), (None, [1.0] * 5, 3), (1350, [0.4] * 5, 3), (1350, [0.4] * 5, 3), (1351, [0.4] * 5, 3)]
    rows += [(i, [0.25] * 5, 8) for i in range(2000, 2120)]  # one vector many times
    assert got(m.mine(table(spark, rows))) == brute(rows)


def test_large_components_stay_exact(spark):
    big = 2.0**21  # products of 2**58
    rows = [(i, [big + i, -big + 2 * i, 3.0 * i], i % 3) for i in range(0, 160)]
    assert got(m.mine(table(spark, rows))) == brute(rows)


def test_empty_and_without_anchors(spark):
    assert m.mine(table(spark, [])).count() == 0
    assert m.mine(table(spark, [(1, [1.0], 1), (2, [1.0], 2)])).count() == 0
    assert m.mine(table(spark, [(50, [1.0], 1)])).count() == 0


def test_walk_ends_early_where_the_bound_allows(spark):
    """Members near their centre, rows far from it: the first step certifies the rest."""
    import pandas as pd

    rng = np.random.default_rng(1)
    close = rng.normal(0, 1, (60, 4)) + [400, 0, 0, 0]
    far = rng.normal(0, 1, (4000, 4)) * 5 + [-400, 0, 0, 0]
    parts = np.concatenate([close, far]).astype(np.int64)
    rows = pd.DataFrame({"vec_id": np.arange(len(parts)), "label": 1, "parts": list(parts)})
    block = m.Block(rows, 4)
    anchor = [(0, 4, 0, [0, 1], [0, 1], [1, 1], parts[:2].tobytes())]
    cluster = m.Cluster(pd.DataFrame(anchor, columns=["pack", "dim", "cluster", "rows", "ids", "labels", "parts"]), 4, block)
    need = np.full(2, 400 * 390.0)
    assert len(list(cluster.walk(np.array([0, 1]), lambda: need))) == 1
    found = m.best_of(cluster, np.array([0]), np.array([0]), np.array([m._NONE]), np.array([2**62]), True, 5)
    scores = sorted((-(parts[0] @ parts[i]), i) for i in range(1, len(parts)))[:5]
    assert [int(x) for x in found[0][1]] == [i for _, i in scores]
