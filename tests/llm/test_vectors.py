"""Hard negatives and whitening beside brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from tests.llm.helpers import clashing
from tradepulse.llm import negatives, whitening

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("label", T.IntegerType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l) for i, v, l in rows], VECTORS)


def drawn(n, d, seed, labels=4, wide=1.0):
    pick = np.random.default_rng(seed)
    centres = pick.standard_normal((labels, d))
    label = pick.integers(0, labels, n)
    return [(int(i), (wide * (centres[label[i]] + pick.standard_normal(d))).round(3).tolist(), int(label[i])) for i in range(n)]


# -- hard negatives ------------------------------------------------------------------------

def usable(rows):
    return [(i, tuple(math.floor(256 * float(x)) for x in v), l) for i, v, l in rows
            if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def brute(anchors, rows, positives=5, wanted=10):
    out, rows = [], usable(rows)
    for anchor in dict.fromkeys(usable(anchors)):
        scored = [(-sum(a * b for a, b in zip(anchor[1], r[1])), r[0], r[2]) for r in rows if r != anchor and len(r[1]) == len(anchor[1])]
        same = sorted(s[:2] for s in scored if s[2] == anchor[2])[:positives]
        for minus, positive in same:
            hits = sorted(s[:2] for s in scored if s[2] != anchor[2] and 30 * -minus <= 100 * -s[0] <= 90 * -minus)[:wanted]
            out += [(anchor[0], positive, rank, i, -minus, -m) for rank, (m, i) in enumerate(hits, 1)]
    return sorted(out)


def mined(spark, anchors, rows, **more):
    got = negatives.mine(frame(spark, anchors), frame(spark, rows), **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("seed, d, wide", [(1, 3, 0.05), (2, 16, 1.0), (3, 2, 30.0)])
def test_negatives_like_brute_force(spark, monkeypatch, seed, d, wide):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 70)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 10)
    monkeypatch.setattr(negatives, "STRIP_ROWS", 8)
    monkeypatch.setattr(negatives, "AT_A_TIME", 4)
    rows = drawn(300, d, seed, wide=wide)
    want = brute(rows[::12], rows)
    assert want and mined(spark, rows[::12], rows) == want


def test_cells_of_the_grid_are_not_broadcast(spark):
    """The planner takes the copies of the blocks to be as few as the blocks; sent to the driver they would fill it."""
    rows = frame(spark, drawn(60, 3, 4))
    plan = negatives.mine(rows.where("vec_id % 10 = 0"), rows)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "BroadcastExchange" not in plan


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [*drawn(60, 2, 5), *drawn(60, 2, 6)[:20], (5, None, 1), (6, [None, 1.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 2), (9, [1.0, 1.0], None),
            (None, [1.0, 1.0], 1), (300, [], 1), (301, [0.0, 0.0], 1), (302, [1.0], 2), (303, [1.0], 2), (304, [0.5], 1), (305, [0.5], 1),
            *[(400 + i, [1.0, 1.0], 1) for i in range(30)], *[(500 + i, [0.5, 0.5], 2) for i in range(30)]]
    anchors = [r for r in rows if r[0] is not None and r[0] % 5 == 0]
    want = brute(anchors, rows)
    assert mined(spark, [*anchors, anchors[3]], rows) == want
    both = clashing(frame(spark, rows))
    assert sorted(map(tuple, negatives.mine(both.where("vec_id % 5 = 0"), both.drop("id")).collect())) == want
    assert mined(spark, [], rows) == mined(spark, anchors, []) == []


def test_negatives_of_great_numbers(spark):
    """Scores beyond a double's 53 bits are compared as integers."""
    rows = [(0, [3e6, 1.0], 1), (1, [3e6, 5.0], 1), (2, [3e6, 4.99], 1), *[(10 + i, [1.5e6, i / 256], 2) for i in range(30)]]
    assert mined(spark, rows[:1], rows) == brute(rows[:1], rows)


@pytest.mark.parametrize("seed", range(4))
def test_bounds_hold_every_score(seed):
    pick = np.random.default_rng(seed)
    a, x = (np.floor(256 * pick.standard_normal((n, 5)) * 10.0 ** pick.integers(-2, 6, (n, 1))) for n in (40, 64))
    a[0] = x[0] = 0
    x[1:5] = a[1] * np.array([[1], [2], [-1], [3]])
    (na, aa), (nx, ax) = negatives.angles(a), negatives.angles(x)
    norms = np.array([(nx[i:i + 8].min(), nx[i:i + 8].max()) for i in range(0, 64, 8)])
    lows, highs = (np.array([f(ax[i:i + 8], axis=0) for i in range(0, 64, 8)]) for f in (np.min, np.max))
    low, high = negatives.score_bounds(na, aa, norms, lows, highs)
    exact = (a @ x.T).reshape(40, 8, 8)
    assert (low[:, :, None] <= exact).all() and (exact <= high[:, :, None]).all()


def test_strips_out_of_the_window_are_not_scored(monkeypatch):
    """Rows opposite to the anchor cannot reach a positive window, by their angles alone."""
    near, far = [(i, [1.0, i / 100], 2) for i in range(20)], [(100 + i, [-1.0, i / 100], 2) for i in range(20)]
    rows = usable([*near, *far])
    x = np.array([r[1] for r in rows], float)
    norm, angle = negatives.angles(x)
    side = lambda at: negatives.Side({"ids": [rows[i][0] for i in at], "labels": [rows[i][2] for i in at], "dim": 2, "data": x[at].tobytes(),
                                      "norms": norm[at].tobytes(), "angles": angle[at].tobytes()}, "")
    anchor = negatives.Side({"ids": [1000], "labels": [1], "dim": 2, "data": np.array([256.0, 0.0]).tobytes(),
                             **dict(zip(("norms", "angles"), (v.tobytes() for v in negatives.angles(np.array([[256.0, 0.0]])))))}, "")
    scored = []
    monkeypatch.setattr(negatives, "STRIP_ROWS", 20)
    monkeypatch.setattr(negatives, "ROUND", 1)
    monkeypatch.setattr(negatives, "scores", lambda q, c: scored.append(len(c)) or q @ c.T)
    got = list(negatives._searched(anchor, side(np.arange(40)), False, [[negatives.tenths(80_000)]], 10))
    assert scored == [20] and {i for _, _, i, _ in got} <= set(range(20)) and len(got) == 10


# -- whitening -------------------------------------------------------------------------------

def exact(rows):
    x = {i: [math.floor(1024 * c) + 100_000 for c in v] for i, v, _ in rows}
    n, sums = len(x), [sum(c) for c in zip(*x.values())]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x.values()])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return list(x), n, deviation, centred, values[::-1], vectors[:, ::-1]


@pytest.mark.parametrize("n, d, seed", [(400, 40, 1), (300, 6, 2), (90, 70, 3)])
def test_whitening_like_brute_force(spark, n, d, seed):
    rows = drawn(n, d, seed)
    ids, n, deviation, centred, values, vectors = exact(rows)
    got = whitening.whiten(frame(spark, rows).repartition(5)).collect()
    k = min(8, d)
    assert len(got) == n * k and {r.n for r in got} == {n}
    assert {(r.id, int(r.deviation)) for r in got} == set(deviation.items())
    table = {(r.id, r.component): r for r in got}
    whole = np.array([[table[i, c].whitened for c in range(1, k + 1)] for i in ids])
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    sign = np.sign((whole * want).sum(axis=0))
    assert np.abs(whole * sign - want).max() < 1e-8
    assert np.abs(np.array([table[ids[0], c].explained for c in range(1, k + 1)]) - values[:k] / values.sum()).max() < 1e-12
    error = {r.identity_error for r in got}
    assert len(error) == 1 and 0 <= error.pop() < 1e-10


class Dense:
    def __init__(self, x):
        self.x, self.passes = x - x.mean(axis=0), 0

    def times(self, q):
        self.passes += 1
        return self.x.T @ (self.x @ q) / len(self.x)


def spectra():
    pick = np.random.default_rng(4)
    e = np.eye(100)
    yield "flat", pick.standard_normal((2000, 150))
    yield "falling", pick.standard_normal((2000, 200)) * np.exp(-np.arange(200) / 10)
    yield "one great", np.hstack([1e4 * pick.standard_normal((2000, 1)), pick.standard_normal((2000, 99))])
    yield "zero dimensions", np.hstack([pick.standard_normal((2000, 30)), np.zeros((2000, 70))])
    yield "low rank", pick.standard_normal((2000, 3)) @ pick.standard_normal((3, 100))
    yield "all equal", np.vstack([e, -e])
    yield "nine equal", np.vstack([e, -e, 3 * e[:9], -3 * e[:9]])


@pytest.mark.parametrize("name, x", list(spectra()), ids=lambda v: v if isinstance(v, str) else "")
def test_leading_eigenpairs(name, x):
    v = np.cov(x.T, bias=True)
    found = whitening.leading(Dense(x), x.shape[1], 8, np.trace(v))
    want = np.linalg.eigvalsh(v)[::-1][:8]
    assert np.abs(found.values - want).max() <= 1e-12 * want[0]
    assert np.abs(found.vectors.T @ found.vectors - np.eye(8)).max() < 1e-12
    assert np.abs(v @ found.vectors - found.vectors * found.values).max() <= 1e-11 * want[0]


def test_whitening_of_odd_rows(spark):
    rows = drawn(60, 3, 7)
    odd = [(1, None, 1), (2, [None, 1.0, 1.0], 1), (3, [float("nan")] * 3, 1), (4, [1.0, float("inf"), 0.0], 1), (5, [], 1), (6, [1.0], 1)]
    want = whitening.whiten(frame(spark, rows)).count()
    got = whitening.whiten(clashing(frame(spark, [*rows, *odd])).drop("id"))
    assert got.count() == want == 180
    twice = whitening.whiten(frame(spark, [*rows, rows[0], (None, rows[1][1], None)])).collect()
    assert len(twice) == 62 * 3 and {r.n for r in twice} == {62}
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, rows[:1])).count() == 0
    assert whitening.whiten(frame(spark, [rows[0]] * 20)).count() == 0
    # a plane in space has two components
    flat = [(i, [v[0], v[1], 0.0], l) for i, v, l in rows]
    assert {r.component for r in whitening.whiten(frame(spark, flat)).collect()} == {1, 2}


def test_whitening_of_great_numbers(spark):
    """Entries whose squares no machine word holds stay exact."""
    rows = [(i, [float(i * 10 ** 9), float(i % 3)], 0) for i in range(40)]
    _, n, deviation, *_ = exact(rows)
    assert {(r.id, int(r.deviation)) for r in whitening.whiten(frame(spark, rows)).collect()} == set(deviation.items())
