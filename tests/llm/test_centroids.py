from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from waybill.llm import centroids

FIELDS = "vec_id long, embedding array<float>, label int"


def brute(rows, k, rounds, length=4):
    """(id, cluster, distance) of all kept rows, by plain integers."""
    kept = []
    for vec_id, vec in rows:
        if vec is not None and len(vec) == length and all(x is not None and np.isfinite(x) for x in vec):
            kept.append((vec_id, [int(np.floor(centroids.SCALE * float(x))) for x in vec]))
    draw = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(kept, key=draw)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            mine = [v for (_, v), o in zip(kept, of) if o == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return sorted((str(i), nearest(v)[1], nearest(v)[0]) for i, v in kept), centres


def found(spark, space, rows, fields="vec_id long, embedding array<double>", **named):
    out, last, _, _ = centroids.cluster(spark.createDataFrame(rows, fields), space, length=4, **named)
    return sorted((str(r.id), r.cluster, r.distance) for r in out.collect()), last.tolist()


@pytest.mark.parametrize("spread", [1.0, 0.02, 900.0, 40_000.0])
def test_rounds_by_brute_force(spark, space, spread):
    rng = random.Random(5)
    middle = [[rng.uniform(-spread, spread) for _ in range(4)] for _ in range(9)]
    rows = [(i, [x + rng.gauss(0, spread / 9) for x in rng.choice(middle)]) for i in range(700)]
    rows += [(700 + i, rows[0][1]) for i in range(350)]
    for rounds in (0, 1, 6):
        assert found(spark, space, rows, centroids=12, rounds=rounds) == brute(rows, 12, rounds)


def test_ties_go_to_the_smaller_number(spark, space):
    rows = [(i, [float(i % 3), 0.0, 0.0, 0.0]) for i in range(60)]
    assert found(spark, space, rows, centroids=10) == brute(rows, 10, 5)


def test_odd_rows(spark, space):
    bad = float("nan"), float("inf")
    rows = [(i, [i / 7, 1.0, -2.0, float(i % 5)]) for i in range(30)]
    odd = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0] * 5), (5, [None, 1.0, 1.0, 1.0])]
    odd += [(6, [x, 0.0, 0.0, 0.0]) for x in bad] + [(None, [0.0] * 4), (None, [0.5] * 4), (7, [0.0] * 4)]
    got = found(spark, space, rows + odd + rows[:3], centroids=6)
    assert got == brute(rows + odd + rows[:3], 6, 5)
    assert found(spark, space, odd[:4], centroids=6) == ([], [])
    few = found(spark, space, rows[:2], centroids=6)
    assert few == brute(rows[:2], 6, 5) and len(few[1]) == 2
    assert found(spark, space, [], centroids=6) == ([], [])
    more = [(*r, 1, 2.0, [3], "x", 1) for r in rows]
    fields = "vec_id long, embedding array<double>, cluster int, upper double, sums array<int>, moved string, row long"
    assert found(spark, space, more, fields, centroids=6) == brute(rows, 6, 5)


def test_components_that_do_not_fit_are_an_error(spark, space):
    with pytest.raises(Exception, match="too large"):
        found(spark, space, [(1, [1e30, 0.0, 0.0, 0.0])], centroids=2)


def test_displacement_since_evaluation_and_exact_rescans():
    """A centroid that went away and came back loosens nothing; all others by where they are now."""
    rng = np.random.default_rng(4)
    far = np.array([[0, 0], [1000, 0], [0, 1000]])
    away = far + np.array([[0, 0], [5000, 0], [0, 0]])
    own = centroids.Bounds(np.array([far, away, far]))
    assert own.moved[0].tolist() == [0, 0, 0]
    x = rng.integers(-100, 100, (50, 2))
    nearest, upper, lower = centroids.Bounds(np.array([far])).rescan(x)
    zero = np.zeros(50, np.int64)
    state, scanned = own.assign(x, (nearest, upper, zero, lower, zero))
    assert scanned == 0 and (state[0] == nearest).all()
    _, scanned = centroids.Bounds(np.array([far, away])).assign(x, (nearest, upper, zero, lower, zero))
    assert scanned == 50


def test_bounds_skip_and_never_err():
    rng = np.random.default_rng(8)
    x = rng.integers(-2000, 2000, (3000, 8))
    history = [x[:20]]
    nearest, upper, lower = centroids.Bounds(np.array(history)).rescan(x)
    zero = np.zeros(len(x), np.int64)
    state, skipped = (nearest, upper, zero, lower, zero), 0
    for _ in range(9):
        means = [x[state[0] == j].mean(0) if (state[0] == j).any() else history[-1][j] for j in range(20)]
        history.append(np.floor(means).astype(np.int64))
        state, scanned = centroids.Bounds(np.array(history)).assign(x, state)
        skipped += len(x) - scanned
        exact = centroids.distances(x, history[-1])
        assert (state[0] == exact.argmin(1)).all()
    assert skipped > 0.3 * 9 * len(x)
