"""Steps with carried bounds against plain steps."""

import numpy as np
import pytest

from clusterkit.operators import bounds, kmeans
from clusterkit.operators.bounds import bounded_lloyd
from clusterkit.operators.kmeans import lloyd_runs
from tests.fixtures import features
from tests.test_kmeans import brute, brute_lloyd, sparse_rows


def clouds(rng, count, groups, width):
    middle = rng.normal(size=(groups, width)) * 6
    return middle[rng.integers(0, groups, count)] + rng.normal(size=(count, width))


@pytest.mark.parametrize("kind", ["clouds", "lattice", "copies"])
def test_centers_equal_those_of_plain_steps(spark, monkeypatch, kind):
    monkeypatch.setattr(bounds, "CUT", 4)
    rng = np.random.default_rng(7)
    points = {"clouds": lambda: clouds(rng, 900, 12, 3), "lattice": lambda: rng.integers(0, 6, (700, 2)).astype(float),
              "copies": lambda: np.repeat(clouds(rng, 90, 5, 2), 8, axis=0)}[kind]()
    starts = {1: points[:1], 4: points[5:9], 40: points[rng.choice(len(points), 40, replace=False)]}
    got = bounded_lloyd(features(spark, points.tolist(), 5), starts, 11, 0.0)
    for run, start in starts.items():
        assert got[run] == pytest.approx(brute_lloyd(points, start, 11)), run


def test_sparse_rows_weights_and_bad_rows(spark):
    rng = np.random.default_rng(8)
    rows = sparse_rows(rng, 160, 30)
    points = np.array([x for *_, x in rows])
    vectors = spark.createDataFrame([(v, 1 + i % 3) for i, v, _ in rows], ["features", "weight"]).repartition(3)
    repeated = np.repeat(points, [1 + i % 3 for i in range(160)], axis=0)
    start = points[1:12]
    assert bounded_lloyd(vectors, {0: start}, 6, 0.0, weight="weight")[0] == pytest.approx(brute_lloyd(repeated, start, 6))
    bad = spark.createDataFrame([(p,) for p in points[:, :3].tolist()] + [(None,), ([1.0, float("nan"), 0.0],), ([1.0],)], "features array<double>")
    assert bounded_lloyd(bad, {0: start[:, :3]}, 4, 0.0)[0] == pytest.approx(brute_lloyd(points[:, :3], start[:, :3], 4))
    assert bounded_lloyd(bad.limit(0), {0: start[:, :3]}, 4, 0.0)[0] == pytest.approx(start[:, :3])


def test_most_distances_are_spared(spark):
    rng = np.random.default_rng(9)
    points = clouds(rng, 4000, 40, 3)
    taken: list[int] = []
    bounded_lloyd(features(spark, points.tolist(), 4), {0: points[rng.choice(4000, 60, replace=False)]}, 12, 0.0, measured=taken)
    assert taken[0] == 4000 * 60 and sum(taken[1:]) < 0.45 * 4000 * 60 * (len(taken) - 1)
    assert taken[-1] < taken[1] / 2


def test_runs_of_many_centers_carry_bounds(spark, monkeypatch):
    rng = np.random.default_rng(10)
    points = clouds(rng, 500, 9, 2)
    starts = {k: points[:k] for k in (3, 33, 50)}
    plain = {}
    for least in (2, 10_000):
        monkeypatch.setattr(kmeans, "BOUNDED_K", least)
        plain[least] = lloyd_runs(features(spark, points.tolist()), starts, iterations=9, tolerance=1e-3)
    for k in starts:
        a, b = plain[2][k], plain[10_000][k]
        assert a.centers == pytest.approx(b.centers) and a.weights.tolist() == b.weights.tolist() and a.cost == pytest.approx(b.cost)
        assert brute(points, a.centers)[1].sum() == pytest.approx(brute(points, b.centers)[1].sum())
