"""Packed rows that meet their centers in a tree, against plain distances."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from clusterkit.operators import pruning, quality
from clusterkit.operators.kmeans import Clustering, Packed, diagonal_start, lloyd_runs, prunes, run_totals
from clusterkit.operators.pruning import _finder, _nearest_rows
from clusterkit.operators.quality import label_entropy, run_entropies
from clusterkit.plans.batch import categorical_sweep_job, normalised_sweep_job
from clusterkit.sources.records import RecordSpec
from tests.fixtures import features, lines
from tests.test_bounds import clouds
from tests.test_kmeans import brute, brute_lloyd


def points(kind, rng, count=1500):
    if kind == "lattice":
        return rng.integers(0, 6, (count, 2)).astype(float)
    if kind == "copies":
        return np.repeat(clouds(rng, count // 4, 7, 3), 4, axis=0)  # a power of two: means of equal rows are exact
    if kind == "far":
        return clouds(rng, count, 12, 3) + [2e7, 0.0, -3e5]
    if kind == "wide":  # categories beside numbers, and columns that never vary
        types = np.eye(4)[rng.integers(0, 4, count)] * 3
        return np.hstack([clouds(rng, count, 8, 4).round(1), types, np.zeros((count, 2))])
    return clouds(rng, count, 12, 3)


KINDS = ["clouds", "lattice", "copies", "far", "wide"]


@pytest.mark.parametrize("kind", KINDS)
def test_nearest_rows_equal_plain_distances(kind):
    rng = np.random.default_rng(31)
    x = points(kind, rng)
    runs = [x[rng.choice(len(x), k, replace=False)] for k in (1, 2, 7, 40, 260)]
    runs.append(np.repeat(np.linspace(x.min(), x.max(), 150)[:, None], x.shape[1], axis=1))  # on a line
    found = dict(_nearest_rows(x.shape[1])(x, runs))
    for r, centers in enumerate(runs):
        assert found[r].tolist() == brute(x, centers)[0].tolist(), len(centers)


@pytest.mark.parametrize("kind", KINDS)
def test_fits_of_many_runs_equal_plain_steps(spark, kind):
    rng = np.random.default_rng(32)
    x = points(kind, rng, 900)
    starts = {k: x[rng.choice(len(x), k, replace=False)] for k in (1, 5, 33, 120, 150)}
    rows = features(spark, x.tolist(), 5)
    assert prunes(rows, sum(starts), x.shape[1], "features")
    got = lloyd_runs(rows, starts, 6)
    for k, start in starts.items():
        want = brute_lloyd(x, start, 6)
        cluster, distance = brute(x, want)
        assert got[k].centers == pytest.approx(want, rel=1e-9, abs=1e-7), k
        assert got[k].weights.tolist() == np.bincount(cluster, minlength=k).tolist()
        assert got[k].cost == pytest.approx((distance ** 2).sum())


def test_weights_bad_rows_and_no_rows(spark):
    rng = np.random.default_rng(33)
    x = clouds(rng, 400, 6, 3)
    times = 1 + np.arange(400) % 3
    rows = [(r, int(t)) for r, t in zip(x.tolist(), times)]
    rows += [(None, 1), ([1.0, float("nan"), 0.0], 2), ([1.0], 1), ([1.0, None, 2.0], 1)]
    df = spark.createDataFrame(rows, "features array<double>, weight bigint").repartition(4)
    runs = {0: x[:3], 1: x[40:340]}
    with pruning.packed(df, 3, weight="weight") as blocks:
        assert isinstance(blocks, Packed)
        for distances in (True, False):
            got = run_totals(blocks, runs, distances=distances)
            for run, centers in runs.items():
                cluster, distance = brute(x, centers)
                assert got[run].count.tolist() == np.bincount(cluster, times, len(centers)).tolist()
                want = np.array([(x * times[:, None])[cluster == c].sum(axis=0) for c in range(len(centers))])
                assert got[run].total == pytest.approx(want)
                if distances:
                    assert got[run].distance.sum() == pytest.approx((distance * times).sum())
                    assert got[run].squared == pytest.approx(np.bincount(cluster, distance ** 2 * times, len(centers)))
    none = lloyd_runs(df.limit(0).select("features"), {0: x[:300]}, 3)[0]
    assert none.centers == pytest.approx(x[:300]) and none.weights.sum() == 0


def test_one_row_repeated_goes_to_several_tasks(spark):
    df = spark.range(30_000).selectExpr("array(1D, 2D, if(id % 100 = 0, double(id), 3D)) AS features").repartition(4)
    with pruning.packed(df, 3) as blocks:
        each = [r["count"] for r in blocks.blocks.groupBy(F.spark_partition_id()).agg(F.sum("leaves").alias("count")).collect()]
        assert len(each) > 2 and max(each) < 0.6 * sum(each)


def test_most_distances_are_not_taken():
    rng = np.random.default_rng(34)
    x = rng.normal(size=(20_000, 3))
    sort, tree, search, *_ = _finder(3)
    pts, w, _ = sort(x)
    taken = []
    search(tree(pts, w), x[:400], np.array([0, 400]), lambda *settled: None, lambda leaf, run, ids, mine: taken.append(mine.size * ids.shape[1]))
    assert sum(taken) < 0.08 * 20_000 * 400


def test_entropies_of_many_centers(spark, monkeypatch):
    rng = np.random.default_rng(35)
    x = clouds(rng, 900, 8, 3)
    labels = [f"l{i}" if i % 3 else "abc"[i % 2] if i % 9 else None for i in range(900)]  # most of them once
    rows = [(label, p) for label, p in zip(labels, x.tolist())] + [("a", None), ("b", [1.0])]
    df = spark.createDataFrame(rows, "label string, features array<double>").repartition(4)
    models = {k: Clustering(x[rng.choice(900, k, replace=False)]) for k in (1, 4, 90, 200)}
    used = []
    monkeypatch.setattr(quality, "_nearest_rows", lambda width: used.append(width) or _nearest_rows(width))
    for split in (50, 10_000):
        got = run_entropies(df, models, split)
        for k, model in models.items():
            each = [(labels[i], int(c)) for i, c in enumerate(brute(x, model.centers)[0])]
            want = label_entropy(spark.createDataFrame(each, "label string, cluster int")).first()["score"]
            assert got[k] == pytest.approx(want, abs=1e-9), (split, k)
    assert used == [3, 3]


def test_every_k_of_a_normalised_sweep(spark, monkeypatch):
    rng = np.random.default_rng(36)
    x = clouds(rng, 300, 5, 3).round(3)
    spec = RecordSpec(names=("id", "a", "b", "c"), numeric=(1, 2, 3), categorical=(), label=0)
    texts = [f"r{i}," + ",".join(map(repr, row)) for i, row in enumerate(x.tolist())]
    used, pack = [], pruning.packed
    monkeypatch.setattr(pruning, "packed", lambda *args: used.append(args[1]) or pack(*args))
    ks = list(range(1, 26))
    got = {r["k"]: r["score"] for r in normalised_sweep_job(lines(spark, texts), spec, ks, lambda k: diagonal_start(k, 3), iterations=4).collect()}
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    for k in ks:
        assert got[k] == pytest.approx(brute(z, brute_lloyd(z, diagonal_start(k, 3), 4))[1].mean()), k
    assert used == [3]


def test_every_k_of_a_categorical_sweep(spark, monkeypatch):
    rng = np.random.default_rng(37)
    x, kind = clouds(rng, 300, 5, 3).round(3), rng.integers(0, 4, 300)
    spec = RecordSpec(names=("id", "kind", "a", "b", "c"), numeric=(2, 3, 4), categorical=(1,), label=0)
    texts = [f"r{i},{'wxyz'[t]}," + ",".join(map(repr, row)) for i, (t, row) in enumerate(zip(kind, x.tolist()))]
    used, pack = [], pruning.packed
    monkeypatch.setattr(pruning, "packed", lambda *args: used.append(args[1]) or pack(*args))
    ks = list(range(1, 26))
    got = {r["k"]: r["score"] for r in categorical_sweep_job(lines(spark, texts), spec, ks, lambda k: diagonal_start(k, 7), iterations=4).collect()}
    rows = np.hstack([x, np.eye(4)[kind]])
    z = (rows - rows.mean(axis=0)) / rows.std(axis=0)
    for k in ks:
        assert got[k] == pytest.approx(brute(z, brute_lloyd(z, diagonal_start(k, 7), 4))[1].mean()), k
    assert used == [7]
