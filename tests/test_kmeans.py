import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from clusterkit.functions.vectors import euclidean
from clusterkit.operators import kmeans
from clusterkit.operators.kmeans import (
    Clustering, assign, assign_runs, centers_table, estimate_k, fit, fit_best_of_ten, lloyd,
    lloyd_runs, run_totals, with_center,
)
from tests.fixtures import blobs, features


def brute(points, centers):
    gaps = ((points[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
    return gaps.argmin(axis=1), np.sqrt(gaps.min(axis=1))


def brute_lloyd(points, centers, iterations):
    for _ in range(iterations):
        cluster, _ = brute(points, centers)
        centers = np.array([
            points[cluster == i].mean(axis=0) if (cluster == i).any() else c for i, c in enumerate(centers)
        ])
    return centers


@pytest.mark.parametrize("n,k", [(0, 0), (1, 0), (2, 1), (6, 1), (10, 2), (150, 8), (500, 15)])
def test_rule_of_thumb(spark, n, k):
    assert estimate_k(spark.range(n)) == k


@pytest.fixture(params=["unrolled", "arrow"])
def form(request, monkeypatch):
    if request.param == "arrow":
        monkeypatch.setattr(kmeans, "MAX_UNROLLED_CELLS", 0)
    return request.param


def test_assignment_equals_brute_force(spark, form):
    points, centers = np.array(blobs()), np.array([[0.2, 0.1], [9.0, 1.0], [1.0, 9.0], [5.0, 5.0]])
    rows = assign(features(spark, points), Clustering(centers)).orderBy("id").collect()
    cluster, distance = brute(points, centers)
    assert [r["cluster"] for r in rows] == cluster.tolist()
    assert [r["distance"] for r in rows] == pytest.approx(distance)


def test_lower_id_wins_a_tie(spark, form):
    df = features(spark, [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]])
    model = Clustering(np.array([[2.0, 0.0], [0.0, 0.0], [2.0, 0.0], [0.0, 0.0]]))
    assert [r["cluster"] for r in assign(df, model).orderBy("id").collect()] == [0, 1, 1]


def test_fixed_start_fit_equals_brute_force(spark, form):
    points, start = np.array(blobs()), np.array([[1.0, 1.0], [2.0, 0.0], [0.0, 2.0], [50.0, 50.0]])
    model = lloyd(features(spark, points), start, iterations=4)
    assert model.centers == pytest.approx(brute_lloyd(points, start, 4))
    assert model.weights.tolist()[3] == 0 and model.centers[3].tolist() == [50.0, 50.0]


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_fit_does_not_depend_on_partitions(spark, form, partitions):
    start = np.array([[1.0, 1.0], [2.0, 0.0], [0.0, 2.0]])
    model = lloyd(features(spark, blobs(), partitions), start, iterations=3)
    assert model.centers == pytest.approx(brute_lloyd(np.array(blobs()), start, 3))


def test_runs_share_scans_and_keep_apart(spark, form):
    points = np.array(blobs())
    starts = {1: np.array([[4.0, 4.0]]), 3: np.array([[1.0, 1.0], [2.0, 0.0], [0.0, 2.0]])}
    models = lloyd_runs(features(spark, points), starts, iterations=3)
    for run, start in starts.items():
        assert models[run].centers == pytest.approx(brute_lloyd(points, start, 3))
    rows = assign_runs(features(spark, points), models).collect()
    assert len(rows) == 2 * len(points) and {r["run"] for r in rows} == {1, 3}


def test_totals(spark, form):
    points, centers = np.array(blobs()), np.array([[0.0, 0.0], [10.0, 0.0], [99.0, 99.0]])
    totals = run_totals(features(spark, points), {5: centers})[5]
    cluster, distance = brute(points, centers)
    assert totals.count.tolist() == np.bincount(cluster, minlength=3).tolist()
    assert totals.mean_distance == pytest.approx(distance.mean())
    assert totals.squared.sum() == pytest.approx((distance ** 2).sum())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-9, 9), st.integers(-9, 9)), min_size=1, max_size=30), st.integers(1, 5))
def test_both_forms_agree_on_lattice_points(spark, points, k):
    """Lattice points are full of exact ties."""
    centers = np.array([[float((i * 5) % 7 - 3), float((i * 3) % 5 - 2)] for i in range(k)])
    df = features(spark, points, 2)
    cluster, distance = brute(np.array(points, dtype=float), centers)
    for limit in (96, 0):
        before, kmeans.MAX_UNROLLED_CELLS = kmeans.MAX_UNROLLED_CELLS, limit
        try:
            rows = assign(df, Clustering(centers)).orderBy("id").collect()
        finally:
            kmeans.MAX_UNROLLED_CELLS = before
        assert [r["cluster"] for r in rows] == cluster.tolist()
        assert [r["distance"] for r in rows] == pytest.approx(distance)


def test_far_from_the_origin(spark, monkeypatch):
    """The matrix product loses digits here; close calls are measured again."""
    monkeypatch.setattr(kmeans, "MAX_UNROLLED_CELLS", 0)
    points = np.array(blobs()) + 1e9
    centers = np.array([[0.0, 0.0], [0.2, 0.0], [0.0, 0.2], [10.0, 0.0]]) + 1e9
    rows = assign(features(spark, points), Clustering(centers)).orderBy("id").collect()
    assert [r["cluster"] for r in rows] == brute(points, centers)[0].tolist()


def test_one_cluster_is_the_mean(spark):
    model = fit(features(spark, blobs()), 1)
    assert model.centers[0] == pytest.approx(np.mean(blobs(), axis=0)) and model.weights[0] == 240


def test_no_cluster_and_no_rows(spark):
    df = features(spark, blobs())
    assert fit(df, 0) is None
    assert fit(df.where("id < 0"), 2) is None
    assert fit(df.where("id < 0"), 1) is None


def test_seeded_fit_finds_the_groups(spark):
    df = features(spark, blobs())
    model = fit_best_of_ten(df, 3)
    assert sorted(model.weights.tolist()) == [80, 80, 80]
    one = fit(df, 3)
    assert model.cost <= one.cost + 1e-9


def test_best_of_given_starts(spark):
    bad = [[5.0, 5.0], [60.0, 60.0], [70.0, 70.0]]
    good = [[0.0, 0.0], [10.0, 0.0], [0.0, 10.0]]
    model = fit(features(spark, blobs()), init=[bad, good], iterations=3)
    assert model.centers == pytest.approx(brute_lloyd(np.array(blobs()), np.array(good), 3))
    assert model.cost == pytest.approx((brute(np.array(blobs()), model.centers)[1] ** 2).sum())


def test_sparse_vectors(spark):
    df = features(spark, blobs()).withColumn("features", array_to_vector("features"))
    model = fit(df, 3, seed=1)
    expected = brute(np.array(blobs()), model.centers)
    for m in (model, Clustering(model.centers)):
        rows = assign(df, m).orderBy("id").collect()
        assert [r["cluster"] for r in rows] == expected[0].tolist()
        assert [r["distance"] for r in rows] == pytest.approx(expected[1])


def test_join_to_the_assigned_center(spark):
    model = Clustering(np.array([[0.0, 0.0], [10.0, 0.0], [0.0, 10.0]]))
    joined = with_center(assign(features(spark, blobs()), model), model)
    wrong = joined.where(F.abs(euclidean(F.col("features"), F.col("center")) - F.col("distance")) > 1e-12)
    assert joined.count() == 240 and wrong.count() == 0
    assert centers_table(spark, model).count() == 3


def test_a_model_too_large_for_a_task_is_refused(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "MAX_MODEL_CELLS", 3)
    with pytest.raises(ValueError):
        assign(features(spark, [[1.0, 2.0]]), Clustering(np.zeros((2, 2))))


BAD_ROWS = [(0, [0.0, 0.0]), (1, [10.0, 10.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [1.0]),
            (6, [1.0, 2.0, 3.0]), (7, [])]


@pytest.mark.parametrize("copies", [1, 60])
def test_unusable_rows_are_in_no_cluster_in_either_form(spark, copies):
    df = spark.createDataFrame(BAD_ROWS, "id int, features array<double>").repartition(2)
    # Centers far away only make the model large enough for the other form.
    centers = np.array([[0.0, 0.0], [9.0, 9.0], *[[1e6 + i, 1e6] for i in range(copies)]])
    assert kmeans._unrolls({0: centers}) == (copies == 1)
    got = {r["id"]: (r["cluster"], r["distance"]) for r in assign(df, Clustering(centers)).collect()}
    assert got[0] == (0, 0.0) and got[1] == (1, pytest.approx(2 ** 0.5))
    assert all(got[i] == (None, None) for i in range(2, 8))
    totals = kmeans.run_totals(df, {0: centers})[0]
    assert totals.count.tolist()[:2] == [1, 1] and totals.count.sum() == 2 and not np.isnan(totals.total).any()


def test_weights_are_those_of_the_centers_returned(spark):
    df = features(spark, blobs(90))
    model = lloyd(df, [[0.0, 0.0], [1.0, 1.0], [2.0, 0.0]], iterations=2)
    rows = [r["cluster"] for r in assign(df, model).collect()]
    assert model.weights.tolist() == [rows.count(k) for k in range(3)]


def test_sparse_rows_are_measured_as_they_are(spark):
    from pyspark.ml.linalg import Vectors

    points = [Vectors.sparse(5, [1, 3], [2.0, -1.0]), Vectors.dense([1.0, 0.0, 0.0, 4.0, 0.0]), Vectors.sparse(5, [], [])]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(points)], ["id", "features"])
    centers = np.array([[0.0, 2.0, 0.0, 0.0, 0.0], [1.0, 0.0, 0.0, 3.0, 0.0]])
    got = {r["id"]: (r["cluster"], r["distance"]) for r in assign(df, Clustering(centers)).collect()}
    gaps = np.array([[np.linalg.norm(p.toArray() - c) for c in centers] for p in points])
    assert got == {i: (int(g.argmin()), pytest.approx(g.min())) for i, g in enumerate(gaps)}


def test_many_centers_are_met_in_tiles(spark):
    rng = np.random.default_rng(2)
    points, centers = rng.normal(size=(600, 30)), rng.normal(size=(5000, 30))
    centers[4000:4010] = centers[:10]  # ties across tiles: the lower id
    points[:10] = centers[:10]
    rows = assign(features(spark, points.tolist()), Clustering(centers)).orderBy("id").collect()
    gaps = [((centers - p) ** 2).sum(axis=1) for p in points]
    assert [r["cluster"] for r in rows] == [int(g.argmin()) for g in gaps]
    assert [r["distance"] for r in rows] == pytest.approx([float(np.sqrt(g.min())) for g in gaps], abs=1e-7)


def sparse_rows(rng, count, width):
    """Rows with few entries, some empty, some given in full; as vectors and as arrays."""
    from pyspark.ml.linalg import Vectors

    out = []
    for i in range(count):
        at = np.sort(rng.choice(width, rng.integers(0, 6), replace=False))
        x = np.zeros(width)
        x[at] = rng.normal(size=len(at)).round(2)
        out.append((i, Vectors.dense(x) if i % 7 == 0 else Vectors.sparse(width, at, x[at]), x))
    return out


@pytest.mark.parametrize("k", [1, 4, 9])
def test_sparse_fit_from_given_starts_equals_the_dense_one(spark, k):
    rows = sparse_rows(np.random.default_rng(3), 120, 40)
    start = np.array([r[2] for r in rows[1:k + 1]])
    vectors = spark.createDataFrame([(i, v) for i, v, _ in rows], ["id", "features"]).repartition(3)
    model = fit(vectors, k, init=start, iterations=4, tolerance=0.0)
    points = np.array([x for *_, x in rows])
    assert model.centers == pytest.approx(brute_lloyd(points, start, 4))
    assert model.cost == pytest.approx((brute(points, model.centers)[1] ** 2).sum())


def test_wide_sparse_rows_fit_from_given_starts(spark):
    rows = sparse_rows(np.random.default_rng(4), 60, 10_000)
    points = np.array([x for *_, x in rows])
    vectors = spark.createDataFrame([(i, v) for i, v, _ in rows], ["id", "features"]).repartition(2)
    model = fit(vectors, 3, init=points[:3], iterations=3, tolerance=0.0)
    assert model.centers == pytest.approx(brute_lloyd(points, points[:3], 3))
    dense = fit(features(spark, points.tolist()), 3, init=points[:3], iterations=3, tolerance=0.0)
    assert dense.centers == pytest.approx(model.centers)


# -- seeding


def noisy(count=400, width=3):
    rng = np.random.default_rng(9)
    return rng.normal(size=(count, width)).round(3).tolist()


def test_seeded_fits_do_not_depend_on_how_rows_are_dealt(spark):
    points = noisy()
    models = [fit(features(spark, order, n), 7, restarts=3, seed=2) for order, n in ((points, 1), (points[::-1], 5))]
    assert models[0].centers == pytest.approx(models[1].centers) and models[0].weights.tolist() == models[1].weights.tolist()
    other = fit(features(spark, points), 7, seed=11)
    assert sorted(other.centers[:, 0]) != pytest.approx(sorted(models[0].centers[:, 0]))


def test_repeated_rows_weigh_as_often_as_they_occur(spark):
    """Three spots hold nearly all rows: each gets a center, though each is one different row."""
    points = [[0.0, 0.0]] * 300 + [[100.0, 0.0]] * 300 + [[0.0, 100.0]] * 300 + [[50.0 + 0.01 * i, 50.0] for i in range(40)]
    model = fit(features(spark, points), 4, restarts=3)
    assert sorted(model.weights.tolist()) == [40, 300, 300, 300]
    spots = {tuple(np.round(c, 6)) for c in model.centers}
    assert {(0.0, 0.0), (100.0, 0.0), (0.0, 100.0)} < spots


def test_fewer_different_rows_than_clusters(spark):
    model = fit(features(spark, [[1.0, 2.0]] * 5 + [[3.0, 4.0]] * 2), 6)
    assert sorted(model.weights.tolist()) == [2, 5] and model.cost == 0.0


def test_all_k_and_restarts_share_the_scans(spark, monkeypatch):
    from clusterkit.operators import seeding
    from clusterkit.operators.quality import fit_sweep

    scans = {"drawn": 0, "seed totals": 0, "totals": 0}

    def counted(name, call):
        def run(*args, **options):
            scans[name] += 1
            return call(*args, **options)

        return run

    monkeypatch.setattr(seeding, "_drawn", counted("drawn", seeding._drawn))
    monkeypatch.setattr(seeding, "run_totals", counted("seed totals", seeding.run_totals))
    monkeypatch.setattr(kmeans, "run_totals", counted("totals", kmeans.run_totals))
    models = fit_sweep(features(spark, noisy(150)), [1, 2, 3, 8], restarts=4, iterations=5)
    assert {k: m.k for k, m in models.items()} == {1: 1, 2: 2, 3: 3, 8: 8}
    assert scans == {"drawn": 1 + kmeans.SEEDING_STEPS, "seed totals": 1, "totals": 6}
    costs = [models[k].cost for k in (1, 2, 3, 8)]
    assert costs == sorted(costs, reverse=True)


def test_seeding_is_about_as_good_as_the_best_of_many_random_starts(spark):
    points = np.array(noisy(300, 2))
    rng = np.random.default_rng(1)
    plain = min((brute(points, brute_lloyd(points, points[rng.choice(300, 6, replace=False)], 20))[1] ** 2).sum() for _ in range(10))
    model = fit_best_of_ten(features(spark, points.tolist()), 6)
    assert model.cost <= plain * 1.03


def test_sparse_rows_are_seeded_like_dense_ones(spark):
    rows = sparse_rows(np.random.default_rng(5), 200, 12)
    vectors = spark.createDataFrame([(i, v) for i, v, _ in rows], ["id", "features"]).repartition(3)
    dense = features(spark, [x.tolist() for *_, x in rows])
    assert fit(vectors, 4, restarts=2).cost == pytest.approx(fit(dense, 4, restarts=2).cost, rel=0.2)


def test_runs_too_many_for_one_scan_are_grouped(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "GROUP_CELLS", 8)
    starts = {k: np.array(blobs()[:k]) for k in (1, 2, 3, 4)}
    assert kmeans._grouped(starts) == [[1, 2], [3], [4]]
    models = lloyd_runs(features(spark, blobs()), starts, iterations=2)
    for k, start in starts.items():
        assert models[k].centers == pytest.approx(brute_lloyd(np.array(blobs()), start, 2))
