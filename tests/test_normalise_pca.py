import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from clusterkit.operators.normalise import (
    apply_zscore, covariance, feature_width, fit_zscore, scale_vectors, vector_stats,
)
from clusterkit.operators.pca import apply_pca, fit_pca
from tests.fixtures import PCA_ROWS, blobs, features


@pytest.mark.parametrize("partitions", [1, 2, 4])
def test_sums_do_not_depend_on_partitions(spark, partitions):
    row = vector_stats(features(spark, [[1], [2], [3], [4]], partitions)).first()
    assert (row["sum"], row["sum_squares"], row["mean"]) == (10.0, 30.0, 2.5)
    assert row["std"] == pytest.approx(np.sqrt(1.25))


def test_zscore(spark):
    points = np.array(blobs(30))
    df = features(spark, points)
    got = np.array([r["features"] for r in apply_zscore(df, fit_zscore(df)).orderBy("id").collect()])
    assert got == pytest.approx((points - points.mean(0)) / points.std(0))


def test_constant_dimension_is_only_shifted(spark):
    df = features(spark, [[1.0, 5.0], [2.0, 5.0]])
    got = [r["features"] for r in apply_zscore(df, fit_zscore(df)).orderBy("id").collect()]
    assert got == [[-1.0, 0.0], [1.0, 0.0]]


def test_nan_becomes_zero_on_request(spark):
    df = features(spark, [[1.0, float("nan")], [3.0, 2.0]])
    params = fit_zscore(df)
    got = [r["features"] for r in apply_zscore(df, params, nan_to_zero=True).orderBy("id").collect()]
    assert got == [[-1.0, 0.0], [1.0, 0.0]]
    assert np.isnan(apply_zscore(df, params).orderBy("id").first()["features"][1])


def test_wide_rows_take_the_same_values(spark):
    points = np.random.default_rng(1).normal(size=(20, 90))
    points[:, 3] = 2.0
    df = features(spark, points)
    params = fit_zscore(df)
    expected = points - points.mean(0)
    varying = points.std(0) > 0
    expected[:, varying] /= points.std(0)[varying]
    got = np.array([r["features"] for r in apply_zscore(df, params).orderBy("id").collect()])
    assert got == pytest.approx(expected)


def test_scaled_vectors_keep_all_distances(spark):
    points = np.array(blobs(12))
    df = features(spark, points)
    params = fit_zscore(df)
    vectors = df.withColumn("features", array_to_vector("features"))
    assert feature_width(vectors) == 2
    scaled = np.array([r["features"].toArray() for r in scale_vectors(vectors, params).orderBy("id").collect()])
    z = (points - params.mean) / params.divisor
    assert scaled - scaled[0] == pytest.approx(z - z[0])


def test_empty_input(spark):
    assert fit_zscore(features(spark, [[1.0]]).where("id < 0")) is None


def test_covariance(spark):
    points = np.array(blobs(30))
    got = {(r["i"], r["j"]): r["covariance"] for r in covariance(features(spark, points)).collect()}
    expected = np.cov(points.T)
    assert got == pytest.approx({(0, 0): expected[0, 0], (0, 1): expected[0, 1], (1, 1): expected[1, 1]})


@pytest.mark.parametrize("width", [3, 70])
def test_statistics_of_wide_and_narrow_rows(spark, width):
    points = np.random.default_rng(width).normal(1000.0, 1.0, size=(40, width))
    df = features(spark, points)
    got = {(r["i"], r["j"]): r["covariance"] for r in covariance(df).collect()}
    expected = np.cov(points.T)
    assert len(got) == width * (width + 1) // 2
    assert all(c == pytest.approx(expected[i, j], rel=1e-9, abs=1e-9) for (i, j), c in got.items())
    stats = vector_stats(df).orderBy("dim").collect()
    assert [r["std"] for r in stats] == pytest.approx(points.std(0)) and [r["sum"] for r in stats] == pytest.approx(points.sum(0))


@pytest.mark.parametrize("width", [3, 70])
def test_nulls_mean_the_same_at_any_width(spark, width):
    good, hole = [float(i) for i in range(width)], [None, *[float(2 * i) for i in range(1, width)]]
    df = spark.createDataFrame([(0, good), (1, hole), (2, None), (3, [1.0])], "id int, features array<double>").coalesce(1)
    params = fit_zscore(df)
    assert params.count == 2 and np.isnan(params.mean[0]) and params.mean[1] == pytest.approx(1.5)
    scaled = {r["id"]: r["features"] for r in apply_zscore(df.where("id < 2"), params, nan_to_zero=True).collect()}
    assert scaled[0][0] == 0.0 and scaled[1][0] == 0.0 and scaled[1][1] == pytest.approx(1.0)


def test_pca_known_values(spark):
    df = features(spark, PCA_ROWS)
    projection = fit_pca(df, 2)
    points = np.array(PCA_ROWS)
    values, vectors = np.linalg.eigh(np.cov(points.T))
    top = vectors[:, ::-1][:, :2]
    top = top * np.sign((top * projection.components).sum(axis=0))  # a component's sign is free
    assert projection.components == pytest.approx(top, abs=1e-9)
    assert projection.explained_variance == pytest.approx(values[::-1][:2] / values.sum())
    rows = [r["features"] for r in apply_pca(df, projection).orderBy("id").collect()]
    assert np.array(rows) == pytest.approx(points @ top)


def test_more_components_than_features_are_clamped(spark):
    assert fit_pca(features(spark, PCA_ROWS), 6).components.shape == (5, 5)


def test_pca_rows_are_uncentered_products(spark):
    points = np.array(blobs(24))
    df = features(spark, points)
    projection = fit_pca(df, 1)
    got = np.array([r["features"] for r in apply_pca(df, projection).orderBy("id").collect()])
    assert got == pytest.approx(points @ projection.components)


def nan_rows(rng, count, width):
    """Rows of zeros and ones with two numbers in front; NaN in one number here and there."""
    x = (rng.random((count, width)) < 0.02).astype(float)
    x[:, 0], x[:, 1] = rng.normal(size=count), rng.normal(size=count) * 50 + 7
    return x


@pytest.mark.parametrize("width", [200, 300])
@pytest.mark.parametrize("fitted_on_nan", [True, False])
def test_nan_on_sparse_rows_is_the_zero_of_the_score(spark, width, fitted_on_nan):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(width)
    clean, dirty = nan_rows(rng, 60, width), nan_rows(rng, 60, width)
    dirty[::5, 1] = np.nan
    dirty[7, 0] = np.nan
    points = dirty if fitted_on_nan else clean
    arrays = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "id int, features array<double>")
    made = [(i, Vectors.dense(x) if i % 4 == 0 else Vectors.sparse(width, np.flatnonzero(x != 0), x[x != 0])) for i, x in enumerate(dirty)]
    params = fit_zscore(arrays)
    flat = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(dirty)], "id int, features array<double>")
    want = np.array([r["features"] for r in apply_zscore(flat, params, nan_to_zero=True).orderBy("id").collect()])
    scaled = scale_vectors(spark.createDataFrame(made, ["id", "features"]), params, nan_to_zero=True)
    got = np.array([r["features"].toArray() for r in scaled.orderBy("id").collect()])
    assert not np.isnan(got).any() and not np.isnan(want).any()
    for a in range(0, 60, 7):  # distances are those of the full score
        assert np.linalg.norm(got - got[a], axis=1) == pytest.approx(np.linalg.norm(want - want[a], axis=1), abs=1e-9)


def test_same_anomalies_on_either_side_of_the_array_width(spark, monkeypatch):
    """Rows with a NaN number are scored alike as arrays and as sparse vectors."""
    from clusterkit.plans import anomalies, features as plan_features
    from clusterkit.sources.records import RecordSpec

    spec = RecordSpec(names=("id", "x", "y", "kind"), numeric=(1, 2), categorical=(3,), label=0)
    rng = np.random.default_rng(6)
    lines = [f"r{i},{rng.normal():.4f},{'NaN' if i % 11 == 0 else f'{rng.normal():.4f}'},k{i % 9}" for i in range(150)]
    given = spark.createDataFrame([(line,) for line in lines], "value string")
    found = []
    for width in (256, 3):
        monkeypatch.setattr(plan_features, "MAX_ARRAY_WIDTH", width)
        rows = anomalies.pca_anomalies_job(given, spec, components=None, k=1, rank=20)
        found.append({r["value"].split(",")[0]: round(r["distance"], 6) for r in rows.collect()})
    assert len(found[0]) == 19 and found[0] == found[1]


# -- wide principal components


def wide_sparse(rng, count, width, factors):
    """Sparse rows along a few directions of falling weight."""
    directions = []
    for f in range(factors):
        d = np.zeros(width)
        d[rng.choice(width, 40, replace=False)] = rng.normal(size=40)
        directions.append(d / np.linalg.norm(d) * 10 * 0.6 ** f)
    return np.array([sum(rng.normal() * d for d in directions) for _ in range(count)])


@pytest.mark.parametrize("width, form", [(20_000, "vectors"), (300, "arrays")])
def test_wide_components_equal_those_of_numpy(spark, monkeypatch, width, form):
    from pyspark.ml.linalg import Vectors

    from clusterkit.operators import pca

    monkeypatch.setattr(pca, "MAX_PCA_WIDTH", 250)
    rng = np.random.default_rng(8)
    points = wide_sparse(rng, 90, width, 8)
    if form == "vectors":
        rows = [(i, Vectors.sparse(width, np.flatnonzero(x), x[np.flatnonzero(x)])) for i, x in enumerate(points)]
        df = spark.createDataFrame(rows, ["id", "features"]).repartition(3)
    else:
        df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "id int, features array<double>").repartition(3)
    model = pca.fit_pca(df, 5)
    centered = points - points.mean(axis=0)
    _, singular, right = np.linalg.svd(centered, full_matrices=False)
    want = pca._turned(right[:5].T)
    assert isinstance(model, pca.WideProjection)
    assert model.components == pytest.approx(want, abs=1e-6)
    assert model.explained_variance == pytest.approx((singular ** 2 / (singular ** 2).sum())[:5])
    got = np.array([r["features"] for r in pca.apply_pca(df, model).orderBy("id").collect()])
    assert got == pytest.approx(points @ want, abs=1e-5)
