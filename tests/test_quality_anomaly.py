import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterkit.operators.anomaly import Detector, farthest, fit_detector, rank_threshold
from clusterkit.operators.counts import cluster_label_counts
from clusterkit.operators.kmeans import Clustering, assign, diagonal_start, fit
from clusterkit.operators.quality import (
    k_grid, label_entropy, mean_distance, sweep_default_fit, sweep_label_entropy, sweep_mean_distance,
)
from clusterkit.plans.anomalies import fit_anomaly_model, pca_anomalies_job, top_anomalies_job
from clusterkit.plans.batch import (
    categorical_sweep_job, cross_tab_job, normalised_sweep_job, pca_entropy_job, raw_sweep_job,
)
from clusterkit.plans import features as feature_plans
from clusterkit.sources.records import TRADE_RECORD, RecordSpec
from tests.fixtures import TRADE_LINES, blobs, features, lines

SPEC = RecordSpec(names=("id", "kind", "x", "y"), numeric=(2, 3), categorical=(0, 1), label=0)


def blob_lines(spark, count=240):
    return lines(spark, [f"r{i},k{i % 3},{x},{y}" for i, (x, y) in enumerate(blobs(count))])


def labelled(spark, pairs):
    return spark.createDataFrame(pairs, "cluster int, label string").repartition(3)


def test_entropy_of_known_counts(spark):
    two = [(0, "a")] * 2 + [(0, "b")] * 2
    assert label_entropy(labelled(spark, two)).first()["score"] == pytest.approx(math.log(2))
    assert label_entropy(labelled(spark, [(0, "a")] * 4)).first()["score"] == pytest.approx(0)
    both = two + [(1, "a")] * 4
    assert label_entropy(labelled(spark, both)).first()["score"] == pytest.approx(0.346574, abs=1e-6)


def test_entropy_stays_within_its_bounds(spark):
    rows = [(i % 4, f"l{(i * i) % 5}") for i in range(200)]
    score = label_entropy(labelled(spark, rows)).first()["score"]
    assert 0 <= score <= math.log(5)


def test_cross_tab_is_sorted(spark):
    rows = cluster_label_counts(labelled(spark, [(1, "b"), (0, "b"), (1, "a"), (1, "b")])).collect()
    assert [tuple(r) for r in rows] == [(0, "b", 1), (1, "a", 1), (1, "b", 2)]


def test_k_grid():
    assert k_grid(0) == [] and k_grid(1) == [1] and k_grid(5) == [1, 2, 3, 4, 5]
    assert k_grid(600) == list(range(1, 601))
    assert k_grid(5, step=3) == [1, 4, 5] and k_grid(4, step=3) == [1, 4]


def test_score_of_one_cluster_is_the_distance_to_the_mean(spark):
    points = np.array(blobs())
    expected = np.sqrt(((points - points.mean(0)) ** 2).sum(1)).mean()
    df = features(spark, points)
    assert mean_distance(assign(df, fit(df, 1))).first()["score"] == pytest.approx(expected)
    assert sweep_mean_distance(df, [1]).first()["score"] == pytest.approx(expected)


def test_sweeps_fall_to_the_number_of_groups(spark):
    df = features(spark, blobs()).persist()
    fixed = {r["k"]: r["score"] for r in sweep_mean_distance(df, [1, 2, 3], lambda k: diagonal_start(k, 2, 0, 10)).collect()}
    seeded = {r["k"]: r["score"] for r in sweep_mean_distance(df, [1, 2, 3], restarts=3).collect()}
    default = {r["k"]: r["score"] for r in sweep_default_fit(df, [1, 2, 3]).collect()}
    assert set(fixed) == set(seeded) == set(default) == {1, 2, 3}
    assert seeded[1] > seeded[2] > seeded[3] and seeded[3] < 1
    assert fixed[1] == pytest.approx(seeded[1]) == pytest.approx(default[1])
    assert sweep_mean_distance(df, []).count() == 0


def test_entropy_sweep(spark):
    df = features(spark, blobs()).selectExpr("cast(id % 3 AS string) AS label", "features").persist()
    scores = {r["k"]: r["score"] for r in sweep_label_entropy(df, [1, 3], restarts=3).collect()}
    assert scores == pytest.approx({1: math.log(3), 3: 0.0})


@pytest.mark.parametrize("rows,above", [(240, 99), (100, 99), (40, 39)])
def test_threshold_is_the_hundredth_distance(spark, rows, above):
    """At most 99 training rows lie strictly above it; with fewer rows it is the smallest distance."""
    points = [[float(i)] for i in range(rows)]
    scored = assign(features(spark, points), Clustering(np.array([[-1.0]])))
    limit = rank_threshold(scored).first()["threshold"]
    assert limit == max(rows - 100, 0) + 1.0
    found = Detector(Clustering(np.array([[-1.0]])), limit).anomalies(features(spark, points))
    assert found.count() == above
    assert [r["id"] for r in farthest(scored, 3, "id").collect()] == [rows - 1, rows - 2, rows - 3]


def test_detector(spark):
    df = features(spark, blobs())
    seeded = fit_detector(df, 3, restarts=2)
    assert seeded.anomalies(df).count() <= 99
    assert seeded.score(df).count() == 240
    assert fit_detector(df, restarts=1).model.k == 10
    assert fit_detector(df.where("id < 0")) is None


def test_cross_tab_job(spark):
    job = cross_tab_job(blob_lines(spark), SPEC, init=[[0.0, 0.0], [10.0, 0.0]], label="kind")
    assert sum(r["count"] for r in job.counts.collect()) == 240
    assert job.centers.count() == 2
    assert job.last_fields.first()["count"] >= 1
    assert cross_tab_job(blob_lines(spark), SPEC).centers.count() == 2


def test_sweep_jobs(spark):
    given = blob_lines(spark)
    raw = raw_sweep_job(given, SPEC, ks=[1, 2], restarts=2).collect()
    assert {r["k"] for r in raw} == {1, 2} and all(r["score2"] > 0 for r in raw)
    for job, width in ((normalised_sweep_job, 2), (categorical_sweep_job, 5)):
        scores = {r["k"]: r["score"] for r in job(given, SPEC, ks=[1, 3], init=lambda k: diagonal_start(k, width)).collect()}
        assert 0 < scores[3] <= scores[1]
    small = lines(spark, ["A,k,4,1", "B,k,5,3", "C,k,6,2", "D,k,7,4", "E,k,3,2", "F,k,3,2"])
    assert [r["k"] for r in normalised_sweep_job(small, SPEC).collect()] == [1]


def test_wide_categories_stay_sparse_and_score_the_same(spark, monkeypatch):
    given = blob_lines(spark)
    dense = {r["k"]: r["score"] for r in categorical_sweep_job(given, SPEC, ks=[1, 3], restarts=3).collect()}
    monkeypatch.setattr(feature_plans, "MAX_ARRAY_WIDTH", 1)
    sparse = {r["k"]: r["score"] for r in categorical_sweep_job(given, SPEC, ks=[1, 3], restarts=3).collect()}
    assert sparse == pytest.approx(dense)


def test_pca_entropy_job(spark):
    given = blob_lines(spark)
    scores = {r["k"]: r["score"] for r in pca_entropy_job(
        given, SPEC, ks=[1, 3], components=2, label="kind", restarts=3).collect()}
    assert scores == pytest.approx({1: math.log(3), 3: 0.0})
    first = pca_entropy_job(given, SPEC, ks=[3], components=2, label="kind", restarts=3, normalise_first=True)
    assert first.first()["score"] == pytest.approx(0.0)


def test_anomaly_jobs_keep_the_lines(spark):
    texts = [f"r{i},k{i % 3},{x},{y}" for i, (x, y) in enumerate(blobs())] + ["out,k0,400.0,400.0"]
    given = lines(spark, texts)
    top = top_anomalies_job(given, SPEC, k=3, restarts=2).collect()
    assert len(top) == 10 and top == sorted(top, key=lambda r: -r["distance"])
    assert set(r["value"] for r in top) <= set(texts)
    found = pca_anomalies_job(given, SPEC, components=2, k=2, restarts=2)
    assert 0 < found.count() <= 99
    assert pca_anomalies_job(given.where("false"), SPEC).count() == 0
    assert top_anomalies_job(given.where("false"), SPEC).count() == 0


def test_anomaly_model_on_other_lines(spark):
    model = fit_anomaly_model(blob_lines(spark), SPEC, components=2, k=3, restarts=2)
    new = lines(spark, ["far,never-seen,500.0,-500.0", "near,k0,0.1,0.1"])
    assert [r["label"] for r in model.anomalies(new).collect()] == ["far"]


def test_trade_lines_run_through_every_job(spark):
    given = lines(spark, TRADE_LINES)
    assert {r["k"] for r in categorical_sweep_job(given, TRADE_RECORD, restarts=1).collect()} == {1, 2}
    assert {r["k"] for r in pca_entropy_job(given, TRADE_RECORD, restarts=1).collect()} == {1, 2}
    assert pca_anomalies_job(given, TRADE_RECORD, k=2, restarts=1).count() <= 9


@pytest.mark.parametrize("width", [2, 60])
def test_a_threshold_does_not_repeat_the_features(spark, width):
    """The filter stays above features and assignment, in both forms of assignment."""
    points = np.random.default_rng(2).normal(size=(30, width))
    df = features(spark, points)
    costly = df.withColumn("features", F.transform("features", lambda x: F.log1p(F.abs(x))))
    centers = np.zeros((3, width)) + np.arange(3)[:, None]
    found = Detector(Clustering(centers), 0.5).anomalies(costly)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("log1p") == 1 and plan.count("ArrowEvalPython") <= 1
    gaps = np.linalg.norm(np.log1p(abs(points))[:, None, :] - centers[None, :, :], axis=2).min(axis=1)
    assert found.count() == (gaps > 0.5).sum()


# -- entropy of many runs, large ranks


@pytest.mark.parametrize("labels", ["few", "unique", "hot", "nulls"])
def test_entropy_of_runs_equals_that_of_each(spark, labels):
    from clusterkit.operators.kmeans import Clustering, assign
    from clusterkit.operators.quality import run_entropies

    rng = np.random.default_rng(3)
    label = {"few": lambda i: f"l{i % 5}", "unique": lambda i: f"l{i // 2}" if i % 3 else f"u{i}",
             "hot": lambda i: "hot" if i % 3 else f"l{i % 7}", "nulls": lambda i: None if i % 4 == 0 else f"{i % 3}"}[labels]
    points = rng.normal(size=(900, 2))
    rows = [(label(i), [float(x) for x in p]) for i, p in enumerate(points)] + [("bad", None), ("bad", [1.0, float("nan")])]
    df = spark.createDataFrame(rows, "label string, features array<double>").repartition(5)
    models = {k: Clustering(points[:k]) for k in (1, 3, 8)}
    got = run_entropies(df, models, split_rows=100)
    for k, model in models.items():
        assert got[k] == pytest.approx(label_entropy(assign(df, model)).first()["score"])


def test_entropy_of_runs_shuffles_each_row_once(spark):
    """What is dealt out are the rows, whatever the number of runs: no row for each row and run."""
    from clusterkit.operators import quality
    from clusterkit.operators.kmeans import Clustering

    sent = {}
    rows = spark.range(400).selectExpr("cast(id % 50 AS string) AS label", "array(double(id % 17), double(id % 5)) AS features")
    for runs in (1, 12):
        models = {r: Clustering(np.random.default_rng(r).normal(size=(4, 2))) for r in range(runs)}
        dealt = rows.select("label", F.lit(False).alias("split"), "features").repartition("label").sortWithinPartitions("label")
        found = quality._label_runs(dealt, models)
        plan = found._jdf.queryExecution().executedPlan().toString()
        sent[runs] = plan.count("Exchange")
        assert "Generate" not in plan and found.count() <= runs * 4 * spark.sparkContext.defaultParallelism * 2
    assert sent[1] == sent[12]


@pytest.mark.parametrize("rank", [1, 40, 999, 2500, 3999, 4000, 9000])
def test_large_ranks_are_narrowed_down(spark, rank):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.exponential(size=2000), np.full(1500, 0.25), rng.normal(size=500) ** 2 * 1e-9])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "distance double").repartition(4)
    want = np.sort(values)[::-1][min(rank, len(values)) - 1]
    assert rank_threshold(df, rank, merged=30).first()["threshold"] == want
    assert rank_threshold(df, rank).first()["threshold"] == want
