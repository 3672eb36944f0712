import numpy as np
import pytest
from pyspark.sql import functions as F

from clusterkit.operators.quality import k_grid
from clusterkit.plans.anomalies import fit_anomaly_model
from clusterkit.plans.batch import categorical_sweep_job, normalised_sweep_job
from clusterkit.sinks.text import append_lines, show_on_console, write_batch_lines
from clusterkit.sources.records import RecordSpec, parse_numbers
from clusterkit.sources.text import read_lines, stream_lines
from clusterkit.streaming import batches as handlers
from clusterkit.streaming.online import OnlineKMeans, start_batches
from tests.fixtures import blobs, features, lines

SPEC = RecordSpec(names=("id", "kind", "x", "y"), numeric=(2, 3), categorical=(0, 1), label=0)
# Centers and weights after each batch of the points (a + i, 2a), a = 0..4.
KNOWN = [
    ([[1.0, 2.0], [3.5, 7.0]], [3, 2]),
    ([[1.5, 2.0], [4.0, 7.0]], [6, 4]),
    ([[1.75, 1.75], [4.428571, 6.571429]], [8, 7]),
]


def batch_points(i):
    return [[a + i, 2.0 * a] for a in range(5)]


def land(directory, number, texts):
    directory.mkdir(exist_ok=True)
    (directory / f"part{number}.txt").write_text("".join(t + "\n" for t in texts))


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_updates_follow_the_recurrence(spark, tmp_path):
    model = OnlineKMeans(spark, str(tmp_path / "state"), init=[[0, 0], [4, 8]])
    for i, (centers, weights) in enumerate(KNOWN):
        got = model.update(features(spark, batch_points(i)), i)
        assert got.centers == pytest.approx(np.array(centers), abs=1e-6)
        assert got.weights.tolist() == weights


def test_replayed_batch_is_not_applied_twice(spark, tmp_path):
    model = OnlineKMeans(spark, str(tmp_path / "state"), init=[[0, 0], [4, 8]])
    for i in (0, 1, 1, 1, 2):
        got = model.update(features(spark, batch_points(i)), i)
    assert got.centers == pytest.approx(np.array(KNOWN[2][0]), abs=1e-6)
    restarted = OnlineKMeans(spark, str(tmp_path / "state"), init=[[0, 0], [4, 8]])
    assert restarted.before(3).centers == pytest.approx(got.centers)


def test_missing_state_is_an_error(spark, tmp_path):
    model = OnlineKMeans(spark, str(tmp_path / "state"), init=[[0, 0]])
    with pytest.raises(Exception):
        model.update(features(spark, batch_points(0)), 5)


def test_decay_and_empty_batch(spark, tmp_path):
    model = OnlineKMeans(spark, str(tmp_path / "state"), init=[[0, 0], [4, 8]], decay=0.5)
    first = model.update(features(spark, batch_points(0)), 0)
    empty = model.update(features(spark, batch_points(0)).where("id < 0"), 1)
    assert empty.centers.tolist() == first.centers.tolist()
    assert empty.weights.tolist() == [1.5, 1.0]


def test_random_start_takes_the_width_of_the_data(spark, tmp_path):
    model = OnlineKMeans(spark, str(tmp_path / "state"), k=3, seed=7)
    empty = features(spark, batch_points(0)).where("id < 0")
    assert model.update(empty, 0) is None
    got = model.update(features(spark, batch_points(1)), 1)
    assert got.centers.shape == (3, 2) and got.weights.sum() == 5


def test_dying_cluster_is_split_on_request(spark, tmp_path):
    options = {"init": [[0, 0], [100, 100]], "init_weights": [1e9, 1e-3]}
    kept = OnlineKMeans(spark, str(tmp_path / "a"), **options).update(features(spark, [[0, 0]]), 0)
    assert kept.centers[1].tolist() == [100.0, 100.0]
    split = OnlineKMeans(spark, str(tmp_path / "b"), split_dying=True, **options)
    got = split.update(features(spark, [[0, 0]]), 0)
    assert got.centers[1] == pytest.approx([0, 0]) and got.weights[0] == got.weights[1]


def test_stream_equals_the_batches_it_is_made_of(spark, tmp_path):
    """Three files, a restart after each; predictions use the centers of their own batch."""
    model = OnlineKMeans(spark, str(tmp_path / "state"), init=[[0, 0], [4, 8]])
    text, counts = str(tmp_path / "text"), str(tmp_path / "predictions")
    write_text = handlers.center_text_writer(text)
    write_predictions = handlers.prediction_writer(counts, "features")

    def on_batch(batch, centers, batch_id):
        write_text(batch, centers, batch_id)
        write_predictions(batch, centers, batch_id)

    for i in range(3):
        land(tmp_path / "in", i, ["\t".join(map(str, p)) for p in batch_points(i)])
        stream = parse_numbers(stream_lines(spark, str(tmp_path / "in")))
        run(model.start(stream, str(tmp_path / "checkpoint"), on_batch, availableNow=True))
    history = {(r["batch_id"], r["cluster"]): r for r in model.history().collect()}
    assert len(history) == 6
    for i, (centers, weights) in enumerate(KNOWN):
        for c in range(2):
            assert history[i, c]["center"] == pytest.approx(centers[c], abs=1e-6)
            assert history[i, c]["weight"] == weights[c]
    assert {r["value"] for r in read_lines(spark, text).where("batch_id = 0").collect()} == {"1.0,2.0", "3.5,7.0"}
    predicted = spark.read.parquet(counts).where("batch_id = 0").collect()
    expected = [min(np.hypot(p[0] - c[0], p[1] - c[1]) for c in KNOWN[0][0]) for p in batch_points(0)]
    assert sorted(r["distance"] for r in predicted) == pytest.approx(sorted(expected))


def test_one_file_per_trigger(spark, tmp_path):
    model = OnlineKMeans(spark, str(tmp_path / "state"), init=[[0, 0], [4, 8]])
    for i in range(3):
        land(tmp_path / "in", i, ["\t".join(map(str, p)) for p in batch_points(i)])
    stream = parse_numbers(stream_lines(spark, str(tmp_path / "in"), max_files_per_trigger=1))
    run(model.start(stream, str(tmp_path / "checkpoint"), availableNow=True))
    assert model.history().select("batch_id").distinct().count() == 3


def test_label_counts_and_texts_per_batch(spark, tmp_path):
    model = OnlineKMeans(spark, str(tmp_path / "state"), init=[[0, 0], [4, 8]])
    labelled = features(spark, batch_points(0)).withColumn("label", F.lit("a"))
    centers = model.update(labelled, 0)
    for _ in range(2):  # a replay replaces its own output
        handlers.label_count_writer(str(tmp_path / "counts"))(labelled, centers, 0)
        handlers.label_report_writer(str(tmp_path / "report"))(labelled, centers, 0)
        handlers.prediction_text_writer(str(tmp_path / "clusters"))(labelled, centers, 0)
    rows = spark.read.parquet(str(tmp_path / "counts")).orderBy("cluster").collect()
    assert [(r["cluster"], r["label"], r["count"]) for r in rows] == [(0, "a", 3), (1, "a", 2)]
    report = {r["value"] for r in read_lines(spark, str(tmp_path / "report")).collect()}
    assert report == {"cluster 0 label a count 3", "cluster 1 label a count 2"}
    assert read_lines(spark, str(tmp_path / "clusters")).count() == 5


def test_running_k(spark, tmp_path):
    running = handlers.RunningK(spark, str(tmp_path / "k"))
    means = [running.update(spark.range(n), i) for i, n in enumerate((10, 500, 0))]
    assert means == [2, 8, 5]
    assert running.update(spark.range(500), 1) == 8
    assert {r["batch_id"]: r["mean_k"] for r in running.history().collect()} == {0: 2, 1: 8, 2: 5}


def test_sweeps_per_batch_with_fixed_dictionaries(spark, tmp_path):
    first = [f"r{i},k{i % 3},{x},{y}" for i, (x, y) in enumerate(blobs(60))]
    second = [f"s{i},new{i % 2},{x},{y}" for i, (x, y) in enumerate(blobs(60))]
    out = str(tmp_path / "scores")
    dictionaries = handlers.FixedDictionaries(spark, str(tmp_path / "dictionaries"), SPEC)
    handle = handlers.sweep_handler(
        categorical_sweep_job, SPEC, out, handlers.RunningK(spark, str(tmp_path / "k")), dictionaries, restarts=1
    )
    for i, texts in enumerate((first, second)):
        land(tmp_path / "in", i, texts)
        run(start_batches(stream_lines(spark, str(tmp_path / "in")), handle, str(tmp_path / "c"), availableNow=True))
    scores = spark.read.parquet(out)
    assert scores.where("batch_id = 0").count() == scores.where("batch_id = 1").count() == len(k_grid(5))
    reloaded = handlers.FixedDictionaries(spark, str(tmp_path / "dictionaries"), SPEC)
    assert reloaded.get(lines(spark, second), 1).values == {"kind": ("k0", "k1", "k2")}


def test_dictionaries_wait_for_a_usable_line_and_outlive_restarts(spark, tmp_path):
    def restarted():
        return handlers.FixedDictionaries(spark, str(tmp_path / "d"), SPEC)

    assert restarted().get(lines(spark, ["damaged"]), 0).width == 0
    running = restarted()
    assert running.get(lines(spark, ["damaged"]), 0).width == 0
    assert running.get(lines(spark, ["a,p,1,2"]), 1).values == {"kind": ("p",)}
    for batch_id in (1, 2, 3):  # replayed, and after restarts
        assert restarted().get(lines(spark, ["b,q,1,2", "c,r,1,2"]), batch_id).values == {"kind": ("p",)}


def test_normalised_sweep_with_given_k(spark, tmp_path):
    out = str(tmp_path / "scores")
    handle = handlers.sweep_handler(
        normalised_sweep_job, SPEC, out, handlers.RunningK(spark, str(tmp_path / "k")), ks=[1, 2], restarts=1
    )
    handle(lines(spark, [f"r{i},k,{x},{y}" for i, (x, y) in enumerate(blobs(30))]), 0)
    assert {r["k"] for r in spark.read.parquet(out).collect()} == {1, 2}


def test_stream_anomalies_of_a_model_from_history(spark, tmp_path):
    history = lines(spark, [f"r{i},k{i % 3},{x},{y}" for i, (x, y) in enumerate(blobs())])
    model = fit_anomaly_model(history, SPEC, components=2, k=3, restarts=2)
    land(tmp_path / "in", 0, ["far,k0,300.0,-300.0", "near,k0,0.1,0.1", "bad line"])
    stream = stream_lines(spark, str(tmp_path / "in"))
    handle = handlers.anomaly_handler(model, str(tmp_path / "out"))
    run(start_batches(stream, handle, str(tmp_path / "c1"), availableNow=True))
    assert [r["value"] for r in read_lines(spark, str(tmp_path / "out")).collect()] == ["far,k0,300.0,-300.0"]
    found = model.anomalies(stream).writeStream.format("memory").queryName("found").outputMode("append")
    run(found.option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start())
    assert [r["label"] for r in spark.table("found").collect()] == ["far"]


def test_text_sinks(spark, tmp_path):
    df = spark.range(3)
    line = F.concat(F.lit("row "), F.col("id").cast("string"))
    append_lines(df, line, str(tmp_path / "log"))
    append_lines(df, line, str(tmp_path / "log"))
    assert read_lines(spark, str(tmp_path / "log")).count() == 6
    for _ in range(2):
        write_batch_lines(df, line, str(tmp_path / "batches"), 4)
    assert read_lines(spark, str(tmp_path / "batches")).count() == 3


def test_console(spark, tmp_path):
    land(tmp_path / "in", 0, ["1\t2"])
    query = show_on_console(stream_lines(spark, str(tmp_path / "in")), str(tmp_path / "c"))
    query.processAllAvailable()
    query.stop()


def test_a_file_path_is_no_streaming_source(spark, tmp_path):
    land(tmp_path / "in", 0, ["1\t2"])
    with pytest.raises(Exception):
        stream = stream_lines(spark, str(tmp_path / "in" / "part0.txt"))
        run(start_batches(stream, lambda df, i: None, str(tmp_path / "c"), availableNow=True))


def test_rejects_are_counted_by_the_job_that_reads_them(spark, tmp_path):
    from pyspark.sql import Observation

    from clusterkit.sources.records import observed_records, outcome_rows

    given = lines(spark, ["a,k,1,2", "b,k,1", "c,k,x,2", "d,k,3,4", "e", "f,k,,7"]).repartition(3)
    watch = Observation("lines")
    assert sorted(r["label"] for r in observed_records(given, SPEC, watch).collect()) == ["a", "d", "f"]
    assert outcome_rows(watch.get) == [("kept", 3), ("field count", 2), ("not a number", 1)]
    nothing = Observation("none")
    assert observed_records(given.limit(0), SPEC, nothing).collect() == [] and outcome_rows(nothing.get) == []


def test_reject_counts_of_a_stream_survive_a_replay(spark, tmp_path):
    landing, state = tmp_path / "in", str(tmp_path / "counts")
    seen = []

    def start():
        counts = handlers.RejectCounts(spark, state, SPEC)

        def handle(batch, batch_id):
            counts.records(batch, batch_id).write.mode("overwrite").parquet(str(tmp_path / f"out{batch_id}"))
            counts.save(batch_id)
            seen.append(batch_id)
            if seen == [0, 1]:
                raise RuntimeError("lost after the state")

        return counts, start_batches(stream_lines(spark, str(landing)), handle, str(tmp_path / "check"), availableNow=True)

    land(landing, 0, ["a,k,1,2", "b,k,1"])
    counts, query = start()
    run(query)
    land(landing, 1, ["c,k,x,2", "d,k,3,4", "e,k,5,6"])
    counts, query = start()
    with pytest.raises(Exception):
        query.awaitTermination(120)
    counts, query = start()
    run(query)
    got = sorted((r["batch_id"], r["outcome"], r["lines"]) for r in counts.history().collect())
    assert got == [(0, "field count", 1), (0, "kept", 1), (1, "kept", 2), (1, "not a number", 1)] and seen == [0, 1, 1]
