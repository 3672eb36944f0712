"""One function per registered query: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from checks import starts as S
from checks.tables import (
    EVENT_RECORD, LINEITEM_RECORD, embedding_features, event_batches, event_line, lineitem, lineitem_features,
    lineitem_lines, table, trade_lines,
)
from clusterkit.functions.fields import cluster_count_line, last_nonempty_field
from clusterkit.operators.anomaly import ANOMALY_CLUSTERS, fit_detector, rank_threshold
from clusterkit.operators.counts import cluster_label_counts, value_counts
from clusterkit.operators.encode import (
    assemble_numeric, category_index, encode_vectors, encode_wide, fit_any_dictionaries, fit_dictionaries,
    lookup_index,
)
from clusterkit.operators.kmeans import (
    RESTART_TOLERANCE, Clustering, assign, centers_table, estimate_k, fit, fit_best_of_ten, lloyd, with_center,
)
from clusterkit.functions.vectors import euclidean
from clusterkit.operators.normalise import apply_zscore, covariance, fit_zscore, vector_stats
from clusterkit.operators.pca import apply_pca, fit_pca
from clusterkit.operators.quality import label_entropy, mean_distance, sweep_mean_distance
from clusterkit.plans import anomalies as anomaly_jobs
from clusterkit.plans import batch as jobs
from clusterkit.plans.features import PCA_COMPONENTS, kept
from clusterkit.scratch import shared_dir
from clusterkit.sinks.text import append_lines
from clusterkit.sources.records import (
    TRADE_RECORD, RecordSpec, observed_records, outcome_rows, parse_numbers, parse_records, rejected_records,
    split_records,
)
from clusterkit.sources.text import read_lines, stream_lines
from clusterkit.streaming import batches as handlers
from clusterkit.streaming.online import OnlineKMeans, start_batches


def r6(column: Column | str) -> Column:
    """Six decimals, without a negative zero."""
    return F.round(column, 6) + F.lit(0.0)


def r4(column: Column | str) -> Column:
    return F.round(column, 4) + F.lit(0.0)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def spread_out(df: DataFrame, width: int, prefix: str, *keep: str, exact: bool = False) -> DataFrame:
    """An array column ``features`` as one column per position."""
    values = [f"features[{i}]" if exact else f"round(features[{i}], 6) + 0D" for i in range(width)]
    return df.select(*keep, *[F.expr(v).alias(f"{prefix}{i}") for i, v in enumerate(values)])


# -- parsing ----------------------------------------------------------------------------------


def parse_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = ["bigint"] * 4 + ["double"] * 4 + ["string"] * 3
    split = split_records(lineitem_lines(spark, sf_dir), LINEITEM_RECORD)
    return split.select(*[F.col(n).cast(t).alias(n) for n, t in zip(LINEITEM_RECORD.names, types)])


def parse_numeric_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c).cast("string") for c in ("event_id", "user_id", "value")]
    lines = table(spark, sf_dir, "events").select(F.concat_ws("\t", *fields).alias("value"))
    return spread_out(parse_numbers(lines), 3, "x", exact=True)


def numeric_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assemble_numeric(parse_records(trade_lines(spark, sf_dir), TRADE_RECORD), TRADE_RECORD)
    return spread_out(rows, S.TRADE_NUMBERS, "f", "label", exact=True)


def blank_to_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line; a seventh of them blank and an eleventh unreadable."""
    value = F.col("value").cast("string")
    damaged = (
        F.when(F.col("event_id") % 7 == 0, F.lit(""))
        .when(F.col("event_id") % 11 == 0, F.concat(F.lit("x"), value)).otherwise(value)
    )
    spec = RecordSpec(names=("event_id", "amount"), numeric=(1,), categorical=(), label=0)
    lines = table(spark, sf_dir, "events").select(
        F.concat_ws(",", F.col("event_id").cast("string"), damaged).alias("value")
    )
    good = parse_records(lines, spec).select(
        F.col("event_id").cast("bigint").alias("event_id"), "amount", F.lit("kept").alias("outcome")
    )
    bad = rejected_records(lines, spec).select(
        F.split("value", ",")[0].cast("bigint").alias("event_id"), F.lit(None).cast("double").alias("amount"),
        F.col("reason").alias("outcome"),
    )
    return good.unionByName(bad)


def last_field_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(
        F.col("l_orderkey").cast("string"), F.lit(","), F.col("l_returnflag"),
        F.repeat(F.lit(","), F.col("l_linenumber")),
    )
    lines = table(spark, sf_dir, "lineitem").select(line.alias("value"))
    return value_counts(lines, last_nonempty_field(F.col("value")))


# -- encoding ---------------------------------------------------------------------------------


def event_type_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_index(table(spark, sf_dir, "events"), "event_type")


def event_type_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return lookup_index(events, "event_type", category_index(events, "event_type"))


def one_hot_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = parse_records(trade_lines(spark, sf_dir), TRADE_RECORD)
    dictionaries = fit_dictionaries(records, TRADE_RECORD.category_names())
    sparse = encode_vectors(records, TRADE_RECORD, dictionaries)
    rows = sparse.select("label", vector_to_array("features").alias("features"))
    return spread_out(rows, S.TRADE_WIDTH, "s", "label", exact=True)


# -- statistics -------------------------------------------------------------------------------


# events with the user as a category beside the type.
USER_RECORD = RecordSpec(names=EVENT_RECORD.names, numeric=(3, 4), categorical=(1, 2), label=0)


def wide_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hot with a dictionary that is held as a table: each entry of the sparse rows."""
    records = parse_records(table(spark, sf_dir, "events").select(event_line().alias("value")), USER_RECORD)
    dictionaries = fit_any_dictionaries(records, USER_RECORD.category_names(), max_width=10)
    rows = encode_wide(records, USER_RECORD, dictionaries).select(
        F.col("label").cast("bigint").alias("event_id"), F.unwrap_udt("features").alias("f"))
    entries = rows.select("event_id", F.explode(F.arrays_zip(F.col("f.indices").alias("i"), F.col("f.values").alias("v"))).alias("e"))
    return entries.select("event_id", F.col("e.i").alias("slot"), F.col("e.v").alias("value"))


def k_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = estimate_k(table(spark, sf_dir, "lineitem"))
    return spark.createDataFrame([(k,)], "k int")


def embedding_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = vector_stats(embedding_features(spark, sf_dir))
    return rounded(stats, "sum", "sum_squares", "mean", "std")


def _with_constant(spark: SparkSession, sf_dir: str, tax: Column) -> DataFrame:
    features = F.array(F.col("l_quantity"), F.col("l_extendedprice"), tax, F.lit(7.5))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", features.alias("features"))


def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _with_constant(spark, sf_dir, F.col("l_tax"))
    return spread_out(apply_zscore(items, fit_zscore(items)), 4, "z", "l_orderkey", "l_linenumber")


def zscore_nan_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tax = F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise(F.col("l_tax"))
    items = _with_constant(spark, sf_dir, tax)
    scaled = apply_zscore(items, fit_zscore(items), nan_to_zero=True)
    return spread_out(scaled, 4, "z", "l_orderkey", "l_linenumber")


def lineitem_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(covariance(lineitem_features(spark, sf_dir)), "covariance")


def embedding_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of the 64 dimensions of the embeddings."""
    return rounded(covariance(embedding_features(spark, sf_dir)), "covariance")


def pca_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_features(spark, sf_dir)
    return spread_out(apply_pca(rows, fit_pca(rows, PCA_COMPONENTS)), PCA_COMPONENTS, "p", "vec_id")


def pca_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineitem_features(spark, sf_dir)
    return spread_out(apply_pca(rows, fit_pca(rows, 2)), 2, "p", "l_orderkey", "l_linenumber")


# -- K-means on lineitem from a fixed start ---------------------------------------------------


def _item_model(rows: DataFrame) -> Clustering:
    with kept(rows.select("features")) as features:
        return lloyd(features, S.ITEM_STARTS, S.ITERATIONS)


def _assigned_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineitem_features(spark, sf_dir)
    return assign(rows, _item_model(rows)).drop("features")


def k1_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit(lineitem_features(spark, sf_dir), 1)
    centers = centers_table(spark, model).withColumnRenamed("center", "features")
    return spread_out(centers, 4, "c", "cluster", F.col("weight"))


def lloyd_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _item_model(lineitem_features(spark, sf_dir))
    centers = centers_table(spark, model).withColumnRenamed("center", "features")
    return spread_out(centers, 4, "c", "cluster", F.col("weight"))


def assign_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned_items(spark, sf_dir).select("l_orderkey", "l_linenumber", "cluster")


def distance_to_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned_items(spark, sf_dir).select("l_orderkey", "l_linenumber", r4("distance").alias("distance"))


def center_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same distance from a join of each row to its center."""
    rows = lineitem_features(spark, sf_dir)
    model = _item_model(rows)
    joined = with_center(assign(rows, model).drop("distance"), model)
    distance = euclidean(F.col("features"), F.col("center"))
    return joined.select("l_orderkey", "l_linenumber", "cluster", r4(distance).alias("distance"))


def item_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_label_counts(_assigned_items(spark, sf_dir))


def item_mean_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(mean_distance(_assigned_items(spark, sf_dir)), "score")


def far_apart(spark: SparkSession, sf_dir: str, group: str, scale: float = 1e4) -> DataFrame:
    """lineitem as groups so far apart that one clustering is best: what a seeded fit must find."""
    spot = F.expr(f"double({group}) * {scale}D")
    return lineitem(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.array(spot + F.col("l_linenumber"), F.col("l_quantity")).alias("features"))


def _by_first(spark: SparkSession, model: Clustering) -> DataFrame:
    """Centers numbered by their first coordinate, as the numbers of a seeded fit are by chance."""
    order = model.centers[:, 0].argsort()
    sorted_model = Clustering(model.centers[order], model.weights[order])
    return spread_out(centers_table(spark, sorted_model).withColumnRenamed("center", "features"), 2, "c", "cluster", "weight")


TWO_GROUPS, THREE_GROUPS = "l_returnflag = 'N'", "instr('ANR', l_returnflag)"
ANOMALY_GROUPS = "l_suppkey % 15 * 10 + l_partkey % 10"


def seeded_default_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default fit: two clusters, k-means|| seeding."""
    with kept(far_apart(spark, sf_dir, f"if({TWO_GROUPS}, 1, 0)").select("features")) as features:
        return _by_first(spark, fit(features))


def seeded_best_of_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The careful fit: ten seeds sharing their scans."""
    with kept(far_apart(spark, sf_dir, THREE_GROUPS).select("features")) as features:
        return _by_first(spark, fit_best_of_ten(features, 3))


def seeded_careful_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The careful fit's mean distance in a sweep without given starts."""
    with kept(far_apart(spark, sf_dir, THREE_GROUPS).select("features")) as features:
        return rounded(sweep_mean_distance(features, [1, 3]), "score")


def seeded_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """150 clusters from k-means||, and the rows beyond the hundredth distance."""
    rows = far_apart(spark, sf_dir, ANOMALY_GROUPS)
    with kept(rows.select("features")) as features:
        detector = fit_detector(features, ANOMALY_CLUSTERS)
    return detector.anomalies(rows).select("l_orderkey", "l_linenumber", r4("distance").alias("distance"))


def item_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(label_entropy(_assigned_items(spark, sf_dir)), "score")


def item_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rank_threshold(_assigned_items(spark, sf_dir)), "threshold")


def item_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineitem_features(spark, sf_dir)
    with kept(rows.select("features")) as features:
        detector = fit_detector(features, init=S.ITEM_STARTS, iterations=S.ITERATIONS, tolerance=0.0)
    found = detector.anomalies(rows)
    return found.select("l_orderkey", "l_linenumber", "cluster", r4("distance").alias("distance"))


def given_restarts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of several given starts."""
    rows = lineitem_features(spark, sf_dir)
    with kept(rows.select("features")) as features:
        model = fit(features, init=S.ITEM_RESTARTS, iterations=S.ITERATIONS, tolerance=0.0)
        return rounded(mean_distance(assign(features, model)), "score").withColumn("cost", r4(F.lit(model.cost)))


# -- jobs -------------------------------------------------------------------------------------

FIXED = {"iterations": S.ITERATIONS, "tolerance": 0.0}


def k_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = jobs.raw_sweep_job(
        trade_lines(spark, sf_dir), TRADE_RECORD, S.SWEEP, S.trade_start, careful_init=S.careful_start, **FIXED
    )
    return rounded(scores, "score", "score2")


def normalised_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = jobs.normalised_sweep_job(
        trade_lines(spark, sf_dir), TRADE_RECORD, S.SWEEP, S.spread(S.TRADE_NUMBERS), **FIXED
    )
    return rounded(scores, "score")


def every_k_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every K up to the rule of thumb, on the numbers of all events."""
    lines = table(spark, sf_dir, "events").select(event_line().alias("value"))
    scores = jobs.normalised_sweep_job(lines, EVENT_RECORD, init=S.spread(3), **FIXED)
    return rounded(scores, "score")


def categorical_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = jobs.categorical_sweep_job(
        trade_lines(spark, sf_dir), TRADE_RECORD, S.SWEEP, S.spread(S.TRADE_WIDTH), **FIXED
    )
    return rounded(scores, "score")


def pca_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = jobs.pca_entropy_job(
        trade_lines(spark, sf_dir), TRADE_RECORD, S.SWEEP, S.spread(2), components=2, label="product_type", **FIXED
    )
    return rounded(scores, "score")


def default_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means|| seeding: the clusters found depend on chance."""
    return jobs.cross_tab_job(trade_lines(spark, sf_dir), TRADE_RECORD, label="product_type").counts


def default_job_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = jobs.cross_tab_job(
        trade_lines(spark, sf_dir), TRADE_RECORD, init=S.trade_start(2), label="product_type", **FIXED
    )
    return result.counts


def restarts_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means|| seeding, ten restarts."""
    with kept(embedding_features(spark, sf_dir).select("features")) as features:
        return rounded(sweep_mean_distance(features, [1, 2, 10]), "score")


def anomalies_fixed_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """150 clusters that start at the vectors with the lowest ids."""
    rows = embedding_features(spark, sf_dir)
    init = [r["features"] for r in first_vectors(rows)]
    with kept(rows.select("features")) as features:
        detector = fit_detector(features, init=init, iterations=S.ITERATIONS, tolerance=0.0)
    return detector.anomalies(rows).select("vec_id", "cluster", r6("distance").alias("distance"))


def first_vectors(rows: DataFrame) -> list:
    return rows.orderBy("vec_id").limit(ANOMALY_CLUSTERS).collect()


def anomalies_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """150 clusters from k-means||."""
    rows = embedding_features(spark, sf_dir)
    with kept(rows.select("features")) as features:
        detector = fit_detector(features, ANOMALY_CLUSTERS)
    return detector.anomalies(rows).select("vec_id", "cluster", r6("distance").alias("distance"))


def _label_and_distance(found: DataFrame) -> DataFrame:
    return found.select(F.split("value", ",")[2].alias("label"), r6("distance").alias("distance"))


def top10_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_and_distance(anomaly_jobs.top_anomalies_job(
        trade_lines(spark, sf_dir), TRADE_RECORD, init=S.spread(S.TRADE_WIDTH)(3), **FIXED
    ))


def pca_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _label_and_distance(anomaly_jobs.pca_anomalies_job(
        trade_lines(spark, sf_dir), TRADE_RECORD, components=2, init=S.spread(2)(3), **FIXED
    ))


# -- streams ----------------------------------------------------------------------------------


def _stream_events(spark: SparkSession, sf_dir: str, start: Callable) -> None:
    """Land one part of the events after another as text files and let ``start(lines, checkpoint)``
    take in each as one micro-batch. The query ends and restarts between them."""
    landing, checkpoint = shared_dir(spark, "landing"), shared_dir(spark, "checkpoint")
    for part in event_batches(spark, sf_dir):
        part.write.mode("append").text(landing)
        query = start(stream_lines(spark, landing), checkpoint)
        query.awaitTermination()


def _event_features(lines: DataFrame) -> DataFrame:
    """(event_id, label, features): the event type as label, value and hour as features."""
    records = parse_records(lines, EVENT_RECORD)
    return records.select(
        F.col("event_id").cast("bigint").alias("event_id"), F.col("event_type").alias("label"),
        F.array("amount", "hour").alias("features"),
    )


def stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "parsed")

    def start(lines: DataFrame, checkpoint: str):
        parsed = parse_records(lines, EVENT_RECORD).drop("value", "label")
        writer = parsed.writeStream.format("parquet").option("path", out)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _stream_events(spark, sf_dir, start)
    rows = spark.read.parquet(out)
    return rows.withColumn("event_id", F.col("event_id").cast("bigint"))


def _online(spark: SparkSession, sf_dir: str, on_batch: Callable | None = None) -> OnlineKMeans:
    model = OnlineKMeans(spark, shared_dir(spark, "centers"), init=S.EVENT_STARTS)

    def start(lines: DataFrame, checkpoint: str):
        return model.start(_event_features(lines), checkpoint, on_batch, availableNow=True)

    _stream_events(spark, sf_dir, start)
    return model


def stream_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _online(spark, sf_dir).history().withColumnRenamed("center", "features")
    return spread_out(history, 2, "c", F.col("batch_id").cast("bigint").alias("batch_id"), "cluster", "weight")


def stream_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "predictions")
    _online(spark, sf_dir, handlers.prediction_writer(out, "event_id"))
    return spark.read.parquet(out).select("event_id", "cluster", r6("distance").alias("distance"))


def stream_cluster_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "label-counts")
    _online(spark, sf_dir, handlers.label_count_writer(out))
    return _batches_of(spark, out).select("batch_id", "cluster", "label", "count")


def stream_center_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "center-text")
    _online(spark, sf_dir, handlers.center_text_writer(out, decimals=6))
    lines = read_lines(spark, out)
    return lines.select(F.col("batch_id").cast("bigint").alias("batch_id"), F.col("value").alias("line"))


def _batches_of(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def stream_running_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = handlers.RunningK(spark, shared_dir(spark, "running-k"))

    def start(lines: DataFrame, checkpoint: str):
        return start_batches(lines, running.update, checkpoint, availableNow=True)

    _stream_events(spark, sf_dir, start)
    return running.history().select("batch_id", "mean_k")


def _stream_sweep(spark: SparkSession, sf_dir: str, job: Callable, encode: bool, **options) -> DataFrame:
    out = shared_dir(spark, "sweep")
    fixed = handlers.FixedDictionaries(spark, shared_dir(spark, "dictionaries"), EVENT_RECORD) if encode else None
    handle = handlers.sweep_handler(
        job, EVENT_RECORD, out, handlers.RunningK(spark, shared_dir(spark, "running-k")), fixed,
        ks=S.SWEEP, **options, **FIXED,
    )

    def start(lines: DataFrame, checkpoint: str):
        return start_batches(lines, handle, checkpoint, availableNow=True)

    _stream_events(spark, sf_dir, start)
    return _batches_of(spark, out)


def stream_raw_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _stream_sweep(spark, sf_dir, jobs.raw_sweep_job, False, init=S.event_start)
    return rounded(scores.select("batch_id", "k", "score", "score2"), "score", "score2")


def stream_normalised_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _stream_sweep(spark, sf_dir, jobs.normalised_sweep_job, False, init=S.spread(3))
    return rounded(scores.select("batch_id", "k", "score"), "score")


def stream_categorical_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _stream_sweep(spark, sf_dir, jobs.categorical_sweep_job, True, init=S.spread(8))
    return rounded(scores.select("batch_id", "k", "score"), "score")


def stream_pca_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _stream_sweep(
        spark, sf_dir, jobs.pca_entropy_job, True, init=S.spread(2), components=2, label="event_type"
    )
    return rounded(scores.select("batch_id", "k", "score"), "score")


def stream_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the first batch, applied to all of them."""
    history = next(event_batches(spark, sf_dir))
    model = anomaly_jobs.fit_anomaly_model(
        history, EVENT_RECORD, components=2, init=S.spread(2)(3), **FIXED
    )
    out = shared_dir(spark, "anomalies")

    def start(lines: DataFrame, checkpoint: str):
        found = model.anomalies(lines)
        writer = found.writeStream.format("parquet").option("path", out)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _stream_events(spark, sf_dir, start)
    found = spark.read.parquet(out)
    return found.select(
        F.col("label").cast("bigint").alias("event_id"), "cluster", r6("distance").alias("distance")
    )


# -- jobs with their own parameters -----------------------------------------------------------


def _event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(event_line().alias("value"))


def raw_sweep_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every K up to the rule of thumb, 20 iterations, the job's own tolerance."""
    return rounded(jobs.raw_sweep_job(
        _event_lines(spark, sf_dir), EVENT_RECORD, init=S.event_start, tolerance=RESTART_TOLERANCE), "score", "score2")


def categorical_sweep_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(jobs.categorical_sweep_job(_event_lines(spark, sf_dir), EVENT_RECORD, init=S.spread(8)), "score")


def pca_entropy_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(jobs.pca_entropy_job(
        _event_lines(spark, sf_dir), EVENT_RECORD, init=S.spread(3), components=3, label="event_type"), "score")


def detector_estimated_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K by the rule of thumb, ten seeds, the hundredth distance."""
    rows = _event_features(_event_lines(spark, sf_dir)).drop("label")
    with kept(rows.select("features")) as features:
        detector = fit_detector(features)
    return detector.anomalies(rows).select("event_id", r6("distance").alias("distance"))


def pca_anomalies_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15 components, 150 clusters, ten seeds."""
    return _label_and_distance(anomaly_jobs.pca_anomalies_job(trade_lines(spark, sf_dir), TRADE_RECORD))


def top10_anomalies_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """150 clusters of all features, ten seeds."""
    return _label_and_distance(anomaly_jobs.top_anomalies_job(trade_lines(spark, sf_dir), TRADE_RECORD))


def stream_running_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch with every K up to the running estimate."""
    out = shared_dir(spark, "sweep")
    handle = handlers.sweep_handler(
        jobs.normalised_sweep_job, EVENT_RECORD, out, handlers.RunningK(spark, shared_dir(spark, "running-k")), init=S.spread(3))

    def start(lines: DataFrame, checkpoint: str):
        return start_batches(lines, handle, checkpoint, availableNow=True)

    _stream_events(spark, sf_dir, start)
    return rounded(_batches_of(spark, out).select("batch_id", "k", "score"), "score")


class _Lost(Exception):
    """What stops a batch after its state was written."""


def online_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query on an interval takes a file a batch; in the second batch it is stopped between the
    state and the commit, and goes on from the checkpoint with that batch once more."""
    landing, checkpoint = shared_dir(spark, "landing"), shared_dir(spark, "checkpoint")
    for number, part in enumerate(event_batches(spark, sf_dir)):
        part.coalesce(1).write.mode("append").text(landing)
    model = OnlineKMeans(spark, shared_dir(spark, "centers"), init=S.EVENT_STARTS)
    seen: list[int] = []

    def on_batch(batch: DataFrame, centers: Clustering, batch_id: int) -> None:
        seen.append(batch_id)
        if seen == [0, 1]:
            raise _Lost("after the state of batch 1")

    def start():
        lines = stream_lines(spark, landing, max_files_per_trigger=1)
        return model.start(_event_features(lines), checkpoint, on_batch, processingTime="1 second")

    query = start()
    try:
        query.processAllAvailable()
    except StreamingQueryException:
        query.stop()
        query = start()
        query.processAllAvailable()
    query.stop()
    if seen[:3] != [0, 1, 1]:
        raise AssertionError(f"batches {seen}: the second was not replayed")
    history = model.history().withColumnRenamed("center", "features")
    return spread_out(history, 2, "c", F.col("batch_id").cast("bigint").alias("batch_id"), "cluster", "weight")


def prediction_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every row of each batch, as text."""
    out = shared_dir(spark, "prediction-text")
    _online(spark, sf_dir, handlers.prediction_text_writer(out))
    return read_lines(spark, out).select(F.col("batch_id").cast("bigint").alias("batch_id"), F.col("value").alias("line"))


def _spoilt(lines: DataFrame) -> DataFrame:
    """Event lines, some of them cut short and some with a word for a number."""
    event_id = F.split("value", ",")[0].cast("bigint")
    return lines.select(F.when(event_id % 13 == 0, F.concat(event_id.cast("string"), F.lit(",cut")))
                        .when(event_id % 17 == 0, F.regexp_replace("value", "^([^,]*),[^,]*,", "$1,many,"))
                        .otherwise(F.col("value")).alias("value"))


def observed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines taken and left out by a job, counted as it runs."""
    watch = Observation("lines")
    records = observed_records(_spoilt(_event_lines(spark, sf_dir)), EVENT_RECORD, watch)
    out = shared_dir(spark, "observed")
    records.write.parquet(out)
    counted = spark.createDataFrame(outcome_rows(watch.get), "outcome string, lines bigint")
    written = spark.read.parquet(out).count()
    return counted.where((F.col("outcome") != "kept") | (F.col("lines") == written))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for every batch of a stream, by the job that trains on the batch."""
    counts = handlers.RejectCounts(spark, shared_dir(spark, "reject-counts"), EVENT_RECORD)
    model = OnlineKMeans(spark, shared_dir(spark, "centers"), init=S.EVENT_STARTS)

    def handle(batch: DataFrame, batch_id: int) -> None:
        records = counts.records(_spoilt(batch), batch_id)
        with kept(records.select(F.array("amount", "hour").alias("features"))) as features:
            model.update(features, batch_id)
        counts.save(batch_id)

    def start(lines: DataFrame, checkpoint: str):
        return start_batches(lines, handle, checkpoint, availableNow=True)

    _stream_events(spark, sf_dir, start)
    return counts.history().select(F.col("batch_id").cast("bigint").alias("batch_id"), "outcome", "lines")


# -- sinks ------------------------------------------------------------------------------------


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "report")
    counts = item_label_counts(spark, sf_dir)
    append_lines(counts, cluster_count_line(F.col("cluster"), F.col("label"), F.col("count")), out)
    return read_lines(spark, out).withColumnRenamed("value", "line")


def anomaly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anomalous rows, written as text and read again."""
    out = shared_dir(spark, "anomaly-lines")
    found = item_anomalies(spark, sf_dir)
    append_lines(found, F.format_string("cluster %d row %d-%d", "cluster", "l_orderkey", "l_linenumber"), out)
    return read_lines(spark, out).withColumnRenamed("value", "line")


def score_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of a sweep, written by the job as text and read again."""
    out = shared_dir(spark, "score-lines")
    scores = jobs.raw_sweep_job(trade_lines(spark, sf_dir), TRADE_RECORD, S.SWEEP, S.trade_start, **FIXED)
    jobs.write_scores(scores, out, decimals=4)
    return read_lines(spark, out).withColumnRenamed("value", "line")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_parse_delimited": parse_delimited,
    "q02_parse_numeric_tsv": parse_numeric_tsv,
    "q03_numeric_features": numeric_features,
    "q04_blank_to_zero": blank_to_zero,
    "q05_last_field_counts": last_field_counts,
    "q06_category_index": event_type_index,
    "q06b_category_lookup": event_type_lookup,
    "q07_one_hot_assemble": one_hot_assemble,
    "q07b_wide_one_hot": wide_one_hot,
    "q10_estimate_k": k_estimate,
    "q11_vector_stats": embedding_stats,
    "q12_zscore": zscore,
    "q13_zscore_nan_safe": zscore_nan_safe,
    "q14_covariance": lineitem_covariance,
    "q14b_covariance_embeddings": embedding_covariance,
    "q15_pca_project": pca_embeddings,
    "q15b_pca_lineitem": pca_lineitem,
    "q16_k1_center": k1_center,
    "q17_lloyd_centers": lloyd_centers,
    "q19_assign": assign_rows,
    "q20_distance_to_center": distance_to_center,
    "q20b_center_join": center_join,
    "q21_cluster_label_counts": item_label_counts,
    "q22_mean_distance": item_mean_distance,
    "q23_k_sweep": k_sweep,
    "q24_weighted_entropy": item_entropy,
    "q25_default_job": default_job,
    "q25b_fixed_start_job": default_job_fixed,
    "q26_restarts_score": restarts_score,
    "q26b_given_restarts": given_restarts,
    "q27_pca_entropy_job": pca_entropy,
    "q28_normalised_sweep": normalised_sweep,
    "q28b_every_k_sweep": every_k_sweep,
    "q25c_seeded_default_fit": seeded_default_fit,
    "q26c_seeded_best_of_ten": seeded_best_of_ten,
    "q26d_seeded_careful_score": seeded_careful_score,
    "q32c_seeded_anomalies": seeded_anomalies,
    "q29_categorical_sweep": categorical_sweep,
    "q30_rank_threshold": item_threshold,
    "q31_anomalies": item_anomalies,
    "q32_anomalies_fixed_k": anomalies_fixed_k,
    "q32b_anomalies_seeded": anomalies_seeded,
    "q33_top10_anomalies": top10_anomalies,
    "q34_pca_anomalies": pca_anomalies,
    "q40_stream_parse": stream_parse,
    "q41_stream_kmeans": stream_kmeans,
    "q42_stream_assign": stream_assign,
    "q43_stream_cluster_label": stream_cluster_label,
    "q44_stream_center_log": stream_center_log,
    "q45_stream_running_k": stream_running_k,
    "q46_stream_raw_sweep": stream_raw_sweep,
    "q46b_stream_normalised_sweep": stream_normalised_sweep,
    "q46c_stream_categorical_sweep": stream_categorical_sweep,
    "q47_stream_pca_entropy": stream_pca_entropy,
    "q48_stream_anomalies": stream_anomalies,
    "q23b_raw_sweep_default": raw_sweep_default,
    "q27b_pca_entropy_default": pca_entropy_default,
    "q29b_categorical_sweep_default": categorical_sweep_default,
    "q33b_top10_anomalies_default": top10_anomalies_default,
    "q34b_pca_anomalies_default": pca_anomalies_default,
    "q41b_online_interval": online_interval,
    "q42b_prediction_text": prediction_text,
    "q46d_stream_running_sweep": stream_running_sweep,
    "q49_observed_rejects": observed_rejects,
    "q49b_stream_rejects": stream_rejects,
    "q55_detector_estimated_k": detector_estimated_k,
    "q50_report_lines": report_lines,
    "q50b_anomaly_lines": anomaly_lines,
    "q50c_score_lines": score_lines,
}
