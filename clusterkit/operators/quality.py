"""Cluster quality: mean distance to the center and label entropy, for one K or a sweep."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterkit.operators.kmeans import (
    DEFAULT_TOLERANCE, MAX_ITERATIONS, RESTARTS, RESTART_TOLERANCE, Clustering, _kernel, arrow_features,
    best_of, fit_seeded, is_vector, lloyd_runs, prunes, run_totals,
)
from clusterkit.operators.pruning import BLOCK_CELLS, _nearest_rows

SCORE_SCHEMA = "k int, score double"
#: Rows of a label that one task counts.
SPLIT_ROWS = 1_000_000


def mean_distance(assigned: DataFrame) -> DataFrame:
    """Mean distance to the assigned center, as (score)."""
    return assigned.agg(F.avg("distance").alias("score"))


def label_entropy(assigned: DataFrame, *by: str) -> DataFrame:
    """Entropy of the labels in each cluster, averaged with the cluster sizes as weights.

    With n rows of a label in a cluster of t rows, t times the entropy is t ln t - sum(n ln n):
    three hash aggregates with partial sums, no window and no group of labels held in one place.
    ``by`` computes one score per value of further columns.
    """
    n, t = F.col("n"), F.col("t")
    rows = assigned.where("cluster IS NOT NULL")
    counts = rows.groupBy(*by, "cluster", "label").agg(F.count("*").alias("n")).where(n > 0)
    clusters = counts.groupBy(*by, "cluster").agg(F.sum("n").alias("t"), F.sum(n * F.log(n)).alias("nln"))
    return clusters.groupBy(*by).agg((F.sum(t * F.log(t) - F.col("nln")) / F.sum("t")).alias("score"))


def _label_runs(df: DataFrame, models: Mapping[int, Clustering]) -> DataFrame:
    """(run, cluster, label, n, t, nln): from rows (label, split, features) sorted by label, for each
    task, run and cluster the rows t and the sum of n ln n over the labels n rows of which are all in
    the task; for split labels (label, n) instead."""
    runs = {run: m.centers for run, m in models.items()}
    width = next(iter(runs.values())).shape[1]
    read, take, nearest, _ = _kernel(width, is_vector(df, "features"))
    sizes = {run: len(c) for run, c in runs.items()}
    pruned = prunes(df, sum(sizes.values()), width, "features")
    nearest_rows, most = _nearest_rows(width), BLOCK_CELLS // (width + 1)
    names = ["run", "cluster", "label", "n", "t", "nln"]

    def count(batches):
        import numpy as np
        import pyarrow as pa

        total = {run: (np.zeros(k, "int64"), np.zeros(k)) for run, k in sizes.items()}
        held, open_counts = None, {}  # the label that the last batch ended with

        def out(rows):
            types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        def close(label, split, counts):
            rows = []
            for run, n in counts.items():
                at = np.flatnonzero(n)
                if split:
                    rows += [(run, int(c), label, int(n[c]), None, None) for c in at]
                else:
                    total[run][0][at] += n[at]
                    total[run][1][at] += n[at] * np.log(n[at])
            return rows

        def gathered():
            some, rows = [], 0
            for batch in batches:
                some.append(batch)
                rows += batch.num_rows
                if not pruned or rows >= most:
                    yield pa.Table.from_batches(some).combine_chunks().to_batches()
                    some, rows = [], 0
            if some:
                yield pa.Table.from_batches(some).combine_chunks().to_batches()

        def clusters(x):
            if not pruned:
                return ((run, nearest(x, centers)[0]) for run, centers in runs.items())
            names = list(runs)
            return ((names[at], cluster) for at, cluster in nearest_rows(x, list(runs.values())))

        for batch in (b for part in gathered() for b in part):
            x, usable = read(batch.column(2))
            if not usable.any():
                continue
            x = take(x, usable)
            label = batch.column(0).filter(pa.array(usable)).to_numpy(zero_copy_only=False)
            split = batch.column(1).filter(pa.array(usable)).to_numpy(zero_copy_only=False)
            change = np.flatnonzero([a != b for a, b in zip(label[1:], label[:-1])]) + 1
            group = np.zeros(len(label), "int64")
            group[change] = 1
            group = np.cumsum(group)
            firsts = np.concatenate([[0], change])
            rows = []
            if held is not None and held[0] != label[0]:
                rows += close(*held, open_counts)
                open_counts = {}
            begun = {run: open_counts.get(run, np.zeros(k, "int64")) for run, k in sizes.items()}
            ended = {run: np.zeros(k, "int64") for run, k in sizes.items()}
            last = group[-1]
            for run, cluster in clusters(x):
                key = group * sizes[run] + cluster
                if (last + 1) * sizes[run] <= len(key):
                    n = np.bincount(key)
                    key = np.flatnonzero(n)
                    n = n[key]
                else:
                    key, n = np.unique(key, return_counts=True)
                g, c = key // sizes[run], key % sizes[run]
                begun[run][c[g == 0]] += n[g == 0]
                ended[run][c[g == last]] += n[g == last]
                whole = (g > 0) & (g < last)
                apart = whole & split[firsts[g]]
                rows += [(run, int(c[i]), label[firsts[g[i]]], int(n[i]), None, None) for i in np.flatnonzero(apart)]
                whole &= ~apart
                np.add.at(total[run][0], c[whole], n[whole])
                np.add.at(total[run][1], c[whole], n[whole] * np.log(n[whole]))
            held = (label[0], bool(split[0])) if last == 0 else (label[-1], bool(split[-1]))
            if last:
                rows += close(label[0], bool(split[0]), begun)
            open_counts = ended if last else begun
            if rows:
                yield out(rows)
        rows = close(*held, open_counts) if held is not None else []
        rows += [(run, int(c), None, None, int(t[c]), float(nln[c])) for run, (t, nln) in total.items() for c in np.flatnonzero(t)]
        if rows:
            yield out(rows)

    columns = [F.col("label"), F.col("split"), arrow_features(df, "features")]
    return df.select(*columns).mapInArrow(count, "run int, cluster int, label string, n long, t long, nln double")


def run_entropies(df: DataFrame, models: Mapping[int, Clustering], split_rows: int = SPLIT_ROWS) -> dict[int, float]:
    """The label entropy of each run, all of them in one pass over ``df`` (label, features).

    Rows are dealt by label once, whatever the number of runs: a label's rows then lie together, and
    a task adds up its labels' share of the entropy without giving out their counts. A label of more
    than ``split_rows`` rows is dealt to several tasks and its counts by cluster are put together.
    """
    if not models:
        return {}
    label = F.coalesce(F.col("label").cast("string"), F.lit("")), F.col("label").isNull()
    rows = df.select(label[0].alias("label"), label[1].alias("none"), "features").select(
        F.concat(F.when(F.col("none"), "0").otherwise("1"), "label").alias("label"), "features")
    many = rows.groupBy("label").agg(F.ceil(F.count("*") / split_rows).cast("int").alias("parts")).where("parts > 1")
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).join(many, "label", "left").select(
        "label", F.col("parts").isNotNull().alias("split"),
        F.when(F.col("parts").isNotNull(), F.pmod("row", "parts")).otherwise(0).cast("int").alias("part"), "features")
    dealt = dealt.repartition("label", "part").sortWithinPartitions("label")
    found = _label_runs(dealt, models)
    n = F.col("n")
    whole = found.where("t IS NOT NULL").groupBy("run", "cluster").agg(F.sum("t").alias("t"), F.sum("nln").alias("nln"))
    parts = found.where("n IS NOT NULL").groupBy("run", "cluster", "label").agg(F.sum("n").alias("n")).groupBy(
        "run", "cluster").agg(F.sum("n").alias("t"), F.sum(n * F.log(n)).alias("nln"))
    each = whole.unionByName(parts).groupBy("run", "cluster").agg(F.sum("t").alias("t"), F.sum("nln").alias("nln"))
    t = F.col("t")
    scores = each.groupBy("run").agg((F.sum(t * F.log(t) - F.col("nln")) / F.sum("t")).alias("score"))
    return {r["run"]: r["score"] for r in scores.collect()}


def k_grid(limit: int, step: int | None = None) -> list[int]:
    """The values of K to try: every one from 1 to ``limit``, or with ``step`` every so many,
    always with both ends."""
    if limit < 1:
        return []
    grid = list(range(1, limit + 1, step or 1))
    return grid if grid[-1] == limit else [*grid, limit]


Start = Callable[[int], Sequence]


def _fixed_start_fits(
    df: DataFrame, ks: Sequence[int], init: Start, tolerance: float, iterations: int
) -> dict[int, Clustering]:
    """All K of a sweep at once. ``init(k)`` gives one start or several, of which the best is kept."""
    starts = {k: np.asarray(init(k), dtype=float) for k in ks}
    several = {k: s for k, s in starts.items() if s.ndim == 3}
    models = lloyd_runs(df, {k: s for k, s in starts.items() if s.ndim == 2}, iterations, tolerance)
    for k, candidates in several.items():
        models[k] = best_of(df, lloyd_runs(df, dict(enumerate(candidates)), iterations, tolerance))
    return {k: models[k] for k in ks}


def fit_sweep(
    df: DataFrame, ks: Sequence[int], init: Start | None = None, restarts: int = RESTARTS,
    tolerance: float = RESTART_TOLERANCE, iterations: int = MAX_ITERATIONS, seed: int = 0,
) -> dict[int, Clustering]:
    """One clustering per K. All K and all restarts share their scans, and those of the seeding where
    no starts are given."""
    if init is not None:
        return _fixed_start_fits(df, ks, init, tolerance, iterations)
    return fit_seeded(df, ks, restarts, tolerance, iterations, seed)


def scores_table(spark: SparkSession, scores: Mapping[int, float | None]) -> DataFrame:
    rows = [(int(k), s) for k, s in scores.items() if s is not None]
    return spark.createDataFrame(rows, SCORE_SCHEMA)


def mean_distances(df: DataFrame, models: Mapping[int, Clustering]) -> dict[int, float | None]:
    """Mean distance per K, all measured in one scan."""
    if not models:
        return {}
    totals = run_totals(df, {k: m.centers for k, m in models.items()})
    return {k: t.mean_distance for k, t in totals.items()}


def sweep_mean_distance(df: DataFrame, ks: Sequence[int], init: Start | None = None, **options) -> DataFrame:
    """(k, score): mean distance, with the careful fit unless the options say otherwise."""
    models = fit_sweep(df, ks, init, **options)
    return scores_table(df.sparkSession, mean_distances(df, models))


def sweep_default_fit(df: DataFrame, ks: Sequence[int], init: Start | None = None, **options) -> DataFrame:
    """(k, score): mean distance with one seed and the default tolerance."""
    options = {"restarts": 1, "tolerance": DEFAULT_TOLERANCE, **options}
    return sweep_mean_distance(df, ks, init, **options)


def sweep_label_entropy(df: DataFrame, ks: Sequence[int], init: Start | None = None, **options) -> DataFrame:
    """(k, score): weighted label entropy, all K measured in one scan (``run_entropies``)."""
    models = fit_sweep(df, ks, init, **options)
    if not models:
        return scores_table(df.sparkSession, {})
    scores = run_entropies(df, models)
    return scores_table(df.sparkSession, scores)
