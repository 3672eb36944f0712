"""The batch clustering jobs.

Each takes a DataFrame of lines (``value``) and a ``RecordSpec``. ``init`` gives fixed starting
centers, for a sweep as a function of K, in place of k-means|| with restarts. ``ks`` names the
values of K of a sweep; without it they run up to the rule of thumb.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterkit.functions.fields import cluster_score_line, last_nonempty_field
from clusterkit.operators.counts import cluster_label_counts, value_counts
from clusterkit.operators.encode import Dictionaries, assemble_numeric
from clusterkit.operators.kmeans import DEFAULT_K, assign, centers_table, estimate_k, fit
from clusterkit.operators.quality import (
    k_grid, sweep_default_fit, sweep_label_entropy, sweep_mean_distance,
)
from clusterkit.plans.features import PCA_COMPONENTS, categorical_features, kept, normalised, projected
from clusterkit.sinks.text import append_lines
from clusterkit.sources.records import RecordSpec, parse_records

Start = Callable[[int], Sequence]


@dataclass(frozen=True)
class CrossTab:
    last_fields: DataFrame
    centers: DataFrame
    counts: DataFrame


def _records(lines: DataFrame, spec: RecordSpec, label: str | None) -> DataFrame:
    records = parse_records(lines, spec)
    return records if label is None else records.withColumn("label", F.col(label).cast("string"))


def _grid(features: DataFrame, ks: Sequence[int] | None, step: int | None) -> Sequence[int]:
    return k_grid(estimate_k(features), step) if ks is None else ks


def cross_tab_job(
    lines: DataFrame, spec: RecordSpec, init: Sequence | None = None, label: str | None = None, **options
) -> CrossTab | None:
    """Counts of the last field, a default clustering of the numbers and its cluster/label counts."""
    data = assemble_numeric(_records(lines, spec, label), spec)
    with kept(data.select("features")) as features:
        model = fit(features, DEFAULT_K, init=init, **options)
    if model is None:
        return None
    return CrossTab(
        last_fields=value_counts(lines, last_nonempty_field(F.col("value"), spec.delimiter)),
        centers=centers_table(lines.sparkSession, model),
        counts=cluster_label_counts(assign(data, model)),
    )


def raw_sweep_job(
    lines: DataFrame, spec: RecordSpec, ks: Sequence[int] | None = None, init: Start | None = None,
    step: int | None = None, careful_init: Start | None = None, **options,
) -> DataFrame:
    """(k, score, score2): mean distance of a default fit and of the careful fit, numbers as they are.
    ``careful_init`` gives the careful fit starts of its own; without it both have those of ``init``."""
    with kept(assemble_numeric(parse_records(lines, spec), spec).select("features")) as features:
        ks = _grid(features, ks, step)
        first = sweep_default_fit(features, ks, init, **options)
        second = sweep_mean_distance(features, ks, careful_init or init, **options)
    return first.join(second.withColumnRenamed("score", "score2"), "k")


def normalised_sweep_job(
    lines: DataFrame, spec: RecordSpec, ks: Sequence[int] | None = None, init: Start | None = None,
    step: int | None = None, **options,
) -> DataFrame:
    """(k, score): the careful fit on z-scored numbers."""
    with kept(assemble_numeric(parse_records(lines, spec), spec).select("features")) as numbers:
        features = normalised(numbers)
        return sweep_mean_distance(features, _grid(features, ks, step), init, **options)


def categorical_sweep_job(
    lines: DataFrame, spec: RecordSpec, ks: Sequence[int] | None = None, init: Start | None = None,
    step: int | None = None, dictionaries: Dictionaries | None = None,
    include_label: bool = False, **options,
) -> DataFrame:
    """(k, score): the careful fit on z-scored numbers and one-hot categories."""
    encoded = categorical_features(
        parse_records(lines, spec), spec, dictionaries=dictionaries, include_label=include_label,
        dense=init is not None,
    )
    with kept(encoded.select("features")) as plain:
        features = normalised(plain)
        return sweep_mean_distance(features, _grid(features, ks, step), init, **options)


def pca_entropy_job(
    lines: DataFrame, spec: RecordSpec, ks: Sequence[int] | None = None, init: Start | None = None,
    components: int = PCA_COMPONENTS, step: int | None = None,
    dictionaries: Dictionaries | None = None, label: str | None = None, include_label: bool = False,
    normalise_first: bool = False, **options,
) -> DataFrame:
    """(k, score): weighted label entropy on the z-scored principal components."""
    encoded = categorical_features(
        _records(lines, spec, label), spec, dictionaries=dictionaries, include_label=include_label
    )
    with kept(encoded) as plain, kept(projected(plain, components, normalise_first)) as data:
        return sweep_label_entropy(data, _grid(data, ks, step), init, **options)


def write_scores(scores: DataFrame, path: str, decimals: int | None = None) -> None:
    """A sweep's result as text, one line for each K: ``cluster 3 score 0.25``."""
    append_lines(scores, cluster_score_line(F.col("k"), F.col("score"), decimals), path)
