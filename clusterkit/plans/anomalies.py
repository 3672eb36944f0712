"""The anomaly jobs: fit on one set of lines, then flag lines of that or any other set."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterkit.operators.anomaly import (
    ANOMALY_CLUSTERS, ANOMALY_RANK, Detector, farthest, fit_detector,
)
from clusterkit.operators.encode import Dictionaries, WideDictionaries, fit_any_dictionaries
from clusterkit.operators.normalise import ZScore, apply_zscore, fit_zscore, scale_vectors
from clusterkit.operators.pca import Projection, WideProjection, apply_pca, fit_pca
from clusterkit.plans.features import PCA_COMPONENTS, categorical_features, kept
from clusterkit.sinks.text import append_lines
from clusterkit.sources.records import RecordSpec, parse_records


def _scaled(df: DataFrame, zscore: ZScore) -> DataFrame:
    if isinstance(df.schema["features"].dataType, VectorUDT):
        return scale_vectors(df, zscore, nan_to_zero=True)
    return apply_zscore(df, zscore, nan_to_zero=True)


@dataclass(frozen=True)
class AnomalyModel:
    """Everything fitted, all of it model-sized. ``anomalies`` is a stateless projection and
    filter, so it takes a streaming DataFrame of lines as well, unless dictionaries are tables."""

    spec: RecordSpec
    dictionaries: Dictionaries | WideDictionaries
    projection: Projection | WideProjection | None
    zscore: ZScore
    detector: Detector
    include_label: bool
    dense: bool

    def features(self, lines: DataFrame) -> DataFrame:
        """(label, value, features), ready to be scored."""
        encoded = categorical_features(
            parse_records(lines, self.spec), self.spec, "value", dictionaries=self.dictionaries,
            include_label=self.include_label, dense=self.dense,
        )
        return _scaled(encoded if self.projection is None else apply_pca(encoded, self.projection), self.zscore)

    def anomalies(self, lines: DataFrame) -> DataFrame:
        """(label, value, cluster, distance) of the anomalous lines."""
        return self.detector.anomalies(self.features(lines)).select("label", "value", "cluster", "distance")


def fit_anomaly_model(
    lines: DataFrame, spec: RecordSpec, components: int | None = PCA_COMPONENTS,
    k: int | None = ANOMALY_CLUSTERS, rank: int = ANOMALY_RANK, init: Sequence | None = None,
    include_label: bool = False, **options,
) -> AnomalyModel | None:
    """Encode, project (``components=None`` leaves that out), z-score, cluster and take the
    threshold. None if no line can be used."""
    records = parse_records(lines, spec)
    dictionaries = fit_any_dictionaries(records, spec.category_names(include_label))
    dense = init is not None
    encoded = categorical_features(
        records, spec, dictionaries=dictionaries, include_label=include_label, dense=dense
    )
    with kept(encoded.select("features")) as plain:
        projection, data = None, plain
        if not plain.isEmpty() and components is not None:
            projection = fit_pca(plain, components)
            data = apply_pca(plain, projection)
        zscore = fit_zscore(data)
        if zscore is None:
            return None
        with kept(_scaled(data, zscore)) as features:
            detector = fit_detector(features, k, rank, init, **options)
    if detector is None:
        return None
    return AnomalyModel(spec, dictionaries, projection, zscore, detector, include_label, dense)


def _none_of(lines: DataFrame) -> DataFrame:
    return lines.where(F.lit(False)).select("value", F.lit(0.0).alias("distance"))


def pca_anomalies_job(lines: DataFrame, spec: RecordSpec, **options) -> DataFrame:
    """The lines whose principal components are anomalies, as (value, distance)."""
    model = fit_anomaly_model(lines, spec, **options)
    return _none_of(lines) if model is None else model.anomalies(lines).select("value", "distance")


def top_anomalies_job(lines: DataFrame, spec: RecordSpec, count: int = 10, **options) -> DataFrame:
    """The ``count`` farthest anomalies without a projection, as (value, distance)."""
    model = fit_anomaly_model(lines, spec, components=None, **options)
    if model is None:
        return _none_of(lines)
    return farthest(model.anomalies(lines).select("value", "distance"), count, "value")


def write_anomalies(found: DataFrame, path: str) -> None:
    """The anomalous lines as text, as they came."""
    append_lines(found, F.col("value"), path)
