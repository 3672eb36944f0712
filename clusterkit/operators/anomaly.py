"""Anomalies: rows farther from their center than the 100th farthest training row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterkit.operators.kmeans import Clustering, assign, estimate_k, fit_best_of_ten

# Fixed values.
ANOMALY_RANK = 100
ANOMALY_CLUSTERS = 150
# Ranks up to this are merged in one task; bins of a histogram that narrows down a larger one.
MERGED_RANK, BINS = 100_000, 4096


def rank_threshold(assigned: DataFrame, rank: int = ANOMALY_RANK, merged: int = MERGED_RANK) -> DataFrame:
    """The rank-th largest distance, or the smallest one if there are fewer rows, as (threshold).

    Up to ``merged`` rows each task keeps its own top ``rank``, and only those are merged. A larger
    rank is narrowed down first: a histogram of all distances says in which of its bins the rank lies,
    that bin is divided in the next scan, and so on until it holds ``merged`` rows or one value. A bin
    is bounded by the least and the largest distance in it, so ties end the search.
    """
    distances = assigned.select("distance").where("distance IS NOT NULL")
    if rank <= merged:
        return distances.orderBy(F.desc("distance")).limit(rank).agg(F.min("distance").alias("threshold"))
    low, high, count = distances.agg(F.min("distance"), F.max("distance"), F.count("*")).first()
    spark = assigned.sparkSession
    if count <= rank or low == high:
        return spark.createDataFrame([(low,)], "threshold double")
    d = F.col("distance")
    while count > merged and low < high:
        at = F.least(F.floor((d - F.lit(low)) / F.lit(high - low) * BINS), F.lit(BINS - 1))
        inside = distances.where((d >= F.lit(low)) & (d <= F.lit(high)))
        bins = inside.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.min(d).alias("low"), F.max(d).alias("high"))
        for row in bins.orderBy(F.desc("bin")).collect():  # at most BINS rows
            if rank <= row["n"]:
                break
            rank -= row["n"]
        low, high, count = row["low"], row["high"], row["n"]
    if low == high:
        return spark.createDataFrame([(low,)], "threshold double")
    return rank_threshold(distances.where((d >= F.lit(low)) & (d <= F.lit(high))), rank, max(merged, rank))


@dataclass(frozen=True)
class Detector:
    model: Clustering
    threshold: float

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``cluster``, ``distance`` and ``anomaly`` (strictly above the threshold)."""
        scored = assign(df, self.model, hold=True)
        return scored.withColumn("anomaly", F.col("distance") > F.lit(self.threshold))

    def anomalies(self, df: DataFrame) -> DataFrame:
        """The rows above the threshold. Works on a streaming DataFrame too."""
        return self.score(df).where("anomaly").drop("anomaly")


def fit_detector(
    df: DataFrame, k: int | None = None, rank: int = ANOMALY_RANK, init: Sequence | None = None,
    **options,
) -> Detector | None:
    """Cluster normalised features and take the threshold from their distances.

    ``k=None`` uses the rule of thumb. None if there is nothing to cluster.
    """
    if k is None:
        k = len(init) if init is not None else estimate_k(df)
    model = fit_best_of_ten(df, k, init=init, **options)
    if model is None:
        return None
    threshold = rank_threshold(assign(df, model), rank).first()["threshold"]
    return None if threshold is None else Detector(model, threshold)


def farthest(scored: DataFrame, count: int, *ties: str) -> DataFrame:
    """The rows with the largest distances, farthest first."""
    return scored.orderBy(F.desc("distance"), *ties).limit(count)
