"""Counting operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, value: Column) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    counts = df.groupBy(value.alias("value")).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "value")


def cluster_label_counts(assigned: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """Rows per (cluster, label), in that order."""
    counts = assigned.groupBy(cluster, label).agg(F.count("*").alias("count"))
    return counts.orderBy(cluster, label)
