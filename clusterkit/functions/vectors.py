"""Expressions over feature arrays (``array<double>``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clusterkit.functions import sqltext as q


def squared_distances_text(features: str, centers: Sequence[Sequence[float]]) -> str:
    """SQL text: array of the squared distances of a row to constant points."""
    x = q.name(features)
    sums = []
    for center in centers:
        gaps = [f"({x}[{i}] - {q.number(c)})" for i, c in enumerate(center)]
        sums.append(" + ".join(f"{g} * {g}" for g in gaps))
    return q.array(sums)


def euclidean(a: Column, b: Column) -> Column:
    """Distance of two array columns of equal width."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def constant_array(values: Sequence[float]) -> Column:
    return F.expr(q.array([q.number(v) for v in values]))
