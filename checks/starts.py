"""Fixed starting centers, given alike to the Spark queries and to their SQL."""

from __future__ import annotations

from clusterkit.operators.kmeans import diagonal_start

ITERATIONS = 4

# lineitem as (quantity, price in thousands, discount in percent, tax in percent).
ITEM_STARTS = [[10.0, 20.0, 2.0, 2.0], [25.0, 50.0, 5.0, 4.0], [40.0, 80.0, 8.0, 6.0]]
ITEM_RESTARTS = [
    ITEM_STARTS,
    [[5.0, 10.0, 5.0, 4.0], [30.0, 30.0, 5.0, 4.0], [45.0, 90.0, 5.0, 4.0]],
    [[25.0, 15.0, 1.0, 1.0], [25.0, 55.0, 9.0, 1.0], [25.0, 85.0, 5.0, 8.0]],
]
SWEEP = [1, 2, 3, 4]
TRADE_WIDTH = 35
TRADE_NUMBERS = 10


def trade_start(k: int) -> list[list[float]]:
    """Raw trade numbers: mid-range values, the notionals spread over their range."""
    return [
        [2e7, 2e7, 25.0, 4.0, 2e7, 1e5 * (j + 0.5) / k, 1e5 * (j + 0.5) / k, 0.04, 0.0, 0.0]
        for j in range(k)
    ]


def careful_start(k: int) -> list[list[float]]:
    """The same numbers with the notionals crowded at the low end of their range."""
    return [[2e7, 2e7, 25.0, 4.0, 2e7, 3e4 * (j + 1) / k, 3e4 * (j + 1) / k, 0.04, 0.0, 0.0] for j in range(k)]


def spread(width: int):
    """K -> starting centers for z-scored features."""
    return lambda k: diagonal_start(k, width).tolist()


def event_start(k: int) -> list[list[float]]:
    """Raw event numbers (user, amount, hour): the amounts spread over their range."""
    return [[50.0, 200.0 * (j + 0.5) / k, 12.0] for j in range(k)]


# events as (value, hour of day).
EVENT_STARTS = [[10.0, 6.0], [60.0, 18.0], [150.0, 12.0]]
BATCHES = 3
