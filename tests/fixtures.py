"""Small inputs made by formulas; tests work out the answers."""

from __future__ import annotations


def trade_values(i: int) -> tuple:
    """Trade date, quantity, counterparty, version and effective date of row i, by formula."""
    return (str(20200101 + 3 * i), f"{1000 + 250 * (i * i % 7)}.5", ("NORTH", "SOUTH", "EAST")[i % 3], str(1 + i % 4),
            str(20210601 + i % 5))


TRADES = [trade_values(i) for i in range(10)]


def trade_line(row: tuple, trade_id: str, tail: str = ",,,") -> str:
    """A line of 28 fields; those without a column in ``row`` are named after their place."""
    day, quantity, counterparty, version, effective = row
    fields = [f"F{i}" for i in range(24)]
    fields[0], fields[2], fields[4], fields[5], fields[6] = day, trade_id, counterparty, day, quantity
    fields[12], fields[14], fields[18], fields[19] = version, effective, quantity, quantity
    fields[8] = fields[17] = fields[21] = fields[22] = ""
    return ",".join(fields) + "," + tail


TRADE_LINES = [trade_line(row, f"T{i}") for i, row in enumerate(TRADES)]
FULL_LINE = trade_line(TRADES[-1], "T9", "A,C,1,1")
SHORT_LINE = "1,2,3,4,5,6,7,8,9,10"

# Correlated rows by formula: the second coordinate follows the first, the last is almost constant.
PCA_ROWS = [[i, 2.0 * i + (i * 5 % 3), (i * 7 % 4) - 1.5, 0.5 * i * i, 3.0 + 0.01 * (i % 2)] for i in range(1, 8)]


def blobs(count: int = 240) -> list[list[float]]:
    """Three groups of points around (0, 0), (10, 0) and (0, 10), on a fixed irregular pattern."""
    centers = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)]
    points = []
    for i in range(count):
        x, y = centers[i % 3]
        points.append([x + ((i * 37) % 101) / 101 - 0.5, y + ((i * 53) % 97) / 97 - 0.5])
    return points


def features(spark, points: list, partitions: int = 3):
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id int, features array<double>").repartition(partitions)


def lines(spark, texts: list[str]):
    return spark.createDataFrame([(t,) for t in texts], "value string")
