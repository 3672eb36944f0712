"""k-means|| seeding of many runs in shared scans.

Each seed draws a first row, then in ``SEEDING_STEPS`` scans as many rows a scan as its oversampling
says, a row of weight w at squared distance d2 to the rows drawn so far with a chance in proportion
to w d2; then the drawn rows, weighted by the rows nearest to them, are thinned out to k starts in the
same manner. All seeds share each scan, and all k of a sweep share the rows drawn for the largest.

A draw is a race: of the keys -ln(u) / (w d2) the least win, which is sampling by weight
without replacement. As u comes from the row's own coordinates, the seed and the step, the starts are
the same however the rows are dealt to tasks, and whether a task runs once or again. Rows must be
different ones with weights, as from ``distinct_rows``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clusterkit.operators.kmeans import (
    GROUP_CELLS, MAX_MODEL_CELLS, SEEDING_STEPS, _kernel, arrow_features, is_vector, run_totals,
)
from clusterkit.operators.pruning import Packed, _block_distances, _unpack

#: Rows drawn a step, as a multiple of k.
OVERSAMPLING = 2
#: Draws of the starts have step numbers of their own.
THINNING = 100

# The draws: the fractional parts of multiples of these are spread evenly.
_STEP, _FIRST, _SECOND = 0.6180339887498949, 0.7548776662466927, 0.5698402909980532


def _part(x: float) -> float:
    return x - np.floor(x)


def draw_factor(seed: int, step: int) -> float:
    return float(1000.0 + 9000.0 * _part((4096 * seed + step + 1) * _STEP))


def mixing_factors(width: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(1, width + 1)
    return 1.0 + _part(at * _FIRST), 100.0 + 900.0 * _part(at * _SECOND)


def _mixer(width: int, sparse: bool) -> Callable:
    """A function from rows to one number each, by their coordinates in order."""
    first, second = mixing_factors(width)

    def mixed(rows):
        import numpy as np

        if not sparse:
            out = np.zeros(len(rows))
            for i in range(width):
                x = rows[:, i] * first[i]
                out = out + (x - np.floor(x)) * second[i]
            return out
        values, columns, starts = rows
        x = values * first[columns]
        each = (x - np.floor(x)) * second[columns]
        out = np.zeros(len(starts) - 1)
        np.add.at(out, np.repeat(np.arange(len(out)), np.diff(starts)), each)
        return out

    return mixed


def _racing() -> Callable:
    """The keys of a draw; rows without mass never win. A closure, so that workers need no copy of
    this package."""
    def race(mixed, factor, mass):
        import numpy as np

        u = mixed * factor
        u = u - np.floor(u)
        key = np.full(len(mixed), np.inf)
        runs = (u > 0) & (mass > 0)
        key[runs] = -np.log(u[runs]) / mass[runs]
        return key

    return race


def _drawn(
    rows: DataFrame | Packed, width: int, found: dict[int, np.ndarray | None], step: int, count: int, features: str
) -> dict[int, np.ndarray]:
    """For each seed the ``count`` rows with the least keys, in one scan."""
    blocks = isinstance(rows, Packed)
    sparse = not blocks and is_vector(rows, features)
    read, take, nearest, _ = _kernel(width, sparse)
    mixer, race = _mixer(width, sparse), _racing()
    unpack, block_distances = _unpack(width), _block_distances(width)
    factors = {seed: draw_factor(seed, step) for seed in found}
    drawing = [seed for seed, points in found.items() if points is not None]

    def parts(batches):
        """Rows, weights and the squared distances of each seed."""
        for batch in batches:
            if blocks:
                for block in unpack(batch):
                    each = ((drawing[at], d2) for at, d2 in block_distances(block, [found[seed] for seed in drawing]))
                    yield block[0].reshape(-1, width), block[1].ravel(), each if drawing else dict.fromkeys(found).items()
                continue
            x, usable = read(batch.column(0))
            if usable.any():
                x = take(x, usable)
                w = batch.column(1).to_numpy(zero_copy_only=False)[usable].astype(float)
                yield x, w, ((seed, points if points is None else nearest(x, points)[1]) for seed, points in found.items())

    def keys(batches: Iterable) -> Iterable:
        import numpy as np
        import pyarrow as pa

        best: dict = {}  # by seed the least keys, ascending, and their rows
        for x, w, each in parts(batches):
            mixed = mixer(x)
            for seed, d2 in each:
                key = race(mixed, factors[seed], w if d2 is None else w * d2)
                full = seed in best and len(best[seed][0]) == count
                key[key > (best[seed][0][-1] if full else np.inf)] = np.inf
                at = np.argsort(key, kind="stable")[:count]
                at = at[key[at] < np.inf]
                if not len(at):
                    continue
                part = take(x, at)
                if sparse:
                    values, columns, starts = part
                    part = np.zeros((len(at), width))
                    part[np.repeat(np.arange(len(at)), np.diff(starts)), columns] = values
                new = (key[at], part)
                if seed in best:
                    new = tuple(np.concatenate(pair) for pair in zip(best[seed], new))
                    order = np.argsort(new[0], kind="stable")[:count]
                    new = (new[0][order], new[1][order])
                best[seed] = new
        for seed, (key, x) in best.items():
            ends = np.arange(0, (len(key) + 1) * width, width, dtype="int32")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(key), seed, dtype="int32")), pa.array(key),
                 pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=["seed", "key", "x"])

    source = rows.blocks if blocks else rows.select(arrow_features(rows, features), "weight")
    drawn = source.mapInArrow(keys, "seed int, key double, x array<double>")
    order = Window.partitionBy("seed").orderBy("key", "x")
    table = drawn.withColumn("n", F.row_number().over(order)).where(F.col("n") <= count).toArrow()
    out = {seed: np.zeros((0, width)) for seed in found}
    if len(table):
        seeds, at = table["seed"].to_numpy(), table["n"].to_numpy()
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(table), width)
        for seed in found:
            mine = np.flatnonzero(seeds == seed)
            out[seed] = x[mine[np.argsort(at[mine])]]
    return out


def thinned(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k of the weighted points (fewer, if they are fewer), each drawn by weight and distance to those
    before it; the first of them are the starts for every smaller k."""
    mixed, race = _mixer(points.shape[1], False)(points), _racing()
    d2 = np.ones(len(points))
    chosen: list[int] = []
    for step in range(min(k, len(points))):
        key = race(mixed, draw_factor(seed, THINNING + step), weights * d2)
        at = int(key.argmin())
        if key[at] == np.inf:
            break
        chosen.append(at)
        gap = ((points - points[at]) ** 2).sum(axis=1)
        d2 = gap if step == 0 else np.minimum(d2, gap)
    return points[chosen]


def seeded_starts(
    rows: DataFrame | Packed, width: int, ks: Sequence[int], seeds: Iterable[int], features: str = "features"
) -> dict[int, dict[int, np.ndarray]]:
    """Starts by k and seed, in ``SEEDING_STEPS`` + 2 scans of ``rows`` (features, weight) for all of
    them; more where the rows drawn are too many to travel with the tasks at once."""
    seeds, most = list(seeds), max(ks)
    count = OVERSAMPLING * most
    if (1 + SEEDING_STEPS * count) * width > MAX_MODEL_CELLS:
        count = max(1, (MAX_MODEL_CELLS // width - 1) // SEEDING_STEPS)
        if 1 + SEEDING_STEPS * count < most:
            raise ValueError(f"{most} centers of {width} coordinates are more than a task may hold")
    together = max(1, GROUP_CELLS // ((1 + SEEDING_STEPS * count) * width))
    sequence: dict[int, np.ndarray] = {}
    for begin in range(0, len(seeds), together):
        group = seeds[begin:begin + together]
        found = _drawn(rows, width, dict.fromkeys(group), 0, 1, features)
        for step in range(1, SEEDING_STEPS + 1):
            if not any(map(len, found.values())):
                break
            more = _drawn(rows, width, {s: p for s, p in found.items() if len(p)}, step, count, features)
            found = {s: np.vstack([p, more[s]]) if s in more else p for s, p in found.items()}
        some = {s: p for s, p in found.items() if len(p)}
        totals = run_totals(rows, some, features, "weight", distances=False) if some else {}
        for s, points in found.items():
            sequence[s] = thinned(points, totals[s].count, most, s) if s in totals else points
    return {k: {s: x[:k] for s, x in sequence.items()} for k in ks}
