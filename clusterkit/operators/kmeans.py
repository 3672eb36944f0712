"""K-means: seeded and fixed-start fits, assignment and distances, on arrays and on sparse vectors.

Many clusterings of the same rows (a sweep over K, restarts) share each scan: they are the
"runs" of one pass. What a pass brings back is one row per run and cluster. Seeding is shared in the
same way (``seeding.py``).

Assignment has two forms, chosen by the number of coordinates in all centers (cells):

* one run of few cells: a literal expression per center inside whole-stage code. 600,000 rows with
  100 cells take 0.3 s; the same with 200 cells takes 5 s, as the generated method becomes too
  large for the JIT compiler, so the bound is below that. Several runs in one method meet the
  same limit early (30 cells in four runs: 2.5 s per pass, most of it compilation);
* all else: matrix products in Arrow batches, 0.6 s at 500 cells. Sparse rows come as compressed rows
  (values, columns, starts) and meet the centers in the columns they have.

Neither joins rows to centers, so nothing is shuffled but the per-cluster sums. Fits and sums of
many centers on arrays that are not wide go by a third way (``pruning.py``), which deals the rows by place once
and spares most distances in every scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterkit.functions import sqltext as q
from clusterkit.functions.fields import k_rule_of_thumb, once
from clusterkit.functions.vectors import euclidean, squared_distances_text
from clusterkit.operators import pruning
from clusterkit.operators.normalise import feature_width
from clusterkit.operators.pruning import Packed

MAX_UNROLLED_CELLS = 96
# Models travel with the tasks and are summed on the driver: 64 million doubles are 512 MB. Runs that
# are more together take their scans in groups.
MAX_MODEL_CELLS = 64_000_000
GROUP_CELLS = 8_000_000
# From so many centers on bounds are worth the 20 bytes a row and run that carry them; runs of one scan.
BOUNDED_K, BOUNDED_RUNS = 32, 64
# Arrays up to this width that meet so many centers are dealt by place and meet them in a tree.
# For one scan they must be so many times as many.
MAX_PRUNED_WIDTH, PRUNED_CENTERS, PACKED_SCANS = 48, 256, 16

# Fixed values of the default and of the careful fit.
DEFAULT_K = 2
DEFAULT_TOLERANCE = 1e-4
RESTARTS = 10
RESTART_TOLERANCE = 1e-6
MAX_ITERATIONS = 20
SEEDING_STEPS = 5

NEAREST_TYPE = "array<struct<run:int,cluster:int,distance:double>>"


@dataclass(frozen=True)
class Clustering:
    """Centers (one row each), rows per center and the sum of squared distances, where known."""

    centers: np.ndarray
    weights: np.ndarray | None = None
    cost: float | None = None

    @property
    def k(self) -> int:
        return len(self.centers)


def centers_table(spark: SparkSession, model: Clustering) -> DataFrame:
    """(cluster, center, weight)."""
    weights = [None] * model.k if model.weights is None else [float(w) for w in model.weights]
    rows = [(i, [float(x) for x in c], w) for i, (c, w) in enumerate(zip(model.centers, weights))]
    return spark.createDataFrame(rows, "cluster int, center array<double>, weight double")


def diagonal_start(k: int, width: int, low: float = -1.0, high: float = 1.0) -> np.ndarray:
    """k points spread evenly along the diagonal of the box [low, high]: a start that depends on
    neither the data nor chance, made for z-scored features."""
    steps = low + (high - low) * (np.arange(k) + 0.5) / max(k, 1)
    return np.repeat(steps[:, None], width, axis=1)


def estimate_k(df: DataFrame) -> int:
    """Rule of thumb for the number of clusters: the root of half the row count."""
    return df.agg(k_rule_of_thumb(F.count("*")).alias("k")).first()["k"]


def usable_text(features: str, width: int) -> str:
    """SQL: a features array of this width without a null or NaN. Rows that fail it are in no
    cluster, in every form of assignment, and count in no sum."""
    x = q.name(features)
    if width <= MAX_UNROLLED_CELLS:
        each = " AND ".join(f"{x}[{i}] IS NOT NULL AND NOT isnan({x}[{i}])" for i in range(width)) or "true"
    else:
        each = f"forall({x}, v -> v IS NOT NULL AND NOT isnan(v))"
    return f"CASE WHEN size({x}) = {width} THEN {each} ELSE false END"


# -- assignment -------------------------------------------------------------------------------


def _cells(runs: Mapping[int, np.ndarray]) -> int:
    cells = sum(c.size for c in runs.values())
    if cells > MAX_MODEL_CELLS:
        raise ValueError(f"{cells} center coordinates are more than the {MAX_MODEL_CELLS} a task may hold")
    return cells


def _unrolls(runs: Mapping[int, np.ndarray]) -> bool:
    return _cells(runs) <= MAX_UNROLLED_CELLS and len(runs) == 1


def _kernel(width: int, sparse: bool) -> tuple[Callable, Callable, Callable, Callable]:
    """The Arrow form's helpers, as closures so that workers need no copy of this package:

    ``read(column)``: rows and which of them are usable;
    ``take(rows, which)``: those rows;
    ``nearest(rows, centers)``: nearest center (the lower id on a tie) and squared distance, and where
    it is asked for, a bound below which no other center's distance is;
    ``sums(rows, cluster, weight, k)``: sums of weighted rows by cluster.
    """
    import numpy as np

    TILE = 2_000_000  # products held at a time

    def read_arrays(column):
        lengths = np.diff(column.offsets.to_numpy())
        values = column.values.to_numpy(zero_copy_only=False).astype(float)
        if not column.null_count and (lengths == width).all():
            start = column.offsets[0].as_py()
            x = values[start:start + len(column) * width].reshape(len(column), width)
        else:  # nulls and other widths become rows of NaN
            x = np.full((len(column), width), np.nan)
            good = (lengths == width) & column.is_valid().to_numpy(zero_copy_only=False)
            begin = column.offsets.to_numpy()[:-1][good]
            x[good] = values[begin[:, None] + np.arange(width)]
        return x, ~np.isnan(x).any(axis=1)

    def read_vectors(column):
        # Structs of type (0: sparse), size, indices, values; a dense one has all columns.
        kind = column.field("type").fill_null(1).to_numpy(zero_copy_only=False)
        listed, held = column.field("indices"), column.field("values")
        count = np.diff(held.offsets.to_numpy()) * held.is_valid().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(count)])
        values = held.flatten().to_numpy(zero_copy_only=False).astype(float)
        columns = np.arange(starts[-1]) - np.repeat(starts[:-1], count)
        columns[np.repeat(kind == 0, count)] = listed.flatten().to_numpy(zero_copy_only=False)
        size = np.where(kind == 0, column.field("size").fill_null(-1).to_numpy(zero_copy_only=False), count)
        bad = np.zeros(len(column), dtype=bool)
        bad[np.repeat(np.arange(len(column)), count)[np.isnan(values)]] = True
        valid = column.is_valid().to_numpy(zero_copy_only=False) & held.is_valid().to_numpy(zero_copy_only=False)
        return (values, columns, starts), valid & ~bad & (size == width)

    def take_vectors(rows, which):
        values, columns, starts = rows
        which = np.flatnonzero(which) if which.dtype == bool else which
        count = (starts[1:] - starts[:-1])[which]
        ends = np.concatenate([[0], np.cumsum(count)])
        place = np.arange(ends[-1]) - np.repeat(ends[:-1], count) + np.repeat(starts[:-1][which], count)
        return values[place], columns[place], ends

    def by_row(products, starts):
        """Sums of the stretches between starts, of which some are empty."""
        out = np.zeros((len(starts) - 1, *products.shape[1:]))
        some = starts[1:] > starts[:-1]
        if some.any():
            out[some] = np.add.reduceat(products, starts[:-1][some], axis=0)
        return out

    def dense(rows):
        values, columns, starts = rows
        x = np.zeros((len(starts) - 1, width))
        x[np.repeat(np.arange(len(x)), np.diff(starts)), columns] = values
        return x

    def products(rows, turned, origin):
        # turned: centers less the origin, a column each; the shift of the rows is their product, too
        if not sparse:
            return (rows - origin) @ turned
        values, columns, starts = rows
        out = np.empty((len(starts) - 1, turned.shape[1]))
        most = max(1, TILE // turned.shape[1])
        a = 0
        while a < len(out):
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + most, side="right")) - 1)
            b = min(b, len(out))
            part = slice(starts[a], starts[b])
            out[a:b] = by_row(values[part, None] * turned[columns[part]], starts[a:b + 1] - starts[a])
            a = b
        return out

    def nearest(rows, centers, with_next=False):
        # |x|^2 - 2xc + |c|^2 rounds, so rows where two centers come out close are measured again.
        # Centers are taken in tiles, with the two least values so far.
        n = len(rows[2]) - 1 if sparse else len(rows)
        origin = np.zeros(width) if sparse else centers.mean(axis=0)
        x2 = by_row(rows[0] ** 2, rows[2]) if sparse else ((rows - origin) ** 2).sum(axis=1)
        best, second, cluster = np.full(n, np.inf), np.full(n, np.inf), np.zeros(n, dtype="int64")
        step = max(1, min(len(centers), TILE // max(1, n), TILE * 4 // max(1, width)))
        largest = 0.0
        tiles = [(c0, centers[c0:c0 + step]) for c0 in range(0, len(centers), step)]
        for c0, some in tiles:
            cs = some - origin
            c2 = (cs * cs).sum(axis=1)
            largest = max(largest, c2.max())
            rough = x2[:, None] - 2.0 * products(rows, np.ascontiguousarray(cs.T), origin) + c2[None, :]
            at = rough.argmin(axis=1)
            low = rough[np.arange(n), at]
            rough[np.arange(n), at] = np.inf
            next_ = rough.min(axis=1)
            second = np.minimum(np.maximum(best, low), np.minimum(second, next_))
            cluster = np.where(low < best, at + c0, cluster)
            best = np.minimum(best, low)
        margin = 1e-9 * (x2 + largest)
        beyond = np.sqrt(np.maximum(0.0, second - margin)) if with_next else None
        unsure = np.flatnonzero(second <= best + margin)
        for start in range(0, len(unsure), 256):
            which = unsure[start:start + 256]
            part = take(rows, which)
            full = dense(part) if sparse else part
            low, winner = np.full(len(which), np.inf), np.zeros(len(which), dtype="int64")
            for c0, some in tiles:
                cs = some - origin
                rough = x2[which, None] - 2.0 * products(part, np.ascontiguousarray(cs.T), origin) + (cs * cs).sum(axis=1)[None, :]
                r, c = np.nonzero(rough <= (best[which] + margin[which])[:, None])
                for begin in range(0, len(r), max(1, TILE // max(1, width))):
                    rr, cc = r[begin:begin + TILE // max(1, width) + 1], c[begin:begin + TILE // max(1, width) + 1]
                    gap = full[rr] - some[cc]
                    d2 = (gap * gap).sum(axis=1)
                    order = np.lexsort((cc, d2, rr))
                    first = order[np.concatenate([[True], rr[order][1:] != rr[order][:-1]])]
                    better = d2[first] < low[rr[first]]
                    first = first[better]
                    low[rr[first]], winner[rr[first]] = d2[first], cc[first] + c0
            cluster[which] = winner
        if not sparse:
            gap = rows - centers[cluster]
            squared = (gap * gap).sum(axis=1)
            return (cluster, squared, beyond) if with_next else (cluster, squared)
        values, columns, starts = rows
        mine = centers[np.repeat(cluster, np.diff(starts)), columns]
        c2 = (centers * centers).sum(axis=1)[cluster]
        squared = by_row((values - mine) ** 2, starts) + np.maximum(0.0, c2 - by_row(mine * mine, starts))
        return (cluster, squared, beyond) if with_next else (cluster, squared)

    def to_own(rows, centers):
        """Distance of each row to its own one of ``centers``, a center a row."""
        if not sparse:
            gap = rows - centers
            return np.sqrt((gap * gap).sum(axis=1))
        values, columns, starts = rows
        mine = centers[np.repeat(np.arange(len(starts) - 1), np.diff(starts)), columns]
        rest = np.maximum(0.0, (centers * centers).sum(axis=1) - by_row(mine * mine, starts))
        return np.sqrt(by_row((values - mine) ** 2, starts) + rest)

    nearest.to_own = to_own

    def take(rows, which):
        return take_vectors(rows, which) if sparse else rows[which]

    def sums(rows, cluster, weight, total):
        if not sparse:
            order = np.argsort(cluster, kind="stable")
            present, first = np.unique(cluster[order], return_index=True)
            if len(present):
                x = rows[order] if weight is None else rows[order] * weight[order, None]
                total[present] += np.add.reduceat(x, first, axis=0)
            return
        values, columns, starts = rows
        count = np.diff(starts)
        if weight is not None:
            values = values * np.repeat(weight, count)
        cell = np.repeat(cluster, count) * width + columns
        order = np.argsort(cell, kind="stable")
        present, first = np.unique(cell[order], return_index=True)
        if len(present):
            total.ravel()[present] += np.add.reduceat(values[order], first)

    return (read_vectors if sparse else read_arrays), take, nearest, sums


def is_vector(df: DataFrame, features: str) -> bool:
    """Whether the features are vectors, as such or as the structs they are made of."""
    return isinstance(df.schema[features].dataType, (VectorUDT, T.StructType))


def arrow_features(df: DataFrame, features: str) -> Column:
    """The features as the Arrow form reads them: arrays, or vectors as structs."""
    return F.unwrap_udt(features) if isinstance(df.schema[features].dataType, VectorUDT) else F.col(features)


def _nearest_arrow(runs: Mapping[int, np.ndarray], width: int, sparse: bool) -> Callable:
    read, take, nearest, _ = _kernel(width, sparse)
    labels = np.array(list(runs), dtype="int32")
    all_centers = list(runs.values())

    def assign(features):
        import numpy as np
        import pyarrow as pa

        x, usable = read(features)
        clusters = np.zeros((len(usable), len(labels)), dtype="int32")
        distances = np.zeros((len(usable), len(labels)))
        if usable.any():
            some = take(x, usable)
            for i, centers in enumerate(all_centers):
                clusters[usable, i], squared = nearest(some, centers)
                distances[usable, i] = np.sqrt(squared)
        none = np.repeat(~usable, len(labels))
        entries = pa.StructArray.from_arrays(
            [pa.array(np.tile(labels, len(usable))), pa.array(clusters.ravel(), mask=none),
             pa.array(distances.ravel(), mask=none)],
            names=["run", "cluster", "distance"],
        )
        offsets = np.arange(0, (len(usable) + 1) * len(labels), len(labels), dtype="int32")
        return pa.ListArray.from_arrays(offsets[:len(usable) + 1], entries)

    # PySpark reads the kind of UDF from the hints, which must be classes and not their names.
    assign.__annotations__ = {"features": pa.Array, "return": pa.Array}
    return F.arrow_udf(assign, NEAREST_TYPE)


def with_nearest(df: DataFrame, runs: Mapping[int, np.ndarray], features: str = "features") -> DataFrame:
    """Add ``nearest``: per run the nearest center (the lower id on a tie) and its distance, both
    null for a row that is null, has a null or NaN, or is of another width."""
    sparse = is_vector(df, features)
    if sparse or not _unrolls(runs):
        width = next(iter(runs.values())).shape[1]
        return df.withColumn("nearest", _nearest_arrow(runs, width, sparse)(arrow_features(df, features)))
    (run, centers), = runs.items()
    entry = (
        f"array(named_struct('run', {run}, 'cluster', cast(array_position(__squared, array_min(__squared)) - 1 AS int), "
        "'distance', sqrt(array_min(__squared))))"
    )
    usable = usable_text(features, centers.shape[1])
    squared = df.withColumn("__squared", F.expr(f"CASE WHEN {usable} THEN {squared_distances_text(features, centers)} END"))
    # Generated, so that neither filters nor fields of it repeat the distances (33 s down to 6 s for
    # 600,000 rows and five scans).
    return squared.withColumn("nearest", once(F.expr(entry))).drop("__squared")


def assign(df: DataFrame, model: Clustering, features: str = "features", hold: bool = False) -> DataFrame:
    """Add ``cluster`` and ``distance``, the nearest center and how far it is.

    ``hold`` keeps filters on them above the features and the assignment, which would else be
    worked out again inside the filter.
    """
    near = F.col("nearest")[0]
    if hold:
        df = df.withColumn(features, once(features))
    found = with_nearest(df, {0: model.centers}, features)
    if hold and (is_vector(df, features) or not _unrolls({0: model.centers})):
        found = found.withColumn("nearest", once("nearest"))
    return found.withColumns({"cluster": near["cluster"], "distance": near["distance"]}).drop("nearest")


def with_center(assigned: DataFrame, model: Clustering) -> DataFrame:
    """Add the ``center`` of each row's cluster. The table joined is the model, whose size is
    bounded, so it is broadcast."""
    _cells({0: model.centers})
    centers = centers_table(assigned.sparkSession, model).drop("weight")
    return assigned.join(F.broadcast(centers), "cluster")


def assign_runs(df: DataFrame, models: Mapping[int, Clustering], features: str = "features") -> DataFrame:
    """One output row per input row and run: ``run``, ``cluster``, ``distance`` and the other columns."""
    others = [c for c in df.columns if c != features]
    near = with_nearest(df, {r: m.centers for r, m in models.items()}, features)
    return near.select(*others, F.inline("nearest"))


# -- one shared pass --------------------------------------------------------------------------


@dataclass
class RunTotals:
    """Per cluster of one run: rows, sum of vectors, sum of distances, sum of squared distances."""

    count: np.ndarray
    total: np.ndarray
    distance: np.ndarray
    squared: np.ndarray

    @property
    def mean_distance(self) -> float | None:
        rows = self.count.sum()
        return float(self.distance.sum() / rows) if rows else None


def prunes(df: DataFrame | Packed, centers: int, width: int, features: str) -> bool:
    """Whether rows are packed to meet so many centers together."""
    if isinstance(df, Packed) or is_vector(df, features):
        return False
    return 0 < width <= MAX_PRUNED_WIDTH and centers >= PRUNED_CENTERS


def run_totals(
    df: DataFrame | Packed, runs: Mapping[int, np.ndarray], features: str = "features", weight: str | None = None,
    distances: bool = True,
) -> dict[int, RunTotals]:
    """Assign every row in every run and sum up per cluster, in one scan. ``weight`` names a column
    of how many rows each row stands for; packed rows have theirs. Without ``distances`` their sums may
    be missing.

    Each task reduces its rows to one partial row per run and cluster before anything is shuffled,
    so a cluster that holds most of the data costs no more than the others.
    """
    width = next(iter(runs.values())).shape[1]
    if isinstance(df, Packed):
        _cells(runs)
        return {run: RunTotals(*t) for run, t in pruning.totals(df, runs, distances).items()}
    if prunes(df, sum(map(len, runs.values())) // PACKED_SCANS, width, features):
        _cells(runs)
        with pruning.packed(df, width, features, weight) as blocks:
            return {run: RunTotals(*t) for run, t in pruning.totals(blocks, runs, distances).items()}
    # Held different rows, which have weights, are met faster in batches: 1.5 s against 4.5 s a scan of
    # 600,000 rows of ten numbers.
    plain = weight is None and _unrolls(runs) and not is_vector(df, features)
    totals = _totals_unrolled if plain else _totals_arrow
    _cells(runs)
    rows = totals(df, runs, width, features, weight).where("cluster IS NOT NULL").toArrow().combine_chunks()
    result = {
        run: RunTotals(np.zeros(len(c), dtype="int64"), np.zeros(c.shape), np.zeros(len(c)), np.zeros(len(c)))
        for run, c in runs.items()
    }
    if not len(rows):
        return result
    run, cluster, count, distance, squared = (rows[c].to_numpy() for c in ("run", "cluster", "count", "distance", "squared"))
    total = rows["total"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), width)
    for r in np.unique(run).tolist():
        mine = np.flatnonzero(run == r)
        t, at = result[r], cluster[mine]
        t.count[at], t.distance[at], t.squared[at], t.total[at] = count[mine], distance[mine], squared[mine], total[mine]
    return result


def _totals_unrolled(
    df: DataFrame, runs: Mapping[int, np.ndarray], width: int, features: str, weight: str | None
) -> DataFrame:
    rows = df.select(features, (F.lit(1) if weight is None else F.col(weight)).cast("bigint").alias("__weight"))
    near = with_nearest(rows, runs, features)
    flat = near.select(features, "__weight", F.col("nearest")[0].alias("n")).select(
        features, "__weight", "n.*").where("cluster IS NOT NULL")
    x, times = q.name(features), "" if weight is None else " * __weight"
    sums = [F.expr(f"sum({x}[{i}]{times})").alias(f"s{i}") for i in range(width)]
    grouped = flat.groupBy("run", "cluster").agg(
        F.sum("__weight").alias("count"), F.expr(f"sum(distance{times})").alias("distance"),
        F.expr(f"sum(distance * distance{times})").alias("squared"), *sums,
    )
    total = q.array([f"s{i}" for i in range(width)])
    return grouped.selectExpr("run", "cluster", "count", "distance", "squared", f"{total} AS total")


def _totals_arrow(
    df: DataFrame, runs: Mapping[int, np.ndarray], width: int, features: str, weight: str | None
) -> DataFrame:
    read, take, nearest, add = _kernel(width, is_vector(df, features))
    fixed, weighted = dict(runs), weight is not None

    def partial(batches: Iterable) -> Iterable:
        import numpy as np
        import pyarrow as pa

        sums = {
            run: (np.zeros(len(c), dtype="int64"), np.zeros(len(c)), np.zeros(len(c)), np.zeros(c.shape))
            for run, c in fixed.items()
        }
        for batch in batches:
            x, usable = read(batch.column(0))
            if not usable.any():
                continue
            x = take(x, usable)
            w = batch.column(1).to_numpy(zero_copy_only=False)[usable].astype("int64") if weighted else None
            for run, centers in fixed.items():
                count, distance, squared, total = sums[run]
                cluster, d2 = nearest(x, centers)
                each = 1 if w is None else w
                if w is None:
                    count += np.bincount(cluster, minlength=len(centers))
                else:
                    np.add.at(count, cluster, w)
                distance += np.bincount(cluster, weights=np.sqrt(d2) * each, minlength=len(centers))
                squared += np.bincount(cluster, weights=d2 * each, minlength=len(centers))
                add(x, cluster, w, total)
        for run, (count, distance, squared, total) in sums.items():
            hit = np.flatnonzero(count)
            offsets = np.arange(0, (len(hit) + 1) * width, width, dtype="int32")[:len(hit) + 1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(hit), run, dtype="int32")), pa.array(hit.astype("int32")),
                    pa.array(count[hit]), pa.array(distance[hit]), pa.array(squared[hit]),
                    pa.ListArray.from_arrays(offsets, pa.array(total[hit].ravel())),
                ],
                names=["run", "cluster", "count", "distance", "squared", "total"],
            )

    schema = "run int, cluster int, count bigint, distance double, squared double, total array<double>"
    columns = [arrow_features(df, features), *([F.col(weight)] if weighted else [])]
    partials = df.select(*columns).mapInArrow(partial, schema)
    summed = partials.groupBy("run", "cluster").agg(
        F.sum("count").alias("count"), F.sum("distance").alias("distance"), F.sum("squared").alias("squared"),
        Summarizer.metrics("sum").summary(array_to_vector("total")).alias("s"),
    )
    return summed.select(
        "run", "cluster", "count", "distance", "squared", vector_to_array("s.sum").alias("total")
    )


# -- fits -------------------------------------------------------------------------------------


def _grouped(runs: Mapping[int, np.ndarray], most: int | None = None) -> list[list[int]]:
    """Runs in groups of bounded size together, ``most`` in one."""
    groups: list[list[int]] = []
    cells = 0
    for run, centers in runs.items():
        if not groups or cells + centers.size > GROUP_CELLS or len(groups[-1]) == most:
            groups.append([])
            cells = 0
        groups[-1].append(run)
        cells += centers.size
    return groups


def lloyd_runs(
    df: DataFrame | Packed, starts: Mapping[int, np.ndarray], iterations: int = MAX_ITERATIONS,
    tolerance: float = 0.0, features: str = "features", weight: str | None = None,
) -> dict[int, Clustering]:
    """Fixed-start K-means for several starts at once, one scan per iteration for all of them (for
    each ``GROUP_CELLS`` of them, where they are more).

    A center without rows stays where it is. A run whose centers all moved by no more than
    ``tolerance`` is finished and leaves the following scans. One scan more counts the rows of the
    centers as they are at the end. Arrays that are not wide are packed (``pruning.py``) where the centers
    of all runs are many; of other rows, runs of ``BOUNDED_K`` centers or more carry distance bounds
    (``bounds.py``). Either spares most distances and changes nothing else.
    """
    from clusterkit.operators.bounds import bounded_lloyd

    starts = {run: np.asarray(c, dtype=float) for run, c in starts.items()}
    width = next(iter(starts.values())).shape[1] if starts else 0
    if iterations > 0 and prunes(df, sum(map(len, starts.values())), width, features):
        with pruning.packed(df, width, features, weight) as blocks:
            return lloyd_runs(blocks, starts, iterations, tolerance)
    bounded = iterations > 1 and not isinstance(df, Packed)
    large = {run: c for run, c in starts.items() if len(c) >= BOUNDED_K and bounded}
    found: dict[int, Clustering] = {}
    for group in _grouped({run: c for run, c in starts.items() if run not in large}):
        found.update(_lloyd_group(df, {run: starts[run] for run in group}, iterations, tolerance, features, weight))
    for group in _grouped(large, BOUNDED_RUNS):
        some = {run: starts[run] for run in group}
        found.update(_measured(df, bounded_lloyd(df, some, iterations, tolerance, features, weight), features, weight))
    return {run: found[run] for run in starts}


def _measured(df: DataFrame | Packed, centers: Mapping[int, np.ndarray], features: str, weight: str | None) -> dict[int, Clustering]:
    totals = run_totals(df, centers, features, weight)
    return {run: Clustering(c, totals[run].count, float(totals[run].squared.sum())) for run, c in centers.items()}


def _lloyd_group(
    df: DataFrame | Packed, starts: Mapping[int, np.ndarray], iterations: int, tolerance: float, features: str, weight: str | None
) -> dict[int, Clustering]:
    centers = dict(starts)
    active = set(starts)
    for _ in range(iterations):
        if not active:
            break
        totals = run_totals(df, {run: c for run, c in centers.items() if run in active}, features, weight, distances=False)
        for run, t in totals.items():
            old = centers[run]
            new = np.where(t.count[:, None] > 0, t.total / np.maximum(t.count, 1)[:, None], old)
            centers[run] = new
            if np.sqrt(((new - old) ** 2).sum(axis=1)).max() <= tolerance:
                active.discard(run)
    return _measured(df, centers, features, weight)


def lloyd(
    df: DataFrame, start: Sequence[Sequence[float]], iterations: int = MAX_ITERATIONS,
    tolerance: float = 0.0, features: str = "features",
) -> Clustering:
    return lloyd_runs(df, {0: np.asarray(start, dtype=float)}, iterations, tolerance, features)[0]


def best_of(df: DataFrame, models: Mapping[int, Clustering], features: str = "features") -> Clustering:
    """The run with the lowest sum of squared distances, all measured in one scan."""
    if any(m.cost is None or m.weights is None for m in models.values()):
        totals = run_totals(df, {r: m.centers for r, m in models.items()}, features)
        models = {r: Clustering(m.centers, totals[r].count, float(totals[r].squared.sum())) for r, m in models.items()}
    best = min(models, key=lambda r: (models[r].cost, r))
    return models[best]


def distinct_rows(df: DataFrame, features: str = "features") -> DataFrame:
    """The usable rows' features, each different one once, and ``weight``, how often it occurs. What a
    seeded fit holds: repeated rows cost it nothing, and a crowded one is met as one row. Rows of
    vectors come as the structs they are made of."""
    if is_vector(df, features):
        rows = df.select(arrow_features(df, features).alias(features)).where(F.col(features).isNotNull())
    else:
        rows = df.select(features).where(usable_text(features, feature_width(df, features)))
    return rows.groupBy(features).agg(F.count("*").alias("weight"))


@contextmanager
def kept_distinct(df: DataFrame, features: str = "features") -> Iterator[DataFrame]:
    """``distinct_rows``, held for the scans inside."""
    rows = distinct_rows(df, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def fit(
    df: DataFrame, k: int = DEFAULT_K, init: Sequence | None = None, restarts: int = 1,
    tolerance: float = DEFAULT_TOLERANCE, iterations: int = MAX_ITERATIONS, seed: int = 0,
    features: str = "features",
) -> Clustering | None:
    """Fit k clusters; None when k is 0 or there are no rows.

    ``init=None``: k-means|| seeding (``seeding.py``), the best of ``restarts`` seeds, all of which
    share their scans. The result depends on rows and seed, not on how the rows are dealt.
    ``init=[center, ...]``: exactly these starting centers.
    ``init=[[center, ...], ...]``: several starts sharing their scans, the best one kept.
    """
    if k < 1:
        return None
    if init is not None:
        starts = np.asarray(init, dtype=float)
        if starts.ndim == 2:
            return lloyd(df, starts, iterations, tolerance, features)
        return best_of(df, lloyd_runs(df, dict(enumerate(starts)), iterations, tolerance, features), features)
    return fit_seeded(df, [k], restarts, tolerance, iterations, seed, features).get(k)


def fit_seeded(
    df: DataFrame, ks: Sequence[int], restarts: int, tolerance: float, iterations: int, seed: int = 0,
    features: str = "features",
) -> dict[int, Clustering]:
    """The best of ``restarts`` seeded fits for each k, all of them in shared scans. No entry for a k
    below 1 or where there are no rows; fewer centers than k where there are fewer different rows."""
    from clusterkit.operators.seeding import seeded_starts

    ks = sorted({k for k in ks if k >= 1})
    width = feature_width(df, features)
    if not ks or width == 0:
        return {}
    with ExitStack() as held:
        rows = held.enter_context(kept_distinct(df, features))
        if prunes(rows, sum(ks) * restarts, width, features):
            different, rows = rows, held.enter_context(pruning.packed(rows, width, features, "weight"))
            different.unpersist()
        starts = seeded_starts(rows, width, ks, range(seed, seed + restarts), features)
        runs = {(k, s): c for k in ks for s, c in starts[k].items() if len(c)}
        numbers = {n: key for n, key in enumerate(runs)}
        models = lloyd_runs(rows, {n: runs[key] for n, key in numbers.items()}, iterations, tolerance, features, "weight")
    best: dict[int, Clustering] = {}
    for n, (k, _) in numbers.items():  # seeds in order, so the first of equals stays
        if k not in best or models[n].cost < best[k].cost:
            best[k] = models[n]
    return best


def fit_best_of_ten(df: DataFrame, k: int, init: Sequence | None = None, **options) -> Clustering | None:
    """The careful fit: ten restarts and a tight tolerance."""
    options = {"restarts": RESTARTS, "tolerance": RESTART_TOLERANCE, **options}
    return fit(df, k, init=init, **options)
