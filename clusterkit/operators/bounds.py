"""Lloyd's steps with distance bounds that the rows carry from one to the next.

Each row keeps, for each run, its cluster, a distance to that center that its true one does not exceed, and
one to all other centers that is not above theirs. When centers move, the bounds move by as much; a row
whose bounds still part its center from the others, or whose center is nearer than half the way to the
next center, keeps its cluster without a distance being taken. All other rows are measured as in a
plain step, so clusters and centers are the same, ties included.

An iteration is one narrow pass: it reads rows with their bounds and gives rows with new bounds, and among
them a few rows with the task's sums, which alone are shuffled. The rows of the iteration before are
released; after ``CUT`` iterations they are written to the shared folder, where their lineage ends.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clusterkit.operators.kmeans import _kernel, arrow_features, is_vector
from clusterkit.scratch import shared_dir

#: Iterations between two writes of the rows.
CUT = 8
#: Bounds part two centers only by more than this share of them, far more than they are off by rounding.
SAFE = 1e-9

_SUMS = "run int, cluster int, count bigint, measured bigint, total array<double>"


def _step(width: int, sparse: bool, runs: Mapping[int, tuple], rows_type: str):
    """``runs``: for each run new centers and how far each moved (None at first), or None for a run that
    is finished."""
    read, take, nearest, add = _kernel(width, sparse)
    to_own = nearest.to_own
    numbers = list(runs)
    fixed = {}
    for run, state in runs.items():
        if state is not None:
            centers, moved = state
            gap = np.full(len(centers), np.inf)
            for i in range(0, len(centers), 256) if len(centers) > 1 else ():
                some = centers[i:i + 256]
                d2 = ((some * some).sum(axis=1)[:, None] - 2 * some @ centers.T + (centers * centers).sum(axis=1)[None, :])
                d2[np.arange(len(some)), np.arange(i, i + len(some))] = np.inf
                gap[i:i + 256] = np.sqrt(np.maximum(0.0, d2.min(axis=1) * (1 - SAFE) - SAFE * (centers * centers).sum(axis=1).max())) / 2
            fixed[run] = centers, moved, gap
    count_of = len(numbers)
    # Of each row and run: cluster, upper and lower bound.
    kind = np.dtype([("cluster", "<i4", count_of), ("upper", "<f8", count_of), ("lower", "<f8", count_of)])
    safe = SAFE

    def run_step(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa

        sums = {run: (np.zeros(len(c), "int64"), np.zeros(c.shape)) for run, (c, _, _) in fixed.items()}
        measured = dict.fromkeys(fixed, 0)
        schema = None
        for batch in batches:
            features, weights, held = batch.column(0), batch.column(1), batch.column(2)
            if schema is None:
                schema = pa.schema([pa.field("features", features.type), ("weight", pa.int64()), ("bounds", pa.binary()),
                                    ("run", pa.int32()), ("cluster", pa.int32()), ("count", pa.int64()), ("measured", pa.int64()),
                                    ("total", pa.list_(pa.float64()))])
            x, usable = read(features)
            if not usable.any():
                continue
            if not usable.all():
                x = take(x, usable)
                features, weights, held = (c.filter(pa.array(usable)) for c in (features, weights, held))
            n = len(features)
            w = weights.to_numpy(zero_copy_only=False).astype("int64")
            first = held.null_count == n
            state = np.zeros(n, kind) if first else np.frombuffer(b"".join(held.to_pylist()), kind).copy()
            for at, run in enumerate(numbers):
                if run not in fixed:
                    continue
                centers, moved, gap = fixed[run]
                cluster, upper, lower = (state[f][:, at] if count_of > 1 else state[f].reshape(n, -1)[:, at] for f in ("cluster", "upper", "lower"))
                if moved is None:
                    cluster[:], d2, beyond = nearest(x, centers, with_next=True)
                    upper[:], lower[:] = np.sqrt(d2), beyond
                    measured[run] += n * len(centers)
                else:
                    upper += moved[cluster]
                    most = int(moved.argmax())
                    next_most = np.delete(moved, most).max(initial=0.0)
                    lower -= np.where(cluster == most, next_most, moved[most])
                    bound = np.maximum(lower, gap[cluster])
                    slack = safe * (np.abs(upper) + np.abs(lower))
                    open_ = np.flatnonzero(~(upper < bound - slack))
                    if len(open_):
                        upper[open_] = to_own(take(x, open_), centers[cluster[open_]])
                        measured[run] += len(open_)
                        open_ = open_[~(upper[open_] < bound[open_] - slack[open_])]
                    if len(open_):
                        cluster[open_], d2, beyond = nearest(take(x, open_), centers, with_next=True)
                        upper[open_], lower[open_] = np.sqrt(d2), beyond
                        measured[run] += len(open_) * len(centers)
                count, total = sums[run]
                np.add.at(count, cluster, w)
                add(x, cluster.astype("int64"), w, total)
            packed = state.tobytes()
            size = kind.itemsize
            bounds = pa.array([packed[i:i + size] for i in range(0, len(packed), size)], pa.binary())
            none = [pa.nulls(n, f.type) for f in list(schema)[3:]]
            yield pa.RecordBatch.from_arrays([features, pa.array(w), bounds, *none], schema=schema)
        if schema is None:
            return
        for run, (count, total) in sums.items():
            hit = np.flatnonzero(count)
            # How many distances the task took stands on its first row of the run.
            taken = np.zeros(len(hit), "int64")
            taken[:1] = measured[run]
            ends = np.arange(0, (len(hit) + 1) * width, width, dtype="int32")[:len(hit) + 1]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(hit), schema.field(0).type), pa.nulls(len(hit), pa.int64()), pa.nulls(len(hit), pa.binary()),
                 pa.array(np.full(len(hit), run, "int32")), pa.array(hit.astype("int32")), pa.array(count[hit]), pa.array(taken),
                 pa.ListArray.from_arrays(ends, pa.array(total[hit].ravel()))], schema=schema)

    return run_step, f"features {rows_type}, weight bigint, bounds binary, {_SUMS}"


def bounded_lloyd(
    df: DataFrame, starts: Mapping[int, np.ndarray], iterations: int, tolerance: float, features: str = "features",
    weight: str | None = None, measured: list[int] | None = None,
) -> dict[int, np.ndarray]:
    """The centers of each run after ``iterations`` steps, or once all of them moved by no more than
    ``tolerance``. ``measured`` is given the number of distances taken in each step."""
    centers = {run: np.asarray(c, dtype=float) for run, c in starts.items()}
    width = next(iter(centers.values())).shape[1]
    sparse = is_vector(df, features)
    rows = df.select(
        arrow_features(df, features).alias("features"),
        (F.lit(1) if weight is None else F.col(weight)).cast("bigint").alias("weight"), F.lit(None).cast("binary").alias("bounds"))
    rows_type = rows.schema["features"].dataType.simpleString()
    moves: dict[int, np.ndarray | None] = dict.fromkeys(centers)
    active, held, spark = set(centers), None, df.sparkSession
    try:
        for step in range(iterations):
            if not active:
                break
            runs = {run: (centers[run], moves[run]) if run in active else None for run in centers}
            work, schema = _step(width, sparse, runs, rows_type)
            made = rows.mapInArrow(work, schema)
            if step % CUT == CUT - 1:
                path = shared_dir(spark, "bounds")
                made.write.parquet(path)
                made = spark.read.schema(T._parse_datatype_string(schema)).parquet(path)
            else:
                made = made.persist(StorageLevel.MEMORY_AND_DISK)
            summed = made.where("run IS NOT NULL").groupBy("run", "cluster").agg(
                F.sum("count").alias("count"), F.sum("measured").alias("measured"),
                Summarizer.metrics("sum").summary(array_to_vector("total")).alias("s"))
            found = summed.select("run", "cluster", "count", "measured", vector_to_array("s.sum").alias("total")).toArrow().combine_chunks()
            if held is not None:
                held.unpersist()
            held = made if made.storageLevel.useMemory else None
            rows = made.where("run IS NULL").select("features", "weight", "bounds")
            run_of, at, count = (found[c].to_numpy() for c in ("run", "cluster", "count"))
            total = found["total"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if len(found) else np.zeros((0, width))
            if measured is not None:
                measured.append(int(found["measured"].to_numpy().sum()))
            for run in list(active):
                mine = np.flatnonzero(run_of == run)
                new = centers[run].copy()
                new[at[mine]] = total[mine] / count[mine][:, None]
                moves[run] = np.sqrt(((new - centers[run]) ** 2).sum(axis=1))
                centers[run] = new
                if moves[run].max() <= tolerance:
                    active.discard(run)
    finally:
        if held is not None:
            held.unpersist()
    return centers
