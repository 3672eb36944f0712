"""Handlers for ``foreachBatch``: the batch jobs, run per micro-batch.

Each handler writes its result for batch n to its own ``batch_id=n`` folder, so a replay of the
batch replaces it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clusterkit.functions.fields import center_text, cluster_count_line
from clusterkit.operators.counts import cluster_label_counts
from clusterkit.operators.encode import Dictionaries, fit_dictionaries
from clusterkit.operators.kmeans import Clustering, assign, centers_table, estimate_k
from clusterkit.operators.quality import k_grid
from clusterkit.plans.anomalies import AnomalyModel
from clusterkit.plans.features import kept
from clusterkit.sinks.text import write_batch_lines
from clusterkit.sources.records import RecordSpec, observed_records, outcome_rows, parse_records
from clusterkit.streaming.state import BatchState


def write_batch(df: DataFrame, directory: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{directory}/batch_id={batch_id}")


def label_count_writer(directory: str) -> Callable[[DataFrame, Clustering, int], None]:
    """For ``OnlineKMeans.start``: cluster/label counts of each batch."""

    def on_batch(batch: DataFrame, model: Clustering, batch_id: int) -> None:
        write_batch(cluster_label_counts(assign(batch, model)), directory, batch_id)

    return on_batch


def label_report_writer(directory: str) -> Callable[[DataFrame, Clustering, int], None]:
    """For ``OnlineKMeans.start``: the same counts as report lines."""

    def on_batch(batch: DataFrame, model: Clustering, batch_id: int) -> None:
        counts = cluster_label_counts(assign(batch, model))
        line = cluster_count_line(F.col("cluster"), F.col("label"), F.col("count"))
        write_batch_lines(counts, line, directory, batch_id)

    return on_batch


def prediction_writer(directory: str, *keep: str) -> Callable[[DataFrame, Clustering, int], None]:
    """For ``OnlineKMeans.start``: each row's cluster and its distance to that center."""

    def on_batch(batch: DataFrame, model: Clustering, batch_id: int) -> None:
        write_batch(assign(batch, model).select(*keep, "cluster", "distance"), directory, batch_id)

    return on_batch


def prediction_text_writer(directory: str) -> Callable[[DataFrame, Clustering, int], None]:
    """For ``OnlineKMeans.start``: the cluster of every row as lines, written by the executors."""

    def on_batch(batch: DataFrame, model: Clustering, batch_id: int) -> None:
        write_batch_lines(assign(batch, model), F.col("cluster").cast("string"), directory, batch_id)

    return on_batch


def center_text_writer(directory: str, decimals: int | None = None) -> Callable[[DataFrame, Clustering, int], None]:
    """For ``OnlineKMeans.start``: the centers after each batch, one line each."""

    def on_batch(batch: DataFrame, model: Clustering, batch_id: int) -> None:
        centers = centers_table(batch.sparkSession, model).orderBy("cluster").coalesce(1)
        write_batch_lines(centers, center_text(F.col("center"), decimals), directory, batch_id)

    return on_batch


class RunningK:
    """Whole-number mean of the rule-of-thumb K over all batches so far."""

    def __init__(self, spark: SparkSession, state_dir: str):
        self._state = BatchState(spark, state_dir, "sum_k bigint, batches bigint")

    def update(self, batch: DataFrame, batch_id: int) -> int:
        rows = self._state.before(batch_id)
        sum_k, batches = (rows[0]["sum_k"], rows[0]["batches"]) if rows else (0, 0)
        sum_k, batches = sum_k + estimate_k(batch), batches + 1
        self._state.write(batch_id, [(sum_k, batches)])
        return sum_k // batches

    def history(self) -> DataFrame:
        """(batch_id, sum_k, batches, mean_k) after every batch."""
        mean = F.floor(F.col("sum_k") / F.col("batches")).cast("int")
        return self._state.history().withColumn("mean_k", mean)


class FixedDictionaries:
    """Category dictionaries of a stream. They come from history or from the first batch with a
    usable line, are saved under that batch, and stay: the model's width must not change, and a
    value seen later encodes to zeros. What is saved is always taken first, so a restart goes on
    with the same dictionaries."""

    def __init__(self, spark: SparkSession, state_dir: str, spec: RecordSpec, known: Dictionaries | None = None):
        self._state = BatchState(spark, state_dir, "field string, value string, position int")
        self._spec = spec
        self._given = known
        self._saved: Dictionaries | None = None

    def get(self, lines: DataFrame, batch_id: int) -> Dictionaries:
        fields = self._spec.category_names()
        if self._saved is None:
            rows = self._state.first()
            if not rows:
                found = self._given or fit_dictionaries(parse_records(lines, self._spec), fields)
                values = found.values
                rows = [(f, v, i) for f in values for i, v in enumerate(values[f])]
                if not rows:
                    return found  # no usable line yet: nothing is decided
                self._state.write(batch_id, rows)
                self._saved = found
            else:
                saved: dict[str, list[str]] = {f: [] for f in fields}
                for row in sorted(rows, key=lambda r: r["position"]):
                    saved[row["field"]].append(row["value"])
                self._saved = Dictionaries({f: tuple(v) for f, v in saved.items()})
        return self._saved


class RejectCounts:
    """Lines kept and left out of every batch, counted by the job that reads the batch.

    ``records(lines, batch_id)`` are the parsed lines; ``save(batch_id)``, called after the batch's
    job, writes what was counted under that batch, so a replayed batch replaces its counts.
    """

    def __init__(self, spark: SparkSession, state_dir: str, spec: RecordSpec):
        self._state = BatchState(spark, state_dir, "outcome string, lines bigint")
        self._spec = spec
        self._watched: dict[int, Observation] = {}

    def records(self, lines: DataFrame, batch_id: int) -> DataFrame:
        self._watched[batch_id] = Observation(f"lines-{batch_id}-{uuid.uuid4().hex}")
        return observed_records(lines, self._spec, self._watched[batch_id])

    def save(self, batch_id: int) -> None:
        self._state.write(batch_id, outcome_rows(self._watched.pop(batch_id).get))

    def history(self) -> DataFrame:
        """(outcome, lines, batch_id) of all batches."""
        return self._state.history()


def sweep_handler(
    job: Callable[..., DataFrame], spec: RecordSpec, directory: str, running_k: RunningK,
    dictionaries: FixedDictionaries | None = None, ks: Sequence[int] | None = None,
    step: int | None = None, **options,
) -> Callable[[DataFrame, int], None]:
    """Run one of the sweep jobs on every batch, with K up to the running estimate, and write its
    scores. Pass ``dictionaries`` for jobs that encode categories."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as lines:
            limit = running_k.update(parse_records(lines, spec), batch_id)
            grid = k_grid(limit, step) if ks is None else ks
            extra = {} if dictionaries is None else {"dictionaries": dictionaries.get(lines, batch_id)}
            write_batch(job(lines, spec, ks=grid, **extra, **options), directory, batch_id)

    return handle


def anomaly_handler(
    model: AnomalyModel, directory: str
) -> Callable[[DataFrame, int], None]:
    """Write the anomalous lines of each batch under a model fitted on history. The model has no
    state, so ``model.anomalies(stream)`` with any other sink does as well."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch_lines(model.anomalies(batch), F.col("value"), directory, batch_id)

    return handle
