"""Online K-means: centers that each micro-batch moves towards its own rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clusterkit.operators.kmeans import Clustering, run_totals
from clusterkit.operators.normalise import feature_width
from clusterkit.plans.features import kept
from clusterkit.streaming.state import BatchState

CENTERS_SCHEMA = "cluster int, center array<double>, weight double"
# A cluster this much lighter than the heaviest one is dying.
DYING_RATIO = 1e-8


class OnlineKMeans:
    """Per batch: assign with the old centers, then move each center to the weighted mean of
    itself (weight times ``decay``) and its new rows.

    Without ``init`` the start is k Gaussian centers as wide as the data with weight 0, so the
    first rows of a cluster replace its center. Only centers (k rows) reach the driver.
    """

    def __init__(
        self, spark: SparkSession, state_dir: str, k: int = 2, decay: float = 1.0,
        init: Sequence | None = None, init_weights: Sequence[float] | None = None, seed: int = 0,
        split_dying: bool = False,
    ):
        self.k = k if init is None else len(init)
        self.decay = decay
        self._init = None if init is None else np.asarray(init, dtype=float)
        self._init_weights = np.zeros(self.k) if init_weights is None else np.asarray(init_weights, dtype=float)
        self._seed = seed
        self._split_dying = split_dying
        self._state = BatchState(spark, state_dir, CENTERS_SCHEMA)

    def _start(self, batch: DataFrame) -> Clustering | None:
        if self._init is not None:
            return Clustering(self._init, self._init_weights)
        width = feature_width(batch)
        if width == 0:
            return None
        centers = np.random.default_rng(self._seed).standard_normal((self.k, width))
        return Clustering(centers, self._init_weights)

    def before(self, batch_id: int) -> Clustering | None:
        """The centers left by the previous batch; None if no batch has made any."""
        rows = sorted(self._state.before(batch_id), key=lambda r: r["cluster"])
        if not rows:
            return None
        return Clustering(np.array([r["center"] for r in rows]), np.array([r["weight"] for r in rows]))

    def update(self, batch: DataFrame, batch_id: int) -> Clustering | None:
        """Train on one micro-batch (``features``) and return the new centers."""
        old = self.before(batch_id) or self._start(batch)
        if old is None:
            self._state.write(batch_id, [])
            return None
        totals = run_totals(batch, {0: old.centers})[0]
        carried = old.weights * self.decay
        weights = carried + totals.count
        moved = (old.centers * carried[:, None] + totals.total) / np.where(weights > 0, weights, 1.0)[:, None]
        centers = np.where(totals.count[:, None] > 0, moved, old.centers)
        if self._split_dying:
            centers, weights = _split_heaviest(centers, weights)
        rows = [(i, c.tolist(), float(w)) for i, (c, w) in enumerate(zip(centers, weights))]
        self._state.write(batch_id, rows)
        return Clustering(centers, weights)

    def history(self) -> DataFrame:
        """The centers after every batch: (cluster, center, weight, batch_id)."""
        return self._state.history()

    def start(
        self, stream: DataFrame, checkpoint: str,
        on_batch: Callable[[DataFrame, Clustering, int], None] | None = None, **trigger,
    ) -> StreamingQuery:
        """Train on a streaming DataFrame with ``features``. ``on_batch(batch, model, batch_id)`` sees
        each batch with the centers it produced, so predictions come after the training."""

        def handle(batch: DataFrame, batch_id: int) -> None:
            with kept(batch) as rows:
                model = self.update(rows, batch_id)
                if on_batch is not None and model is not None:
                    on_batch(rows, model, batch_id)

        return start_batches(stream, handle, checkpoint, **trigger)


def _split_heaviest(centers: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Give a dying cluster half of the heaviest one, at almost the same place."""
    light, heavy = int(weights.argmin()), int(weights.argmax())
    if weights[light] >= DYING_RATIO * weights[heavy]:
        return centers, weights
    centers, weights = centers.copy(), weights.copy()
    nudge = 1e-14 * np.maximum(np.abs(centers[heavy]), 1.0)
    centers[light] = centers[heavy] - nudge
    centers[heavy] = centers[heavy] + nudge
    weights[[light, heavy]] = (weights[light] + weights[heavy]) / 2
    return centers, weights


def start_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, **trigger
) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` on every micro-batch. ``trigger`` is Spark's, for example
    ``processingTime="2 seconds"`` or ``availableNow=True``."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
