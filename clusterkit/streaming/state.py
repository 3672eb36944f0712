"""Small per-batch state that survives a restart.

``foreachBatch`` runs a batch at least once. Each batch therefore writes its own version of the
state and starts from the version of the batch before it, so a replayed batch id repeats the same
step instead of applying it twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class BatchState:
    """Versions of a model-sized table under ``directory``, which all executors must share. Use
    one folder per stream, beside its checkpoint."""

    def __init__(self, spark: SparkSession, directory: str, schema: str):
        self._spark = spark
        self._schema = schema
        self.directory = directory.rstrip("/")

    def _version(self, batch_id: int) -> str:
        return f"{self.directory}/batch_id={batch_id}"

    def before(self, batch_id: int) -> list:
        """Rows left by the previous batch; none before the first."""
        if batch_id == 0:
            return []
        return self._spark.read.schema(self._schema).parquet(self._version(batch_id - 1)).collect()

    def first(self) -> list:
        """Rows of the earliest version that has any; none where nothing was written yet."""
        try:
            rows = self.history().collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        earliest = min((r["batch_id"] for r in rows), default=None)
        return [r for r in rows if r["batch_id"] == earliest]

    def write(self, batch_id: int, rows: list) -> None:
        table = self._spark.createDataFrame(rows, self._schema).coalesce(1)
        table.write.mode("overwrite").parquet(self._version(batch_id))

    def history(self) -> DataFrame:
        """All versions, with their ``batch_id``."""
        schema = f"{self._schema}, batch_id bigint"
        return self._spark.read.schema(schema).parquet(self.directory)
