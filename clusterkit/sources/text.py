"""Line-oriented sources, batch and streaming. Both give one column, ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def stream_lines(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Every new file under ``directory`` (a directory, not a file) joins the next micro-batch."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(directory)
