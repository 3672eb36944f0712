"""Text sinks: every executor writes its own part files, nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def append_lines(df: DataFrame, line: Column, path: str) -> None:
    """Add one line per row to the text folder, which is made if it is absent."""
    df.select(line.alias("value")).write.mode("append").text(path)


def write_batch_lines(df: DataFrame, line: Column, directory: str, batch_id: int) -> None:
    """Write one micro-batch to its own folder. The folder is named after the batch id, not the
    clock, so a replayed batch replaces its own output and nothing else."""
    df.select(line.alias("value")).write.mode("overwrite").text(f"{directory}/batch_id={batch_id}")


def show_on_console(stream: DataFrame, checkpoint: str):
    """Print each micro-batch of a stream; the caller stops the returned query."""
    return stream.writeStream.format("console").option("checkpointLocation", checkpoint).start()
