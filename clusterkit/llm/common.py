"""What the operators of this subpackage share: reading tables, word rules, batches, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterkit.scratch import shared_dir

#: Rows of one Arrow batch, so that a batch of long texts stays within a worker's memory.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id`` (long, may be null) and ``text`` (null as empty); others are left out."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list]], schema: str,
             arrow_schema: pa.Schema) -> DataFrame:
    """Arrow batches through ``make()``, called once a task, which gives a function from a
    batch to a list of columns in the order of ``schema``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            columns = work(batch)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type)
                 for c, f in zip(columns, arrow_schema)], schema=arrow_schema)

    return df.mapInArrow(run, schema)


def written(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The frame, written under the shared folder and read again: its lineage ends there."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.options(**options).parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._written_path = path
    return found


def drop_written(*frames: DataFrame) -> None:
    """Remove the folders of frames that ``written`` gave and that nothing reads any more, as all that
    was made from them is written itself."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame._written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def hashed(columns: list[str]) -> Column:
    """A salt that is the same for the same row, whichever task computes it."""
    return F.xxhash64(*columns)
