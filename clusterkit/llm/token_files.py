"""Token ids in Parquet files laid out for selective reads.

A file holds documents in ascending doc_id order: doc_id, part, part_start, n_tokens, ids. The
ids are a list column with dictionary encoding (a vocabulary of up to some 200,000 ids fits one
dictionary page); the sorted or counting columns are delta encoded. Row groups and the pages in
them are kept small, and the writer adds page indexes, so a read of some documents, or of the
columns beside the ids, touches those pages only.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clusterkit.llm.common import id_and_text, map_rows
from clusterkit.llm.pretoken import rank_encoding
from clusterkit.scratch import shared_dir

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()),
                   ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


def layout(row_group_bytes: int, page_rows: int) -> dict[str, str]:
    plain = ["doc_id", "part", "part_start", "n_tokens"]
    return {
        "compression": "zstd",
        "parquet.writer.version": "v2",  # delta encoding where there is no dictionary
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.enable.dictionary": "true",
        **{f"parquet.enable.dictionary#{c}": "false" for c in plain},
    }


def write_tokens(docs: DataFrame, vocab_path: str, out: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", row_group_bytes: int = 32 << 20, page_rows: int = 1000) -> None:
    """Encode every text as the tokenizers library does, add ``end_id``, write sorted by doc_id.

    Rows are dealt out by ranges of (doc_id, text hash): a doc_id that many rows share is split,
    and equal rows are equal in any order. Null texts are empty (the end id alone); null ids come
    first. An empty table gives files without rows; columns of other names are not read.
    """
    salt = F.xxhash64("text")
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.repartitionByRange("doc_id", salt).sortWithinPartitions("doc_id", salt)

    def make():
        encode = rank_encoding(vocab_path).encode
        part, start = TaskContext.get().partitionId(), 0

        def work(batch: pa.RecordBatch) -> list:
            nonlocal start
            texts = batch.column("text").to_pylist()
            got = [np.array([*encode(text, allowed_special="all"), end_id], np.int32) for text in texts]
            count = np.array([len(x) for x in got], np.int64)
            ends = np.r_[0, np.cumsum(count)]
            flat = np.concatenate(got) if got else np.zeros(0, np.int32)
            starts = start + ends[:-1]
            start += int(ends[-1])
            return [batch.column("doc_id"), np.full(len(got), part, np.int32), starts, count,
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]

        return work

    files = map_rows(rows, make, SCHEMA, ARROW)
    files.write.options(**layout(row_group_bytes, page_rows)).parquet(out)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids of the documents from ``first`` to ``last`` (None: no bound); the
    bounds reach the row groups and pages of the files. With a bound rows without an id are left out;
    files without rows give none; repeated rows come as often as they were written."""
    files = spark.read.schema(SCHEMA).parquet(path)
    if first is not None:
        files = files.filter(F.col("doc_id") >= first)
    if last is not None:
        files = files.filter(F.col("doc_id") <= last)
    return files.select("doc_id", "n_tokens", "ids")


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens of all documents, without reading ids.

    ``start`` is the number of ids before the document: that within its part, which the file
    holds, and the totals of the parts before, of which there is one row for each part. Null ids come
    first, repeated rows have starts of their own, files without rows give none.
    """
    return _with_start(spark, spark.read.schema(SCHEMA).parquet(path), path).select("doc_id", "start", "n_tokens")


def _with_start(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    totals = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # One row for each written partition: bounded by the number of tasks, not by rows.
    return rows.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("part_start"))


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Columns doc_id, start, n_tokens, ids_crc32, all read from the files: one row for each row
    written, none for files without rows."""
    def make():
        def work(batch: pa.RecordBatch) -> list:
            ids = batch.column("ids")
            flat = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")
            at = ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            return [batch.column(c) for c in ("doc_id", "part", "part_start", "n_tokens")] + [crc]

        return work

    rows = map_rows(spark.read.schema(SCHEMA).parquet(path), make,
                    "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long",
                    pa.schema([*list(ARROW)[:4], ("ids_crc32", pa.int64())]))
    return _with_start(spark, rows, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def token_files_digest(docs: DataFrame, vocab_path: str, **how) -> DataFrame:
    """Write under the shared folder, read back, and give the digest of what was read."""
    spark = docs.sparkSession
    out = shared_dir(spark, "tokens")
    write_tokens(docs, vocab_path, out, **how)
    return token_digest(spark, out)
