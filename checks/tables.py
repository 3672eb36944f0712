"""The given tables as lines, feature arrays and micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.starts import BATCHES
from clusterkit.scratch import shared_dir
from clusterkit.sources.records import RecordSpec
from clusterkit.sources.text import read_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem on all cores. A file with one row group is read by one task, however many cores
    there are; a table of many files already has more partitions than that and is left alone."""
    items = table(spark, sf_dir, "lineitem")
    cores = spark.sparkContext.defaultParallelism
    return items.repartition(cores) if items.rdd.getNumPartitions() < cores else items


def lineitem_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four numbers of comparable size, with the keys and the return flag as label."""
    features = F.array(
        F.col("l_quantity"), F.col("l_extendedprice") / 1000, F.col("l_discount") * 100, F.col("l_tax") * 100
    )
    return lineitem(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("label"), features.alias("features")
    )


def embedding_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


LINEITEM_RECORD = RecordSpec(
    names=(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ),
    numeric=(4, 5, 6, 7), categorical=(8, 9), label=8,
)


def lineitem_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as comma-separated text files, read back line by line."""
    items = lineitem(spark, sf_dir)
    fields = [
        F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if c == "l_shipdate" else F.col(c).cast("string")
        for c in LINEITEM_RECORD.names
    ]
    path = shared_dir(spark, "lineitem-lines")
    items.select(F.concat_ws(",", *fields).alias("value")).write.text(path)
    return read_lines(spark, path)


def trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem in the 28-field trade layout; fields it has no counterpart for are blank or constant."""
    day = F.date_format("l_shipdate", "yyyyMMdd")
    text = {
        0: day, 1: F.col("l_returnflag"),
        2: F.concat(F.lit("T"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")),
        3: F.concat(F.lit("B"), F.col("l_linenumber").cast("string")), 5: day,
        6: F.col("l_quantity").cast("string"), 7: F.lit("USD"), 9: F.col("l_linestatus"),
        11: F.date_format("l_shipdate", "yyyyMMdd HH:mm:ss"), 12: F.col("l_linenumber").cast("string"),
        14: day, 15: F.lit("LE"), 16: F.lit("DESK"), 18: F.col("l_extendedprice").cast("string"),
        19: (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("string"), 20: F.lit("New"),
        21: F.when(F.col("l_tax") == 0, F.lit("")).otherwise(F.col("l_tax").cast("string")), 23: F.lit("ACCEPT"),
    }
    fields = [text.get(i, F.lit("")) for i in range(28)]
    return lineitem(spark, sf_dir).select(F.concat_ws(",", *fields).alias("value"))


EVENT_RECORD = RecordSpec(
    names=("event_id", "user_id", "event_type", "amount", "hour"),
    numeric=(1, 3, 4), categorical=(2,), label=0,
)


def event_line() -> Column:
    return F.concat_ws(
        ",", F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("event_type"),
        F.col("value").cast("string"), F.hour("ts").cast("string"),
    )


def event_batches(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """All events as lines, in equal ranges of event_id; the first is open below and takes null
    ids, the last is open above."""
    events = table(spark, sf_dir, "events")
    end = events.agg(F.max("event_id")).first()[0] + 1
    bounds = [-(-batch * end // BATCHES) for batch in range(1, BATCHES)]
    batch = sum(((F.coalesce(F.col("event_id"), F.lit(-1)) >= b).cast("int") for b in bounds), F.lit(0))
    for number in range(BATCHES):
        yield events.where(batch == number).select(event_line().alias("value"))
