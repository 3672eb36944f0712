"""Z-score with the population standard deviation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clusterkit.functions import sqltext as q
from clusterkit.functions.vectors import constant_array

# Tasks' matrices are put together in so many groups, then once more.
GRAM_SLOTS = 16
# Up to this width one aggregate (or one expression) per dimension compiles to fast code.
MAX_UNROLLED = 64


@dataclass(frozen=True)
class ZScore:
    count: int
    mean: np.ndarray
    std: np.ndarray

    @property
    def divisor(self) -> np.ndarray:
        """The deviation, or 1 where a dimension does not vary."""
        return np.where(self.std <= 0, 1.0, self.std)


def feature_width(df: DataFrame, features: str = "features") -> int:
    """Width of the first row that is not null; 0 if there is none."""
    df = df.where(F.col(features).isNotNull())
    if isinstance(df.schema[features].dataType, VectorUDT):
        row = df.select(features).first()
        return 0 if row is None else len(row[0])
    row = df.select(F.size(features)).first()
    return 0 if row is None else row[0]


def vector_stats(df: DataFrame, features: str = "features") -> DataFrame:
    """Per dimension: sum, sum of squares, mean and population deviation, as (dim, ...), all in one
    scan without a row per coordinate. A dimension with a null or NaN has NaN statistics."""
    width = feature_width(df, features)
    empty = df.sparkSession.createDataFrame([], "dim int, sum double, sum_squares double, mean double, std double")
    if width == 0:
        return empty
    metrics = Summarizer.metrics("count", "sum", "normL2", "mean", "variance")
    s = _complete(df, features, width).select(metrics.summary(array_to_vector(features)).alias("s")).select(
        F.col("s.count").alias("n"), *[vector_to_array(f"s.{m}").alias(m) for m in ("sum", "normL2", "mean", "variance")])
    each = s.select("n", F.posexplode(F.arrays_zip("sum", "normL2", "mean", "variance")).alias("dim", "m"))
    population = F.greatest(F.col("m.variance") * (F.col("n") - 1) / F.col("n"), F.lit(0.0))
    return each.select("dim", F.col("m.sum").alias("sum"), (F.col("m.normL2") * F.col("m.normL2")).alias("sum_squares"),
                       F.col("m.mean").alias("mean"), F.sqrt(population).alias("std"))


def _complete(df: DataFrame, features: str, width: int) -> DataFrame:
    """The rows of this width, each null coordinate as NaN."""
    filled = F.transform(features, lambda x: F.coalesce(x, F.lit(float("nan"))))
    return df.where(F.size(features) == width).withColumn(features, filled)


def covariance(df: DataFrame, features: str = "features") -> DataFrame:
    """Sample covariance of every pair of dimensions, i <= j, in one scan.

    Every task sums one Gram matrix of its rows, less the first row it meets so that large means
    do not cancel; the matrices, one for each task, are put together in two steps.
    """
    spark = df.sparkSession
    width = feature_width(df, features)
    schema = "slot int, n double, mean array<double>, gram array<double>"
    names = ["slot", "n", "mean", "gram"]

    def packed(slot, n, mean, gram):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays(
            [pa.array([slot], pa.int32()), pa.array([float(n)]), pa.array([mean.tolist()], pa.list_(pa.float64())),
             pa.array([gram.ravel().tolist()], pa.list_(pa.float64()))], names)

    def joined(a, b):
        # Counts, means and sums of squared gaps of two sets of rows together.
        (n, mean, gram), (m, other, more) = a, b
        gap = other - mean
        total = n + m
        return total, mean + gap * (m / total), gram + more + np.outer(gap, gap) * (n * m / total)

    def partial(batches):
        from pyspark import TaskContext

        all_rows = None
        for batch in batches:
            column = batch.column(0)
            if len(column):
                x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
                mean = x.mean(axis=0)
                own = len(x), mean, (x - mean).T @ (x - mean)
                all_rows = own if all_rows is None else joined(all_rows, own)
        if all_rows is not None:
            yield packed(TaskContext.get().partitionId() % GRAM_SLOTS, *all_rows)

    def together(batches):
        all_rows = None
        for batch in batches:
            for n, mean, gram in zip(*(batch.column(c).to_pylist() for c in names[1:])):
                own = n, np.array(mean), np.array(gram).reshape(width, width)
                all_rows = own if all_rows is None else joined(all_rows, own)
        if all_rows is not None:
            yield packed(0, *all_rows)

    if width == 0:
        return spark.createDataFrame([], "i int, j int, covariance double")
    parts = _complete(df.select(features), features, width).mapInArrow(partial, schema)
    whole = parts.repartition(GRAM_SLOTS, "slot").mapInArrow(together, schema).repartition(1).mapInArrow(together, schema)
    pairs = whole.select("n", F.posexplode("gram").alias("at", "g"))
    i, j = F.floor(F.col("at") / width).cast("int"), (F.col("at") % width).cast("int")
    return pairs.select(i.alias("i"), j.alias("j"), (F.col("g") / (F.col("n") - 1)).alias("covariance")).where("i <= j")


def fit_zscore(df: DataFrame, features: str = "features") -> ZScore | None:
    """Count, means and deviations in one scan; None for an empty input.

    In either form, rows that are null or of another width than the first are left out, and a null
    counts as NaN: its dimension has no mean, as with any NaN.
    """
    is_vector = isinstance(df.schema[features].dataType, VectorUDT)
    width = feature_width(df, features)
    if width == 0:
        return None
    if not is_vector and width <= MAX_UNROLLED:
        f = q.name(features)
        x = [f"coalesce({f}[{i}], double('NaN'))" for i in range(width)]
        means, deviations = [f"avg({e})" for e in x], [f"stddev_pop({e})" for e in x]
        row = df.where(F.size(features) == width).agg(F.count("*"), *[F.expr(e) for e in means + deviations]).first()
        return ZScore(row[0], np.array(row[1:width + 1]), np.array(row[width + 1:]))
    vectors = F.col(features) if is_vector else array_to_vector(features)
    df = df if is_vector else _complete(df, features, width)
    metrics = Summarizer.metrics("count", "mean", "variance").summary(vectors)
    s = df.select(metrics.alias("s")).select("s.*").first()
    n = s["count"]
    variance = np.maximum(s["variance"].toArray(), 0.0) * (n - 1) / n
    return ZScore(n, s["mean"].toArray(), np.sqrt(variance))


def apply_zscore(
    df: DataFrame, params: ZScore, features: str = "features", nan_to_zero: bool = False
) -> DataFrame:
    """Replace a features array by its z-scores: x - mean, divided by the deviation if there is one."""
    width = len(params.mean)
    if width <= MAX_UNROLLED:
        f = q.name(features)
        shifted = [f"({f}[{i}] - {q.number(m)})" for i, m in enumerate(params.mean)]
        divided = [x if s <= 0 else f"{x} / {q.number(s)}" for x, s in zip(shifted, params.std)]
        scaled = F.expr(q.array([f"coalesce(nanvl({x}, 0D), 0D)" if nan_to_zero else x for x in divided]))
    else:
        clean = (lambda x: F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0))) if nan_to_zero else (lambda x: x)
        shifted = F.zip_with(features, constant_array(params.mean), lambda x, m: x - m)
        scaled = F.zip_with(shifted, constant_array(params.divisor), lambda x, s: clean(x / s))
    return df.withColumn(features, scaled)


def scale_vectors(
    df: DataFrame, params: ZScore, features: str = "features", nan_to_zero: bool = False
) -> DataFrame:
    """Divide a features vector by the deviations and leave out the shift.

    Distances do not change when all points move by the same amount, so clusters, distances and
    anomalies are those of the full z-score, and a sparse row stays sparse. Centers found here
    are z-score centers plus ``params.mean / params.divisor``.

    ``nan_to_zero``: what would be a z-score of NaN becomes the place of a z-score of zero. For a
    coordinate that is NaN this is the mean divided by the deviation; in a dimension without a mean
    all coordinates have it, so all become zero.
    """
    if not nan_to_zero:
        product = ElementwiseProduct(
            scalingVec=Vectors.dense(1.0 / params.divisor), inputCol=features, outputCol="__scaled"
        )
        return product.transform(df).drop(features).withColumnRenamed("__scaled", features)
    known = ~np.isnan(params.mean) & ~np.isnan(params.divisor)
    factor = np.where(known, 1.0 / np.where(known, params.divisor, 1.0), 0.0)
    center = np.where(known, params.mean, 0.0) * factor

    def scaled(x):
        import numpy as np
        import pyarrow as pa

        # Stored entries alone: those of a sparse vector have columns, a full one has them all.
        values, columns = x.field("values"), x.field("indices")
        sparse = x.field("type").fill_null(0).to_numpy(zero_copy_only=False) == 0
        count = np.diff(values.offsets.to_numpy()) * values.is_valid().to_numpy(zero_copy_only=False)
        first = np.cumsum(count) - count
        at = np.arange(count.sum()) - np.repeat(first, count)
        at[np.repeat(sparse, count)] = columns.flatten().to_numpy(zero_copy_only=False)
        old = values.flatten().to_numpy(zero_copy_only=False).astype(float)
        new = np.where(known[at], np.where(np.isnan(old), center[at], old * factor[at]), 0.0)
        offsets = pa.array(np.append(first, count.sum()).astype("int32"), mask=np.append(values.is_null().to_numpy(zero_copy_only=False), False))
        lists = pa.ListArray.from_arrays(offsets, pa.array(new), type=values.type)
        return pa.StructArray.from_arrays(
            [x.field("type"), x.field("size"), columns, lists], fields=list(x.type), mask=x.is_null())

    scaled.__annotations__ = {"x": pa.Array, "return": pa.Array}
    return df.withColumn(features, F.arrow_udf(scaled, VectorUDT())(F.unwrap_udt(features)))
