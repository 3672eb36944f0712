"""Categorical dictionaries, one-hot blocks and feature assembly."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clusterkit.functions import sqltext as q
from clusterkit.scratch import shared_dir
from clusterkit.sources.records import RecordSpec

# Dictionaries that are held whole, by the driver and in plans, have at most so many values together.
MAX_ENCODED_WIDTH = 100_000
# Above this width an array of literals per row loses to a sparse vector.
MAX_ARRAY_WIDTH = 256
# Dictionaries of at most this many values are broadcast in a lookup.
SMALL_DICTIONARY = 100_000


@dataclass(frozen=True)
class Dictionaries:
    """The values of each categorical field, alphabetically; a value's position is its index."""

    values: dict[str, tuple[str, ...]]

    @property
    def width(self) -> int:
        return sum(len(v) for v in self.values.values())


def assemble_numeric(records: DataFrame, spec: RecordSpec, *keep: str) -> DataFrame:
    """``label`` and the numeric fields as one ``features`` array."""
    return records.select("label", *keep, F.array(*spec.numeric_names).alias("features"))


def fit_dictionaries(
    records: DataFrame, fields: Sequence[str], max_width: int = MAX_ENCODED_WIDTH
) -> Dictionaries:
    """Distinct values of all fields, in one scan.

    Each task reduces its rows to its distinct (field, value) pairs before the shuffle, so a value
    that holds most of the rows is sent once per task. At most ``max_width + 1`` values are
    fetched; if there are more, the fit fails and names the widest field.
    """
    fields = list(fields)
    if not fields:
        return Dictionaries({})
    values = q.array([f"coalesce({q.name(f)}, '')" for f in fields])
    pairs = records.select(F.expr(f"posexplode({values})"))
    found = pairs.select("pos", "col").distinct().limit(max_width + 1).collect()
    if len(found) > max_width:
        widest, count = Counter(fields[r["pos"]] for r in found).most_common(1)[0]
        raise ValueError(f"more than {max_width} category values, {count} or more of them in field {widest!r}")
    # By UTF-8 bytes, the order in which Spark and SQL engines sort text.
    ordered = {
        f: tuple(sorted((r["col"] for r in found if r["pos"] == i), key=lambda v: v.encode()))
        for i, f in enumerate(fields)
    }
    return Dictionaries(ordered)


def encode_arrays(
    records: DataFrame, spec: RecordSpec, dictionaries: Dictionaries, *keep: str,
    include_label: bool = False,
) -> DataFrame:
    """Numbers and one-hot blocks as one ``features`` array. A value that is in no dictionary
    encodes to an all-zero block."""
    slots = []
    for field in spec.feature_order(include_label):
        if field in dictionaries.values:
            slots += [
                f"if({q.name(field)} <=> {q.text(value)}, 1D, 0D)" for value in dictionaries.values[field]
            ]
        else:
            slots.append(q.name(field))
    return records.select("label", *keep, F.expr(q.array(slots)).alias("features"))


def encode_vectors(
    records: DataFrame, spec: RecordSpec, dictionaries: Dictionaries, *keep: str,
    include_label: bool = False, unseen: str = "keep",
) -> DataFrame:
    """The same layout as a sparse ``features`` vector, for dictionaries of any allowed width.

    ``unseen="keep"`` encodes a value that is in no dictionary as an all-zero block (the slot
    dropped is the one for unknown values); ``"error"`` refuses it. The encoder names its slots
    after the values and takes no empty name, hence the leading mark.
    """
    fields = list(dictionaries.values)
    marked = records.select(
        "label", *keep, *[n for n in spec.feature_order(include_label) if n not in dictionaries.values],
        *[F.expr(f"concat('=', coalesce({q.name(f)}, ''))").alias(f"{f}__text") for f in fields],
    )
    # One model per field: label lists of different lengths cannot share one, the shorter ones
    # would be filled up with nulls.
    indexed = marked
    for f in fields:
        indexer = StringIndexerModel.from_labels(
            ["=" + v for v in dictionaries.values[f]], inputCol=f"{f}__text", outputCol=f"{f}__index",
            handleInvalid=unseen,
        )
        indexed = indexer.transform(indexed)
    encoder = OneHotEncoder(
        inputCols=[f"{f}__index" for f in fields],
        outputCols=[f"{f}__block" for f in fields],
        dropLast=unseen == "keep",
    )
    # The encoder takes its widths from the indexer's column metadata: the fit scans no rows.
    blocks = encoder.fit(indexed).transform(indexed)
    order = [f"{n}__block" if n in dictionaries.values else n for n in spec.feature_order(include_label)]
    # NaN is a number like any other here; what it means is said by the scaling.
    assembled = VectorAssembler(inputCols=order, outputCol="features", handleInvalid="keep").transform(blocks)
    return assembled.select("label", *keep, "features")


@dataclass(frozen=True)
class WideDictionaries:
    """Dictionaries of any width. Fields with few values are held as values, the others are tables of
    (value, index) that no process holds whole; ``sizes`` says how many values every field has."""

    narrow: Dictionaries
    tables: dict[str, DataFrame]
    sizes: dict[str, int]

    @property
    def width(self) -> int:
        return sum(self.sizes.values())


def fit_any_dictionaries(
    records: DataFrame, fields: Sequence[str], max_width: int = MAX_ENCODED_WIDTH
) -> Dictionaries | WideDictionaries:
    """``fit_dictionaries`` where all values together are at most ``max_width``; else the narrowest
    fields that are so together are held and the others become tables. The distinct pairs of field
    and value are counted, not fetched."""
    fields = list(fields)
    if not fields:
        return Dictionaries({})
    values = q.array([f"coalesce({q.name(f)}, '')" for f in fields])
    counts = records.select(F.expr(f"posexplode({values})")).distinct().groupBy("pos").agg(F.count("*").alias("n")).collect()
    sizes = {fields[r["pos"]]: r["n"] for r in counts}
    sizes = {f: sizes.get(f, 0) for f in fields}
    held, total = [], 0
    for f in sorted(fields, key=lambda f: (sizes[f], f)):
        if total + sizes[f] <= max_width:
            held.append(f)
            total += sizes[f]
    narrow = fit_dictionaries(records, [f for f in fields if f in held], max_width)
    if len(held) == len(fields):
        return narrow
    return WideDictionaries(narrow, {f: category_index(records, f) for f in fields if f not in held}, sizes)


def encode_wide(
    records: DataFrame, spec: RecordSpec, dictionaries: WideDictionaries, *keep: str, include_label: bool = False,
) -> DataFrame:
    """The layout of ``encode_vectors`` for dictionaries of any width, as sparse vectors.

    A row meets the tables of its wide fields by joins on the value (``lookup_index``, which splits a
    value that holds much of the data); what it gets is an index, so nothing as wide as the features
    exists for a row. A value that is in no dictionary encodes to an all-zero block.
    """
    rows = records
    for n, (field, table) in enumerate(dictionaries.tables.items()):
        rows = lookup_index(rows, field, table.withColumnRenamed("index", f"__wide{n}"))
    wide = {field: f"__wide{n}" for n, field in enumerate(dictionaries.tables)}
    narrow = {}
    for n, (field, values) in enumerate(dictionaries.narrow.values.items()):
        narrow[field] = f"__narrow{n}"
        rows = rows.withColumn(f"__text{n}", F.concat(F.lit("="), _value(field)))
        rows = StringIndexerModel.from_labels(
            ["=" + v for v in values], inputCol=f"__text{n}", outputCol=narrow[field], handleInvalid="keep").transform(rows)
    places, numbers, offsets, at = [], [], [], 0
    for field in spec.feature_order(include_label):
        offsets.append(at)
        if field in wide:
            places.append(F.col(wide[field]).cast("int"))
        elif field in narrow:  # the indexer gives unknown values the place after the last
            index = F.col(narrow[field]).cast("int")
            places.append(F.when(index < len(dictionaries.narrow.values[field]), index))
        else:
            places.append(F.lit(0))
            numbers.append(F.col(field).cast("double"))
            at += 1
            continue
        numbers.append(F.when(places[-1].isNotNull(), 1.0).otherwise(0.0))
        at += dictionaries.sizes[field]
    features = _sparse_rows(offsets, at)(F.array(*[F.coalesce(p, F.lit(0)) for p in places]), F.array(*numbers))
    return rows.select("label", *keep, features.alias("features"))


def _sparse_rows(offsets: list[int], width: int):
    """Sparse vectors from the place of each field in its block and its value there."""
    base = np.array(offsets, dtype="int64")

    def build(places, values):
        import numpy as np
        import pyarrow as pa

        count = len(base)
        index = places.flatten().to_numpy(zero_copy_only=False).reshape(-1, count) + base
        value = values.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, count)
        some = value != 0  # NaN, which a null number becomes, is kept
        ends = pa.array(np.concatenate([[0], np.cumsum(some.sum(axis=1))]).astype("int32"))
        return pa.StructArray.from_arrays(
            [pa.array(np.zeros(len(value), "int8")), pa.array(np.full(len(value), width, "int32")),
             pa.ListArray.from_arrays(ends, pa.array(index[some].astype("int32"))),
             pa.ListArray.from_arrays(ends, pa.array(value[some]))], names=["type", "size", "indices", "values"])

    build.__annotations__ = {"places": pa.Array, "values": pa.Array, "return": pa.Array}
    return F.arrow_udf(build, VectorUDT())


def _value(field: str) -> Column:
    """A category value; null counts as the empty text, as in ``fit_dictionaries``."""
    return F.coalesce(F.col(field).cast("string"), F.lit(""))


def category_index(df: DataFrame, field: str) -> DataFrame:
    """Each value of a field with its alphabetical position from 0, as (value, index).

    The distinct values are sorted by range and written once; a value's position is that in its
    partition and the sizes of the partitions before, of which there is one row each.
    """
    values = df.select(_value(field).alias("value")).distinct()
    path = shared_dir(df.sparkSession, "dictionary")
    values.repartitionByRange("value").withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranked = df.sparkSession.read.schema("value string, part int").parquet(path)
    own = F.row_number().over(Window.partitionBy("part").orderBy("value")) - 1
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranked.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = ranked.select("value", "part", own.alias("own")).join(F.broadcast(bases), "part")
    return numbered.select("value", (F.col("own") + F.col("base")).cast("int").alias("index"))


def lookup_index(df: DataFrame, field: str, index: DataFrame, small: int = SMALL_DICTIONARY, salts: int = 16) -> DataFrame:
    """Add ``index`` for a field. A dictionary of at most ``small`` values is broadcast; a larger one
    is repeated for each of ``salts`` shares of the rows, so that a value that holds much of the
    data is met in as many tasks."""
    size = index.limit(small + 1).count()
    keys = index.withColumnRenamed("value", "__key")
    rows = df.withColumn("__value", _value(field))
    if size <= small:
        return rows.join(F.broadcast(keys), rows["__value"] == keys["__key"], "left").drop("__value", "__key")
    keys = keys.withColumn("__share", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    match = (rows["__value"] == keys["__key"]) & (rows["__salt"] == keys["__share"])
    return rows.join(keys, match, "left").drop("__value", "__salt", "__share", "__key")
