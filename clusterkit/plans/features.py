"""Feature steps shared by the batch and streaming jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame

from clusterkit.operators.encode import (
    MAX_ARRAY_WIDTH, Dictionaries, WideDictionaries, encode_arrays, encode_vectors, encode_wide,
    fit_any_dictionaries,
)
from clusterkit.operators.normalise import apply_zscore, fit_zscore, scale_vectors
from clusterkit.operators.pca import apply_pca, fit_pca
from clusterkit.sources.records import RecordSpec

# Fixed value.
PCA_COMPONENTS = 15


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Hold a DataFrame for the scans of a fit and release it after the last one. Partitions lost
    with an executor are computed again from the source."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def categorical_features(
    records: DataFrame, spec: RecordSpec, *keep: str, dictionaries: Dictionaries | WideDictionaries | None = None,
    include_label: bool = False, dense: bool = False,
) -> DataFrame:
    """One-hot and numeric features: arrays while narrow, else sparse vectors, whose dictionaries are
    tables where they are too wide to be held.

    ``dense`` asks for arrays at any width, which given starting centers need.
    """
    if dictionaries is None:
        dictionaries = fit_any_dictionaries(records, spec.category_names(include_label))
    if isinstance(dictionaries, WideDictionaries):
        if dense:
            raise ValueError(f"arrays of {dictionaries.width} category slots: given starts ask for them, fits without do not")
        return encode_wide(records, spec, dictionaries, *keep, include_label=include_label)
    width = len(spec.numeric) + dictionaries.width
    encode = encode_arrays if dense or width <= MAX_ARRAY_WIDTH else encode_vectors
    return encode(records, spec, dictionaries, *keep, include_label=include_label)


def normalised(df: DataFrame, nan_to_zero: bool = False) -> DataFrame:
    """Z-scored features, fitted on the same rows. Vectors are scaled without the shift, which
    leaves every distance as it is."""
    params = fit_zscore(df)
    if params is None:
        return df
    if isinstance(df.schema["features"].dataType, VectorUDT):
        return scale_vectors(df, params, nan_to_zero=nan_to_zero)
    return apply_zscore(df, params, nan_to_zero=nan_to_zero)


def projected(df: DataFrame, components: int, normalise_first: bool = False) -> DataFrame:
    """Principal components, then z-scores of the projection. As the components are taken from
    features as they are, those with large values dominate; ``normalise_first`` evens them out."""
    if normalise_first:
        df = normalised(df)
    return normalised(apply_pca(df, fit_pca(df, components)))
