"""A cross-section of the registered queries against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entries
from checks.compare import difference, duck

SF_DIR = "/root/testdata/sf0.001"
NAMES = [
    "q01_parse_delimited", "q04_blank_to_zero", "q07_one_hot_assemble", "q07b_wide_one_hot", "q13_zscore_nan_safe",
    "q24_weighted_entropy", "q29_categorical_sweep", "q34_pca_anomalies", "q43_stream_cluster_label",
    "q26_restarts_score", "q27b_pca_entropy_default", "q41b_online_interval", "q46d_stream_running_sweep",
    "q49b_stream_rejects", "q55_detector_estimated_k",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_sql_text_has_its_query():
    assert set(entries.oracle_sql()) <= set(entries.queries())


def test_entry(spark):
    assert entries.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    found = entries.queries()[name](spark, SF_DIR).toPandas()
    assert difference(found, duck(SF_DIR).execute(entries.oracle_sql()[name]).fetchdf()) == ""
