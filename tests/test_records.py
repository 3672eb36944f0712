import numpy as np
import pytest

from clusterkit.functions.fields import last_nonempty_field
from clusterkit.operators.counts import value_counts
from clusterkit.operators.encode import assemble_numeric
from clusterkit.operators.kmeans import estimate_k
from clusterkit.operators.normalise import fit_zscore
from clusterkit.sources.records import (
    TRADE_RECORD, RecordSpec, parse_numbers, parse_records, rejected_records, split_records,
)
from clusterkit.sources.text import read_lines
from pyspark.sql import functions as F
from tests.fixtures import FULL_LINE, SHORT_LINE, TRADE_LINES, TRADES, lines

NETWORK_RECORD = RecordSpec(
    names=tuple(f"f{i}" for i in range(42)), numeric=(0, *range(4, 41)), categorical=(1, 2, 3), label=41
)


def test_text_files_are_read_line_by_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(TRADE_LINES[:4]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join(TRADE_LINES[4:]) + "\n")
    assert read_lines(spark, str(tmp_path)).count() == 10


def test_every_trade_line_has_28_fields(spark):
    row = split_records(lines(spark, [FULL_LINE]), TRADE_RECORD).first()
    assert [row[n] for n in TRADE_RECORD.names[24:]] == ["A", "C", "1", "1"]
    trailing = split_records(lines(spark, TRADE_LINES[:1]), TRADE_RECORD).first()
    assert trailing["remaining_notional_cftr"] == ""


def test_last_field_takes_the_rest_of_the_line(spark):
    spec = RecordSpec(names=("a", "b"), numeric=(), categorical=(0,), label=0)
    row = split_records(lines(spark, ["x,y,z,"]), spec).first()
    assert (row["a"], row["b"]) == ("x", "y,z,")


def test_typed_record(spark):
    row = parse_records(lines(spark, TRADE_LINES), TRADE_RECORD).where("label = 'T2'").first()
    assert row["trade_version"] == float(TRADES[2][3]) and row["sec_amount"] == 0.0
    assert row["symbol"] == "" and row["value"] == TRADE_LINES[2]


def test_numeric_features_match_known_statistics(spark):
    data = assemble_numeric(parse_records(lines(spark, TRADE_LINES), TRADE_RECORD), TRADE_RECORD)
    stats = fit_zscore(data)
    assert stats.count == 10 and estimate_k(data) == 2
    day, quantity, _, version, effective = np.array(TRADES).T
    numbers = np.array([day, day, quantity, version, effective, quantity, quantity], dtype=float)
    numbers = np.vstack([numbers, np.zeros((3, 10))])
    assert stats.mean == pytest.approx(numbers.mean(axis=1))
    assert stats.std == pytest.approx(numbers.std(axis=1))


def test_bad_lines_are_rejected_with_a_reason(spark):
    bad_number = TRADE_LINES[0].replace(TRADES[0][1], "many", 1)
    given = lines(spark, [TRADE_LINES[0], SHORT_LINE, bad_number, ""])
    assert parse_records(given, TRADE_RECORD).count() == 1
    reasons = {r["value"]: r["reason"] for r in rejected_records(given, TRADE_RECORD).collect()}
    assert reasons == {SHORT_LINE: "field count", "": "field count", bad_number: "not a number"}


def test_blank_is_zero(spark):
    spec = RecordSpec(names=("id", "x"), numeric=(1,), categorical=(), label=0)
    rows = parse_records(lines(spark, ["a,", "b,1.5", "c,abc"]), spec).collect()
    assert {r["label"]: r["x"] for r in rows} == {"a": 0.0, "b": 1.5}


def test_tab_separated_numbers(spark):
    rows = parse_numbers(lines(spark, ["5.1\t3.5\t1.4\t0.2", "4.9\t3\t1.4\t0.2", "a\tb", ""])).collect()
    assert [r["features"] for r in rows] == [[5.1, 3.5, 1.4, 0.2], [4.9, 3.0, 1.4, 0.2]]


def test_network_record(spark):
    line = ",".join(["0", "one", "two", "three", *["181"] * 37, "plain."])
    row = parse_records(lines(spark, [line, "one damaged line"]), NETWORK_RECORD).collect()
    assert len(row) == 1 and row[0]["label"] == "plain." and row[0]["f4"] == 181.0


def test_last_nonempty_field_counts(spark):
    counted = value_counts(lines(spark, [*TRADE_LINES, "a,b", "a,b,,", "c"]), last_nonempty_field(F.col("value")))
    assert [(r["value"], r["count"]) for r in counted.collect()] == [("F23", 10), ("b", 2), ("c", 1)]


def test_reserved_field_names_are_refused():
    with pytest.raises(ValueError):
        RecordSpec(names=("value",), numeric=(), categorical=(0,), label=0)


def test_line_is_split_once(spark):
    """The filter on the fields stays above the column that holds them."""
    plan = parse_records(lines(spark, TRADE_LINES), TRADE_RECORD)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
