import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from clusterkit.operators.encode import (
    Dictionaries, category_index, encode_arrays, encode_vectors, fit_dictionaries, lookup_index,
)
from clusterkit.sources.records import TRADE_RECORD, RecordSpec, parse_records
from tests.fixtures import TRADE_LINES, lines

SPEC = RecordSpec(names=("id", "kind", "x", "y"), numeric=(2, 3), categorical=(0, 1), label=0)


def records(spark, kinds):
    return parse_records(lines(spark, [f"r{i},{k},{i},{i * 2}" for i, k in enumerate(kinds)]), SPEC)


def test_dictionaries_are_alphabetical(spark):
    found = fit_dictionaries(records(spark, ["b", "a", "", "b"]), ["kind"])
    assert found.values == {"kind": ("", "a", "b")} and found.width == 3


def test_near_unique_field_is_refused_by_name(spark):
    with pytest.raises(ValueError, match="'id'"):
        fit_dictionaries(records(spark, ["a"] * 60), ["id", "kind"], max_width=20)


def test_widths_with_and_without_the_label(spark):
    trades = parse_records(lines(spark, TRADE_LINES), TRADE_RECORD)
    # 16 fields with one value each, but for the counterparty's three.
    assert fit_dictionaries(trades, TRADE_RECORD.category_names()).width == 15 + 3
    with_label = fit_dictionaries(trades, TRADE_RECORD.category_names(include_label=True))
    assert with_label.width == 15 + 3 + 10
    row = encode_arrays(trades, TRADE_RECORD, with_label, include_label=True).first()
    assert len(row["features"]) == 10 + 28


def test_layout_first_number_blocks_other_numbers(spark):
    data = records(spark, ["b", "a", "", "b"])
    dictionaries = fit_dictionaries(data, ["kind"])
    rows = {r["label"]: r["features"] for r in encode_arrays(data, SPEC, dictionaries).collect()}
    assert rows["r0"] == [0.0, 0.0, 0.0, 1.0, 0.0]
    assert rows["r2"] == [2.0, 1.0, 0.0, 0.0, 4.0]


def test_arrays_and_sparse_vectors_agree(spark):
    trades = parse_records(lines(spark, TRADE_LINES), TRADE_RECORD)
    dictionaries = fit_dictionaries(trades, TRADE_RECORD.category_names())
    dense = {r["label"]: r["features"] for r in encode_arrays(trades, TRADE_RECORD, dictionaries).collect()}
    sparse = encode_vectors(trades, TRADE_RECORD, dictionaries)
    as_arrays = sparse.select("label", vector_to_array("features").alias("features")).collect()
    assert {r["label"]: r["features"] for r in as_arrays} == dense


def test_wide_rows_are_sparse(spark):
    data = records(spark, [f"k{i}" for i in range(30)])
    row = encode_vectors(data, SPEC, fit_dictionaries(data, ["kind"])).first()["features"]
    assert isinstance(row, SparseVector) and row.size == 32


@pytest.mark.parametrize("encode", [encode_arrays, encode_vectors])
def test_unseen_value_is_an_all_zero_block(spark, encode):
    known = Dictionaries({"kind": ("", "a", "b")})
    row = encode(records(spark, ["zz"]), SPEC, known).first()["features"]
    assert list(row if isinstance(row, list) else row.toArray()) == [0.0] * 5


def test_unseen_value_can_be_an_error(spark):
    known = Dictionaries({"kind": ("a", "b")})
    with pytest.raises(Exception):
        encode_vectors(records(spark, ["zz"]), SPEC, known, unseen="error").collect()


def test_values_with_quotes_and_backslashes(spark):
    odd = ["it's", 'say "x"', "back\\slash", "a`b", "${x}"]
    data = records(spark, odd)
    dictionaries = fit_dictionaries(data, ["kind"])
    rows = encode_arrays(data, SPEC, dictionaries).collect()
    assert all(sum(r["features"][1:6]) == 1.0 for r in rows)


@pytest.mark.parametrize("small", [100, 2])
def test_category_index_and_lookup(spark, small):
    kinds = ["b", "a", None, "c", "b", "", "d"] * 5
    df = spark.createDataFrame([(i, k, f"line {i}") for i, k in enumerate(kinds)], "id int, kind string, value string")
    index = category_index(df, "kind")
    assert {r["value"]: r["index"] for r in index.collect()} == {"": 0, "a": 1, "b": 2, "c": 3, "d": 4}
    joined = lookup_index(df, "kind", index, small=small)
    assert joined.columns == ["id", "kind", "value", "index"]
    assert {r["id"]: r["index"] for r in joined.collect()} == {
        i: ["", "a", "b", "c", "d"].index(k or "") for i, k in enumerate(kinds)}
    assert category_index(df.limit(0), "kind").count() == 0


# -- dictionaries of any width


def kind_records(spark, count, kinds):
    given = spark.range(count).selectExpr(
        f"concat('r', id, ',', id % 7, ',k', id % {kinds}, ',', if(id % 3 = 0, 'hot', concat('u', id)), ',', id % 5) AS value")
    spec = RecordSpec(names=("id", "x", "kind", "user", "y"), numeric=(1, 4), categorical=(2, 3), label=0)
    return parse_records(given, spec), spec


def test_wide_encoding_equals_that_of_held_dictionaries(spark):
    from clusterkit.operators.encode import WideDictionaries, encode_wide, fit_any_dictionaries

    data, spec = kind_records(spark, 400, 9)
    held = fit_any_dictionaries(data, spec.category_names())
    wide = fit_any_dictionaries(data, spec.category_names(), max_width=20)
    assert isinstance(held, Dictionaries) and isinstance(wide, WideDictionaries)
    assert list(wide.tables) == ["user"] and wide.width == held.width
    want = {r["label"]: r["features"] for r in encode_vectors(data, spec, held).collect()}
    got = {r["label"]: r["features"] for r in encode_wide(data, spec, wide).collect()}
    assert got.keys() == want.keys() and all(list(got[k].toArray()) == list(want[k].toArray()) for k in want)
    assert all(isinstance(v, SparseVector) for v in got.values())
    other = parse_records(lines(spark, ["new,NaN,zz,nobody,3", "n2,1,k1,hot,0"]), spec)
    unseen = {r["label"]: r["features"] for r in encode_wide(other, spec, wide).collect()}
    known = {r["label"]: r["features"] for r in encode_vectors(other, spec, held).collect()}
    for k in known:
        assert repr(list(unseen[k].toArray())) == repr(list(known[k].toArray()))


def test_a_million_values_are_encoded(spark):
    from clusterkit.operators.encode import encode_wide, fit_any_dictionaries

    data, spec = kind_records(spark, 1_500_000, 11)
    dictionaries = fit_any_dictionaries(data, spec.category_names())
    assert dictionaries.sizes == {"kind": 11, "user": 1_000_001} and list(dictionaries.tables) == ["user"]
    rows = encode_wide(data, spec, dictionaries).select(F.unwrap_udt("features").alias("f"))
    # One slot for each category: the user's block comes first after the first number.
    slots = rows.select(F.explode("f.indices").alias("i")).where("i >= 1 AND i < 1000002").groupBy("i").count()
    found = slots.agg(F.count("*"), F.sum("count"), F.max("count")).first()
    assert tuple(found) == (1_000_001, 1_500_000, 500_000)
    assert rows.where(f"f.size <> {2 + 11 + 1_000_001}").isEmpty()


def test_jobs_take_dictionaries_too_wide_to_be_held(spark, monkeypatch):
    from clusterkit.operators import encode
    from clusterkit.plans.batch import categorical_sweep_job

    given = lines(spark, [f"r{i},{i % 4},k{i % 30},{i % 3}" for i in range(90)])
    spec = RecordSpec(names=("id", "x", "kind", "y"), numeric=(1, 3), categorical=(2,), label=0)
    want = {r["k"]: r["score"] for r in categorical_sweep_job(given, spec, ks=[1], restarts=2).collect()}
    monkeypatch.setattr(encode.fit_any_dictionaries, "__defaults__", (10,))
    got = {r["k"]: r["score"] for r in categorical_sweep_job(given, spec, ks=[1], restarts=2).collect()}
    assert got.keys() == want.keys() and got[1] == pytest.approx(want[1])
