"""Missing-value truth tables of the eight filter operators."""

from __future__ import annotations

import datetime as dt
import math
import time
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from matrixlens.operators import predicates
from matrixlens.operators.predicates import check_triple, filter_rows, mask, row_filter

NAN = float("nan")
ROWS = [
    (0, "a", 1, 1.0, True, "x", dt.datetime(2024, 1, 1)),
    (1, "b", 2, 2.5, False, "y", dt.datetime(2024, 1, 2)),
    (2, "c", 3, NAN, None, "1", dt.datetime(2024, 1, 3)),
    (3, "d", None, None, True, None, None),
    (4, "e", 30, 30.0, False, "30", dt.datetime(2024, 1, 5)),
]
SCHEMA = "_pos int, _index string, i bigint, f double, b boolean, s string, t timestamp_ntz"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


CASES = [
    ("i", "==", 2, [1]),
    ("i", "==", 2.0, [1]),
    ("i", "==", 2.5, []),
    ("i", "==", True, [0]),
    ("i", "==", "2", []),
    ("i", "==", 1e30, []),
    ("i", "!=", 2, [0, 2, 3, 4]),
    ("i", "!=", "2", [0, 1, 2, 3, 4]),
    ("i", ">", "2", [2, 4]),
    ("i", ">", 2.5, [2, 4]),
    ("i", ">=", 2.5, [2, 4]),
    ("i", "<", 2.5, [0, 1]),
    ("i", "<=", 2.5, [0, 1]),
    ("i", "<", 1e300, [0, 1, 2, 4]),
    ("i", ">", float("-inf"), [0, 1, 2, 4]),
    ("i", ">=", float("inf"), []),
    ("i", "<", NAN, []),
    ("i", "isin", [1, 3.0, "30"], [0, 2]),
    ("i", "isin", 30, [4]),
    ("i", "notin", [1, 3], [1, 3, 4]),
    ("i", "notin", ["1"], [0, 1, 2, 3, 4]),
    ("f", "==", 2.5, [1]),
    ("f", "==", NAN, []),
    ("f", "!=", NAN, [0, 1, 2, 3, 4]),
    ("f", "!=", 2.5, [0, 2, 3, 4]),
    ("f", ">", 2, [1, 4]),
    ("f", ">=", 2.5, [1, 4]),
    ("f", "<", 30, [0, 1]),
    ("f", "<=", 30, [0, 1, 4]),
    ("f", "isin", [1, 30], [0, 4]),
    ("f", "isin", [1, NAN], [0, 2, 3]),
    ("f", "notin", [1], [1, 2, 3, 4]),
    ("f", "notin", [1, NAN], [1, 4]),
    ("b", "==", True, [0, 3]),
    ("b", "==", 1, [0, 3]),
    ("b", "!=", True, [1, 2, 4]),
    ("b", ">", 0.5, [0, 3]),
    ("b", "isin", [False], [1, 4]),
    ("s", "==", "x", [0]),
    ("s", "==", 1, []),
    ("s", "!=", "x", [1, 2, 3, 4]),
    ("s", "isin", ["x", "30", 30], [0, 4]),
    ("s", "notin", ["x"], [1, 2, 3, 4]),
    ("t", "==", "2024-01-02", [1]),
    ("t", ">", "2024-01-02", [2, 4]),
    ("t", "!=", "not a date", [0, 1, 2, 3, 4]),
    ("index", "isin", ["a", "e", "z"], [0, 4]),
    ("index", "!=", "a", [1, 2, 3, 4]),
]


@pytest.mark.parametrize("name, op, value, expected", CASES)
def test_truth_table(table, name, op, value, expected):
    assert sorted(r["_pos"] for r in filter_rows(table, name, op, value).collect()) == expected


def test_masks_are_never_null_and_agree_with_filters(table):
    masks = table.select("_pos", *[mask(table.schema, n, o, v).alias(f"m{k}") for k, (n, o, v, _) in enumerate(CASES)])
    for row in masks.collect():
        for k, (*_, expected) in enumerate(CASES):
            assert row[f"m{k}"] is (row["_pos"] in expected)


@pytest.mark.parametrize(
    "value, matches",
    [(2, lambda s: s == 2), (2.5, lambda s: s == 2.5)],
)
def test_matches_pandas(table, value, matches):
    frame = pd.DataFrame({"f": [r[3] for r in ROWS]}, dtype="float64")
    expected = frame.index[matches(frame.f)].tolist()
    assert sorted(r["_pos"] for r in filter_rows(table, "f", "==", value).collect()) == expected


def test_float32_columns_compare_in_their_own_precision(spark):
    df = spark.createDataFrame([(0.1,), (0.2,)], "x float")
    assert filter_rows(df, "x", "==", 0.1).count() == 1
    assert filter_rows(df, "x", ">", 0.1).count() == 1
    assert filter_rows(df, "x", "isin", [0.1, 0.2]).count() == 2


@pytest.mark.parametrize("name", ["i", "f", "s", "b", "index", "t"])
@pytest.mark.parametrize("op", ["isin", "notin"])
def test_long_lists_mean_the_same_as_short_ones(table, monkeypatch, name, op):
    values = [1, 2.5, "x", "a", True, 30, "30", "2024-01-02"]
    short = sorted(r["_pos"] for r in filter_rows(table, name, op, values).collect())
    monkeypatch.setattr(predicates, "INLINE_VALUES", 2)
    assert sorted(r["_pos"] for r in filter_rows(table, name, op, values).collect()) == short


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    assert filter_rows(df, "a.b", "==", 1).count() == 1
    assert filter_rows(df, "c`d", ">", 1).count() == 1


def test_validation(table):
    with pytest.raises(ValueError, match="no column named 'zzz'"):
        filter_rows(table, "zzz", "==", 1)
    with pytest.raises(ValueError, match="not one of the operators"):
        filter_rows(table, "i", "~", 1)
    with pytest.raises(TypeError):
        filter_rows(table, "s", ">", 1)
    with pytest.raises(ValueError):
        filter_rows(table, "i", ">", "many")
    with pytest.raises(ValueError, match="isin"):
        filter_rows(table, "i", "==", [1, 2])
    with pytest.raises(ValueError, match="missing: filter_operator, filter_value"):
        check_triple(filter_column="i", filter_operator=None, filter_value=None)
    assert check_triple(a=1, b=False) and not check_triple(a=None)


def test_filters_reach_the_parquet_reader(spark, tmp_path, table):
    path = str(tmp_path / "t")
    table.write.parquet(path)
    stored = spark.read.parquet(path)

    def plan(*triple):
        return filter_rows(stored, *triple)._jdf.queryExecution().executedPlan().toString()

    assert "EqualTo(i,2)" in plan("i", "==", 2)
    assert "GreaterThan(i,2)" in plan("i", ">", 2.5)
    assert "GreaterThan(f,2.0)" in plan("f", ">", 2)
    assert "In(i, [1,3])" in plan("i", "isin", [1, 3])
    assert "Not(EqualNullSafe(i,2))" in plan("i", "!=", 2)


def test_streams(spark, tmp_path, table):
    table.select("_pos", "i").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("_pos int, i bigint").parquet(str(tmp_path / "in"))
    kept = filter_rows(stream, "i", "!=", 2).select("_pos", (F.col("i") + 1).alias("next"))
    query = (
        kept.writeStream.format("memory").queryName("kept_rows").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.awaitTermination(60)
    assert sorted(r["_pos"] for r in spark.table("kept_rows").collect()) == [0, 2, 3, 4]


# -- one meaning at any length, exact decimals ---------------------------------------------

MANY = "n bigint, x double, f float, d decimal(20,2), day date, at timestamp, plain timestamp_ntz, s string, b boolean"


@pytest.fixture(scope="module")
def many(spark):
    moment = dt.datetime(2024, 5, 1, 10, 30)
    rows = [
        (1, 1.5, 0.1, Decimal("0.10"), moment.date(), moment, moment, "a", True),
        (2, float("nan"), float("nan"), Decimal("12345678901234567.89"), dt.date(2024, 1, 1), moment.replace(hour=0, minute=0), moment, "2024-01", False),
        (2**53 + 1, -0.0, -0.0, Decimal("-7.00"), None, None, None, "", None),
        (None,) * 9,
    ]
    return spark.createDataFrame(rows, MANY)


VALUES = st.one_of(
    st.sampled_from([None, math.nan, math.inf, 1, 2, 1.5, 0.0, 0.1, True, False, 2**53 + 1, float(2**53), 12345678901234567.0, -7, "a", "", "2024-01", "2024-01-01", "2024-05-01T10:30", "2024-W18-3", "20240501", "x"]),
    st.integers(-5, 5),
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(VALUES, max_size=6), st.sampled_from(["isin", "notin"]), st.sampled_from([c.split()[0] for c in MANY.split(", ")]))
def test_a_list_means_the_same_at_any_length(many, values, op, name):
    inline = many.select(name).filter(row_filter(many.schema, name, op, values))
    joined = predicates._filter_by_join(many.select(name), name, op, values)
    assert sorted(map(repr, inline.collect())) == sorted(map(repr, joined.collect()))


def test_long_lists_are_planned_quickly(many):
    begun = time.perf_counter()
    left = filter_rows(many, "n", "isin", [*range(20_000), math.nan])
    left._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - begun < 2
    assert left.count() == 3
    assert filter_rows(many, "b", "notin", [True, *["x"] * 2000, None]).count() == 1


def test_decimals_are_compared_exactly(many):
    def left(op, value):
        return sorted(r["d"] for r in filter_rows(many, "d", op, value).collect())

    small, large, low = Decimal("0.10"), Decimal("12345678901234567.89"), Decimal("-7.00")
    assert left("==", 12345678901234567.0) == [] and left("==", 0.1) == [small] and left("==", Decimal("12345678901234567.89")) == [large]
    assert left("isin", [0.105, -7]) == [low]
    assert left(">", 0.095) == left(">=", 0.1) == [small, large] and left(">", 0.1) == [large]
    assert left("<", 0.105) == [low, small] and left("<=", "-7.001") == []
    assert left(">", -1e300) == [low, small, large] and left(">=", 1e300) == [] and left("<", math.inf) == [low, small, large]


def test_decimal_filters_reach_parquet(spark, many, tmp_path):
    many.select("d").write.parquet(str(tmp_path / "d"))
    plan = filter_rows(spark.read.parquet(str(tmp_path / "d")), "d", ">", 1.005)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(d), GreaterThan(d,1.00)]" in plan
