import pytest
from pyspark.sql import functions as F

from tallystar.operators.profile import describe, null_counts
from tallystar.operators.quality import (
    assert_passed,
    domain_report,
    duplicate_report,
    quality_report,
    reconcile,
)

SCHEMA = "ID string, Gender string, Age int, ImmigrationVolume int, SingleCountry string"


def _report(df):
    return {r[0]: (r[1], r[2]) for r in df.collect()}


def test_empty_fact_fails(spark):
    rep = _report(quality_report(spark.createDataFrame([], SCHEMA), "ImmigrationVolume"))
    assert rep["not_empty"] == (1, "failed")


def test_zero_measure_and_nulls(spark):
    df = spark.createDataFrame([("1", "Men", 3, 0, "Y"), ("2", None, 4, 5, "Y")], SCHEMA)
    rep = _report(quality_report(df, "ImmigrationVolume"))
    assert rep["no_zero_measure"] == (1, "failed")
    assert rep["no_null_cells"] == (1, "failed")
    with pytest.raises(AssertionError):
        assert_passed(quality_report(df, "ImmigrationVolume"))


def test_domain_rules_one_violation_each(spark):
    df = spark.createDataFrame([("1", "Men", 106, 5, "X"), ("2", "Women", 30, 5, "Y")], SCHEMA)
    rep = _report(domain_report(df, {"age": F.col("Age").between(0, 105),
                                     "flag": F.col("SingleCountry").isin("Y", "N"),
                                     "volume": F.col("ImmigrationVolume") > 0}))
    assert rep == {"age": (1, "failed"), "flag": (1, "failed"), "volume": (0, "passed")}


def test_reconcile_detects_dropped_file(spark):
    rows_in = spark.createDataFrame([(2018,), (2018,), (2019,)], "Year int")
    rows_out = spark.createDataFrame([(2018,), (2018,)], "Year int")
    rep = {r["Year"]: (r["rows_in"], r["rows_out"], r["status"]) for r in reconcile(rows_in, rows_out, "Year").collect()}
    assert rep == {2018: (2, 2, "passed"), 2019: (1, 0, "failed")}


def test_duplicates_composite_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", None)], "k string, n int")
    r = duplicate_report(df, ["k", "n"]).first()
    assert (r["rows"], r["distinct_keys"], r["duplicates"]) == (4, 3, 1)


def test_profile_shapes(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "b")], "x double, s string")
    nulls = {r["column_name"]: (r["data_type"], r["non_null"], r["nulls"]) for r in null_counts(df).collect()}
    assert nulls == {"x": ("double", 2, 1), "s": ("string", 3, 0)}
    d = describe(df, ["x"], exact=True).first()
    assert (d["n"], d["mean"], d["min"], d["q50"], d["max"]) == (2, 2.0, 1.0, 2.0, 3.0)
