"""Stored sketches: error against the exact count, and refresh of one year."""
import os

from pyspark.sql import functions as F

from tallystar.operators.profile import distinct_counts
from tallystar.operators.sketches import merged_counts, year_sketches
from tallystar.plans.model import FACT_COLS
from tallystar.sources.versions import manifests
from test_api import _inputs
from test_lossless import run


def counts(df):
    return {r["column_name"]: r.asDict() for r in df.collect()}


def test_merged_years_are_near_the_exact_count(spark):
    df = spark.range(200_000).select(
        (F.col("id") % 7 + 2010).cast("int").alias("Year"), (F.col("id") % 60_000).alias("many"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 500)).alias("a b"), F.lit(None).cast("double").alias("none"))
    got = counts(merged_counts(year_sketches(df, ["many", "a b", "none"])))
    exact = {r["column_name"]: r["n_distinct"] for r in distinct_counts(df, ["many", "none"], exact=True).collect()}
    assert abs(got["many"]["n_distinct"] / exact["many"] - 1) < 0.03 and exact["many"] == 60_000
    assert got["a b"]["n_distinct"] == 500 and got["none"]["n_distinct"] == exact["none"] == 0
    assert [got["none"][c] for c in ("rows", "nulls")] == [200_000, 200_000]
    assert merged_counts(year_sketches(df.where("id < 0"), ["many"])).count() == 0


def test_refresh_sketches_only_the_years_it_wrote(spark, local_tmp, tmp):
    _inputs(local_tmp)
    first = run(spark, local_tmp, tmp)
    fact = first.fact(spark)
    exact = {r["column_name"]: r["n_distinct"] for r in distinct_counts(fact, FACT_COLS, exact=True).collect()}
    assert {c: r["n_distinct"] for c, r in counts(first.distinct_counts(spark)).items()} == exact

    def folders(number):
        return dict(next(m for m in manifests(spark, tmp) if m["number"] == number)["tables"]["sketches"])

    files = sorted(f for f in os.listdir(f"{local_tmp}/imm"))
    years = sorted(folders(first.version))
    os.remove(f"{local_tmp}/imm/{files[0]}")  # the refresh holds the other files' years only
    second = run(spark, local_tmp, tmp, refresh=True)
    before, after = folders(first.version), folders(second.version)
    renewed = {y for y in after if after[y] != before.get(y)}
    assert sorted(after) == years and renewed and renewed < set(years)
    assert {c: r["n_distinct"] for c, r in counts(second.distinct_counts(spark)).items()} == exact
