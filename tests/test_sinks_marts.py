from pyspark.sql import functions as F

from tallystar.operators.rank import rank_within
from tallystar.plans import marts
from tallystar.sources.sinks import write_by_year

FACT = "ID string, Gender string, Age int, MaritalStatus string, Country string, " \
       "ImmigrationVolume int, SingleCountry string, Year int"


def _fact(spark):
    rows = [("1", "Men", 30, "Married", "Morocco", 10, "Y", 2018),
            ("2", "Women", 30, "Married", "Syria", 10, "Y", 2018),
            ("3", "Men", 31, "Married", "Africa", 50, "N", 2018),
            ("4", "Men", 31, "Married", "Morocco", 4, "Y", 2019)]
    return spark.createDataFrame(rows, FACT)


def _dim(spark):
    return spark.createDataFrame([("Morocco", 5.2, 2018), ("Syria", 3.4, 2018), ("Africa", 1.0, 2018)],
                                 "Country string, Happiness_Score double, Year int")


def test_topk_ties_by_name_and_singles_only(spark):
    out = marts.topk_with_score(_fact(spark), _dim(spark), 2018, k=1).collect()
    assert [(r["Country"], r["sumImmigrationVolume"]) for r in out] == [("Morocco", 10)]


def test_profile_counts_regions_by_default(spark):
    prof = {(r["Year"], r["Age"]): r["sumImmigrationVolume"] for r in marts.age_profile(_fact(spark)).collect()}
    assert prof == {(2018, 30): 20, (2018, 31): 50, (2019, 31): 4}
    singles = marts.age_profile(_fact(spark), singles_only=True).collect()
    assert {(r["Year"], r["Age"]): r[2] for r in singles} == {(2018, 30): 20, (2019, 31): 4}


def test_trend_pivot_columns(spark):
    p = marts.trend_pivot(_fact(spark), [2018, 2019, 2020])
    assert p.columns == ["Age", "y2018", "y2019", "y2020"]
    got = {r["Age"]: (r["y2018"], r["y2019"], r["y2020"]) for r in p.collect()}
    assert got == {30: (20, None, None), 31: (50, 4, None)}


def test_rank_is_one_based_with_tiebreak(spark):
    df = spark.createDataFrame([("B", 5.0, 1), ("A", 5.0, 1), ("C", 6.0, 1)], "Country string, s double, Year int")
    r = {x["Country"]: x["Overall_rank"] for x in rank_within(df, ["Year"], "s", ["Country"]).collect()}
    assert r == {"C": 1, "A": 2, "B": 3}


def test_dynamic_refresh_keeps_other_years(spark, tmp):
    fact = _fact(spark)
    write_by_year(fact, tmp)
    write_by_year(fact.where(F.col("Year") == 2019).withColumn("ImmigrationVolume", F.lit(99)), tmp, refresh=True)
    back = {(r["ID"], r["ImmigrationVolume"]) for r in spark.read.parquet(tmp).collect()}
    assert back == {("1", 10), ("2", 10), ("3", 50), ("4", 99)}
    write_by_year(fact.where(F.col("Year") == 2019), tmp)  # static overwrite wipes 2018
    assert {r["Year"] for r in spark.read.parquet(tmp).collect()} == {2019}
