"""The analysis questions (M1-M4) over the written star.

All of them aggregate the fact first (partial + final aggregation, so a hot
country or age costs one row per map task in the shuffle) and only then
touch the dimension, which by then meets at most one row per country.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.operators.rank import rank_within

VOLUME = "ImmigrationVolume"
SUM_VOLUME = "sumImmigrationVolume"


def volume_by(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(F.sum(VOLUME).cast("long").alias(SUM_VOLUME))


def topk_with_score(fact: DataFrame, dim: DataFrame, year: int, k: int = 10,
                    singles_only: bool = True) -> DataFrame:
    """M1: the ``k`` birth countries with the most immigrants in ``year``,
    with their happiness score. Sorted after the join, ties by name (D6)."""
    cond = F.col("Year") == year
    if singles_only:
        cond = cond & (F.col("SingleCountry") == "Y")
    vol = volume_by(fact.where(cond), ["Country"])
    score = dim.where(F.col("Year") == year).select("Country", "Happiness_Score")
    return (vol.join(score, "Country")
            .orderBy(F.col(SUM_VOLUME).desc(), F.col("Country"))
            .limit(k)
            .select("Country", SUM_VOLUME, "Happiness_Score"))


def topk_per_year(fact: DataFrame, dim: DataFrame, k: int = 10) -> DataFrame:
    """M1 for every year at once: rank countries within each year after the
    fact is aggregated to one row per (year, country), so each window group
    holds at most one row per country."""
    vol = volume_by(fact.where(F.col("SingleCountry") == "Y"), ["Year", "Country"])
    j = vol.join(dim.select("Country", "Year", "Happiness_Score"), ["Country", "Year"])
    ranked = rank_within(j, ["Year"], SUM_VOLUME, ["Country"], name="rank")
    return ranked.where(F.col("rank") <= k).select("Year", "rank", "Country", SUM_VOLUME, "Happiness_Score")


def age_profile(fact: DataFrame, keys: Sequence[str] = ("Year", "Age"),
                singles_only: bool = False) -> DataFrame:
    """M2: volume per year and age (optionally split further, e.g. by
    gender). One grouped pass instead of one filtered pass per year.
    ``singles_only=False`` keeps the reference's behaviour of counting
    region rows too (D7)."""
    f = fact.where(F.col("SingleCountry") == "Y") if singles_only else fact
    return volume_by(f, list(keys))


def score_volume_correlation(fact: DataFrame, dim: DataFrame, digits: int = 6) -> DataFrame:
    """M3: per year, Pearson correlation of log10(volume per country) with
    the happiness score, and the number of countries behind it."""
    vol = volume_by(fact.where(F.col("SingleCountry") == "Y"), ["Country", "Year"])
    j = vol.join(dim.select("Country", "Year", "Happiness_Score"), ["Country", "Year"])
    return j.groupBy("Year").agg(
        F.round(F.corr(F.log10(SUM_VOLUME), "Happiness_Score"), digits).alias("corr_log_volume_score"),
        F.count(F.lit(1)).alias("n_countries"))


def partition_years(fact: DataFrame) -> list[int]:
    """The years the written fact holds, from its partition column alone
    (no data column is read); one value per year reaches the driver."""
    return sorted(r["Year"] for r in fact.select("Year").distinct().collect() if r["Year"] is not None)


def trend_pivot(fact: DataFrame, years: Sequence[int], key: str = "Age") -> DataFrame:
    """M4: volume per ``key`` with one column per year (``y<year>``). Only the
    listed years' partitions are scanned; ``partition_years`` lists them all."""
    chosen = list(years)
    p = fact.where(F.col("Year").isin(chosen)).groupBy(key).pivot("Year", chosen).agg(F.sum(VOLUME).cast("long"))
    return p.select(key, *[F.col(str(y)).alias(f"y{y}") for y in chosen])
