"""The checks of the star (Q1, Q2, Q4, Q5), as aggregates that ride along its write.

``observe`` a write with ``*_metrics`` and the numbers are there when it ends:
no scan of their own. ``fact_rules`` and ``dimension_rules`` are the accepted
values of the documented tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystar.operators.quality import rule_metrics
from tallystar.plans.model import FACT_COLS, HAPPINESS_COLS, CodeBook

LARGEST_AGE = 105
SCORE_RANGE = (0, 10)


def fact_rules(book: CodeBook) -> dict[str, Column]:
    """What every row of the fact must meet."""
    def labels(english: Mapping[str, str], total: str) -> list[str]:
        return [label for code, label in english.items() if code != book.totals.get(total)]
    return {
        "gender_known": F.col("Gender").isin(labels(book.gender_en, "Geslacht")),
        "age_in_range": F.col("Age").between(0, LARGEST_AGE),
        "marital_status_known": F.col("MaritalStatus").isin(labels(book.marital_en, "BurgerlijkeStaat")),
        "volume_positive": F.col("ImmigrationVolume") > 0,
        "single_country_y_n": F.col("SingleCountry").isin("Y", "N"),
    }


def dimension_rules() -> dict[str, Column]:
    """What every row of the dimension must meet; a score may be missing."""
    rules = {f"{c}_in_range": F.col(c).isNull() | F.col(c).between(*SCORE_RANGE) for c in HAPPINESS_COLS if c.endswith("_Score")}
    return {"country_present": F.col("Country").isNotNull(), "year_positive": F.col("Year") > 0, **rules}


def fact_metrics(where: Column) -> list[Column]:
    """Q1 and Q2 of the fact's rows, those of ``where``."""
    nulls = sum((F.count_if(where & F.col(c).isNull()) for c in FACT_COLS), F.lit(0))
    return [F.count_if(where).alias("rows"), F.count_if(where & (F.col("ImmigrationVolume") == 0)).alias("zero_measure"),
            nulls.alias("null_cells")]


def observed(obs: Observation, metrics: Sequence[Column], written: DataFrame) -> dict:
    """The ``metrics`` that ``obs`` saw on a write; a write without rows runs no
    plan that could be observed, so they are computed on the (empty) result."""
    return written.agg(*metrics).first().asDict() if written.isEmpty() else dict(obs.get)


def type_breaches(df: DataFrame, contract: StructType) -> dict[str, str]:
    """Q5: columns of ``contract`` that are missing or of another type, with the type found; known without a job."""
    found = {f.name: f.dataType for f in df.schema.fields}
    return {f.name: found[f.name].simpleString() if f.name in found else "missing"
            for f in contract.fields if found.get(f.name) != f.dataType}


__all__ = ["dimension_rules", "fact_metrics", "fact_rules", "observed", "rule_metrics", "type_breaches"]
