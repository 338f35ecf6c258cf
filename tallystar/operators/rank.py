"""Rank rows by a score within a group.

Used on dimension rows or on aggregates (one row per country and year), so a
window group is bounded by the size of the country domain, not by the data.
Ties are broken by ``tiebreak`` so the rank is deterministic; ranks are
1-based like the published ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, part: Sequence[str], score: str, tiebreak: Sequence[str],
                name: str = "Overall_rank", descending: bool = True) -> DataFrame:
    s = F.col(score).desc() if descending else F.col(score).asc()
    w = Window.partitionBy(*part).orderBy(s, *tiebreak)
    return df.withColumn(name, F.row_number().over(w))
