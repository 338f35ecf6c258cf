"""Star-schema operators.

Dimensions here are code lists. The planner broadcasts them by their size in
bytes (``spark.sql.autoBroadcastJoinThreshold``, and AQE at run time);
above that the join is shuffled and AQE splits hot keys. No job runs while a
plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.functions.strings import strip_ws
from tallystar.operators.clean import dedup_first


def unique_rows(dim: DataFrame, keys: Sequence[str], on_duplicate: str = "fail") -> DataFrame:
    """``dim`` with one row per key, so a join on it cannot fan out.

    Rows that repeat a key with the same values collapse. Where values differ,
    ``on_duplicate='fail'`` raises when the plan runs, ``'first'`` keeps the
    row that sorts first, in each column a value before NULL.
    """
    if on_duplicate not in ("fail", "first"):
        raise ValueError(f"on_duplicate: {on_duplicate}")
    if on_duplicate == "first":
        return dedup_first(dim, keys)
    rest = [c for c in dim.columns if c not in keys]
    packed = F.struct(*rest) if rest else F.lit(True)
    one = dim.groupBy(*keys).agg(F.min(packed).alias("_lo"), F.max(packed).alias("_hi"))
    text = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    conflict = F.raise_error(F.concat(F.lit(f"conflicting rows for key ({', '.join(keys)}): "), text))
    first = keys[0]
    one = one.withColumn(first, F.when(~F.col("_lo").eqNullSafe(F.col("_hi")), conflict.cast(dim.schema[first].dataType))
                         .otherwise(F.col(first)))
    return one.select(*[F.col(c) if c in keys else F.col(f"_lo.`{c}`").alias(c) for c in dim.columns])


def decode(fact: DataFrame, dim: DataFrame, fact_col: str, dim_key: str,
           keep: Sequence[str] | None = None, how: str = "inner", on_duplicate: str = "fail") -> DataFrame:
    """Join a code list on ``fact_col == dim_key`` and bring in the
    ``keep`` columns (default: all of the dimension's other columns).
    Inner by default, as the reference: unmatched codes drop; list them with
    ``coverage``. The dimension is made unique first (``unique_rows``)."""
    keep = [c for c in dim.columns if c != dim_key] if keep is None else list(keep)
    d = unique_rows(dim.select(F.col(dim_key).alias("_dk"), *keep), ["_dk"], on_duplicate)
    return fact.join(d, fact[fact_col] == F.col("_dk"), how).drop("_dk")


def coverage(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
             trim: bool = False) -> DataFrame:
    """Distinct ``left_col`` values with no match in ``right_col``."""
    lc = strip_ws(left_col) if trim else F.col(left_col)
    rc = strip_ws(right_col) if trim else F.col(right_col)
    lk = left.select(lc.alias(left_col)).distinct()
    rk = right.select(rc.alias("_rk")).distinct()
    return lk.join(rk, lk[left_col] == rk["_rk"], "left_anti")


def coverage_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J4 on a composite key: distinct ``keys`` of ``left`` with no row in
    ``right`` (what an inner join on ``keys`` would drop silently, D17)."""
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), list(keys), "left_anti")


def conform(df: DataFrame, mapping: Mapping[str, str], cols: Sequence[str]) -> DataFrame:
    """Rename by ``mapping`` (source -> target) and keep ``cols`` in
    that order; unmapped source columns are dropped."""
    inv = {dst: src for src, dst in mapping.items()}
    return df.select(*[F.col(f"`{inv.get(c, c)}`").alias(c) for c in cols])


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def except_keys(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct key values of ``a`` that are not in ``b``."""
    return a.select(*cols).subtract(b.select(*cols))


def key_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Empty means
    the frame may be joined on ``keys`` without fan-out."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def resolve_duplicates(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                       how: str = "mean") -> DataFrame:
    """Make ``keys`` unique after a harmonise, averaging ``values``
    (``how='mean'``) or keeping the smallest row (``how='first'``)."""
    if how == "mean":
        return df.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values],
                                     F.count(F.lit(1)).alias("n_merged"))
    return dedup_first(df.select(*keys, *values), keys)
