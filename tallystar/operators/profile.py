"""Profiling.

Every profile is one aggregation over the frame, reshaped to long form
``(column_name, ...)`` so any number of columns gives a fixed schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.operators.quantiles import exact_quantiles


def _cols(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    return list(cols) if cols is not None else df.columns


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A6 + A10: ``(column_name, data_type, non_null, nulls)`` per column."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"),
                     F.count(F.col(c)).alias("non_null"),
                     F.count_if(F.col(c).isNull()).cast("long").alias("nulls"))
            for c in _cols(df, cols)]
    return df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None,
                    exact: bool = False, rsd: float = 0.01) -> DataFrame:
    """``(column_name, n_distinct)`` by HyperLogLog (fixed memory per
    column, one row per task in the shuffle). ``exact=True`` counts exactly;
    its shuffle follows the number of distinct values."""
    def nd(c: str) -> Column:
        return F.count_distinct(c) if exact else F.approx_count_distinct(c, rsd)
    rows = [F.struct(F.lit(c).alias("column_name"), nd(c).cast("long").alias("n_distinct"))
            for c in _cols(df, cols)]
    return df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """O2: sorted distinct values of one column."""
    return df.select(col).distinct().orderBy(col)


def describe(df: DataFrame, cols: Sequence[str], exact: bool = False,
             accuracy: int = 10000, digits: int = 6) -> DataFrame:
    """Count, mean, std (sample), min, quartiles, max per column, long
    form. Quartiles come from ``percentile_approx`` (bounded memory).
    ``exact=True`` selects them in a few passes of bounded memory
    (``quantiles.exact_quantiles``), which run when this is called."""
    probs = [0.25, 0.5, 0.75]
    found = exact_quantiles(df, cols, probs) if exact else {}

    def q(c: str) -> Column:
        if exact:
            return F.array(*[F.lit(x).cast("double") for x in found[c]])
        return F.percentile_approx(F.col(c).cast("double"), F.array(*map(F.lit, probs)), accuracy).cast("array<double>")

    rows = []
    for c in cols:
        v = F.col(c).cast("double")
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.count(v).alias("n"),
            F.round(F.avg(v), digits).alias("mean"), F.round(F.stddev_samp(v), digits).alias("std"),
            F.min(v).alias("min"), q(c).alias("_q"), F.max(v).alias("max")))
    out = df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))
    return out.select("column_name", "n", "mean", "std", "min",
                      *[F.round(F.col("_q")[i], digits).alias(n) for i, n in enumerate(["q25", "q50", "q75"])],
                      "max")


def head(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """O4 head: first ``n`` rows in ``order`` (a top-k, so one partial sort
    per task and a merge of ``n`` rows each)."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """O4 tail: last ``n`` rows in ``order``."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def cell(df: DataFrame, order: Sequence[str], row: int, *cols: str) -> DataFrame:
    """The values of ``cols`` at 0-based position ``row`` in ``order``."""
    return df.orderBy(*order).offset(row).limit(1).select(*cols)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample per partition; no shuffle, no global sort."""
    return df.sample(fraction=fraction, seed=seed)


def key_hash(key: str) -> Column:
    """The first 32 bits of the md5 of the key's text, as a long: the same in
    any engine, on every run and after any task retry."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")


def sample_by_key(df: DataFrame, key: str, fraction: float, buckets: int = 10_000) -> DataFrame:
    """O5, reproducible: keep rows whose key hashes into the first ``fraction``
    of ``buckets``; whole keys are kept or dropped together. Rows without a
    key are not sampled."""
    return df.where(F.pmod(key_hash(key), F.lit(buckets)) < F.lit(int(round(fraction * buckets))))


def sample_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows, those whose keys hash smallest (ties by key). A top-k:
    each task sends at most ``n`` rows."""
    return df.orderBy(key_hash(key).asc_nulls_last(), key).limit(n)
