"""Data-quality checks.

The reference runs each check as its own action and only prints. Here a
report is a small DataFrame computed in one aggregation pass; callers that
must stop on failure use ``assert_passed`` (which collects the few report
rows, never the data).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _long(agg: DataFrame, names: Sequence[str], name_col: str, value_col: str) -> DataFrame:
    return agg.unpivot([], list(names), name_col, value_col)


def _status(col: str = "failures") -> Column:
    return F.when(F.col(col) == 0, F.lit("passed")).otherwise(F.lit("failed")).alias("status")


def quality_report(df: DataFrame, measure: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Q1 + Q2 + D3 in one pass: ``(check_name, failures, status)`` for
    not_empty, no_null_cells (per column, summed) and no_zero_measure."""
    cols = list(cols) if cols is not None else df.columns
    null_cells = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0).cast("long"))
    agg = df.agg(
        F.when(F.count(F.lit(1)) == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("not_empty"),
        null_cells.cast("long").alias("no_null_cells"),
        F.count_if(F.col(measure) == 0).cast("long").alias("no_zero_measure"),
    )
    return _long(agg, ["not_empty", "no_null_cells", "no_zero_measure"], "check_name", "failures") \
        .select("check_name", "failures", _status())


def rule_metrics(rules: Mapping[str, Column], where: Column | None = None) -> list[Column]:
    """Each rule as an aggregate that counts its violations (NULL counts as one) among
    the rows of ``where``: for ``domain_report``, or observed on a write, where
    they cost no pass of their own."""
    rows = F.lit(True) if where is None else where
    return [F.count_if(rows & ~F.coalesce(cond, F.lit(False))).cast("long").alias(name) for name, cond in rules.items()]


def domain_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Q4: each rule is a condition every row must meet; a NULL result counts
    as a violation. One pass for all rules. ``(rule, violations, status)``."""
    agg = df.agg(*rule_metrics(rules))
    return _long(agg, list(rules), "rule", "violations") \
        .select("rule", "violations", _status("violations"))


def reconcile(inputs: DataFrame, output: DataFrame, key: str) -> DataFrame:
    """Q3: row counts per ``key`` (file, year) before and after a step.
    ``(key, rows_in, rows_out, status)``; a key missing on one side counts 0."""
    a = inputs.groupBy(key).agg(F.count(F.lit(1)).alias("rows_in"))
    b = output.groupBy(key).agg(F.count(F.lit(1)).alias("rows_out"))
    b = b.withColumnRenamed(key, "_key")
    # null-safe: rows without a key are one group on both sides
    j = a.join(b, F.col(key).eqNullSafe(F.col("_key")), "full_outer").select(
        F.coalesce(key, "_key").alias(key), F.coalesce("rows_in", F.lit(0)).alias("rows_in"),
        F.coalesce("rows_out", F.lit(0)).alias("rows_out"))
    return j.withColumn("status", F.when(F.col("rows_in") == F.col("rows_out"), "passed")
                        .otherwise("failed"))


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows``, ``distinct_keys`` and ``duplicates`` for a key that
    may be composite or nullable (counted as a struct)."""
    k = F.struct(*keys)
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(k).alias("distinct_keys")) \
        .withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))


def schema_report(df: DataFrame, contract: StructType) -> DataFrame:
    """Q5 (types) + A6: per contract column, the type found and the nulls
    counted in the data, in one pass. ``(column_name, expected_type,
    data_type, nulls, status)``; a missing column has type ``missing``."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    present = [f.name for f in contract.fields if f.name in found]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in present]) \
        if present else None
    rows = []
    for f in contract.fields:
        nulls = F.col(f"`{f.name}`") if f.name in found else F.lit(None).cast("long")
        rows.append(F.struct(F.lit(f.name).alias("column_name"),
                             F.lit(f.dataType.simpleString()).alias("expected_type"),
                             F.lit(found.get(f.name, "missing")).alias("data_type"),
                             nulls.alias("nulls")))
    base = counts if counts is not None else df.sparkSession.range(1)
    out = base.select(F.inline(F.array(*rows)))
    ok = (F.col("expected_type") == F.col("data_type")) & F.coalesce(F.col("nulls") == 0, F.lit(False))
    return out.withColumn("status", F.when(ok, "passed").otherwise("failed"))


def assert_passed(report: DataFrame, status_col: str = "status") -> None:
    """D4 ``fail_on_error``: raise if any report row failed."""
    failed = report.where(F.col(status_col) != "passed").collect()
    if failed:
        raise AssertionError(f"data quality check failed: {[r.asDict() for r in failed]}")
