"""Cleaning operators.

The reference cleans record by record in pandas; here each rule is a column
predicate over the exploded records, applied in one narrow stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tallystar.functions.strings import strict_int, strip_ws


def trim_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """X1 on several columns; done before any code comparison."""
    return df.withColumns({c: strip_ws(c) for c in cols})


def positive_measure(measure: str) -> Column:
    """measure present and above zero."""
    return F.col(measure).isNotNull() & (F.col(measure) > 0)


def keep_positive(df: DataFrame, measure: str) -> DataFrame:
    return df.where(positive_measure(measure))


def code_below(code: str, limit: int) -> Column:
    """numeric value of the whole code below ``limit``. A code that is not
    an integer gives NULL and is dropped (the reference raises on it);
    ``star_build.reject_report`` counts those."""
    return strict_int(strip_ws(code)) < F.lit(limit)


def not_total(totals: Mapping[str, str]) -> Column:
    """none of the columns equals its total code. Null-safe, so a NULL
    code is kept here, as in the reference's Python test (D14)."""
    cond = F.lit(True)
    for c, code in totals.items():
        cond = cond & ~F.col(c).eqNullSafe(F.lit(code))
    return cond


def drop_totals(df: DataFrame, totals: Mapping[str, str]) -> DataFrame:
    return df.where(not_total(totals))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
                copies: str | None = None, also: Sequence[Column] = ()) -> DataFrame:
    """A4, deterministic: per key keep the row that is smallest in ``order``
    (default: all other columns, left to right). In each column a value comes
    before NULL, so a row with a code is kept rather than one without. ``copies``
    names a further column with the number of rows of the key, ``also`` further
    named aggregates over them; columns of neither ``keys`` nor ``order`` are then dropped.

    Written as ``min(struct(...))`` per key rather than ``row_number`` over a
    window: the aggregate combines map-side, so a key with millions of copies
    sends one row per map task to the shuffle instead of all its copies to
    one task.
    """
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else rest
    tail = [c for c in rest if c not in order] if not also else []
    packed = F.struct(*[x for i, c in enumerate(order)
                        for x in (F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_o{i}"))],
                      *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tail)])
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    made = [c for c in df.groupBy(*keys).agg(*also).columns if c not in keys] if also else []
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"), *counted, *also)
    return agg.select(
        *keys,
        *[F.col(f"_first._o{i}").alias(c) for i, c in enumerate(order)],
        *[F.col(f"_first._t{i}").alias(c) for i, c in enumerate(tail)],
        *([copies] if copies else []), *made,
    ).select(*[c for c in df.columns if c in keys or c in order or c in tail], *([copies] if copies else []), *made)


def key_slice(df: DataFrame, key: str, starts: Sequence[int], length: int = 5) -> DataFrame:
    """records whose numeric key lies in ``[s, s + length)`` for any
    start ``s`` (the reference's preview of a few keys at chosen offsets).
    An integral key is compared as is, so the ranges reach the Parquet scan
    as pushed filters; a text key (the JSON map keys) is parsed first, whatever
    its number of digits."""
    if isinstance(df.schema[key].dataType, IntegralType):
        k = F.col(key)
    else:
        text = strip_ws(key)
        bare = F.ltrim(F.when(text.startswith("+") | text.startswith("-"), F.substring(text, 2, 2 ** 31 - 1)).otherwise(text), F.lit("0"))
        zero = (bare == "") & text.endswith("0")
        # what is no digit becomes a blank, and longer keys than 18 digits are in no range of longs
        whole = (F.length(bare) <= 18) & (F.translate(bare, "0123456789", "") == "") & (bare != "")
        number = F.when(whole, bare.cast("long")).when(zero, 0)
        k = F.when(text.startswith("-"), -number).otherwise(number)
    cond = F.lit(False)
    for s in starts:
        cond = cond | k.between(s, s + length - 1)
    return df.where(cond)


def harmonise_values(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    """Whole-value renames in one column (e.g. two spellings of one
    country). May make a key non-unique; run ``star.key_unique`` after."""
    return df.replace(dict(mapping), subset=[col])
