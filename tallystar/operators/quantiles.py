"""Exact quantiles of columns of any number of distinct values.

Distributed selection: a quantile is the value at one rank, or between two.
Each pass counts, for every rank still sought, the values of the interval
known to hold it in ``bins`` equal cells (an aggregate that combines
map-side) and goes on with the cell that holds the rank, until all values of
that cell are equal. A cell's own least and greatest value bound the next
pass; every second pass takes cells equal in the logarithm where an interval
spans magnitudes, so few passes do. Values are kept only as bounds: a task holds at
most ``bins`` cells a rank, and the driver reads as many rows a pass.

The frame is read once a pass (only its columns of interest, and a pass after
the first only aggregates the interval's rows): pass a stored table, not a long plan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024
_INF = float("inf")
_LIFT = 746.0  # makes the logarithm of every positive double positive


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    bins: int = BINS) -> dict[str, list[float | None]]:
    """For each column its quantiles at ``probs``, linear between two ranks.

    NULL takes no part, NaN sorts above all numbers; a column without values
    has None for each quantile."""
    if bins < 2:
        raise ValueError(f"bins: {bins}")
    if not cols:
        return {}
    long = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("col"), F.col(c).cast("double").alias("v"))
                                        for i, c in enumerate(cols)]))).where(F.col("v").isNotNull())
    v = F.col("v")
    finite = ~F.isnan(v) & (F.abs(v) != F.lit(_INF))
    total = {r["col"]: r for r in long.groupBy("col").agg(  # one row a column
        F.count(v).alias("n"), F.count_if(v == F.lit(-_INF)).alias("below"), F.count_if(finite).alias("finite"),
        F.count_if(v == F.lit(_INF)).alias("above"),
        F.min(F.when(finite, v)).alias("lo"), F.max(F.when(finite, v)).alias("hi")).collect()}

    ends = {(i, p): (math.floor(p * (t["n"] - 1)), math.ceil(p * (t["n"] - 1))) for i, t in total.items() for p in probs}
    found: dict[tuple[int, int], float] = {}                # (column, rank) -> value
    sought: dict[tuple[int, float, float, int], set[int]] = {}  # (column, least, greatest, values below) -> ranks
    for (i, _), pair in ends.items():
        t = total[i]
        for rank in pair:
            if rank < t["below"]:
                found[i, rank] = -_INF
            elif rank >= t["below"] + t["finite"]:
                found[i, rank] = _INF if rank < t["below"] + t["finite"] + t["above"] else math.nan
            else:
                sought.setdefault((i, t["lo"], t["hi"], t["below"]), set()).add(rank)

    passes = 0
    while sought:
        for key in [k for k in sought if k[1] == k[2]]:
            found |= {(key[0], rank): key[1] for rank in sought.pop(key)}
        if not sought:
            break
        cells = _cells(long, list(sought), bins, logarithmic=passes % 2 == 1)
        passes += 1
        rest: dict[tuple[int, float, float, int], set[int]] = {}
        for key, ranks in sought.items():
            at, below = 0, key[3]
            mine = cells[key]
            for rank in sorted(ranks):
                while rank >= below + mine[at][0]:
                    below, at = below + mine[at][0], at + 1
                rest.setdefault((key[0], mine[at][1], mine[at][2], below), set()).add(rank)
        sought = rest

    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        out[c] = []
        for p in probs:
            if i not in total:
                out[c].append(None)
                continue
            a, b = (found[i, rank] for rank in ends[i, p])
            share = p * (total[i]["n"] - 1) - ends[i, p][0]
            out[c].append(a if a == b or share == 0 else a + (b - a) * share)
    return out


def _magnitude(x: float) -> float:
    return math.copysign(math.log(abs(x)) + _LIFT, x) if x else 0.0


def _cells(long: DataFrame, intervals: list[tuple[int, float, float, int]], bins: int,
           logarithmic: bool) -> dict[tuple[int, float, float, int], list[tuple[int, float, float]]]:
    """(values, least, greatest) of the cells of each interval, in order."""
    # halved where the span itself has no finite value
    rows = [(n, i, lo, hi, 1.0 if math.isfinite(hi - lo) else 0.5, logarithmic and _magnitude(hi) - _magnitude(lo) > 1)
            for n, (i, lo, hi, _) in enumerate(intervals)]
    given = long.sparkSession.createDataFrame(rows, "id int, col int, lo double, hi double, scale double, by_log boolean")

    def place(c: str) -> Column:
        by_log = F.when(F.col(c) == 0, 0.0).otherwise(F.signum(c) * (F.log(F.abs(c)) + _LIFT))
        return F.when(F.col("by_log"), by_log).otherwise(F.col(c) * F.col("scale"))

    x = {c: place(c) for c in ("v", "lo", "hi")}
    # monotone in v at every rounding, 0 at lo and 1 at hi: cells are stretches of values, and the two ends part
    cell = F.least(F.lit(bins - 1), F.floor((x["v"] - x["lo"]) / (x["hi"] - x["lo"]) * bins).cast("int"))
    got = (long.join(F.broadcast(given), "col")  # two rows a quantile and column at most
           .where(F.col("v").between(F.col("lo"), F.col("hi")))  # leaves out NaN and infinite values
           .groupBy("id", cell.alias("cell"))
           .agg(F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("most")).collect())
    out: dict[tuple[int, float, float, int], list[tuple[int, float, float]]] = {k: [] for k in intervals}
    for r in sorted(got, key=lambda r: (r["id"], r["cell"])):
        out[intervals[r["id"]]].append((r["n"], r["least"], r["most"]))
    return out
