"""Sinks.

K1 ``write_csv``      header CSV export; ``readers.read_csv_exact`` reads it
   back value for value.
K2 ``write_by_year``  Parquet partitioned by ``Year``.
K3 ``write_by_year(..., refresh=True)`` replaces only the years present in
   the frame (dynamic partition overwrite, set per write so the session
   default stays untouched); the other years stay as they are.

Rows are rebalanced by year before the write, so a year's rows meet in few
files instead of one file per task and year. It is a hint that AQE splits by
size: a year that holds a third of all rows is still written by many tasks.
``spread=False`` writes rows that already lie together by year as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Options that keep every text value: blanks, quotes, line ends, empty text.
CSV_EXACT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
             "ignoreTrailingWhiteSpace": False, "nullValue": "\\N"}
MAX_RECORDS_PER_FILE = 20_000_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.options(**CSV_EXACT, emptyValue='""').mode(mode).csv(path)


def write_by_year(df: DataFrame, path: str, year_col: str = "Year", refresh: bool = False,
                  above: Sequence[str] = (), spread: bool = True, compression: str | None = None) -> None:
    """``above``: columns whose folders come before those of the year. ``spread``:
    rebalance the rows before the write."""
    cols = [*above, year_col]
    rows = df.hint("rebalance", *[F.col(c) for c in cols]) if spread else df
    writer = rows.write.partitionBy(*cols).mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    if refresh:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path, compression=compression)
