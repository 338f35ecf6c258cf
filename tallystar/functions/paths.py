"""Year from an input path.

The reference cuts the year out of the file name by fixed negative offsets.
Here it is a regex over ``_metadata``: first the file name
(``..._2018.json``, also compressed, ``.json.gz``), then
the parent folder (``Year=2018/part-...``, the layout Spark itself writes). A
path without a year is an error, never a NULL year.

``in_year`` is the matching filter on a timestamp column, written as a range
so it is pushed to the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_YEAR = r"(\d{4})\.[A-Za-z]+(?:\.(?:gz|bz2|zst|lz4|snappy|deflate))?$"
DIR_YEAR = r"(\d{4})[^/\d]*/[^/]*$"


def file_year(name_pattern: str = NAME_YEAR, dir_pattern: str = DIR_YEAR, path: Column | None = None) -> Column:
    """The year in the path of the row's file, or in the column ``path``."""
    path = F.col("_metadata.file_path") if path is None else path
    from_name = F.nullif(F.regexp_extract(path, name_pattern, 1), F.lit(""))
    from_dir = F.nullif(F.regexp_extract(path, dir_pattern, 1), F.lit(""))
    year = F.coalesce(from_name, from_dir)
    missing = F.raise_error(F.concat(F.lit("no year in input path "), path))
    return F.when(year.isNull(), missing.cast("int")).otherwise(year.cast("int"))


def in_year(ts_col: str, year: int) -> Column:
    """``year(ts_col) == year`` for a TIMESTAMP_NTZ column, written as a
    half-open range on the column itself, so Parquet gets it as a pushed
    filter (row-group skipping)."""
    c = F.col(ts_col)
    lo = F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{year + 1}-01-01 00:00:00").cast("timestamp_ntz")
    return (c >= lo) & (c < hi)
