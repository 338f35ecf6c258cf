"""Readers for the reference's input shapes.

S1 ``list_inputs``      top-level files of a folder (metadata only).
S2 ``read_keyed_json``  JSON whose records are the values of a map under
                        ``value``; read with an explicit schema (inference
                        would make one struct field per key) and exploded. A
                        broken document or a value of another type is an
                        error.
S3 ``with_file_year``   year column from the file path.
S4 ``read_sections``    one text file holding several ``Key;Title`` tables;
                        sections are found by their header line, inside the
                        row, so no window or single-task pass is needed.
S6 ``read_csv_by_name`` header CSV, the needed columns by name, typed, with
                        ``N/A`` nulls.
S7 ``read_csv_strings`` header CSV, every column a string;
   ``read_csv_exact``   reads what ``sinks.write_csv`` wrote.
S8 ``read_parquet``     Parquet with partition discovery.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from tallystar.functions.paths import file_year
from tallystar.functions.strings import NUM_TEXT, strip_ws
from tallystar.sources.sinks import CSV_EXACT


def _paths(p: str | Sequence[str]) -> list[str]:
    return [p] if isinstance(p, str) else list(p)


def list_inputs(spark: SparkSession, path: str) -> list[str]:
    """Files directly under ``path`` (no recursion), sorted. Only the file
    listing reaches the driver."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path)
    return sorted(map(unquote, df.inputFiles()))


def with_file_year(df: DataFrame, name: str = "Year") -> DataFrame:
    return df.withColumn(name, file_year())


def read_keyed_json(spark: SparkSession, paths: str | Sequence[str], record_schema: StructType,
                    key_col: str = "key", keep_year: bool = False, multi_line: bool = False,
                    spread: bool = False, keep_file: bool = False) -> DataFrame:
    """Each JSON document is ``{"value": {"<key>": {record}, ...}}``; one
    document per line (``multi_line=True`` for pretty-printed files, one
    document per file). Returns one row per record: ``key`` plus the record
    fields (and ``Year`` from the path when ``keep_year``, ``file``, the path, when ``keep_file``). Folders are read
    with all their subfolders.

    A document that does not parse or has no ``value``, and a value that does
    not fit its field (``5.0`` or ``"5"`` for an int), fail the read; nothing is dropped.

    A document is one row of text, so one task parses it, and it must stay
    below 2 GB (a larger one fails the read): ``json_ranges.read_keyed_json_ranges``
    reads larger ones. ``spread=True`` rebalances the records after the parse, for
    readers that do not shuffle them anyway (the fact build does, on ID)."""
    schema = StructType([StructField("value", MapType(StringType(), record_schema))])
    raw = (spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST")
           .option("recursiveFileLookup", True).json(_paths(paths)))
    if keep_year:
        raw = raw.withColumn("_file_year", file_year())
    lost = F.raise_error(F.concat(F.lit("a document has no object 'value': "), F.col("_metadata.file_path")))
    value = F.when(F.col("value").isNull(), lost.cast(schema["value"].dataType)).otherwise(F.col("value"))
    exploded = raw.select(
        *([F.col("_file_year").alias("Year")] if keep_year else []),
        *([F.col("_metadata.file_path").alias("file")] if keep_file else []),
        F.explode(value).alias(key_col, "_rec"),
    )
    records = exploded.select(
        key_col, *[F.col(f"_rec.{f.name}").alias(f.name) for f in record_schema.fields],
        *(["Year"] if keep_year else []), *(["file"] if keep_file else []),
    )
    return records.hint("rebalance") if spread else records


def read_sections(spark: SparkSession, path: str | Sequence[str], marker: str = "Key",
                  sep: str = ";", names: Sequence[str] = ("Key", "Title"),
                  count: int | None = None) -> DataFrame:
    """Split a multi-table text file into ``(section, line_no, *names)``.

    A section starts at a header line whose first field is ``marker``, quoted
    or not; the lines before the first header (preamble) are dropped, as are
    blank lines. ``section`` is 0-based in file order. Only the first
    ``len(names)`` fields of each line are kept (S5, positional pick). A file
    without a section, or with another number of them than ``count``, is an
    error.
    """
    head = rf'"?{re.escape(marker)}"?{re.escape(sep)}'
    text = spark.read.text(_paths(path), wholetext=True)
    # split before every header line; keep only the parts that are sections
    found = F.filter(F.split("value", rf"\r?\n(?={head})"), lambda p: p.rlike(rf"^\uFEFF?{head}"))
    wrong = F.size(found) == 0 if count is None else F.size(found) != count
    parts = F.when(wrong, F.raise_error(F.concat(
        F.lit("sections found: "), F.size(found).cast("string"), F.lit(f", expected {count or 'one or more'} in "),
        F.col("_metadata.file_path"))).cast("array<string>")).otherwise(found)
    sections = text.select(F.posexplode(parts).alias("section", "part"))
    lines = sections.select(
        "section", F.posexplode(F.split("part", r"\r?\n")).alias("line_no", "line")
    ).where((F.col("line_no") > 0) & (F.trim("line") != ""))
    schema = ", ".join(f"`{n}` string" for n in names)
    return lines.select(
        "section", "line_no", F.from_csv("line", schema, {"sep": sep}).alias("r")
    ).select("section", "line_no", *[F.col(f"r.`{n}`").alias(n) for n in names])


def read_section_ranges(spark: SparkSession, path: str, ranges: Sequence[tuple[int, int]],
                        sep: str = ";", names: Sequence[str] = ("Key", "Title")) -> DataFrame:
    """The reference's form of S4: ``(skiprows, nrows)`` per table, where the
    first line after the skipped ones is the header."""
    text = spark.read.text(path, wholetext=True)
    lines = text.select(F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line"))
    sec = None
    for i, (skip, nrows) in enumerate(ranges):
        cond = (F.col("pos") > skip) & (F.col("pos") <= skip + nrows)
        sec = F.when(cond, F.lit(i)) if sec is None else sec.when(cond, F.lit(i))
    schema = ", ".join(f"`{n}` string" for n in names)
    return (
        lines.withColumn("section", sec)
        .where(F.col("section").isNotNull())
        .select("section", F.col("pos").alias("line_no"),
                F.from_csv("line", schema, {"sep": sep}).alias("r"))
        .select("section", "line_no", *[F.col(f"r.`{n}`").alias(n) for n in names])
    )


def _plain(path: str) -> str:
    """A path as Spark reports it and as callers give it, in one spelling."""
    return re.sub(r"^file:/+", "/", unquote(path))


def csv_headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """CSV files by their column names (their first lines); one job for all files.

    Only the first split of a file is read, and one line a file leaves a task."""
    if not paths:
        return {}
    first = (spark.read.text(list(paths)).where(F.col("_metadata.file_block_start") == 0)
             .select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("at"))
             .groupBy("file").agg(F.min_by("value", "at").alias("line")))
    lines = {_plain(r["file"]): r["line"] for r in first.collect()}  # one row a file
    out: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        line = lines.get(_plain(p), "")  # an empty file has none
        out.setdefault(tuple(next(csv.reader([line.lstrip("\ufeff")]), ())), []).append(p)
    return out


def read_csv_by_name(spark: SparkSession, paths: str | Sequence[str], columns: StructType,
                     null_value: str = "N/A") -> DataFrame:
    """The ``columns`` of header CSV files by name, and ``Year`` from the path.

    Files may hold them in any order and hold further columns. Files with one
    header are read together. A file that lacks a column, and a text that does
    not fit its column's type, are errors; ``null_value`` and empty fields are
    NULL. Quoted cells may hold line ends; a file is one task, as yearly files are small."""
    by_header = csv_headers(spark, _paths(paths))
    for header, files in by_header.items():
        missing = [c for c in columns.fieldNames() if c not in header]
        if missing:
            raise ValueError(f"{files[0]} lacks the columns {missing}")

    def typed(field: StructField) -> Column:
        text = strip_ws(f"`{field.name}`")
        value = F.when((text != null_value) & (text != ""), text if field.dataType != StringType() else F.col(f"`{field.name}`"))
        if field.dataType != StringType():
            bad = F.raise_error(F.concat(F.lit(f"{field.name}: not a number: "), value)).cast(field.dataType)
            value = F.when(value.isNull(), F.lit(None)).when(value.rlike(NUM_TEXT), value.try_cast(field.dataType)).otherwise(bad)
        return value.alias(field.name)

    parts = []
    for header, files in sorted(by_header.items()):
        # positions only carry the file's own header; a repeated name is read at its first place
        names = [h if header.index(h) == i else f"_{i}" for i, h in enumerate(header)]
        schema = StructType([StructField(n, StringType()) for n in names])
        raw = spark.read.schema(schema).options(header=True, mode="FAILFAST", multiLine=True, escape='"').csv(files)
        parts.append(with_file_year(raw).select(*[typed(f) for f in columns.fields], "Year"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_csv_exact(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back what ``sinks.write_csv`` wrote, value for value."""
    return spark.read.schema(schema).options(**CSV_EXACT, emptyValue="", multiLine=True, mode="FAILFAST").csv(path)


def read_csv_strings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.option("header", True).csv(_paths(paths))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
