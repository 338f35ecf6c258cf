"""Land the reference-shaped inputs, then build and write the star.

``land_inputs`` writes, from the test tables, the four inputs the builds
read: keyed-JSON record documents, the sectioned code-list file, the
translation CSV and the yearly happiness CSVs in two header layouts (plus
the raw records as Parquet, which the record-level queries read).
``ensure_star`` runs M5 and M6 over them and writes the flagged build (fact and
rejects, by step) and the dimension as Parquet partitioned by ``Year``. Both are written once per
session and state of the table folder (file names, sizes and times), under the
shared scratch root, and later queries read the written tables (partition
pruning, column pruning, no recompute after an executor loss).
"""

from __future__ import annotations

import math
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.strings import strict_int
from tallystar.operators.rank import rank_within
from tallystar.plans import bindings as B
from tallystar.plans.checks import fact_metrics, observed
from tallystar.plans.model import (
    FACT_COLS,
    LAYOUT_2018_COLUMNS,
    LAYOUT_2020_COLUMNS,
    RAW_FIELDS,
    RAW_SCHEMA,
)
from tallystar.plans.star_build import FACT_STEP, build_dimension, build_fact, flagged_build, read_code_lists
from tallystar.session import fresh_path
from tallystar.sources.readers import read_csv_strings, read_keyed_json
from tallystar.sources.sinks import write_by_year

CODE_LIST_HEADER = "Key;Title;Description"
CODE_LIST_PREAMBLE = [
    "Immigration by sex, age, marital status and country of birth",
    "Code lists per dimension follow; each starts with a Key;Title header line.",
    "",
]


@dataclass
class Landing:
    raw: str
    imm: str
    codes: str
    translation: str
    happiness: str
    build: str | None = None
    dim: str | None = None
    checks: dict | None = None


_LANDED: dict[tuple, Landing] = {}
# Queries may be called from several driver threads; land and build once.
_LOCK = threading.RLock()


SOURCE_TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    """Application, folder, and the listing of the source tables' files: a
    table that is written anew is landed anew."""
    folder = sf_dir.rstrip("/")
    listing = spark.read.format("binaryFile").load([f"{folder}/{t}.parquet" for t in SOURCE_TABLES])
    files = sorted(tuple(map(str, r)) for r in listing.select("path", "modificationTime", "length").collect())
    return (spark.sparkContext.applicationId, folder, tuple(files))


# ------------------------------------------------------------------- writers
# Files are kept small: Spark counts 4 MB for opening each when it packs files into tasks, so
# a task's rows stay bounded however well they compress.
DOCS_PER_TASK = 16
RECORDS_PER_FILE = 100_000
CODEC = "zstd"  # of the landed and built Parquet


def with_row_key(written: DataFrame) -> DataFrame:
    """The records of a written table with ``_row_key``, a record's file and position in it:
    unique, the same on every recomputation, and neither written nor carried through the joins."""
    return written.withColumn("_row_key", F.concat_ws(
        "-", F.xxhash64("_metadata.file_path").cast("string"), F.col("_metadata.row_index").cast("string")))


def keyed_documents(raw: DataFrame, records_per_doc: int, n_records: int) -> DataFrame:
    """(Year, value): JSON documents ``{"value": {"<key>": record}}``, one per year and shard.

    ``raw`` carries ``_row_key``, a unique key that is stable under
    recomputation. Records are spread over shards by its hash, so a document
    holds at most about ``records_per_doc`` records (fewer where a year has
    few) even when one ID or one year holds a large share of the rows.

    The records are shuffled as they are (year, shard and nesting are made behind the
    shuffle, so they take no bytes of it) and collected there, by as many
    tasks as keep ``DOCS_PER_TASK`` shards each. Collecting before it would save
    nothing, as no records combine, and sort a task's whole input, beyond memory
    where that is large."""
    n_docs = max(1, math.ceil(n_records / records_per_doc))
    year = strict_int(F.substring("Perioden", 1, 4))
    doc = F.pmod(F.xxhash64("_row_key"), F.lit(n_docs))
    tasks = max(math.ceil(n_docs / DOCS_PER_TASK), min(n_docs, raw.sparkSession.sparkContext.defaultParallelism))
    docs = (raw.select("_row_key", *RAW_FIELDS).repartition(tasks, year, doc)
            .select(year.alias("Year"), doc.alias("_doc"), F.struct("_row_key", F.struct(*RAW_FIELDS)).alias("_entry"))
            .groupBy("Year", "_doc").agg(F.map_from_entries(F.collect_list("_entry")).alias("value")))
    return docs.select("Year", "value")


def write_keyed_json(raw: DataFrame, path: str, records_per_doc: int, n_records: int,
                     compression: str | None = None) -> None:
    """The ``keyed_documents`` of ``raw``, one a line. The files of the year
    ``B.FILE_NAMED_YEAR`` carry the year in their names, those of the other
    years in their folder's. A file of a ``compression`` that Spark cannot split
    is read by one task; it holds a year's documents of one writing task."""
    keyed_documents(raw, records_per_doc, n_records).write.partitionBy("Year").mode("overwrite").json(
        path, compression=compression)
    name_files(raw.sparkSession, f"{path}/Year={B.FILE_NAMED_YEAR}", path, B.FILE_NAMED_YEAR)


def name_files(spark: SparkSession, folder: str, target: str, year: int) -> None:
    """Move the data files of ``folder`` to ``target`` as
    ``immigration_<year>.json``, ``immigration_1_<year>.json`` and so on (as
    published files are named by hand); a folder that is not there is left
    alone. The ending that tells a compression stays. Each file is as its task
    wrote it, so no task writes a whole year."""
    jvm = spark._jvm
    source = jvm.org.apache.hadoop.fs.Path(folder)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(source):
        files = [f.getPath() for f in fs.listStatus(source) if not f.getPath().getName().startswith(("_", "."))]
        for k, file in enumerate(files):
            ending = ".json" + file.getName().partition(".json")[2]
            name = f"immigration_{k}_{year}{ending}" if k else f"immigration_{year}{ending}"
            if not fs.rename(file, jvm.org.apache.hadoop.fs.Path(f"{target}/{name}")):
                raise OSError(f"{file.toString()} could not be renamed to {name}")
        fs.delete(source, True)


def write_code_list(sections: DataFrame, spark: SparkSession, path: str) -> None:
    """The sectioned text file: preamble, then per section a blank line (not
    before the first), the header and ``Key;Title;`` lines. The file is as
    small as the code domains, so it is written by one task in order."""
    pre = spark.createDataFrame(
        [(-1, 0, f"{i:04d}", line) for i, line in enumerate(CODE_LIST_PREAMBLE)],
        "section int, pos int, sort_key string, line string")
    secs = sections.select("section").distinct()
    gaps = secs.where(F.col("section") > 0).select(
        "section", F.lit(0).alias("pos"), F.lit("").alias("sort_key"), F.lit("").alias("line"))
    heads = secs.select("section", F.lit(1).alias("pos"), F.lit("").alias("sort_key"),
                        F.lit(CODE_LIST_HEADER).alias("line"))
    body = sections.select("section", F.lit(2).alias("pos"), "sort_key",
                           F.concat_ws(";", "Key", "Title", F.lit("")).alias("line"))
    lines = pre.unionByName(gaps).unionByName(heads).unionByName(body)
    (lines.repartition(1).sortWithinPartitions("section", "pos", "sort_key")
     .select("line").write.mode("overwrite").text(path))


def write_happiness(h: DataFrame, path: str, switch_year: int) -> None:
    """Yearly CSVs (``Year=<y>/part-*.csv``): years before ``switch_year``
    with the 2018 header (with ``Overall rank``), later years with the 2020
    header and its further columns; NULL is written as ``N/A``. The rank window is per year over one row per country. The ranked
    table (countries x years) is cached for the two writes."""
    ranked = rank_within(h, ["Year"], "Happiness_Score", ["Country"], name="rank").cache()
    try:
        old = ranked.where(F.col("Year") < switch_year).select(
            *[F.col(src).alias(dst) for src, dst in zip(
                ["rank", "Country", "Happiness_Score", "GDP_Score", "Social_Score", "Health_Score",
                 "Freedom_Score", "Generosity_Score", "Corruption_Score"], LAYOUT_2018_COLUMNS)], "Year")
        new = ranked.withColumns({"Error": F.col("Social_Score") / 10, "Residual": F.col("GDP_Score")}) \
            .where(F.col("Year") >= switch_year).select(
            *[F.col(src).alias(dst) for src, dst in zip(
                ["Country", "Region", "Happiness_Score", "Error", "GDP_Score", "Social_Score", "Health_Score",
                 "Freedom_Score", "Generosity_Score", "Corruption_Score", "Residual"], LAYOUT_2020_COLUMNS)], "Year")
        for part, mode in ((old, "overwrite"), (new, "append")):
            part.write.partitionBy("Year").option("header", True).option("nullValue", "N/A").mode(mode).csv(path)
    finally:
        ranked.unpersist()


# ------------------------------------------------------------------ landing
def _run_concurrently(jobs: list) -> None:
    """Submit independent writes as concurrent Spark jobs (one driver thread
    each), so small jobs overlap instead of queueing behind a large one."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()


def land_inputs(spark: SparkSession, sf_dir: str) -> Landing:
    with _LOCK:
        return _land_inputs(spark, sf_dir)


def _land_inputs(spark: SparkSession, sf_dir: str) -> Landing:
    key = _key(spark, sf_dir)
    if key in _LANDED:
        return _LANDED[key]
    n_records = B.table(spark, sf_dir, "lineitem").count()
    land = Landing(raw=fresh_path(spark, "raw-records"), imm=fresh_path(spark, "imm-json"),
                   codes=fresh_path(spark, "codelist"), translation=fresh_path(spark, "translation"),
                   happiness=fresh_path(spark, "happiness"))

    def records() -> None:
        # the four-table join runs once: raw records are written as Parquet
        # and the keyed-JSON documents are built from that copy
        (B.raw_records(spark, sf_dir).write.option("maxRecordsPerFile", RECORDS_PER_FILE)
         .mode("overwrite").parquet(land.raw, compression=CODEC))
        write_keyed_json(with_row_key(spark.read.parquet(land.raw)), land.imm, B.RECORDS_PER_DOC, n_records,
                         compression="gzip")

    _run_concurrently([
        records,
        lambda: write_code_list(B.code_sections(spark, sf_dir), spark, land.codes),
        lambda: B.translation(spark, sf_dir).write.option("header", True).mode("overwrite")
        .csv(land.translation),
        lambda: write_happiness(B.happiness_yearly(spark, sf_dir), land.happiness, B.STANDIN_LAYOUT_SWITCH),
    ])
    _LANDED[key] = land
    return land


def landed_raw(spark: SparkSession, land: Landing) -> DataFrame:
    """The raw records as the reference reads them: from the keyed JSON."""
    return read_keyed_json(spark, land.imm, RAW_SCHEMA).drop("key")


def landed_raw_table(spark: SparkSession, land: Landing) -> DataFrame:
    """The same records from the Parquet copy (columnar, prunable)."""
    return spark.read.parquet(land.raw).select(*RAW_FIELDS)


def landed_code_lists(spark: SparkSession, land: Landing) -> dict[str, DataFrame]:
    return read_code_lists(spark, land.codes, B.STANDIN_BOOK)


def landed_fact(spark: SparkSession, land: Landing) -> DataFrame:
    """M5 over the landed files (lazy)."""
    return build_fact(landed_raw(spark, land), landed_code_lists(spark, land),
                      read_csv_strings(spark, land.translation), B.STANDIN_BOOK)


def landed_dimension(spark: SparkSession, land: Landing) -> DataFrame:
    """M6 over the landed files (lazy)."""
    return build_dimension(spark, land.happiness, B.standin_layout)


def ensure_star(spark: SparkSession, sf_dir: str) -> Landing:
    """Write the fact and the dimension once; checks ride along the fact
    write through ``observe``, so they cost no extra pass."""
    with _LOCK:
        return _ensure_star(spark, sf_dir)


def _ensure_star(spark: SparkSession, sf_dir: str) -> Landing:
    land = land_inputs(spark, sf_dir)
    if land.build is not None:
        return land
    build = flagged_build(landed_raw(spark, land), landed_code_lists(spark, land),
                          read_csv_strings(spark, land.translation), B.STANDIN_BOOK, clustered=True)
    obs, metrics = Observation("fact_checks"), fact_metrics(F.col("step") == FACT_STEP)
    watched = build.observe(obs, *metrics)
    build_path, dim_path = fresh_path(spark, "build"), fresh_path(spark, "dim")
    dim = landed_dimension(spark, land)
    _run_concurrently([lambda: write_by_year(watched, build_path, above=["step"], spread=False, compression=CODEC),
                       lambda: write_by_year(dim, dim_path)])
    land.build, land.dim, land.checks = build_path, dim_path, observed(obs, metrics, spark.read.schema(build.schema).parquet(build_path))
    return land


def built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written build: the fact's rows and the rejects, by ``step``."""
    return spark.read.parquet(ensure_star(spark, sf_dir).build)


def star_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    land = ensure_star(spark, sf_dir)
    fact = spark.read.option("basePath", land.build).parquet(f"{land.build}/step={FACT_STEP}")
    return fact.select(*FACT_COLS), spark.read.parquet(land.dim)
