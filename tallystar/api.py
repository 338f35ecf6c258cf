"""One-call entry points for the published inputs.

``run_etl`` does the reference's whole batch: keyed-JSON immigration files,
the sectioned code-list file, the translation CSV and the yearly happiness
CSVs in, the fact and the dimension out as Parquet partitioned by ``Year``.
Both, and the records that the fact drops, are written as one version of the
output folder, with the checks computed on the way; the version becomes
visible as a whole, and only if the checks pass, so a failed check or a run
that dies leaves an earlier star as it was. ``top_countries``,
``age_profile``, ``score_volume_correlation`` and ``trend`` answer the
questions on the written star.

Paths may be anything Spark reads (local, HDFS, object store).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystar.operators.quality import reconcile
from tallystar.operators.sketches import merged_counts, year_sketches
from tallystar.operators.star import key_unique
from tallystar.plans import marts
from tallystar.plans.checks import dimension_rules, fact_metrics, fact_rules, observed, rule_metrics, type_breaches
from tallystar.plans.model import (
    FACT_COLS,
    FACT_CONTRACT,
    RAW_SCHEMA,
    REFERENCE_BOOK,
    REFERENCE_SECTION_RANGES,
    CodeBook,
    reference_layout,
)
from tallystar.plans.star_build import (
    FACT_STEP,
    build_dimension,
    build_fact,
    clean_records,
    code_lists,
    conform_yearly,
    decode_coverage,
    files_by_layout,
    file_counts,
    flagged_build,
    list_inputs_deep,
    read_yearly_layouts,
    reject_counts,
    reject_report,
)
from tallystar.sources.json_ranges import read_keyed_json_ranges
from tallystar.sources.readers import (
    read_csv_strings,
    read_keyed_json,
    read_section_ranges,
    read_sections,
)
from tallystar.sources.sinks import write_by_year
from tallystar.sources.versions import (
    commit,
    new_version,
    read_table,
    version_folder,
    written_steps,
    written_years,
)


@dataclass
class EtlResult:
    """``fact_path`` and ``dim_path`` hold what this run wrote; ``fact`` and
    ``dimension`` read the whole version that it made."""
    out_dir: str
    version: int
    fact_path: str
    dim_path: str
    fact_checks: dict
    rule_checks: dict[str, int]
    dim_rows: int
    dim_reconcile: list[dict]
    rejects: dict[str, int]
    file_report: DataFrame | None = None

    def fact(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.out_dir, "fact", self.version)

    def dimension(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.out_dir, "dimension", self.version)

    def distinct_counts(self, spark: SparkSession) -> DataFrame:
        """A7 over the whole version's fact, from the stored sketches of its years."""
        return merged_counts(read_table(spark, self.out_dir, "sketches", self.version))

    def rejected(self, spark: SparkSession) -> DataFrame:
        """The dropped records of the version, with the ``step`` that drops them."""
        return read_table(spark, self.out_dir, "rejects", self.version)


def read_records(spark: SparkSession, imm_path: str, keep_file: bool = False) -> DataFrame:
    """The records of the keyed-JSON files. Where a file is larger than what one task
    should read (``spark.sql.files.maxPartitionBytes``), all are read by byte ranges, so a
    year published as one document is read by many tasks."""
    largest = _files(spark, imm_path).agg(F.max("length")).first()[0] or 0
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    read = read_keyed_json_ranges if largest > most else read_keyed_json
    return read(spark, imm_path, RAW_SCHEMA, keep_file=keep_file).drop("key")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)


def _parts(spark: SparkSession, imm_path: str, metadata_path: str, translation_path: str, book: CodeBook,
           section_ranges: Sequence[tuple[int, int]] | None, keep_file: bool = False) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    sections = (read_section_ranges(spark, metadata_path, section_ranges) if section_ranges
                else read_sections(spark, metadata_path, count=5))
    return (read_records(spark, imm_path, keep_file), code_lists(sections, book),
            read_csv_strings(spark, translation_path))


def read_inputs(spark: SparkSession, imm_path: str, metadata_path: str, translation_path: str,
                book: CodeBook = REFERENCE_BOOK,
                section_ranges: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """The fact as a lazy plan. Sections are found by their ``Key;`` header
    line; pass ``section_ranges`` (e.g. ``REFERENCE_SECTION_RANGES``) to cut
    them by fixed (skiprows, nrows) instead."""
    raw, dims, translation = _parts(spark, imm_path, metadata_path, translation_path, book, section_ranges)
    return build_fact(raw, dims, translation, book)


def coverage(spark: SparkSession, imm_path: str, metadata_path: str, translation_path: str,
             book: CodeBook = REFERENCE_BOOK,
             section_ranges: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """Codes of the cleaned records that no code list or translation
    covers, with the rows the fact build drops because of them."""
    raw, dims, translation = _parts(spark, imm_path, metadata_path, translation_path, book, section_ranges)
    return decode_coverage(clean_records(raw, book), dims, translation)


def rejects(spark: SparkSession, imm_path: str, metadata_path: str, translation_path: str,
            book: CodeBook = REFERENCE_BOOK,
            section_ranges: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """Rows in, rows dropped by each rule and each decode, rows out."""
    raw, dims, translation = _parts(spark, imm_path, metadata_path, translation_path, book, section_ranges)
    return reject_report(raw, dims, translation, book)


def run_etl(spark: SparkSession, imm_path: str, metadata_path: str, translation_path: str,
            happiness_path: str, out_dir: str, book: CodeBook = REFERENCE_BOOK,
            layout_for_year: Callable[[int], str] = reference_layout,
            section_ranges: Sequence[tuple[int, int]] | None = None,
            fail_on_error: bool = False, refresh: bool = False,
            renames: Mapping[str, str] | None = None, on_duplicate: str = "fail", per_file: bool = False) -> EtlResult:
    """The whole batch, as one version of fact, dimension and rejects in ``out_dir``.

    The fact and the records it drops come from one plan and one write. Row
    counts, zero measures, null cells and the accepted values of every column
    are observed on the writes; repeated IDs and the records per yearly file
    against the dimension are counted after. ``fail_on_error`` raises if a
    check fails, before the version becomes visible (``sources.versions``).
    One distinct-value sketch a year and column of the fact is stored beside
    them (``EtlResult.distinct_counts``).
    ``refresh`` replaces only the years that the inputs hold. ``renames`` and
    ``on_duplicate`` go to ``build_dimension``. ``per_file`` carries the file of every
    record through the build; ``EtlResult.file_report`` then has rows in, rejected,
    duplicates and rows out of each file, and a file that holds no record is a failed check."""
    root, version = out_dir.rstrip("/"), new_version()
    raw, dims, translation = _parts(spark, imm_path, metadata_path, translation_path, book, section_ranges, per_file)
    build = flagged_build(raw, dims, translation, book)
    dim = build_dimension(spark, happiness_path, layout_for_year, renames, on_duplicate)
    if wrong := type_breaches(build, FACT_CONTRACT):
        raise AssertionError(f"columns of other types than documented: {wrong}")
    is_fact, rules, dim_rules = F.col("step") == FACT_STEP, fact_rules(book), dimension_rules()
    obs_f, obs_d = Observation("fact"), Observation("dim")
    on_fact = [*fact_metrics(is_fact), *rule_metrics(rules, is_fact)]
    on_dim = [F.count(F.lit(1)).alias("rows"), *rule_metrics(dim_rules)]
    build_o, dim_o = build.observe(obs_f, *on_fact), dim.observe(obs_d, *on_dim)
    build_path, dim_path = version_folder(root, "build", version), version_folder(root, "happiness", version)
    _both(lambda: write_by_year(build_o, build_path, above=["step"]), lambda: write_by_year(dim_o, dim_path))

    written, dim_s = spark.read.schema(build.schema).parquet(build_path), spark.read.schema(dim.schema).parquet(dim_path)
    seen, seen_d = observed(obs_f, on_fact, written), observed(obs_d, on_dim, dim_s)
    checks = {k: seen[k] for k in ("rows", "zero_measure", "null_cells")}
    checks["repeated_ids"] = key_unique(written.where(is_fact).select("ID"), ["ID"]).count()
    broken = {k: seen[k] for k in rules} | {k: seen_d[k] for k in dim_rules}
    # one row a year; the records of the files are read as the dimension reads them
    records = conform_yearly(read_yearly_layouts(spark, files_by_layout(list_inputs_deep(spark, happiness_path), layout_for_year)))
    counted = [r.asDict() for r in reconcile(records, dim_s, "Year").orderBy("Year").collect()]
    report = file_counts(written, _files(spark, imm_path).select(F.col("_metadata.file_path").alias("file"))) if per_file else None
    bad_files = [r.asDict() for r in report.where("status <> 'passed'").orderBy("file").limit(20).collect()] if per_file else []
    failed = bad_files or checks["rows"] == 0 or any(checks[k] for k in ("zero_measure", "null_cells", "repeated_ids")) or any(broken.values())
    uneven = not renames and any(r["status"] != "passed" for r in counted)
    if fail_on_error and (failed or uneven):
        raise AssertionError(f"checks failed, nothing published: {checks}, {broken}, rows per year: {counted}, files: {bad_files}")

    counts = {r["step"]: r["rows"] for r in reject_counts(written).collect()}  # one row a step
    sketched, sketch_path = year_sketches(written.where(is_fact).select(*FACT_COLS), FACT_COLS), version_folder(root, "sketches", version)
    write_by_year(sketched, sketch_path)
    steps = written_steps(spark, build_path)
    dropped = [f"{build_path}/{s}" for s in steps if s != f"step={FACT_STEP}"]
    years = {y for s in steps for y in written_years(spark, root, f"{build_path}/{s}")}
    made = commit(spark, root, {"fact": [f"{build_path}/step={FACT_STEP}"], "rejects": dropped, "dimension": [dim_path], "sketches": [sketch_path]},
                  {"fact": StructType([build.schema[c] for c in FACT_COLS]), "dimension": dim.schema,
                   "rejects": StructType([build.schema[c] for c in ("step", "copies", "record", "Year")]),
                   "sketches": sketched.schema},
                  refresh, {"fact": years, "rejects": years, "sketches": years})
    return EtlResult(root, made["number"], f"{build_path}/step={FACT_STEP}", dim_path, checks, broken, seen_d["rows"], counted, counts, report)


def _both(*jobs: Callable[[], None]) -> None:
    """Run independent writes as concurrent Spark jobs."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for j in [pool.submit(job) for job in jobs]:
            j.result()


def top_countries(spark: SparkSession, result: EtlResult, year: int, k: int = 10) -> DataFrame:
    """M1 on the written star."""
    return marts.topk_with_score(result.fact(spark), result.dimension(spark), year, k)


def age_profile(spark: SparkSession, result: EtlResult, by_gender: bool = False) -> DataFrame:
    """M2 on the written star: volume per year and age (and gender)."""
    keys = ("Year", "Gender", "Age") if by_gender else ("Year", "Age")
    return marts.age_profile(result.fact(spark), keys)


def score_volume_correlation(spark: SparkSession, result: EtlResult) -> DataFrame:
    """M3 on the written star."""
    return marts.score_volume_correlation(result.fact(spark), result.dimension(spark))


def trend(spark: SparkSession, result: EtlResult, years: Sequence[int] | None = None, key: str = "Age") -> DataFrame:
    """M4 on the written star: volume per ``key``, one column per year (all years unless given)."""
    fact = result.fact(spark)
    return marts.trend_pivot(fact, marts.partition_years(fact) if years is None else years, key)


__all__ = ["EtlResult", "read_inputs", "coverage", "rejects", "run_etl", "top_countries", "age_profile",
           "score_volume_correlation", "trend", "REFERENCE_SECTION_RANGES"]
