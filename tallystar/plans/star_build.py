"""M5 (fact build) and M6 (dimension build) as single lazy plans.

Fact: keyed JSON -> trim codes -> F1/F2/F3 -> dedup on ID -> five code-list
joins + translation lookup -> casts. The records are shuffled once (the
dedup); every code list is made unique, then broadcast by its size in bytes.
``flagged_build`` is the same with left joins: the fact and what each rule and
each decode drops, in one pass; ``reject_counts`` counts it. The reference's
CSV staging hop and five re-evaluations are gone: checks run in one pass
(``quality.py``).

Dimension: yearly CSVs -> columns by name, one read per header -> conform ->
union by name -> Year from the file path -> optional renames.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.paths import DIR_YEAR, NAME_YEAR
from tallystar.functions.strings import decode_map, leading_int, replace_chain, safe_int, strict_int, strip_ws
from tallystar.operators.clean import dedup_first, harmonise_values, trim_columns
from tallystar.operators.star import conform, decode, resolve_duplicates, union_all, unique_rows
from tallystar.plans.model import (
    AGE_LABEL_CHAIN,
    CODE_COLS,
    FACT_COLS,
    HAPPINESS_COLS,
    HAPPINESS_LAYOUTS,
    RAW_FIELDS,
    SECTION_NAMES,
    CodeBook,
    reference_layout,
)
from tallystar.sources.readers import list_inputs, read_csv_by_name, read_sections


# ----------------------------------------------------------------- code lists
def code_lists(sections: DataFrame, book: CodeBook) -> dict[str, DataFrame]:
    """Five dimensions from the sectioned code list ``(section, Key, Title)``,
    sections in the order gender, age, marital, country, period. Keys are
    stripped (D13); English labels are looked up by code, not by row order
    (P5)."""
    sec = {name: sections.where(F.col("section") == i).select(strip_ws("Key").alias("Key"), "Title")
           for i, name in enumerate(SECTION_NAMES)}
    return {
        "gender": sec["gender"].select(F.col("Key").alias("GeslachtCode"), F.col("Title").alias("Geslacht"),
                                       decode_map("Key", book.gender_en).alias("Gender")),
        "age": sec["age"].select(F.col("Key").alias("LeeftijdCode"),
                                 replace_chain("Title", AGE_LABEL_CHAIN).alias("Age")),
        "marital": sec["marital"].select(F.col("Key").alias("BurgerlijkeStaatCode"),
                                         F.col("Title").alias("BurgerlijkeStaatNL"),
                                         decode_map("Key", book.marital_en).alias("MaritalStatus")),
        "country": sec["country"].select(F.col("Key").alias("LandCode"), F.col("Title").alias("Land")),
        "period": sec["period"].select(F.col("Key").alias("PeriodeCode"), F.col("Title").alias("Year")),
    }


def read_code_lists(spark: SparkSession, path: str, book: CodeBook) -> dict[str, DataFrame]:
    return code_lists(read_sections(spark, path, count=len(SECTION_NAMES)), book)


# ----------------------------------------------------------------------- fact
FILE = "file"


def flag_records(raw: DataFrame, book: CodeBook) -> DataFrame:
    """Trimmed records with ``reject``: the first cleaning rule that drops the
    record (F1 measure, F2 age code, F3 totals), NULL where none does. A NULL
    code passes F3, as in the reference (D14)."""
    r = trim_columns(raw.select(*RAW_FIELDS, *([FILE] if FILE in raw.columns else [])), CODE_COLS)
    age = strict_int("LeeftijdOp31December")
    measure = F.col("Immigratie_1")
    reject = (F.when(measure.isNull(), "measure_missing").when(measure <= 0, "measure_not_positive")
              .when(age.isNull(), "age_code_unusable").when(age >= book.age_band_limit, "age_band"))
    for c, code in book.totals.items():
        reject = reject.when(F.col(c).eqNullSafe(F.lit(code)), f"total_{c}")
    return r.withColumn("reject", reject)


def clean_records(raw: DataFrame, book: CodeBook) -> DataFrame:
    """The records that no cleaning rule drops."""
    return flag_records(raw, book).where(F.col("reject").isNull()).drop("reject")


def unique_records(clean: DataFrame, book: CodeBook) -> DataFrame:
    """A4 on the record ID."""
    return dedup_first(clean, list(book.dedup_key), [c for c in RAW_FIELDS if c not in book.dedup_key])


def _translated(translation: DataFrame) -> DataFrame:
    return translation.select(strip_ws("Land_Dutch").alias("Land_Dutch"), strip_ws("Country").alias("Country"),
                              strip_ws("SingleCountry").alias("SingleCountry"))


def decode_records(records: DataFrame, dims: Mapping[str, DataFrame], translation: DataFrame,
                   how: str = "inner") -> DataFrame:
    """J1 (five code lists) and J2 (Land -> Country via the translation
    table, joined on a column the country join brought in). A code list or
    translation with conflicting rows for one key is an error (D2)."""
    f = decode(records, dims["gender"], "Geslacht", "GeslachtCode", ["Gender"], how)
    f = decode(f, dims["age"], "LeeftijdOp31December", "LeeftijdCode", ["Age"], how)
    f = decode(f, dims["marital"], "BurgerlijkeStaat", "BurgerlijkeStaatCode", ["MaritalStatus"], how)
    f = decode(f, dims["country"].withColumn("Land", strip_ws("Land")), "Geboorteland", "LandCode", ["Land"], how)
    f = decode(f, dims["period"].withColumnRenamed("Year", "PeriodLabel"), "Perioden", "PeriodeCode",
               ["PeriodLabel"], how)
    return decode(f, _translated(translation), "Land", "Land_Dutch", ["Country", "SingleCountry"], how)


DECODES = [("gender", "Geslacht", "GeslachtCode"), ("age", "LeeftijdOp31December", "LeeftijdCode"),
           ("marital", "BurgerlijkeStaat", "BurgerlijkeStaatCode"), ("country", "Geboorteland", "LandCode"),
           ("period", "Perioden", "PeriodeCode")]


FACT_STEP = "fact"
RECORD = "record"


def flagged_build(raw: DataFrame, dims: Mapping[str, DataFrame], translation: DataFrame, book: CodeBook,
                  clustered: bool = False) -> DataFrame:
    """M5, F2 and D17 as one plan: the fact's columns, ``step``, ``copies`` and ``record``.

    ``step`` is ``fact`` for the fact's rows, else what drops the row: a
    cleaning rule, or the first decode that misses. Records are made unique by
    ID within the rule that drops them (none, for the fact's), in one shuffle;
    ``copies`` says how many there were. ``record`` holds the trimmed input
    fields of dropped rows. The decodes are left joins, so one pass gives the
    fact, the rejects and all counts.

    Where ``raw`` has a column ``file``, so has the build, with ``files``: how
    many records of the ID each file holds (at most one entry a file), for
    ``file_counts``. They are counted by ID and file first, so a second shuffle
    carries one row of each.

    ``clustered``, for a write by ``step`` and ``Year``: the unique records are rebalanced
    by rule and period, before labels and ``record`` widen them, so each task writes few
    folders and the write needs no shuffle of its own."""
    # the ID first: sorts compare its first bytes, which nearly always differ
    keys, fields = [*book.dedup_key, "reject"], [c for c in RAW_FIELDS if c not in book.dedup_key]
    flagged = flag_records(raw, book)
    by_file = FILE in flagged.columns
    if by_file:
        per_file = dedup_first(flagged, [*keys, FILE], fields, copies="n")
        unique = dedup_first(per_file, keys, [*fields, FILE], also=[
            F.sum("n").alias("copies"), F.collect_list(F.struct(FILE, "n")).alias("files")])
    else:
        unique = dedup_first(flagged, keys, fields, copies="copies")
    if clustered:
        unique = unique.hint("rebalance", F.col("reject"), F.col("Perioden"))
    marked = {d: dims[d].withColumn(f"has_{d}", F.lit(True)) for d, _, _ in DECODES}
    f = decode(unique, marked["gender"], "Geslacht", "GeslachtCode", ["Gender", "has_gender"], "left")
    f = decode(f, marked["age"], "LeeftijdOp31December", "LeeftijdCode", ["Age", "has_age"], "left")
    f = decode(f, marked["marital"], "BurgerlijkeStaat", "BurgerlijkeStaatCode", ["MaritalStatus", "has_marital"], "left")
    f = decode(f, marked["country"].withColumn("Land", strip_ws("Land")), "Geboorteland", "LandCode", ["Land", "has_country"], "left")
    f = decode(f, marked["period"].withColumnRenamed("Year", "PeriodLabel"), "Perioden", "PeriodeCode",
               ["PeriodLabel", "has_period"], "left")
    f = decode(f, _translated(translation).withColumn("has_translation", F.lit(True)), "Land", "Land_Dutch",
               ["Country", "SingleCountry", "has_translation"], "left")
    step = F.col("reject")
    for d in [*[d for d, _, _ in DECODES], "translation"]:
        step = F.coalesce(step, F.when(F.col(f"has_{d}").isNull(), f"decode_{d}"))
    f = f.withColumn("step", F.coalesce(step, F.lit(FACT_STEP)))
    return f.select(*_fact_columns(), "copies", F.when(F.col("step") != FACT_STEP, F.struct(*RAW_FIELDS)).alias(RECORD),
                    *([FILE, "files"] if by_file else []), "step")


def reject_counts(flagged: DataFrame) -> DataFrame:
    """``(step, rows)`` of a flagged build (planned or read back): ``rows_in``, the records
    each cleaning rule drops, ``duplicates``, the records each decode drops,
    and ``rows_out``. The steps between sum to ``rows_in - rows_out``."""
    per_step = flagged.groupBy("step").agg(F.sum("copies").alias("all"), F.count(F.lit(1)).alias("kept"))
    by_rule = ~(F.col("step").startswith("decode_") | (F.col("step") == FACT_STEP))
    name = F.when(F.col("step") == FACT_STEP, "rows_out").otherwise(F.col("step"))
    lines = F.array(*[F.struct(n.alias("step"), v.cast("long").alias("n")) for n, v in (
        (F.lit("rows_in"), F.col("all")), (name, F.when(by_rule, F.col("all")).otherwise(F.col("kept"))),
        (F.lit("duplicates"), F.when(by_rule, 0).otherwise(F.col("all") - F.col("kept"))))])
    return (per_step.select(F.explode(lines).alias("x")).groupBy("x.step")
            .agg(F.sum("x.n").cast("long").alias("rows")).where(F.col("rows") != 0))


def file_counts(flagged: DataFrame, files: DataFrame) -> DataFrame:
    """Q3 for the fact: ``(file, rows_in, rejected, duplicates, rows_out, status)`` of a flagged
    build with files, one row for each ``file`` of ``files`` and of the build.

    A record that several files hold counts as out of the file whose row is kept
    (ties: the first path), and as a duplicate elsewhere. A file without a
    record, or whose rows do not add up, has status ``failed``."""
    each = flagged.select("step", F.col(FILE).alias("kept_from"), F.inline("files"))
    kept = (F.col(FILE) == F.col("kept_from")).cast("long")
    by_rule = ~(F.col("step").startswith("decode_") | (F.col("step") == FACT_STEP))
    out = F.when(F.col("step") == FACT_STEP, kept).otherwise(0)
    rejected = F.when(by_rule, F.col("n")).when(F.col("step") != FACT_STEP, kept).otherwise(0)
    counted = each.groupBy(FILE).agg(F.sum("n").alias("rows_in"), F.sum(rejected).alias("rejected"),
                                     F.sum(F.when(by_rule, 0).otherwise(F.col("n") - kept)).alias("duplicates"),
                                     F.sum(out).alias("rows_out"))
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("rows_in", "rejected", "duplicates", "rows_out")]
    adds_up = (F.col("rows_in") > 0) & (F.col("rows_in") == F.col("rejected") + F.col("duplicates") + F.col("rows_out"))
    return (files.select(FILE).distinct().join(counted, FILE, "full_outer").select(FILE, *numbers)
            .withColumn("status", F.when(adds_up, "passed").otherwise("failed")))


def reject_report(raw: DataFrame, dims: Mapping[str, DataFrame], translation: DataFrame, book: CodeBook) -> DataFrame:
    """D17 for the whole build: the ``reject_counts`` of its one plan."""
    return reject_counts(flagged_build(raw, dims, translation, book))


def decode_coverage(records: DataFrame, dims: Mapping[str, DataFrame], translation: DataFrame) -> DataFrame:
    """Codes the inner decode joins would drop, ``(dimension, code,
    rows)``; the ``translation`` rows are country names without translation.

    One scan: every code column is unpivoted and counted per (dimension,
    code) with map-side combining, so the shuffle carries at most one row per
    distinct code per task. The counts then meet the code lists and the
    translation by left joins (a null test after the join, so neither join is
    pushed below the count)."""
    codes = records.select(F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(c).alias("code")) for d, c, _ in DECODES])).alias("x")) \
        .select("x.*").groupBy("dimension", "code").agg(F.count(F.lit(1)).alias("rows"))
    known = union_all([dims[d].select(F.lit(d).alias("_dim"), F.col(k).alias("_code"), *(
        [strip_ws("Land").alias("Land")] if d == "country" else [F.lit(None).cast("string").alias("Land")]))
        for d, _, k in DECODES])
    known = unique_rows(known, ["_dim", "_code"])
    lands = unique_rows(_translated(translation).select("Land_Dutch", F.lit(True).alias("_translated")), ["Land_Dutch"])
    j = (codes.join(known, (F.col("dimension") == F.col("_dim")) & (F.col("code") == F.col("_code")), "left")
         .join(lands, F.col("Land") == F.col("Land_Dutch"), "left"))
    unknown, untranslated = F.col("_dim").isNull(), (F.col("dimension") == "country") & F.col("_translated").isNull()
    return (j.where(unknown | untranslated)
            .select(F.when(unknown, F.col("dimension")).otherwise(F.lit("translation")).alias("dimension"),
                    F.when(unknown, F.col("code")).otherwise(F.col("Land")).alias("code"), "rows")
            .groupBy("dimension", "code").agg(F.sum("rows").alias("rows")))


def build_fact(raw: DataFrame, dims: Mapping[str, DataFrame], translation: DataFrame,
               book: CodeBook) -> DataFrame:
    """M5: raw records (the reference's seven fields) to the fact table."""
    return decode_records(unique_records(clean_records(raw, book), book), dims, translation).select(*_fact_columns())


def _fact_columns() -> list[Column]:
    made = {"Age": leading_int("Age"), "ImmigrationVolume": F.col("Immigratie_1").cast("int"), "Year": safe_int("PeriodLabel")}
    return [made.get(c, F.col(c)).alias(c) for c in FACT_COLS]


# ------------------------------------------------------------------ dimension
def _path_year(path: str) -> int | None:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    m = re.search(NAME_YEAR, name) or re.search(DIR_YEAR, path)
    return int(m.group(1)) if m else None


def files_by_layout(paths: Sequence[str], layout_for_year: Callable[[int], str]) -> dict[str, list[str]]:
    """Group input files by header layout, chosen from the year in the path
    as the reference does. Works on the file listing only."""
    out: dict[str, list[str]] = {}
    for p in paths:
        y = _path_year(p)
        if y is None:
            raise ValueError(f"no year in input path {p}")
        out.setdefault(layout_for_year(y), []).append(p)
    return out


def read_yearly_layouts(spark: SparkSession, files: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """The needed columns of each layout by name, with ``Year`` from the path."""
    return {lay: read_csv_by_name(spark, list(paths), HAPPINESS_LAYOUTS[lay][0]) for lay, paths in files.items()}


def conform_yearly(parts: Mapping[str, DataFrame]) -> DataFrame:
    """P7 + U1: rename each layout to the canonical columns and union."""
    return union_all([conform(df, {**HAPPINESS_LAYOUTS[lay][1], "Year": "Year"}, HAPPINESS_COLS)
                      for lay, df in sorted(parts.items())])


def build_dimension(spark: SparkSession, folder: str,
                    layout_for_year: Callable[[int], str] = reference_layout,
                    renames: Mapping[str, str] | None = None, on_duplicate: str = "fail") -> DataFrame:
    """M6: every yearly file in ``folder`` to the happiness dimension
    (``dimension_of``)."""
    files = list_inputs_deep(spark, folder)
    if not files:
        raise ValueError(f"no input files in {folder}")
    return dimension_of(spark, files, layout_for_year, renames, on_duplicate)


def dimension_of(spark: SparkSession, files: Sequence[str],
                 layout_for_year: Callable[[int], str] = reference_layout,
                 renames: Mapping[str, str] | None = None, on_duplicate: str = "fail") -> DataFrame:
    """The yearly ``files`` as rows of the dimension.

    ``renames`` harmonises country names (X7). A country that then has several
    rows in a year is an error, or is resolved by ``on_duplicate``: ``'mean'``
    of the scores, or the ``'first'`` row (D2)."""
    dim = conform_yearly(read_yearly_layouts(spark, files_by_layout(files, layout_for_year)))
    if renames:
        dim = harmonise_values(dim, "Country", renames)
    return one_per_country(dim, on_duplicate)


def one_per_country(dim: DataFrame, on_duplicate: str = "fail") -> DataFrame:
    """D2 on (Country, Year)."""
    keys = ["Country", "Year"]
    if on_duplicate == "mean":
        scores = [c for c in HAPPINESS_COLS if c not in keys]
        return resolve_duplicates(dim, keys, scores).select(*HAPPINESS_COLS)
    return unique_rows(dim, keys, on_duplicate).select(*HAPPINESS_COLS)


def list_inputs_deep(spark: SparkSession, folder: str) -> list[str]:
    """Data files in ``folder`` and under its ``Year=...`` folders, whatever
    their extension (hidden and marker files skipped)."""
    return list_inputs(spark, folder)
