"""One plan for fact and rejects, checks on the write, and versions that appear whole."""
import json
import os
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallystar import api
from tallystar.operators.clean import key_slice
from tallystar.operators.star import resolve_duplicates, unique_rows
from tallystar.plans.checks import type_breaches
from tallystar.plans.model import FACT_COLS, FACT_CONTRACT, LAYOUT_2018_COLUMNS, RAW_SCHEMA, REFERENCE_BOOK
from tallystar.plans.star_build import build_dimension, build_fact, flagged_build, reject_counts, reject_report
from tallystar.sources import versions
from tallystar.sources.readers import csv_headers, read_keyed_json
from tallystar.sources.sinks import write_by_year
from tallystar.streaming.refresh import start_refresh
from test_api import _inputs
from test_lossless import GOOD, dims, happiness, raw, run, translation


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan_of(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan


# --------------------------------------------------------------- one pass
def test_fact_and_rejects_come_from_one_scan(spark, local_tmp):
    bad = [GOOD[:5] + (None,), GOOD[:5] + (0,), ("3000", "x", *GOOD[2:]), ("T001038", *GOOD[1:]), (None, *GOOD[1:]),
           (*GOOD[:3], "L9", *GOOD[4:]), (*GOOD[:3], "L2", *GOOD[4:])]
    records = [dict(zip(RAW_SCHEMA.fieldNames(), r)) for r in raw(spark, GOOD, *bad, GOOD).union(raw(spark, GOOD, GOOD[:5] + (None,))).collect()]
    open(f"{local_tmp}/i_2018.json", "w").write(json.dumps({"value": {str(i): r for i, r in enumerate(records)}}) + "\n")
    source = read_keyed_json(spark, local_tmp, RAW_SCHEMA).drop("key")
    built = flagged_build(source, dims(spark), translation(spark), REFERENCE_BOOK)
    fact = built.where(F.col("step") == "fact").select(*FACT_COLS)
    assert rows(fact) == rows(build_fact(source, dims(spark), translation(spark), REFERENCE_BOOK)) and fact.count() == 2
    assert plan_of(built).count("FileScan json") == 1
    report = reject_report(source, dims(spark), translation(spark), REFERENCE_BOOK)
    assert plan_of(report).count("FileScan json") == 1
    got = {r["step"]: r["rows"] for r in reject_counts(built).collect()}
    assert got == {r["step"]: r["rows"] for r in report.collect()}
    assert got == {"rows_in": 11, "measure_missing": 2, "measure_not_positive": 1, "age_code_unusable": 1, "total_Geslacht": 1,
                   "decode_gender": 1, "decode_country": 1, "decode_translation": 1, "duplicates": 1, "rows_out": 2}
    dropped = {r["step"]: r["record"]["Geboorteland"] for r in built.where("step like 'decode%'").collect()}
    assert dropped["decode_country"] == "L9" and built.where("step = 'fact' and record is not null").count() == 0



def test_the_dedup_of_the_build_sorts_by_id_first(spark):
    built = flagged_build(raw(spark, GOOD), dims(spark), translation(spark), REFERENCE_BOOK)
    plan = built._jdf.queryExecution().sparkPlan().toString()
    keys = re.findall(r"SortAggregate\(key=\[([^\]]*)\]", plan)
    keys = [k for k in keys if "reject" in k]
    assert keys and all(re.match(r"ID#\d+, reject#\d+$", k) for k in keys)


def test_a_clustered_build_shuffles_before_it_is_decoded(spark, tmp):
    source = raw(spark, GOOD, GOOD, ("T001038", *GOOD[1:]), (*GOOD[:3], "L9", *GOOD[4:]), GOOD[:5] + (None,))
    plain = flagged_build(source, dims(spark), translation(spark), REFERENCE_BOOK)
    built = flagged_build(source, dims(spark), translation(spark), REFERENCE_BOOK, clustered=True)
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RebalancePartitions") == 1 and "RebalancePartitions" not in plain._jdf.queryExecution().optimizedPlan().toString()
    depth = {n: [x.index(n) for x in plan.splitlines() if n in x] for n in ("RebalancePartitions", "Join LeftOuter")}
    assert len(depth["Join LeftOuter"]) == 6 and depth["RebalancePartitions"][0] > max(depth["Join LeftOuter"])
    write_by_year(built, tmp, above=["step"], spread=False)
    assert rows(spark.read.parquet(tmp).select(*plain.columns)) == rows(plain)


def test_the_written_build_crosses_no_second_shuffle(spark, monkeypatch):
    from tallystar.plans import landing
    written = {}

    def keep(df, path, **how):
        written[path.rsplit("/", 1)[-1].split("-")[0]] = df, how
        write_by_year(df, path, **how)
    monkeypatch.setattr(landing, "write_by_year", keep)
    monkeypatch.setattr(landing, "_LANDED", {})
    landing.ensure_star(spark, "/root/testdata/sf0.001")
    build, how = written["build"]
    assert how["spread"] is False and build._jdf.queryExecution().optimizedPlan().toString().count("RebalancePartitions") == 1


def test_catalog_reads_one_build(spark):
    from tallystar.plans import catalog, landing
    sf = "/root/testdata/sf0.001"
    land = landing.ensure_star(spark, sf)
    fact = landing.star_tables(spark, sf)[0]
    for df in (fact, catalog.dq_rejects(spark, sf)):
        files = df.inputFiles()
        assert files and all(Path(land.build).name in f for f in files)
    assert rows(fact) == rows(catalog.fact_build(spark, sf))


# ------------------------------------------------------------------- rules
def test_a_value_outside_its_domain_stops_the_run(spark, local_tmp, tmp):
    _inputs(local_tmp)
    good = run(spark, local_tmp, tmp, fail_on_error=True)
    assert set(good.rule_checks.values()) == {0} and len(good.rule_checks) >= 10
    text = open(f"{local_tmp}/translation.csv").read()
    open(f"{local_tmp}/translation.csv", "w").write(text.replace("Land1,Morocco,Y", "Land1,Morocco,X"))
    with pytest.raises(AssertionError, match="'single_country_y_n': 2"):
        run(spark, local_tmp, tmp, fail_on_error=True)
    assert rows(versions.read_table(spark, tmp, "fact")) == rows(good.fact(spark))
    loose = run(spark, local_tmp, tmp)
    assert loose.rule_checks["single_country_y_n"] == 2 and loose.version == good.version + 1
    open(f"{local_tmp}/happy/2018.csv", "a").write("3,Chad,11.5,1,1,1,1,1,1\n")
    with pytest.raises(AssertionError, match="'Happiness_Score_in_range': 1"):
        run(spark, local_tmp, tmp, fail_on_error=True)


def test_types_are_checked_without_a_job(spark):
    df = spark.createDataFrame([("a", 1.5)], "ID string, Age double")
    found = type_breaches(df, FACT_CONTRACT)
    assert found["Age"] == "double" and found["Year"] == "missing" and "ID" not in found


def test_result_counts_rejects(spark, local_tmp, tmp):
    _inputs(local_tmp)
    res = run(spark, local_tmp, tmp)
    assert res.rejects == {"rows_in": 8, "measure_missing": 1, "age_band": 1, "total_Geslacht": 1, "rows_out": 5}
    dropped = {r["step"]: r["record"]["ID"] for r in res.rejected(spark).collect()}
    assert dropped == {"measure_missing": "a7", "age_band": "a5", "total_Geslacht": "a4"}


# ---------------------------------------------------------------- versions
@pytest.mark.parametrize("table", ["happiness", "build"])
def test_a_write_that_fails_leaves_the_pair(spark, local_tmp, tmp, monkeypatch, table):
    _inputs(local_tmp)
    good = run(spark, local_tmp, tmp)
    before = rows(good.fact(spark)), rows(good.dimension(spark))
    write = api.write_by_year

    def failing(df, path, **how):
        if f"/{table}/" in path:
            df = df.withColumn("Year", F.raise_error(F.lit("disk full")).cast("int"))
        write(df, path, **how)
    monkeypatch.setattr(api, "write_by_year", failing)
    open(f"{local_tmp}/happy/2018.csv", "a").write("3,Chad,4.5,1,1,1,1,1,1\n")
    for refresh in (True, False):
        with pytest.raises(Exception, match="disk full"):
            run(spark, local_tmp, tmp, refresh=refresh)
        assert (rows(versions.read_table(spark, tmp, "fact")), rows(versions.read_table(spark, tmp, "dimension"))) == before
    monkeypatch.setattr(api, "write_by_year", write)
    assert run(spark, local_tmp, tmp).dimension(spark).count() == len(before[1]) + 1


def test_refresh_writes_only_its_years(spark, local_tmp, tmp):
    _inputs(local_tmp)
    first = run(spark, local_tmp, tmp)
    later = f"{local_tmp}/later"
    os.makedirs(later)
    _inputs(later)
    for kind in ("imm", "happy"):
        for f in Path(f"{later}/{kind}").iterdir():
            if "2020" in f.name:
                f.unlink()
    open(f"{later}/happy/2018.csv", "a").write("3,Chad,4.5,1,1,1,1,1,1\n")
    second = run(spark, later, tmp, refresh=True)
    assert second.dimension(spark).count() == first.dimension(spark).count() + 1
    assert rows(second.fact(spark)) == rows(first.fact(spark)) and first.dimension(spark).count() == 3
    old, new = versions.manifests(spark, tmp)
    assert dict(new["tables"]["fact"])["2020"] == dict(old["tables"]["fact"])["2020"]
    assert dict(new["tables"]["fact"])["2018"] != dict(old["tables"]["fact"])["2018"]
    assert "PartitionFilters: [isnotnull(Year" in plan_of(second.fact(spark).where("Year = 2018"))
    assert api.top_countries(spark, second, 2018).count() == 2


def test_unfinished_and_rival_manifests(spark, local_tmp, tmp):
    _inputs(local_tmp)
    first = run(spark, local_tmp, tmp)
    open(f"{tmp.removeprefix('file:')}/_manifests/00000002.json", "w").write('{"tables": {"fa')
    assert versions.current(spark, tmp)["number"] == 1 and versions.read_table(spark, tmp, "fact").count() == 5
    with pytest.raises(RuntimeError, match="another run"):
        run(spark, local_tmp, tmp, refresh=True)
    assert rows(versions.read_table(spark, tmp, "fact")) == rows(first.fact(spark))
    with pytest.raises(ValueError, match="no such version"):
        versions.read_table(spark, tmp, "fact", 9)


def test_an_empty_fact_has_columns(spark, local_tmp, tmp):
    _inputs(local_tmp)
    for f in Path(f"{local_tmp}/imm").iterdir():
        f.write_text('{"value": {}}\n')
    res = run(spark, local_tmp, tmp)
    assert res.fact(spark).columns == FACT_COLS and res.fact(spark).count() == 0 and res.fact_checks["rows"] == 0
    assert res.dimension(spark).count() == 3


# ------------------------------------------------------------------- inputs
def test_first_duplicate_is_one_with_a_value(spark):
    df = spark.createDataFrame([("NL", 2018, None), ("NL", 2018, 7.5), ("NL", 2018, 8.0)], "Country string, Year int, Score double")
    assert [tuple(r) for r in unique_rows(df, ["Country", "Year"], "first").collect()] == [("NL", 2018, 7.5)]
    assert resolve_duplicates(df, ["Country", "Year"], ["Score"], "first").first()["Score"] == 7.5


def test_quoted_line_ends_and_repeated_header_lines(spark, local_tmp, tmp):
    _inputs(local_tmp)
    open(f"{local_tmp}/happy/2018.csv", "a").write('3,"Trinidad\nand ""Tobago""",6.1,1,1,1,1,1,1\n')
    res = run(spark, local_tmp, tmp, fail_on_error=True)
    assert {r["Year"]: (r["rows_in"], r["rows_out"]) for r in res.dim_reconcile} == {2018: (3, 3), 2020: (1, 1)}
    assert 'Trinidad\nand "Tobago"' in {r["Country"] for r in res.dimension(spark).collect()}
    open(f"{local_tmp}/happy/2018.csv", "a").write(",".join(LAYOUT_2018_COLUMNS) + "\n")
    with pytest.raises(Exception, match="not a number"):
        run(spark, local_tmp, tmp)


def test_headers_of_all_files_in_one_job(spark, local_tmp):
    for k in range(6):
        happiness(local_tmp, f"a file {2010 + k}.csv", ["x", "y"] if k % 2 else ["y", "x"], [[1, 2]])
    open(f"{local_tmp}/empty_2020.csv", "w").close()
    files = [f"{local_tmp}/{n}" for n in sorted(os.listdir(local_tmp))]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "one job")
    got = csv_headers(spark, files)
    jobs = tracker.getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {h: len(f) for h, f in got.items()} == {("x", "y"): 3, ("y", "x"): 3, (): 1}
    assert len(jobs) <= 2  # the two stages of one query
    with pytest.raises(ValueError, match="lacks"):
        build_dimension(spark, local_tmp)


def test_stream_refuses_a_repeated_country(spark, local_tmp, tmp):
    landing = f"{local_tmp}/landing"
    os.makedirs(landing)
    happiness(landing, "2018.csv", LAYOUT_2018_COLUMNS, [[1, "Finland", 7.6, 1, 1, 1, 1, 1, 1], [2, "Finland", 7.5, 1, 1, 1, 1, 1, 1]])
    with pytest.raises(Exception, match="conflicting rows"):
        start_refresh(spark, landing, f"{tmp}/out", f"{tmp}/c1").awaitTermination()
    start_refresh(spark, landing, f"{tmp}/out", f"{tmp}/c2", on_duplicate="mean").awaitTermination()
    assert [r["Happiness_Score"] for r in spark.read.parquet(f"{tmp}/out").collect()] == [7.55]


def test_key_slice_signs_and_zeros(spark):
    keys = ["0", "00", "-1", "-0", "+2", "", "-", "+", "1-", "--1", "1 2", "٣", "0" * 40, "9" * 18, "9" * 19, " 1\t", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r["k"] for r in key_slice(df, "k", [-1], 4).collect()]
    assert got == ["0", "00", "-1", "-0", "+2", "0" * 40, " 1\t"]
    assert [r["k"] for r in key_slice(df, "k", [10 ** 18 - 1], 1).collect()] == ["9" * 18]
