"""Faults that would lose or double rows must be loud, counted or absent."""
import gzip
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallystar import api
from tallystar.functions.strings import leading_int, replace_chain, strict_int, strip_ws
from tallystar.operators import profile, quality, star
from tallystar.operators.clean import code_below, dedup_first, key_slice
from tallystar.plans.model import COUNTRY_RENAMES, LAYOUT_2018_COLUMNS, RAW_SCHEMA, REFERENCE_BOOK
from tallystar.plans.star_build import build_dimension, build_fact, code_lists, decode_coverage, reject_report
from tallystar.sources.readers import read_csv_exact, read_keyed_json, read_sections
from tallystar.sources.sinks import write_by_year, write_csv
from test_api import _inputs

SECTIONS = [[("3000", "Mannen"), ("4000", "Vrouwen")], [("10010", "0 jaar"), ("19905", "105 jaar of ouder")],
            [("1010", "Ongehuwd")], [("L1", "Land1"), ("L2", "Land2")], [("2018JJ00", "2018")]]
GOOD = ("3000", "10010", "1010 ", "L1", "2018JJ00", 5)


def dims(spark, sections=SECTIONS):
    rows = [(i, k, t) for i, sec in enumerate(sections) for k, t in sec]
    return code_lists(spark.createDataFrame(rows, "section int, Key string, Title string"), REFERENCE_BOOK)


def translation(spark, rows=(("Land1", "Morocco", "Y"),)):
    return spark.createDataFrame(list(rows), "Land_Dutch string, Country string, SingleCountry string")


def raw(spark, *rows):
    return spark.createDataFrame([(f"id{i}", *r) if len(r) == 6 else r for i, r in enumerate(rows)], RAW_SCHEMA)


def run(spark, root, out, **more):
    return api.run_etl(spark, f"{root}/imm", f"{root}/metadata.csv", f"{root}/translation.csv", f"{root}/happy", out, **more)


# ------------------------------------------------------------------ the star
def test_failed_check_leaves_the_earlier_star(spark, local_tmp, tmp):
    _inputs(local_tmp)
    good = run(spark, local_tmp, tmp, fail_on_error=True)
    before = sorted(map(tuple, spark.read.parquet(good.fact_path).collect()))
    text = open(f"{local_tmp}/translation.csv").read()
    open(f"{local_tmp}/translation.csv", "w").write(text.replace("Land1,Morocco,Y", "Land1,Morocco,"))
    with pytest.raises(AssertionError):
        run(spark, local_tmp, tmp, fail_on_error=True)
    assert sorted(map(tuple, spark.read.parquet(good.fact_path).collect())) == before


def test_conflicting_code_or_translation_is_an_error(spark):
    records = raw(spark, GOOD)
    twice = translation(spark, [("Land1", "Morocco", "Y"), ("Land1", "Maroc", "Y")])
    with pytest.raises(Exception, match="conflicting rows"):
        build_fact(records, dims(spark), twice, REFERENCE_BOOK).collect()
    same = translation(spark, [("Land1", "Morocco", "Y")] * 2)
    assert build_fact(records, dims(spark), same, REFERENCE_BOOK).count() == 1
    with pytest.raises(Exception, match="conflicting rows"):
        bad = [SECTIONS[0] + [("3000", "Men")], *SECTIONS[1:]]
        # the label is looked up by code, so only a differing title conflicts
        star.unique_rows(spark.createDataFrame(bad[0], "Key string, Title string"), ["Key"]).collect()


def test_dedup_prefers_a_code_to_null(spark):
    records = raw(spark, ("a", None, *GOOD[1:]), ("a", *GOOD))
    assert dedup_first(records, ["ID"]).first()["Geslacht"] == "3000"
    assert [r["ID"] for r in build_fact(records, dims(spark), translation(spark), REFERENCE_BOOK).collect()] == ["a"]


def test_age_code_is_read_whole(spark):
    df = spark.createDataFrame([("10010abc",), ("12.9",), ("1e5",), ("-5",), ("0000010010",), (" 7 ",), ("2000000000",), (None,)], "c string")
    kept = [r["c"] for r in df.where(code_below("c", 19906)).collect()]
    assert kept == ["-5", "0000010010", " 7 "]


def test_every_dropped_row_is_counted(spark):
    rows = [GOOD, GOOD[:5] + (None,), GOOD[:5] + (0,), ("3000", "x", *GOOD[2:]), ("3000", "22000", *GOOD[2:]), ("T001038", *GOOD[1:]),
            (None, *GOOD[1:]), ("3000", "10020", *GOOD[2:]), (*GOOD[:3], "L9", *GOOD[4:]), (*GOOD[:3], "L2", *GOOD[4:])]
    records = raw(spark, *rows).union(raw(spark, GOOD))  # id0 twice
    got = {r["step"]: r["rows"] for r in reject_report(records, dims(spark), translation(spark), REFERENCE_BOOK).collect()}
    assert got == {"rows_in": 11, "measure_missing": 1, "measure_not_positive": 1, "age_code_unusable": 1, "age_band": 1,
                   "total_Geslacht": 1, "duplicates": 1, "decode_gender": 1, "decode_age": 1, "decode_country": 1,
                   "decode_translation": 1, "rows_out": 1}
    assert got.pop("rows_in") == sum(got.values())
    assert got["rows_out"] == build_fact(records, dims(spark), translation(spark), REFERENCE_BOOK).count()


def test_coverage_is_one_scan(spark, tmp):
    raw(spark, GOOD, (None, *GOOD[1:]), (*GOOD[:3], "L2", *GOOD[4:])).write.parquet(tmp)
    records = spark.read.parquet(tmp)
    cover = decode_coverage(records, dims(spark), translation(spark))
    assert sorted(map(tuple, cover.collect()), key=str) == [("gender", None, 1), ("marital", "1010 ", 3), ("translation", "Land2", 1)]
    plan = cover._jdf.queryExecution().executedPlan().toString()
    initial = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert initial.count("FileScan parquet") == 1


# -------------------------------------------------------------------- inputs
@pytest.mark.parametrize("text", ['{"value": {"1": {"ID": "a", "Immigratie_1"', '{"value": {"1": {"ID": "a", "Immigratie_1": 5.0}}}',
                                  '{"value": {"1": {"ID": "a", "Immigratie_1": "5"}}}', '{"value": {"1": {"ID": "a", "Immigratie_1": 3000000000}}}'])
def test_broken_json_is_an_error(spark, local_tmp, text):
    open(f"{local_tmp}/x_2018.json", "w").write(text + "\n")
    with pytest.raises(Exception):
        read_keyed_json(spark, local_tmp, RAW_SCHEMA).collect()


def test_compressed_and_named_years(spark, local_tmp):
    doc = json.dumps({"value": {"1": {"ID": "a", "Immigratie_1": 1}}}) + "\n"
    with gzip.open(f"{local_tmp}/immigration_age_status_birthplace_2018.json.gz", "wt") as f:
        f.write(doc)
    open(f"{local_tmp}/immigration_age_status_birthplace_2019.json", "w").write(doc)
    got = read_keyed_json(spark, local_tmp, RAW_SCHEMA, keep_year=True, spread=True).collect()
    assert sorted(r["Year"] for r in got) == [2018, 2019]
    os.makedirs(f"{local_tmp}/none")
    open(f"{local_tmp}/none/records.json", "w").write(doc)
    with pytest.raises(Exception, match="no year"):
        read_keyed_json(spark, f"{local_tmp}/none", RAW_SCHEMA, keep_year=True).collect()


def happiness(folder, name, header, rows):
    opener = gzip.open if name.endswith("gz") else open
    with opener(f"{folder}/{name}", "wt") as f:
        f.write("\n".join([",".join(header), *(",".join(map(str, r)) for r in rows)]) + "\n")


def test_yearly_files_by_name(spark, local_tmp):
    old = LAYOUT_2018_COLUMNS
    happiness(local_tmp, "2018.csv", old, [[1, "Finland", 7.6, 1, 1, 1, 1, 1, "N/A"]])
    shuffled = [*old[::-1], "whisker", "Dystopia"]
    happiness(local_tmp, "2019.csv.gz", shuffled, [["", 1, 1, 1, 1, 1, 7.7, "Finland", 1, "x", 9]])
    new = ["Country name", "Ladder score", "upperwhisker", "Explained by: Log GDP per capita", "Explained by: Healthy life expectancy",
           "Explained by: Freedom to make life choices", "Explained by: Generosity", "Explained by: Perceptions of corruption", "Dystopia + residual"]
    happiness(local_tmp, "2020.csv", new, [["Finland", 7.8, 8, 1, 1, 1, 1, 0.5, 2]])
    got = sorted((r["Year"], r["Country"], r["Happiness_Score"], r["Corruption_Score"]) for r in build_dimension(spark, local_tmp).collect())
    assert got == [(2018, "Finland", 7.6, None), (2019, "Finland", 7.7, None), (2020, "Finland", 7.8, 0.5)]
    happiness(local_tmp, "2017.csv", old[:-1], [[1, "Finland", 7.6, 1, 1, 1, 1, 1]])
    with pytest.raises(ValueError, match="lacks"):
        build_dimension(spark, local_tmp)


def test_malformed_score_is_an_error(spark, local_tmp):
    happiness(local_tmp, "2018.csv", LAYOUT_2018_COLUMNS, [[1, "Finland", "7.6x", 1, 1, 1, 1, 1, 1]])
    with pytest.raises(Exception, match="not a number"):
        build_dimension(spark, local_tmp).collect()


def test_renames_need_a_resolution(spark, local_tmp):
    happiness(local_tmp, "2018.csv", LAYOUT_2018_COLUMNS, [[1, "Congo (Brazzaville)", 4, 1, 1, 1, 1, 1, 1], [2, "Congo (Kinshasa)", 2, 1, 1, 1, 1, 1, 1],
                                                           [3, "Trinidad & Tobago", 6, 1, 1, 1, 1, 1, 1]])
    with pytest.raises(Exception, match="conflicting rows"):
        build_dimension(spark, local_tmp, renames=COUNTRY_RENAMES).collect()
    got = {r["Country"]: r["Happiness_Score"] for r in build_dimension(spark, local_tmp, renames=COUNTRY_RENAMES, on_duplicate="mean").collect()}
    assert got == {"Congo": 3.0, "Trinidad and Tobago": 6.0}


def test_quoted_section_headers(spark, local_tmp):
    open(f"{local_tmp}/m.csv", "w").write('intro\n"Key";"Title";"Description"\n"1";"a";"x"\n\n"Key";"Title";"Description"\n"2";"b";"y"\n')
    got = sorted((r["section"], r["Key"], r["Title"]) for r in read_sections(spark, f"{local_tmp}/m.csv", count=2).collect())
    assert got == [(0, "1", "a"), (1, "2", "b")]
    for count in (None, 3):
        open(f"{local_tmp}/n.csv", "w").write("nothing here\n" if count is None else open(f"{local_tmp}/m.csv").read())
        with pytest.raises(Exception, match="sections found"):
            read_sections(spark, f"{local_tmp}/n.csv", count=count).collect()


# ------------------------------------------------------------------- refresh
def test_refresh_keeps_other_years(spark, local_tmp, tmp):
    _inputs(local_tmp)
    first = run(spark, local_tmp, tmp)
    later = f"{local_tmp}/later"
    os.makedirs(later)
    _inputs(later)
    for kind in ("imm", "happy"):
        for f in Path(f"{later}/{kind}").iterdir():
            if "2018" in f.name:
                f.unlink()
    run(spark, later, tmp, refresh=True, fail_on_error=True)
    assert sorted(r["Year"] for r in spark.read.parquet(first.fact_path).select("Year").distinct().collect()) == [2018, 2020]
    assert sorted(r["Year"] for r in spark.read.parquet(first.dim_path).select("Year").distinct().collect()) == [2018, 2020]


def test_renamed_country_meets_its_score(spark, local_tmp, tmp):
    _inputs(local_tmp)
    path = f"{local_tmp}/happy/2018.csv"
    open(path, "a").write("3,Trinidad & Tobago,6.1,1,1,1,1,1,1\n")
    text = open(f"{local_tmp}/translation.csv").read()
    open(f"{local_tmp}/translation.csv", "w").write(text.replace("Morocco", "Trinidad and Tobago"))
    res = run(spark, local_tmp, tmp, renames=COUNTRY_RENAMES)
    top = {r["Country"]: r["Happiness_Score"] for r in api.top_countries(spark, res, 2018).collect()}
    assert top["Trinidad and Tobago"] == 6.1
    assert api.score_volume_correlation(spark, res).count() == 2  # years
    assert api.trend(spark, res).columns == ["Age", "y2018", "y2020"]


# ----------------------------------------------------------------- operators
def test_single_nullable_key_and_null_groups(spark):
    r = quality.duplicate_report(spark.createDataFrame([("a",), (None,)], "k string"), ["k"]).first()
    assert (r["rows"], r["distinct_keys"], r["duplicates"]) == (2, 2, 0)
    df = spark.createDataFrame([(2018,), (None,)], "Year int")
    assert all(x["status"] == "passed" for x in quality.reconcile(df, df, "Year").collect())


def test_csv_round_trip_is_exact(spark, tmp):
    rows = [(" Tuvalu ", 1.5), ('a"b', None), ("", 0.0), (None, 2.0), ("x,y\nz", 3.0), ("back\\slash", 4.0)]
    df = spark.createDataFrame(rows, "Country string, Score double")
    write_csv(df, tmp)
    assert sorted(map(tuple, read_csv_exact(spark, tmp, df.schema).collect()), key=str) == sorted(rows, key=str)


def test_sample_by_key_is_a_hash(spark):
    for stride in (1, 2500, 5000, 10_000):
        df = spark.range(0, 4000 * stride, stride).withColumnRenamed("id", "k")
        assert 0.07 < profile.sample_by_key(df, "k", 0.1).count() / 4000 < 0.13
    ten = profile.sample_n(spark.range(1000).withColumnRenamed("id", "k"), "k", 10)
    assert ten.count() == 10 and ten.collect() == ten.collect()


def test_strip_and_casts(spark):
    blanks = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    df = spark.createDataFrame([(blanks + "x y" + blanks, "0000010010", "12345678901234567890123")], "a string, b string, c string")
    r = df.select(strip_ws("a").alias("a"), leading_int("b").alias("b"), strict_int("c").alias("c"),
                  strict_int(F.lit("2000000000")).alias("d"), replace_chain("a", [("x y", "$z"), ("[$]", "S"), "strip"]).alias("e")).first()
    assert tuple(r) == ("x y", 10010, None, 2000000000, "Sz")


def test_key_slice_on_long_text_keys(spark):
    df = spark.createDataFrame([("0" * 30 + "101",), ("101",), ("9" * 45,), ("x101",), (" 104 ",), (None,)], "k string")
    assert [r["k"] for r in key_slice(df, "k", [100]).collect()] == ["0" * 30 + "101", "101", " 104 "]


def test_write_by_year_is_rebalanced(spark, tmp):
    df = spark.range(0, 4000, 1, 16).select(F.col("id").alias("v"), (F.lit(2015) + F.col("id") % 5).cast("int").alias("Year"))
    plan = df.hint("rebalance", F.col("Year"))._jdf.queryExecution().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    write_by_year(df, tmp)
    files = spark.read.parquet(tmp).inputFiles()
    assert len(files) <= 2 * 5 and spark.read.parquet(tmp).count() == 4000


def test_trend_scans_only_its_years(spark, tmp):
    from tallystar.plans import marts
    rows = [(30, "Men", "A", y, 1) for y in (2018, 2019, 2020)]
    write_by_year(spark.createDataFrame(rows, "Age int, Gender string, Country string, Year int, ImmigrationVolume int"), tmp)
    fact = spark.read.parquet(tmp)
    assert marts.partition_years(fact) == [2018, 2019, 2020]
    plan = marts.trend_pivot(fact, [2019])._jdf.queryExecution().toString()
    assert "PartitionFilters: [(Year" in plan or "PartitionFilters: [isnotnull(Year" in plan


# ------------------------------------------- the published happiness files
PUBLISHED = os.environ.get("TALLYSTAR_HAPPINESS_DIR", "")


@pytest.mark.skipif(not PUBLISHED, reason="set TALLYSTAR_HAPPINESS_DIR to the folder of the published yearly files")
def test_published_happiness_files(spark):
    got = {r["Year"]: r for r in build_dimension(spark, PUBLISHED).groupBy("Year").agg(
        F.count("*").alias("n"), F.min("Happiness_Score").alias("lo"), F.max("Happiness_Score").alias("hi"),
        F.round(F.avg("Happiness_Score"), 4).alias("mean"), F.count_if(F.col("Corruption_Score").isNull()).alias("nulls")).collect()}
    assert tuple(got[2018])[1:] == (156, 2.905, 7.632, 5.3759, 1)
    assert tuple(got[2019])[1:] == (156, 2.853, 7.769, 5.4071, 0)
