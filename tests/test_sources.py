import json

import pytest
from pyspark.sql import functions as F

from tallystar.plans import bindings as B
from tallystar.plans.landing import keyed_documents, write_keyed_json
from tallystar.plans.model import LAYOUT_2018_COLUMNS, LAYOUT_2020_COLUMNS, RAW_SCHEMA, REFERENCE_SECTION_RANGES
from tallystar.plans.star_build import build_dimension, files_by_layout, read_yearly_layouts
from tallystar.sources.json_ranges import read_keyed_json_ranges
from tallystar.sources.readers import (
    list_inputs,
    read_csv_strings,
    read_keyed_json,
    read_section_ranges,
    read_sections,
)


def test_keyed_json(spark, local_tmp):
    doc = {"value": {"0": {"ID": "1", "Geslacht": "3000", "LeeftijdOp31December": "10010",
                           "BurgerlijkeStaat": "1010 ", "Geboorteland": "L1", "Perioden": "2018JJ00",
                           "Immigratie_1": 5},
                     "24": {"ID": "2", "Geslacht": "4000", "Immigratie_1": None}}}
    path = f"{local_tmp}/immigration_records_2018.json"
    open(path, "w").write(json.dumps(doc) + "\n")
    df = read_keyed_json(spark, path, RAW_SCHEMA, keep_year=True)
    rows = {r["key"]: r for r in df.collect()}
    assert set(rows) == {"0", "24"}
    assert rows["0"]["Immigratie_1"] == 5 and rows["24"]["Immigratie_1"] is None
    assert rows["0"]["Year"] == 2018
    assert df.columns == ["key", *RAW_SCHEMA.fieldNames(), "Year"]


def _metadata_file(path):
    """A code-list file laid out like the published one: the five sections
    start where the reference's (skiprows, nrows) pairs say."""
    sizes = [n for _, n in REFERENCE_SECTION_RANGES]
    lines = [f"preamble line {i}" for i in range(17)]
    for s, n in enumerate(sizes):
        if s:
            lines.append("")
        lines.append("Key;Title;Description")
        lines += [f"K{s}_{i};T{s}_{i};d" for i in range(n)]
    open(path, "w").write("\r\n".join(lines) + "\r\n")
    return sizes


def test_sections_by_marker_and_by_ranges_agree(spark, local_tmp):
    path = f"{local_tmp}/code_lists.csv"
    sizes = _metadata_file(path)
    by_marker = read_sections(spark, path)
    by_range = read_section_ranges(spark, path, REFERENCE_SECTION_RANGES)
    counts = {r["section"]: r["count"] for r in by_marker.groupBy("section").count().collect()}
    assert [counts[i] for i in range(5)] == sizes
    a = sorted((r["section"], r["Key"], r["Title"]) for r in by_marker.collect())
    b = sorted((r["section"], r["Key"], r["Title"]) for r in by_range.collect())
    assert a == b


def test_translation_csv_quoted_and_blanks(spark, local_tmp):
    path = f"{local_tmp}/translation.csv"
    open(path, "w").write('Land_Dutch,Country\r\n"Bonaire, Sint Eustatius",Bonaire\r\nTuvalu,Tuvalu \r\n')
    rows = read_csv_strings(spark, path).collect()
    assert rows[0]["Land_Dutch"] == "Bonaire, Sint Eustatius" and rows[1]["Country"] == "Tuvalu "


def _write_happiness(folder):
    old = LAYOUT_2018_COLUMNS
    new = [c for c in LAYOUT_2020_COLUMNS if "error" not in c and "residual" not in c]
    open(f"{folder}/2018.csv", "w").write(",".join(old) + "\n1,Finland,7.632,1.3,1.5,0.9,0.7,0.2,0.4\n"
                                         "2,United Arab Emirates,6.774,2.0,1.4,0.7,0.6,0.2,N/A\n")
    open(f"{folder}/2020.csv", "w").write(",".join(new) + "\nFinland,Western Europe,7.809,1.3,1.5,0.9,0.7,0.2,0.5\n")


def test_yearly_layouts_conform(spark, local_tmp):
    _write_happiness(local_tmp)
    assert len(list_inputs(spark, local_tmp)) == 2
    dim = build_dimension(spark, local_tmp)
    rows = sorted((r["Country"], r["Year"], r["Happiness_Score"], r["Corruption_Score"]) for r in dim.collect())
    assert rows == [("Finland", 2018, 7.632, 0.4), ("Finland", 2020, 7.809, 0.5),
                    ("United Arab Emirates", 2018, 6.774, None)]


def test_layout_mismatch_fails(spark, local_tmp):
    _write_happiness(local_tmp)
    files = files_by_layout(list_inputs(spark, local_tmp), lambda y: "2018")
    with pytest.raises(Exception):
        read_yearly_layouts(spark, files)["2018"].collect()


def test_keyed_json_pretty_printed(spark, local_tmp):
    doc = {"value": {"7": {"ID": "9", "Geslacht": "3000", "Immigratie_1": 1}}}
    path = f"{local_tmp}/immigration_records_2019.json"
    open(path, "w").write(json.dumps(doc, indent=2) + "\n")
    rows = read_keyed_json(spark, path, RAW_SCHEMA, multi_line=True).collect()
    assert [(r["key"], r["ID"], r["Immigratie_1"]) for r in rows] == [("7", "9", 1)]


def test_landed_documents_are_bounded_in_every_year(spark, tmp):
    year = B.FILE_NAMED_YEAR
    raw = spark.range(3000).select(
        F.col("id").cast("string").alias("_row_key"),
        *[(F.when(F.col("id") < 2600, f"{year}JJ00").otherwise("2001JJ00") if f.name == "Perioden"
           else F.col("id").cast(f.dataType)).alias(f.name) for f in RAW_SCHEMA.fields])
    write_keyed_json(raw, tmp, 100, 3000)
    back = read_keyed_json(spark, tmp, RAW_SCHEMA, keep_year=True)
    assert {r["Year"]: r["count"] for r in back.groupBy("Year").count().collect()} == {year: 2600, 2001: 400}
    assert back.select("key").distinct().count() == 3000
    files = spark.read.text(tmp, recursiveFileLookup=True).select(
        F.col("_metadata.file_name").alias("file"),
        F.size(F.from_json("value", "value map<string, struct<ID: string>>").getField("value")).alias("records"))
    named = files.where(F.col("file").rlike(rf"^immigration_(\d+_)?{year}\.json$")).collect()
    assert sum(r["records"] for r in named) == 2600 and len(named) == 30
    assert f"immigration_{year}.json" in {r["file"] for r in named}
    assert max(r["records"] for r in files.collect()) < 200


def test_records_are_collected_behind_their_one_shuffle(spark):
    raw = spark.range(500).select(F.col("id").cast("string").alias("_row_key"), *[
        F.col("id").cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])
    lines = keyed_documents(raw, 100, 500)._jdf.queryExecution().executedPlan().toString().splitlines()
    shuffles = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    collects = [i for i, x in enumerate(lines) if "collect_list" in x and "Aggregate" in x]
    assert len(shuffles) == 1 and collects and max(collects) < shuffles[0]


def test_the_shuffle_of_the_documents_carries_the_record_alone(spark):
    raw = spark.range(500).select(F.col("id").cast("string").alias("_row_key"), *[
        F.col("id").cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])
    lines = keyed_documents(raw, 100, 500)._jdf.queryExecution().executedPlan().toString().splitlines()
    shuffles = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    below = " ".join(lines[shuffles[0] + 1:])
    assert "struct(" not in below and "xxhash64(" not in below and "Year" not in below


def test_row_keys_come_from_the_landed_files(spark):
    from tallystar.plans import landing
    land = landing.land_inputs(spark, "/root/testdata/sf0.001")
    written = spark.read.parquet(land.raw)
    assert written.columns == RAW_SCHEMA.fieldNames()
    keyed = landing.with_row_key(written)
    keys = sorted(r["_row_key"] for r in keyed.select("_row_key").collect())
    assert len(set(keys)) == len(keys) == written.count()
    assert keys == sorted(r["key"] for r in read_keyed_json(spark, land.imm, RAW_SCHEMA).select("key").collect())


def test_records_that_a_join_repeats_keep_keys_of_their_own(spark, tmp):
    from tallystar.plans import landing
    one = spark.range(3).select(*[F.col("id").cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])
    one.union(one).write.parquet(f"{tmp}/raw")
    write_keyed_json(landing.with_row_key(spark.read.parquet(f"{tmp}/raw")), f"{tmp}/json", 2, 6)
    back = read_keyed_json(spark, f"{tmp}/json", RAW_SCHEMA).collect()
    assert sorted(r["ID"] for r in back) == list("001122") and len({r["key"] for r in back}) == 6


def test_compressed_documents_are_the_same_records(spark, tmp):
    year = B.FILE_NAMED_YEAR
    raw = spark.range(900).select(F.col("id").cast("string").alias("_row_key"), *[
        (F.when(F.col("id") % 2 == 0, f"{year}JJ00").otherwise("2001JJ00") if f.name == "Perioden"
         else F.col("id").cast(f.dataType)).alias(f.name) for f in RAW_SCHEMA.fields])
    write_keyed_json(raw, tmp, 100, 900, compression="gzip")
    names = [p.rsplit("/", 1)[-1] for p in spark.read.option("recursiveFileLookup", True).text(tmp).inputFiles()]
    assert f"immigration_{year}.json.gz" in names and all(n.endswith(".json.gz") for n in names)
    for back in (read_keyed_json(spark, tmp, RAW_SCHEMA, keep_year=True),
                 read_keyed_json_ranges(spark, tmp, RAW_SCHEMA, keep_year=True)):
        got = {(r["key"], r["ID"], r["Immigratie_1"], r["Year"]) for r in back.collect()}
        assert got == {(str(k), str(k), k, 2001 if k % 2 else year) for k in range(900)}


def test_one_document_for_a_whole_year(spark, local_tmp):
    doc = {"value": {str(k): {"ID": str(k % 7), "Immigratie_1": k} for k in range(5000)}}
    open(f"{local_tmp}/immigration_2019.json", "w").write(json.dumps(doc) + "\n")
    df = read_keyed_json(spark, local_tmp, RAW_SCHEMA, keep_year=True)
    assert sorted((int(r["key"]), r["ID"], r["Immigratie_1"], r["Year"]) for r in df.collect()) == [
        (k, str(k % 7), k, 2019) for k in range(5000)]
