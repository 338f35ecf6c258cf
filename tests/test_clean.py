"""Crafted records, one per cleaning rule, through the fact build with the
reference's code book."""
import pytest
from pyspark.sql import functions as F

from tallystar.operators.clean import dedup_first, drop_totals, key_slice
from tallystar.plans.model import RAW_SCHEMA, REFERENCE_BOOK
from tallystar.plans.star_build import build_fact, clean_records, code_lists

BASE = ["3000", "10010", "1010   ", "L1", "2018JJ00", 7]


def rec(key, **over):
    fields = ["Geslacht", "LeeftijdOp31December", "BurgerlijkeStaat", "Geboorteland", "Perioden",
              "Immigratie_1"]
    vals = dict(zip(fields, BASE))
    vals.update(over)
    return (over.pop("ID", f"id{key}"), *[vals[f] for f in fields])


RECORDS = [
    rec(0),                                   # kept, marital trimmed
    rec(1, Immigratie_1=None),                # null measure
    rec(2, Immigratie_1=0),                   # zero measure
    rec(3, LeeftijdOp31December="22000"),     # age band
    rec(4, LeeftijdOp31December="10000"),     # age total
    rec(5, Geslacht="T001038"),               # gender total
    rec(6, BurgerlijkeStaat="T001019"),       # marital total
    rec(7, Geboorteland="T001175"),           # country total
    rec(8, Geslacht=None),                    # kept by cleaning, dropped by decode
    ("id0", "4000", "10010", "1010", "L1", "2018JJ00", 3),  # duplicate ID of key 0
    rec(10, LeeftijdOp31December="19905"),    # 105 or older
    rec(11, Geboorteland="L9"),               # not in the country list
    rec(12, Geboorteland="L3"),               # Land not in the translation
    rec(13, Geboorteland="L2"),               # a region (SingleCountry N)
]


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(RECORDS, RAW_SCHEMA)


@pytest.fixture()
def dims(spark):
    rows = [(0, "T001038", "Totaal mannen en vrouwen"), (0, "3000", "Mannen"), (0, "4000", "Vrouwen"),
            (1, "10000", "Totaal leeftijd"), (1, "10010", "0 jaar"), (1, "19905", "105 jaar of ouder"),
            (1, "22000", "0 tot 5 jaar"),
            (2, "T001019 ", "Totaal burgerlijke staat"), (2, "1010    ", "Ongehuwd"),
            (3, "L1", "Marokko"), (3, "L2", "Afrika"), (3, "L3", "Atlantis"),
            (4, "2018JJ00", "2018")]
    sections = spark.createDataFrame(rows, "section int, Key string, Title string")
    return code_lists(sections, REFERENCE_BOOK)


@pytest.fixture()
def translation(spark):
    return spark.createDataFrame([("Marokko", "Morocco", "Y"), ("Afrika", "Africa ", "N")],
                                 "Land_Dutch string, Country string, SingleCountry string")


def test_clean_rules(raw):
    kept = {r["ID"] for r in clean_records(raw, REFERENCE_BOOK).collect()}
    assert kept == {"id0", "id8", "id10", "id11", "id12", "id13"}


def test_null_code_survives_total_filter(spark):
    df = spark.createDataFrame([(None,), ("T001038",), ("3000",)], "Geslacht string")
    assert drop_totals(df, {"Geslacht": "T001038"}).count() == 2


def test_dedup_keeps_smallest_row(raw):
    out = dedup_first(clean_records(raw, REFERENCE_BOOK), ["ID"])
    row = out.where(F.col("ID") == "id0").collect()
    assert len(row) == 1 and row[0]["Geslacht"] == "3000"


def test_fact_rows(raw, dims, translation):
    fact = {r["ID"]: r for r in build_fact(raw, dims, translation, REFERENCE_BOOK).collect()}
    assert set(fact) == {"id0", "id10", "id13"}
    assert fact["id0"]["MaritalStatus"] == "Unmarried" and fact["id0"]["Age"] == 0
    assert fact["id0"]["Gender"] == "Men" and fact["id0"]["Year"] == 2018
    assert fact["id10"]["Age"] == 105
    assert fact["id13"]["SingleCountry"] == "N" and fact["id13"]["Country"] == "Africa"


def test_coverage_lists_unmatched(raw, dims, translation):
    from tallystar.operators.star import coverage
    recs = clean_records(raw, REFERENCE_BOOK)
    missing = {r[0] for r in coverage(recs, dims["country"], "Geboorteland", "LandCode").collect()}
    assert missing == {"L9"}
    lands = dims["country"]
    missing_tr = {r[0] for r in coverage(lands, translation, "Land", "Land_Dutch", trim=True).collect()}
    assert missing_tr == {"Atlantis"}


def test_key_slice(spark):
    df = spark.createDataFrame([(str(i),) for i in range(20)], "k string")
    got = sorted(int(r["k"]) for r in key_slice(df, "k", [2, 10], 3).collect())
    assert got == [2, 3, 4, 10, 11, 12]
