"""End to end on files shaped like the published inputs, with the reference
code book: run_etl, then the two questions."""
import json
import os

import pytest

from tallystar.api import age_profile, run_etl, top_countries
from tallystar.plans.model import LAYOUT_2018_COLUMNS, LAYOUT_2020_COLUMNS, REFERENCE_SECTION_RANGES


def _inputs(root):
    os.makedirs(f"{root}/imm")
    os.makedirs(f"{root}/happy")
    recs = {
        "2018": [("a1", "3000", "10030", "1010    ", "L1", "2018JJ00", 5),
                 ("a2", "4000", "10030", "1020    ", "L1", "2018JJ00", 7),
                 ("a3", "3000", "10040", "1010    ", "L2", "2018JJ00", 4),
                 ("a4", "T001038", "10030", "1010    ", "L1", "2018JJ00", 99),   # total
                 ("a5", "3000", "22000", "1010    ", "L1", "2018JJ00", 50),      # age band
                 ("a6", "3000", "10030", "1010    ", "L0", "2018JJ00", 30),      # region
                 ("a7", "3000", "10030", "1010    ", "L1", "2018JJ00", None)],   # no measure
        "2020": [("b1", "4000", "19905", "1080    ", "L2", "2020JJ00", 3)],
    }
    fields = ["ID", "Geslacht", "LeeftijdOp31December", "BurgerlijkeStaat", "Geboorteland", "Perioden",
              "Immigratie_1"]
    for year, rows in recs.items():
        doc = {"value": {str(i): dict(zip(fields, r)) for i, r in enumerate(rows)}}
        open(f"{root}/imm/immigration_records_{year}.json", "w").write(json.dumps(doc) + "\n")
    # code-list file laid out at the published (skiprows, nrows) positions
    sections = [
        [("T001038", "Totaal mannen en vrouwen"), ("3000", "Mannen"), ("4000", "Vrouwen")],
        [("10000", "Totaal leeftijd")] + [(str(10010 + 10 * a), f"{a} jaar") for a in range(126)]
        + [("19905", "105 jaar of ouder")],
        [("T001019 ", "Totaal burgerlijke staat"), ("1010    ", "Ongehuwd"), ("1020    ", "Gehuwd"),
         ("1050    ", "Verweduwd"), ("1080    ", "Gescheiden")],
        [(f"L{i}", f"Land{i}") for i in range(263)],
        [(f"{1995 + i}JJ00", str(1995 + i)) for i in range(26)],
    ]
    assert [len(s) for s in sections] == [n for _, n in REFERENCE_SECTION_RANGES]
    lines = [f"preamble {i}" for i in range(17)]
    for i, sec in enumerate(sections):
        lines += ([""] if i else []) + ["Key;Title;Description"] + [f"{k};{t};" for k, t in sec]
    open(f"{root}/metadata.csv", "w").write("\n".join(lines) + "\n")
    open(f"{root}/translation.csv", "w").write(
        "Land_Dutch,Country,SingleCountry\nLand0,Africa,N\nLand1,Morocco,Y\nLand2,Syria ,Y\n")
    old = ",".join(LAYOUT_2018_COLUMNS)
    new = ",".join([c for c in LAYOUT_2020_COLUMNS if "error" not in c and "residual" not in c])
    open(f"{root}/happy/2018.csv", "w").write(old + "\n1,Morocco,5.2,1,1,1,1,1,1\n2,Syria,3.4,1,1,1,1,1,1\n")
    open(f"{root}/happy/2020.csv", "w").write(new + "\nSyria,Middle East,3.5,1,1,1,1,1,1\n")


@pytest.mark.parametrize("ranges", [None, REFERENCE_SECTION_RANGES])
def test_run_etl_and_questions(spark, local_tmp, tmp, ranges):
    _inputs(local_tmp)
    res = run_etl(spark, f"{local_tmp}/imm", f"{local_tmp}/metadata.csv", f"{local_tmp}/translation.csv",
                  f"{local_tmp}/happy", tmp, section_ranges=ranges, fail_on_error=True)
    assert res.fact_checks == {"rows": 5, "zero_measure": 0, "null_cells": 0, "repeated_ids": 0}
    assert res.dim_rows == 3
    fact = {r["ID"]: r for r in spark.read.parquet(res.fact_path).collect()}
    assert set(fact) == {"a1", "a2", "a3", "a6", "b1"}
    assert fact["b1"]["Age"] == 105 and fact["b1"]["MaritalStatus"] == "Divorced" and fact["b1"]["Year"] == 2020
    assert fact["a2"]["Gender"] == "Women" and fact["a2"]["Age"] == 2
    top = [(r["Country"], r["sumImmigrationVolume"], r["Happiness_Score"]) for r in top_countries(spark, res, 2018).collect()]
    assert top == [("Morocco", 12, 5.2), ("Syria", 4, 3.4)]
    prof = {(r["Year"], r["Age"]): r["sumImmigrationVolume"] for r in age_profile(spark, res).collect()}
    assert prof == {(2018, 2): 42, (2018, 3): 4, (2020, 105): 3}


def test_coverage_lists_what_the_build_drops(spark, local_tmp):
    from tallystar.api import coverage
    _inputs(local_tmp)
    # an unknown country code and a country without translation
    doc = {"value": {"0": {"ID": "c1", "Geslacht": "3000", "LeeftijdOp31December": "10030",
                           "BurgerlijkeStaat": "1010", "Geboorteland": "LX", "Perioden": "2019JJ00",
                           "Immigratie_1": 2},
                     "1": {"ID": "c2", "Geslacht": "3000", "LeeftijdOp31December": "10030",
                           "BurgerlijkeStaat": "1010", "Geboorteland": "L7", "Perioden": "2019JJ00",
                           "Immigratie_1": 2}}}
    open(f"{local_tmp}/imm/immigration_records_2019.json", "w").write(json.dumps(doc) + "\n")
    got = {(r["dimension"], r["code"], r["rows"]) for r in
           coverage(spark, f"{local_tmp}/imm", f"{local_tmp}/metadata.csv", f"{local_tmp}/translation.csv").collect()}
    assert got == {("country", "LX", 1), ("translation", "Land7", 1)}
