import json
import random

import pytest

from pyspark.sql.types import _parse_datatype_string

from tallystar.plans.model import RAW_SCHEMA
from tallystar.sources.json_ranges import read_keyed_json_ranges
from tallystar.sources.readers import read_keyed_json

NASTY = ["plain", 'a},"b": {', "}}}{{{", '\\"}', 'quote " and } and \\', "é}ß{", "", "},", "{\"value\": {", "line\nend }"]


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def plain(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def records(rng, n):
    out = {}
    for i in range(n):
        key = str(i) if rng.random() < 0.8 else f"{i}{rng.choice(NASTY)}"
        out[key] = {"s": rng.choice(NASTY) + str(i), "n": rng.choice([i, None]), "inner": {"t": rng.choice(NASTY), "deep": {"u": rng.choice(NASTY)}}}
        if rng.random() < 0.1:
            out[key] = None
    return out


SCHEMA = "s string, n int, inner struct<t: string, deep: struct<u: string>>"


@pytest.mark.parametrize("size", [61, 400, 10 ** 6])
def test_cuts_anywhere_give_the_rows_of_the_map_parse(spark, local_tmp, small_splits, size):
    rng = random.Random(size)
    doc = {"meta}": {"value": "no } record", "x": {"y": 1}}, "note": "a } note", "value": records(rng, 25), "after": {"value": {"no": {"s": "x"}}}}
    schema = _parse_datatype_string(SCHEMA)
    for k, text in enumerate((json.dumps(doc, ensure_ascii=False), json.dumps(doc, indent=2) + "\r\n",
                              "﻿" + json.dumps(doc, ensure_ascii=False) + "\n")):
        path = f"{local_tmp}/immigration_{k}_2018.json"
        open(path, "w", encoding="utf-8").write(text)
        want = plain(read_keyed_json(spark, path, schema, multi_line=True, keep_year=True))
        small_splits(size)
        got = read_keyed_json_ranges(spark, path, schema, keep_year=True)
        assert plain(got) == want and len(want) == len(doc["value"])
        small_splits(128 << 20)


def test_many_documents_in_many_files(spark, local_tmp, small_splits):
    rng = random.Random(1)
    schema = _parse_datatype_string(SCHEMA)
    for f in range(4):
        with open(f"{local_tmp}/part{f}_20{18 + f}.json", "w", encoding="utf-8") as out:
            for _ in range(rng.choice([1, 6])):
                out.write(json.dumps({"value": records(rng, rng.choice([0, 3, 12]))}) + "\n")
    want = plain(read_keyed_json(spark, local_tmp, schema, keep_year=True))
    small_splits(300)
    got = read_keyed_json_ranges(spark, local_tmp, schema, keep_year=True)
    assert plain(got) == want and len(want) > 20
    assert got.rdd.getNumPartitions() > 8


@pytest.mark.parametrize("bad,message", [
    ('{"Value": {"a": {"n": 1}}}', "no object 'value'"), ('{"x": 1}', "no object 'value'"), ('{"value": null}', "no object 'value'"),
    ('{"value": {"a": {"n": 1}}', "ends early"), ('{"value": {"a": {"n": 1', "ends early"), ('{"value": {"a": {"n": 1}}}}', "closes more"),
    ('{"value": {"a": {"n": 1}}} rest', "outside of a document"), ('{"value": {"a": {"n": 1.5}}}', None), ('{"value": {"a": {"n": "1"}}}', None),
    ('{"value": {"a": {"n": 1}, "b": 7}}', None), ('{"value": {"a": {"n": 1} "b": {"n": 2}}}', "one comma"), ('{"value": {"a": {"n": 1},}}', "one comma"),
    ('{"value": {,"a": {"n": 1}}}', "one comma"), ('{"value": {"a": {"n": 1},, "b": {"n": 1}}}', None)])
@pytest.mark.parametrize("size", [30, 10 ** 6])
def test_broken_documents_are_loud(spark, local_tmp, small_splits, bad, message, size):
    open(f"{local_tmp}/a_2018.json", "w").write('{"value": {"a": {"n": 1}}}\n' + bad + "\n")
    small_splits(size)
    with pytest.raises(Exception, match=message):
        read_keyed_json_ranges(spark, local_tmp, _parse_datatype_string("n int")).collect()


@pytest.mark.parametrize("bad", ['{"Value": {"a": {}}}', '{"x": 1}', '{"value": null}'])
def test_documents_without_value_fail_the_map_parse_too(spark, local_tmp, bad):
    open(f"{local_tmp}/a_2018.json", "w").write('{"value": {"a": {"Immigratie_1": 1}}}\n' + bad + "\n")
    with pytest.raises(Exception, match="no object 'value'.*a_2018.json"):
        read_keyed_json(spark, local_tmp, RAW_SCHEMA).collect()


def test_compressed_and_empty_files(spark, local_tmp):
    import gzip
    with gzip.open(f"{local_tmp}/a_2018.json.gz", "wt") as out:
        out.write('{"value": {"a": {"Immigratie_1": 1}}}\n')
    open(f"{local_tmp}/b_2019.json", "w").close()
    got = read_keyed_json_ranges(spark, local_tmp, RAW_SCHEMA, keep_year=True).collect()
    assert [(r["key"], r["Immigratie_1"], r["Year"]) for r in got] == [("a", 1, 2018)]
