from tallystar.functions.strings import decode_map, leading_int, replace_chain, safe_int, strict_int, strip_ws
from tallystar.plans.model import AGE_LABEL_CHAIN


def _one(spark, col, value):
    return spark.createDataFrame([(value,)], "v string").select(col.alias("r")).first()["r"]


def test_strip_ws_removes_tabs_and_newlines(spark):
    assert _one(spark, strip_ws("v"), " \t1010  \n") == "1010"
    assert _one(spark, strip_ws("v"), "a b") == "a b"


def test_age_label_chain_cases(spark):
    # label cleaning cases: order of the steps matters
    cases = {"Totaal leeftijd": "Total leeftijd", "0 jaar": "0", "0 tot 5 jaar": "0 to 5",
             "105 jaar of ouder": "105  or older"}
    for src, dst in cases.items():
        assert _one(spark, replace_chain("v", AGE_LABEL_CHAIN), src) == dst


def test_leading_int_parses_open_ended_label(spark):
    assert _one(spark, leading_int("v"), "105  or older") == 105
    assert _one(spark, leading_int("v"), "Total leeftijd") is None
    assert _one(spark, leading_int("v"), " 42") == 42


def test_safe_and_strict_int(spark):
    assert _one(spark, safe_int("v"), "3.0") == 3
    assert _one(spark, safe_int("v"), "abc") is None
    assert _one(spark, strict_int("v"), "3.0") is None
    assert _one(spark, strict_int("v"), " 7 ") == 7


def test_decode_map_by_code(spark):
    m = {"3000": "Men", "4000": "Women"}
    assert _one(spark, decode_map("v", m), "4000") == "Women"
    assert _one(spark, decode_map("v", m), "9999") is None


def test_file_year_from_name_and_folder(spark, local_tmp):
    import os
    os.makedirs(f"{local_tmp}/a/Year=2019")
    open(f"{local_tmp}/a/immigration_records_2018.txt", "w").write("x\n")
    open(f"{local_tmp}/a/Year=2019/part-00000-abc.c000.txt", "w").write("y\n")
    from tallystar.sources.readers import with_file_year
    df = with_file_year(spark.read.text([f"{local_tmp}/a/immigration_records_2018.txt",
                                         f"{local_tmp}/a/Year=2019/part-00000-abc.c000.txt"]))
    got = sorted((r["value"], r["Year"]) for r in df.collect())
    assert got == [("x", 2018), ("y", 2019)]


def test_scratch_root_follows_session_checkpoint_dir(spark):
    from tallystar.session import fresh_path, scratch_root
    before = spark.sparkContext.getCheckpointDir()
    root = scratch_root(spark)
    assert spark.sparkContext.getCheckpointDir() == before  # the caller's setting stays
    assert root == (before or root).rstrip("/")
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a.startswith(root) and a != b
