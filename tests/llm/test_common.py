from pyspark.sql import functions as F

from tallystar.llm import common


def test_bounded_sample_is_the_smallest_hashes(spark):
    for rows in (5, 30, 5000):
        df = spark.range(rows).repartition(7)
        want = [r["id"] for r in df.orderBy(F.xxhash64("id"), "id").limit(20).collect()]
        assert [r["id"] for r in common.bounded_sample(df, 20, "id").collect()] == want
    assert common.bounded_sample(spark.range(0), 20, "id").count() == 0


def test_repeated_keys_do_not_break_the_sample(spark):
    df = spark.range(5000).select(F.lit(7).alias("id"))
    assert common.bounded_sample(df, 20, "id").count() == 20


def test_both_joins_of_with_ids_agree(spark, monkeypatch):
    df, ids = spark.range(100).withColumnRenamed("id", "k"), spark.range(0, 100, 3).withColumnRenamed("id", "k")
    for how in ("left_semi", "left_anti"):
        few = sorted(map(tuple, common.with_ids(df, ids, "k", how).collect()))
        monkeypatch.setattr(common, "small_enough", lambda *a: False)
        assert sorted(map(tuple, common.with_ids(df, ids, "k", how).collect())) == few
        monkeypatch.undo()


def test_stored_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, "a", [1.0]), (None, None, None)], "a long, b string, c array<double>")
    back = common.stored(df, "t")
    assert back.schema == df.schema and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert not common.stored(df.limit(0), "t").collect()


def test_per_row_keeps_clashing_columns(spark):
    df = spark.createDataFrame([("x", 1, 2), (None, 3, 4)], "text string, made int, row int")
    out = common.per_row(df, lambda t: (len(t or ""),), "made long").select("row.*", F.col("made").alias("n"))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("x", 1, 2, 1), (None, 3, 4, 0)], key=str)
