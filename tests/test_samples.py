"""Shares and seeds of the samples, and the error of the approximate distinct count."""
import pytest

from tallystar.operators.profile import distinct_counts, sample_by_key, sample_n, sample_rows


def ids(df):
    return sorted(r[0] for r in df.collect())


@pytest.mark.parametrize("fraction", [0.01, 0.1, 0.5])
def test_sample_rows_has_its_share_and_follows_its_seed(spark, fraction):
    n = 100_000
    rows = spark.range(0, n, 1, 8)
    got = ids(sample_rows(rows, fraction, seed=7))
    assert got == ids(sample_rows(rows, fraction, seed=7)) != ids(sample_rows(rows, fraction, seed=8))
    assert abs(len(got) - fraction * n) < 5 * (n * fraction * (1 - fraction)) ** 0.5
    assert len(set(got)) == len(got)
    # every part of the table is sampled alike
    for at in range(0, n, n // 4):
        part = sum(at <= i < at + n // 4 for i in got)
        assert abs(part - fraction * n / 4) < 5 * (n / 4 * fraction * (1 - fraction)) ** 0.5


def test_sample_rows_at_the_ends(spark):
    assert ids(sample_rows(spark.range(50), 0.0)) == [] and ids(sample_rows(spark.range(50), 1.0)) == list(range(50))
    assert ids(sample_rows(spark.range(0), 0.5)) == []


def test_keyed_samples_do_not_depend_on_partitions(spark):
    a, b = spark.range(0, 20_000, 1, 3), spark.range(0, 20_000, 1, 11)
    assert ids(sample_by_key(a, "id", 0.05)) == ids(sample_by_key(b, "id", 0.05))
    assert ids(sample_n(a, "id", 100)) == ids(sample_n(b, "id", 100)) and sample_n(a, "id", 100).count() == 100


def test_default_distinct_counts_are_within_their_error(spark):
    df = spark.range(150_000).selectExpr("id", "id % 30000 as many", "cast(id % 40 as string) as few", "cast(null as int) as none")
    got = {r["column_name"]: r["n_distinct"] for r in distinct_counts(df).collect()}
    for c, n in (("id", 150_000), ("many", 30_000), ("few", 40)):
        assert abs(got[c] / n - 1) < 0.04, c
    assert got["none"] == 0
