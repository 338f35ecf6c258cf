"""The yearly refresh stream: new files are picked up once, a year whose
files arrive in several runs is written whole, other years stay."""
import os

from tallystar.plans.model import LAYOUT_2018_COLUMNS, LAYOUT_2020_COLUMNS
from tallystar.streaming.refresh import start_refresh

OLD = ",".join(LAYOUT_2018_COLUMNS)
NEW = ",".join([c for c in LAYOUT_2020_COLUMNS if "error" not in c and "residual" not in c])


def _run(spark, landing, out, ckpt):
    q = start_refresh(spark, landing, out, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    return sorted((r["Country"], r["Year"], r["Happiness_Score"]) for r in spark.read.parquet(out).collect())


def test_refresh_stream(spark, local_tmp, tmp):
    landing = f"{local_tmp}/landing"
    os.makedirs(landing)
    out, ckpt = f"{tmp}/out", f"{tmp}/ckpt"
    open(f"{landing}/2018.csv", "w").write(OLD + "\n1,Finland,7.6,1,1,1,1,1,1\n")
    open(f"{landing}/2020.csv", "w").write(NEW + "\nFinland,Western Europe,7.8,1,1,1,1,1,1\n")
    assert _run(spark, landing, out, ckpt) == [("Finland", 2018, 7.6), ("Finland", 2020, 7.8)]
    # a late file for 2018: 2018 is rewritten from both files, 2020 untouched
    open(f"{landing}/late_2018.csv", "w").write(OLD + "\n2,Norway,7.5,1,1,1,1,1,1\n")
    assert _run(spark, landing, out, ckpt) == [("Finland", 2018, 7.6), ("Finland", 2020, 7.8),
                                               ("Norway", 2018, 7.5)]
    # nothing new: a rerun changes nothing
    assert _run(spark, landing, out, ckpt) == [("Finland", 2018, 7.6), ("Finland", 2020, 7.8),
                                               ("Norway", 2018, 7.5)]
