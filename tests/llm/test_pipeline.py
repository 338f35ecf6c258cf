import importlib
import random

import pytest

import corpus_pipeline as cp
from tallystar.llm import near_dedup, secret_scan

WORDS = ["river", "town", "stone", "light", "walks", "quietly", "over", "old", "the", "and", "sees", "many", "lamps", "boats"]


def write(spark, tmp):
    rng = random.Random(12)
    rows = []
    for i in range(150):
        text = " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(rng.randint(12, 200))) + "."
        good = i % 6 != 0
        if not good:
            text = " ".join(w + "***" for w in text.split())
        elif i % 11 == 0:
            text += ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
        rows.append((i, text, "en", "hot" if i % 3 else "cold", len(text), int(good)))
    rows += [(500 + i, rows[7][1], "en", "hot", 1, 1) for i in range(40)]
    spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([(r[0], r[5], 0) for r in rows[:150]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    return {r[0]: r for r in rows}


def test_stages_one_by_one(spark, tmp):
    rows = write(spark, tmp)
    docs = spark.read.parquet(f"{tmp}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, tmp)
        if k < len(cp.STAGES) - 1:
            assert out.columns == cp.COLUMNS
        path = f"{tmp}/stage{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
    first = {r["doc_id"] for r in seen["quality classifier"]}
    assert all((i in first) == bool(r[5]) for i, r in rows.items())
    second = [r["doc_id"] for r in seen["near duplicates"]]
    assert len(second) == len(set(second)) and 7 in second and not any(i >= 500 for i in second)
    assert set(second) == first - set(range(500, 540))
    assert all(not secret_scan.find_secrets(r["text"])[1] for r in seen["secret scans"])
    assert any(secret_scan.MARK in r["text"] and r["n_chars"] == len(r["text"]) for r in seen["secret scans"])
    assert {r["doc_id"] for r in seen["mixing sources"]} <= set(second)
    total = {}
    for r in seen["best-fit packing"]:
        total[r["sequence_id"]] = total.get(r["sequence_id"], 0) + r["length"]
    assert max(total.values()) <= 1024


def test_run_returns_the_last_stage(spark, tmp):
    write(spark, tmp)
    out = cp.run(spark, tmp)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_registered_queries():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert names["pipeline"] is cp.run
    assert set(entry.oracle_sql()) <= set(names)


def test_keep_one_agrees_with_the_operator(docs):
    rows = [(i, f"alpha beta gamma delta {i % 4} epsilon zeta") for i in range(20)]
    d = docs(rows)
    kept = {r["doc_id"] for r in near_dedup.near_duplicates(d).collect() if r["kept"]}
    assert {r["doc_id"] for r in near_dedup.keep_one(d).collect()} == kept == {0, 1, 2, 3}


@pytest.mark.parametrize("stage", [f for _, f in cp.STAGES], ids=[n for n, _ in cp.STAGES])
def test_every_stage_takes_odd_rows_and_empty_tables(spark, tmp, docs, labels, stage):
    labels([(i, i % 2, 0) for i in range(20)] + [(None, 1, 0), (3, None, None)]).write.parquet(f"{tmp}/labels.parquet")
    rows = [(i, f"some words for text number {i} and a few more of them {i * 7}", "en", "s", 5) for i in range(20)]
    rows += [(50, None, None, None, None), (51, "", "en", "", 0), (52, "long word " * 30_000, "en", "s", 9), (53, " \n\t", "xx", "s", 3),
             (None, "no id at all here", "en", "s", 3), (54, "twice the same row here", "en", "s", 3), (54, "twice the same row here", "en", "s", 3)]
    extra = ", score double, kept boolean, copy int, rate double, piece int, row string"
    d = docs([(*r, 0.5, False, 7, 1.5, 2, "r") for r in rows], extra)
    out = stage(spark, d, tmp)
    got = out.collect()
    empty = stage(spark, docs([], extra), tmp)
    assert empty.count() == 0 and empty.columns == out.columns
    if stage is not cp.best_fit_packing:
        assert out.columns == cp.COLUMNS
        assert {r["doc_id"] for r in got} <= {r[0] for r in rows}
    if stage is cp.near_duplicates:
        assert sum(r["doc_id"] == 54 for r in got) == 1 and sum(r["doc_id"] is None for r in got) == 1
        assert {50, 51, 52, 53} <= {r["doc_id"] for r in got}
    if stage in (cp.secrets, cp.best_fit_packing):
        assert len({r["doc_id"] for r in got}) == len({r[0] for r in rows})
