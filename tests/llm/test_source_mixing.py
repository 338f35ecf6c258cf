import hashlib
import math
import random
from collections import Counter

import duckdb
import pytest

from tallystar.llm import source_mixing as sm


def uniform(*parts):
    return int(hashlib.md5(":".join("" if p is None else str(p) for p in parts).encode()).hexdigest()[:13], 16) / 2 ** 52


def poisson(u, rate):
    term = total = math.exp(-rate)
    k = 0
    while total <= u and k < sm.TERMS - 1:
        k += 1
        term *= rate / k
        total += term
    return k if total > u else k + 1


def brute(rows, weights=None):
    size = Counter()
    for _, text, _, source, _ in rows:
        size[source] += max(1, len(text or ""))
    w = {s: math.sqrt(n) for s, n in size.items()} if weights is None else {s: weights.get(s) for s in size if weights.get(s)}
    out = Counter()
    for i, _, _, source, _ in rows:
        if source in w:
            rate = w[source] / sum(w.values()) * sum(size[s] for s in w) / size[source]
            draws = max(1, math.ceil(rate / sm.SPLIT))
            n = sum(poisson(uniform(sm.SEED, i, d), rate / draws) for d in range(1, draws + 1))
            out.update((i, c) for c in range(n))
    return out


def corpus(n=400):
    rng = random.Random(6)
    return [(i, "x" * rng.randint(0, 90), "en", "hot" if i % 3 == 0 else f"s{i % 7}", 0) for i in range(n)]


@pytest.mark.parametrize("weights", [None, {"hot": 1.0, "s1": 5.0, "s2": 0.0, "s4": None}, {"s5": 1000.0, "hot": 1.0}])
def test_draws_match_brute_force(docs, weights):
    rows = corpus()
    got = Counter((r["doc_id"], r["copy"]) for r in sm.mix(docs(rows), weights).collect())
    assert got == brute(rows, weights)


def test_large_rates_are_split(docs):
    rows = [(0, "x", "en", "tiny", 0)] + [(i, "x" * 200, "en", "big", 0) for i in range(1, 40)]
    got = sm.mix(docs(rows), {"tiny": 1.0, "big": 1.0})
    assert Counter((r["doc_id"], r["copy"]) for r in got.collect()) == brute(rows, {"tiny": 1.0, "big": 1.0})
    assert got.where("doc_id = 0").count() > 3000


def test_expected_mix_meets_the_targets(docs):
    rows = [(i, "y" * 50, "en", "a" if i % 4 else "b", 0) for i in range(4000)]
    got = Counter(r["source"] for r in sm.mix(docs(rows), {"a": 1.0, "b": 1.0}).collect())
    assert abs(got["a"] / sum(got.values()) - 0.5) < 0.03


def test_oracle_sql(docs):
    rows = corpus(200) + [(900, None, None, None, None), (901, "", "en", None, 0)]
    d = docs(rows)
    con = duckdb.connect()
    con.register("documents", d.toArrow())
    want = sorted(con.sql(f"SELECT doc_id, copy, shuffle_key FROM ({sm.oracle()})").fetchall())
    assert sorted((r["doc_id"], r["copy"], r["shuffle_key"]) for r in sm.mix(d).collect()) == want


def test_edges_and_clashing_columns(docs):
    assert sm.mix(docs([])).count() == 0
    d = docs([(i, "text", "en", "s", 4, 9, 0.5, "w", 3) for i in range(50)] + [(7, "text", "en", "s", 4, 9, 0.5, "w", 3)] * 2,
             ", copy int, rate double, sums string, copies int")
    out = sm.mix(d)
    assert out.columns == [c for c in d.columns if c != "copy"] + ["copy", "shuffle_key"]
    rows = out.collect()
    assert all(r["rate"] == 0.5 and r["copies"] == 3 for r in rows)
    mine = Counter(r["copy"] for r in rows if r["doc_id"] == 7)
    assert all(n == 3 for n in mine.values())  # repeated rows draw alike
    with pytest.raises(ValueError):
        sm.mix(d, {"s": -1.0})
