import random
import re
import zlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest

from tallystar.llm import spelling_variants as sv


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def grouped(counts):
    out = {}
    for w, n in counts.items():
        around = [x for x in counts if near(w, x)]
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= 5 * n else None
        out[w] = (form, n, len(around), counts[best] if form else None)
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows)


def counted(rows, least=5):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 6 and n >= least}


def edited(rng, w, letters):
    k = rng.randrange(len(w) + 1)
    return rng.choice([w[:k] + rng.choice(letters) + w[k:], w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k + 1:]])


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "aéßz÷Àq"])
def test_pairs_equal_brute_force(spark, letters):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.choice([6, 7, 8, 12]))) for _ in range(60)}
    for _ in range(2):
        words |= {e for w in list(words) if len(e := edited(rng, w, letters)) >= 4}
    words |= {letters[0] * n for n in (4, 5, 6, 7, 30)} | {letters[:2] * 2, letters[:2] * 5, letters[:2] * 5 + letters[0]}
    got = sv.near_pairs(spark.createDataFrame([(w, i) for i, w in enumerate(sorted(words))], "word string, n long")).collect()
    want = {(a, b) for a, b in combinations(sorted(words), 2) if near(a, b)}
    assert {(r["word_a"], r["word_b"]) for r in got} == want and len(got) == len(want) > 20
    number = {w: i for i, w in enumerate(sorted(words))}
    assert all((r["n_a"], r["n_b"]) == (number[r["word_a"]], number[r["word_b"]]) for r in got)


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(1)
    for _ in range(500):
        grams = [(rng.randrange(9), "xx", p) for p in rng.sample(range(9), rng.randrange(3, 7))]
        got = sv.disjoint_pivots(grams)
        assert len(got) == 2 and abs(got[0][2] - got[1][2]) >= 2
        assert sum(g[0] for g in got) == min(a[0] + b[0] for a, b in combinations(grams, 2) if abs(a[2] - b[2]) >= 2)
    pivots, prefix, end = sv.signature("papapapapa", np.zeros(sv.GRAM_BUCKETS, dtype=np.int64))
    assert len(prefix) == 4 and end["gram"] == "ap"  # ties with the third all belong to it
    assert sv.signature("abc", np.zeros(sv.GRAM_BUCKETS)) is None


def test_query_equals_brute_force(spark, docs):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdeéßn") for _ in range(rng.choice([6, 7, 9, 14]))) for _ in range(60)]
    rows = []
    for i in range(300):
        words = rng.choices(base, weights=[1 + 40 // (k + 1) for k in range(len(base))], k=40)
        rows.append((i, " ".join(edited(rng, w, "abc") if rng.random() < 0.25 else w.upper() if rng.random() < 0.1 else w for w in words)))
    rows += [(400, None), (401, ""), (402, "k" * 20_000), (None, f"{base[0]} " * 30), (403, f"{base[1]}-{base[1]}9{base[1]}_ÀÉßÿ×÷ " * 6)]
    rows += [(404, "samesame samesame")] * 4
    d = docs([(*r, "en", "s", 1, "w", 3) for r in rows], ", word string, n int")
    want = grouped(counted(rows))
    assert sorted(tuple(r) for r in sv.variants(d).select("word", "form", "root", "n", "n_near", "form_n").collect()) == want
    assert sum(r[1] is not None for r in want) > 10
    con = duckdb.connect()
    con.register("documents", d.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    assert sorted(con.sql(sv.oracle()).fetchall()) == want


def test_forms_lead_to_a_root(spark):
    words = ["stonea", "stone", "stoneab", "stoneabc", "stoneabcd", "stoneabcde", "stoneabcdef"]
    rows = [(w, 5 ** (9 - k)) for k, w in enumerate(sorted(words, key=len))]
    got = {r["word"]: r for r in sv.group(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert {r["root"] for r in got.values()} == {"stone"} and got["stone"]["form"] is None
    assert got["stoneabcdef"]["form"] == "stoneabcde" and got["stoneab"]["n_near"] == 2


def test_ties_and_empty_tables(spark, docs):
    rows = [("stonex", 1), ("stoney", 50), ("stonez", 50), ("lonely", 3)]
    got = {r["word"]: r for r in sv.group(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got["stonex"]["form"] == "stoney" and got["stoney"]["form"] is None and got["lonely"]["n_near"] == 0
    assert sv.variants(docs([])).count() == 0
    assert sv.variants(docs([(1, "one two")])).count() == 0
