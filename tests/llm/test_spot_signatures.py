import hashlib
import random
import re
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

from tallystar.llm import spot_signatures as ss

VOCABULARY = ["house", "campaign", "Wealth", "river", "stone", "light", "tower", "bridge", "winter", "garden"]


def spots(text, chain=2, distance=1):
    plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\W_]+", plain)
    out = set()
    for i, w in enumerate(words):
        follow = [x for x in words[i + 1:] if x not in ss.ANCHORS][::distance][:chain]
        if w in ss.ANCHORS and follow:
            out.add(":".join([w, *follow]))
    if not out:
        out = {"=" + " ".join(words) if words else "#" + plain}
    return sorted(hashlib.md5(s.encode()).hexdigest()[:16] for s in out)


def jaccard(a, b):
    return len(set(a) & set(b)) / len(set(a) | set(b))


def prose(rng, n):
    return " ".join(rng.choice(ss.ANCHORS if rng.random() < 0.4 else VOCABULARY) for _ in range(n))


def expected(rows):
    """Digest of (doc_id, text) rows without repeated ids."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    out = []
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = spots(text), spots(edited), spots(after)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), " ".join(a), " ".join(b), jaccard(a, b), jaccard(a, c)))
    return sorted(out)


def test_digest_equals_brute_force(docs):
    rng = random.Random(2)
    rows = [(i * i - 40, prose(rng, rng.choice([0, 1, 2, 9, 40, 120])) + rng.choice(["", ".", " é£𝒳 %"])) for i in range(150)]
    rows += [(90_000, None), (90_001, ""), (90_002, "the of and"), (90_003, "#!? \n"), (90_004, "the " * 1_500), (90_005, "x" * 50_000)]
    d = docs([(*r, "en", "s", 1, "f") for r in rows], ", fingerprint string")
    got = sorted(tuple(r) for r in ss.digest(d).collect())
    assert got == expected(rows)


@pytest.mark.parametrize("chain,distance", [(1, 1), (2, 2), (3, 1)])
def test_chain_length_and_distance(docs, chain, distance):
    rng = random.Random(chain)
    rows = [(i, prose(rng, 30)) for i in range(20)]
    got = docs(rows).select("text", ss.spots(F.col("text"), chain=chain, distance=distance).alias("s")).collect()
    assert [r["s"] for r in got] == [spots(r["text"], chain, distance) for r in got]


def test_sql_says_the_same(spark, docs):
    rng = random.Random(5)
    d = docs([(i, prose(rng, 50)) for i in range(40)] + [(50, None), (51, " ")])
    con = duckdb.connect()
    con.register("documents", d.toPandas())
    want = con.sql(ss.oracle()).fetchall()
    assert sorted(tuple(r) for r in ss.digest(d).collect()) == sorted(want)


def test_next_document_over_many_ranges(spark):
    for ids in ([5], [1, 2], list(range(0, 3000, 7)), [0] * 5 + [9] * 400 + [11, 12], [None, None, 3]):
        d = spark.createDataFrame([(i, f"t{k:04d}") for k, i in enumerate(ids)], "doc_id long, text string").repartition(5)
        got = ss.with_next(d).collect()
        follow = {r["text"]: r["next_text"] for r in got}
        id_of = {f"t{k:04d}": i for k, i in enumerate(ids)}
        assert len(got) == len(ids) and sorted(follow.values()) == sorted(id_of)
        at, ring = got[0]["text"], []
        for _ in ids:
            ring.append(-1 if id_of[at] is None else id_of[at])
            at = follow[at]
        assert at == got[0]["text"] and len(ring) == len(ids)  # one ring over all rows, and one step up in it
        assert sum(a < b for a, b in zip(ring, ring[1:] + ring[:1])) == (len(set(ring)) > 1)


def test_empty_table_and_missing_ids(docs):
    assert ss.digest(docs([])).count() == 0
    got = ss.digest(docs([(None, "the house of stone"), (None, None), (3, "the river"), (3, "the river")])).collect()
    assert len(got) == 4 and sum(r["doc_id"] is None for r in got) == 2


def test_similar_equals_brute_force(docs):
    rng = random.Random(8)
    rows = []
    for base in range(12):
        words = prose(rng, rng.choice([30, 60, 200])).split()
        for k in range(rng.choice([1, 2, 6])):
            w = list(words)
            for _ in range(k * len(w) // 40):
                w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
            rows.append((base * 10 + k, " ".join(w)))
    rows += [(500 + i, rows[0][1]) for i in range(30)] + [(600, None), (601, ""), (602, "a b"), (None, "the lone house")]
    for threshold in (0.5, 0.8, 1.0):
        members, links = ss.similar(docs(rows), threshold)
        sets = {i: spots(t) for i, t in rows if i is not None}
        class_of = {i: min(j for j in sets if sets[j] == s) for i, s in sets.items()}
        assert {r["doc_id"]: r["class_id"] for r in members.collect()} == class_of
        reps = sorted(set(class_of.values()))
        want = {(a, b): jaccard(sets[a], sets[b]) for a, b in combinations(reps, 2) if jaccard(sets[a], sets[b]) >= threshold}
        got = {(r["class_a"], r["class_b"]): r["similarity"] for r in links.collect()}
        assert got == pytest.approx(want) and (want or threshold == 1.0)


def test_likeness_prunes_by_size_only(spark):
    d = spark.createDataFrame([(["a", "b"], ["a", "b", "c"])], "x array<string>, y array<string>")
    got = d.select(ss.likeness(F.col("x"), F.col("y"), 0.6).alias("in"), ss.likeness(F.col("x"), F.col("y"), 0.7).alias("out")).first()
    assert got["in"] == pytest.approx(2 / 3) and got["out"] == 0.0
