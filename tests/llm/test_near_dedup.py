import random
import re

import numpy as np
import pytest

from tallystar.llm import near_dedup as nd


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + 4]) for k in range(max(1, len(words) - 3)))


def brute(rows):
    sets, parent = {}, {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, set()).add(shingles(t))
            parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {i: find(i) for i in ids}


def variants(seed=2):
    """Chains, stars and loose relatives of a few base texts."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows, i = [], 0
    for _ in range(6):
        base = [rng.choice(words) for _ in range(rng.randint(20, 90))]
        for _ in range(12):
            rows.append((i, " ".join(base)))
            i += rng.randint(1, 3)
            if rng.random() < 0.8:
                base = list(base)
                for _ in range(rng.randint(0, 2)):
                    base[rng.randrange(len(base))] = rng.choice(words)
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(docs):
    rows = variants()
    got = nd.near_duplicates(docs(rows)).collect()
    want, sets = brute(rows), dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == want[r["doc_id"]]
        assert r["n_shingles"] == len(shingles(sets[r["doc_id"]]))
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_blocks_match_brute_force(docs, monkeypatch):
    monkeypatch.setattr(nd, "SMALL", 1)
    monkeypatch.setattr(nd, "BLOCK", 3)
    rng = random.Random(8)
    base = [f"v{k}" for k in range(100)]
    rows = []
    for i in range(60):  # edits spread so that many pairs stay below the threshold
        text = list(base)
        for _ in range(rng.randint(0, 8)):
            text[rng.randrange(len(text))] = f"u{rng.randint(0, 40)}"
        rows.append((i, " ".join(text)))
    got = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(docs(rows)).collect()}
    want = brute(rows)
    assert len(set(want.values())) > 3 and got == want


def test_hot_groups_of_copies_and_near_copies(docs):
    rng = random.Random(4)
    base = [rng.choice("abcdefgh") + str(rng.randint(0, 500)) for _ in range(120)]
    rows = [(i, " ".join(base)) for i in range(0, 120)]
    for i in range(200, 320):
        near = list(base)
        near[rng.randrange(len(near))] = f"z{i}"
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join(f"{i}x{k}" for k in range(50))) for i in range(400, 420)]
    got = {r["doc_id"]: r["component_id"] for r in nd.near_duplicates(docs(rows)).collect()}
    assert got == brute(rows)


def test_null_empty_short_repeated_and_long(docs):
    long = " ".join(f"t{k}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One Two"), (5, "one  two"), (6, "one two three"), (7, long), (8, long + " end"),
            (9, "p q r s t"), (9, "u v w x y"), (10, "u v w x y"), (None, "one two"), (11, "é É x y z"), (12, "é é x y z")]
    got = nd.near_duplicates(docs(rows)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]]
    assert want[5] == 4 and want[8] == 7 and want[10] == 9 and want[12] == 12


def test_empty_table_and_extra_columns(docs):
    assert nd.near_duplicates(docs([])).count() == 0
    d = docs([(2, "a b c d", "en", "s", 7, True, 9), (1, "a b c d", "en", "s", 7, True, 9), (3, "other", "en", "s", 5, False, 8)],
             ", kept boolean, component_id long")
    out = nd.keep_one(d)
    assert out.columns == d.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3]
    twice = docs([(1, "a b c d"), (1, "a b c d"), (2, "z")])
    assert sorted(r["doc_id"] for r in nd.keep_one(twice).collect()) == [1, 2]


def test_bounds_keep_similar_pairs():
    assert all(nd.least_matches(n) <= 0.8 * n for n in range(nd.BATCH, nd.LANES + 1, nd.BATCH))
    a = np.arange(nd.LANES * 2).reshape(2, -1).astype("<u2")
    b = a.copy()
    b[1, ::2] += 1  # half the lanes differ
    assert nd.survives(a, b).tolist() == [True, False]
    assert (1 - 0.8 ** nd.ROWS) ** nd.BANDS < 1e-6


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (9, 8), (3, 10)], [(k, k + 1) for k in range(40)]])
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in
           nd.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for a, b in edges:
        want.setdefault(a, a), want.setdefault(b, b)
    for _ in want:
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want
