import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tallystar.llm import periodic_runs as pr


def brute(x):
    """Every run (start, length, period), period by period and word by word."""
    out = []
    for q in range(1, len(x) // 2 + 1):
        k = 0
        while k + q < len(x):
            s = k
            while k + q < len(x) and x[k] == x[k + q]:
                k += 1
            length = k - s + q
            if length >= max(12, 2 * q) and not any(
                    all(x[s + i] == x[s + i + d] for i in range(length - d)) for d in range(1, q)):
                out.append((s, length, q))
            k += k == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def edited(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = edited(doc_id, re.findall("[^\x20\x09-\x0D]+", text or ""))
    runs = brute(words)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def random_words(rng):
    n, k = rng.choice([0, 1, 11, 12, 13, 24, 60, 150, 260]), rng.choice([1, 2, 3, 5, 40])
    x = [rng.randrange(k) for _ in range(n)]
    if n > 12 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + rng.randrange((n - a) // 2 + 1)
        x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.4:
            x[rng.randrange(n)] = 99
    return x


def test_runs_equal_brute_force():
    rng = random.Random(7)
    texts = [random_words(rng) for _ in range(400)]
    got = pr.find_runs([np.array(t, dtype=np.int64) for t in texts])
    assert sum(map(len, got)) > 100
    assert got == [brute(t) for t in texts]


def test_long_texts_and_all_scales():
    rng = random.Random(3)
    for n, k in ((1500, 2), (1200, 3), (900, 1)):
        x = [rng.randrange(k) for _ in range(n)]
        assert pr.find_runs([np.array(x)])[0] == brute(x)
    for q in (1, 2, 5, 6, 7, 13, 14, 15, 30, 31, 62, 63, 400):
        x = [1000 + i for i in range(17)] + [rng.randrange(10 ** 6) for _ in range(q)] * 2 + [5] * 3
        want = brute(x)
        assert pr.find_runs([np.array(x)])[0] == want
        assert any(r[2] == q for r in want) == (2 * q >= 12)


def test_capped_blocks_find_long_periods(monkeypatch):
    monkeypatch.setattr(pr, "LONGEST_BLOCK", 4)
    rng = random.Random(4)
    for _ in range(20):
        x = random_words(rng) + [rng.randrange(10 ** 6) for _ in range(rng.randrange(5, 70))] * 2
        assert pr.find_runs([np.array(x)])[0] == brute(x)


@pytest.mark.parametrize("n", [2, 8, 64])
def test_transform_products_are_exact(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(0, pr.PRIME, (n, 3)), rng.integers(0, pr.PRIME, (n, 3))
    t = pr.Transform(n)
    assert (t.backward(t.forward(a)) == a).all()
    got = t.backward(t.forward(a) * t.forward(b) % pr.PRIME)
    for c in range(3):
        assert got[:, c].tolist() == [sum(int(a[i, c]) * int(b[(k - i) % n, c]) for i in range(n)) % pr.PRIME for k in range(n)]


def test_query_equals_brute_force(docs):
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{v}" for v in random_words(rng)) or None) for i in range(120)]
    rows += [(200, ""), (201, " \t\n"), (202, "a " * 4000), (203, "x y " * 9 + "z" * 50_000), (204, "b c " * 7),
             (204, "b c " * 7), (None, "a b " * 10), (205, None)]
    d = docs([(*r, "en", "s", 1, 5, "r") for r in rows], ", runs int, row string")
    got = [tuple(r) for r in pr.digest(d).collect()]
    key = lambda r: (r[0] is None, r[0], r[6])
    assert sorted(got, key=key) == sorted((expected(*r[:2]) for r in rows), key=key)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and t for i, t in rows[:120])


def test_detect_keeps_columns_and_takes_an_empty_table(docs):
    d = docs([(1, "go on " * 8 + "now")])
    r = pr.detect(d).first()
    assert r["row"]["doc_id"] == 1 and r["n_words"] == 17 and r["collapsed"] == "go on now"
    assert [tuple(v) for v in r["runs"]] == [(0, 16, 2)]
    assert pr.digest(docs([])).count() == 0
