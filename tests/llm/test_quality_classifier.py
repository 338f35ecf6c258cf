import random
import zlib

from tallystar.llm import quality_classifier as qc


def prose(rng, n):
    return " ".join(rng.choice(["the", "river", "town", "walks", "quietly", "over", "old", "stones"]) for _ in range(n)) + "."


def junk(rng, n):
    return " ".join(w + rng.choice(["***", "&&&", "%%%"]) for w in prose(rng, n).split())


def corpus(n=300):
    rng = random.Random(1)
    out = []
    for i in range(n):
        good = i % 4 != 0
        out.append((i, (prose if good else junk)(rng, rng.randint(5, 60)), int(good)))
    return out


def test_learns_on_its_folds_and_scores_held_out_rows(docs, labels):
    rows = corpus()
    got = qc.classify(docs([r[:2] for r in rows]), labels([(i, q, 0) for i, _, q in rows])).collect()
    assert len(got) == len(rows)
    truth = {i: q for i, _, q in rows}
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95


def test_held_out_labels_do_not_move_a_score(docs, labels):
    rows = corpus(120)
    d = docs([r[:2] for r in rows])
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 0) for i, _, q in rows]
    a = {r["doc_id"]: r["score"] for r in qc.classify(d, labels([(i, q, 0) for i, _, q in rows])).collect()}
    b = {r["doc_id"]: r["score"] for r in qc.classify(d, labels(flipped)).collect()}
    assert a == b


def test_nulls_empty_long_and_repeated_rows(docs, labels):
    rows = corpus(80)
    odd = [(900, None), (901, ""), (902, "word " * 200_000), (903, "same text here"), (903, "same text here"), (None, "x")]
    d = docs([r[:2] for r in rows] + odd)
    got = qc.classify(d, labels([(i, q, 0) for i, _, q in rows] + [(900, None, None), (5, 0, 0), (5, 1, 0)])).collect()
    assert len(got) == len(rows) + len(odd)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["score"])
    assert by[900] == by[901] and len(set(by[903])) == 1


def test_empty_tables_one_class_and_extra_columns(spark, docs, labels):
    none = docs([])
    assert qc.classify(none, labels([])).count() == 0
    d = docs([(1, "a b c", "en", "s", 5, 0.5, 1)], ", score double, predicted int")
    assert qc.classify(d, labels([])).first()["score"] == 0.5
    one = qc.classify(d, labels([(1, 1, 0)])).first()
    assert 0.5 <= one["score"] <= 1
    kept = qc.keep_good(d, labels([(1, 1, 0)]))
    assert kept.columns == d.columns and kept.collect() == d.collect()


def test_dual_descent_separates():
    model = qc.fit([([b"good", b"x"], 1)] * 20 + [([b"bad", b"x"], 0)] * 20)
    assert model.score("good x") > 0.9 > 0.1 > model.score("bad x")


def test_long_texts_keep_all_their_shared_grams(docs, labels):
    rng = random.Random(2)
    long = " ".join(f"rare{k}" for k in range(6000))
    rows = [(i, prose(rng, 20), 1) for i in range(40)] + [(100 + i, long + f" only{i}", 0) for i in range(4)]
    model = qc.train(docs([r[:2] for r in rows]), labels([(i, q, 0) for i, _, q in rows]))
    assert all(f"rare{k}".encode() in model.weight for k in range(6000))
    assert not any(g.startswith(b"only") for g in model.weight)
    whole = qc.fit([(qc.grams(t), q) for _, t, q in sorted(rows)])
    assert model.weight.keys() == whole.weight.keys()
    assert all(abs(model.score(t) - whole.score(t)) < 1e-6 for _, t, _ in rows)
