import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallystar.llm import rule_forest as rf


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            inside.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside))


def random_texts(n=300):
    rng = random.Random(3)
    parts = ["a", "b", "ab", "é", " ", " ", "#", "*", "|x", "\n", "\n", " ", "  ", "\t", "\r\n", "\x0b", "\x1c", "\x85", "字"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def test_counts_match_brute_force():
    for text in [*random_texts(), None, "", "a b c d e a b c d e", "x\nx\n \n \nx"]:
        assert rf.stats(text)[0] == brute(text)


def corpus():
    rng = random.Random(5)
    words = ["the", "river", "town", "walks", "quietly", "over", "old", "stones", "and", "sees", "many", "lights"]
    rows = []
    for i in range(400):
        w = [rng.choice(words) + rng.choice(words) for _ in range(rng.randint(15, 120))]
        bad = i % 10 == 0
        rows.append((i, " ".join(x + "***" if bad else x for x in w) + ".", int(not bad)))
    return rows


def test_forest_rejects_anomalies_and_keeps_clean_rows(docs, labels):
    rows = corpus()
    got = {r["doc_id"]: r for r in rf.judge(docs([r[:2] for r in rows]), labels([(i, q, 0) for i, _, q in rows if i % 2 == 0])).collect()}
    for i, t, _ in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(t)
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    caught = [got[i]["kept"] for i, _, q in rows if not q]
    clean = [got[i]["kept"] for i, _, q in rows if q and not got[i]["base_failed"]]
    assert sum(caught) <= 2 and sum(clean) / len(clean) > 0.98


def test_edge_rows_and_tables(docs, labels):
    assert rf.judge(docs([]), labels([])).count() == 0
    rows = [(1, None), (2, ""), (3, "one two " * 60_000), (4, "a b c d e f g h i j k"), (4, "a b c d e f g h i j k"), (None, "x" * 100_000)]
    d = docs([(i, t, None, None, None, True, 1.0) for i, t in rows], ", kept boolean, features double")
    got = rf.judge(d, labels([])).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["base_failed"] and by[2]["base_failed"] and by[3]["base_failed"] and by[4]["kept"]


def test_outside_points_have_short_paths():
    rng = np.random.default_rng(0)
    inside = rng.normal(0, 0.05, (500, 2))
    forest = rf.grow(inside, np.array([-1.0, -1.0]), np.array([1.0, 1.0]))
    assert forest.score(np.array([[0.9, 0.9]]))[0] > forest.score(inside).max()
    assert rf.calibrate(np.array([0.1, 0.2, 0.9]), np.array([True, True, False]), 1.0) > 0.2


def test_scores_equal_the_walk_down_every_tree():
    rng = np.random.default_rng(4)
    points = rng.normal(0, 1, (60, 3))
    points[:, 2] = 0.5  # constant
    forest = rf.grow(points, np.full(3, -4.0), np.full(3, 4.0), trees=20, subsample=32, depth_limit=7, seed=3)
    asked = np.concatenate([points[:10], rng.normal(0, 3, (20, 3)), [[np.inf, -np.inf, 0.5]]])

    def walk(x, tree):
        feature, cut, left, right, depth = tree
        at = steps = 0
        while feature[at] >= 0:
            at = left[at] if x[feature[at]] <= cut[at] else right[at]
            steps += 1
        assert steps <= 7 and depth[at] >= steps
        return depth[at]
    want = [2 ** (-np.mean([walk(x, t) for t in forest.trees]) / forest.norm) for x in asked]
    assert np.allclose(forest.score(asked), want, rtol=1e-12)


def test_leaves_count_the_sample_points_that_reach_them():
    points = np.random.default_rng(1).normal(0, 1, (40, 2))
    forest = rf.grow(points, np.full(2, -4.0), np.full(2, 4.0), trees=5, subsample=40, depth_limit=3)

    def depths(tree, rows, at=0, d=0):
        feature, cut, left, right, depth = tree
        if feature[at] < 0:
            assert np.isclose(depth[at], d + rf._path_norm(len(rows)))
            return
        low = rows[:, feature[at]] <= cut[at]
        span = rows[:, feature[at]]
        assert span.min() - 0.4 <= cut[at] <= span.max() + 0.4  # MARGIN of a span of 8
        depths(tree, rows[low], left[at], d + 1)
        depths(tree, rows[~low], right[at], d + 1)
    for tree in forest.trees:
        depths(tree, points)


def test_an_extreme_document_changes_no_other_verdict(docs, labels):
    rows = corpus()
    marks = [(i, q, 0) for i, _, q in rows if i % 2 == 0]
    extreme = (9000, " ".join(f"w{i}" for i in range(40)) + " " + "$" * 100_000)
    for seed in range(11, 17):
        def kept(extra, more=()):
            got = rf.judge(docs([r[:2] for r in rows] + extra), labels(marks + list(more)), seed=seed).collect()
            return {r["doc_id"]: r["kept"] for r in got}
        plain, with_it = kept([]), kept([extreme])
        assert with_it.pop(9000) is False and with_it == plain
        if seed == 11:  # nor when it is labelled bad
            marked = kept([extreme], [(9000, 0, 0)])
            assert marked.pop(9000) is False and sum(marked[i] != plain[i] for i in plain) <= len(plain) // 100
        caught = [plain[i] for i, _, q in rows if not q]
        assert sum(caught) <= 2


def test_every_tree_draws_from_all_rows(spark):
    n = 5000
    rows = spark.range(n).select(F.col("id").alias("doc_id"),
                                 F.array(*[F.col("id").cast("double")] * len(rf.FEATURES)).alias("features"))
    drawn = rf.subsamples(rows, trees=100, size=256)
    assert len(drawn) == 100 and all(len(x) == len(set(x[:, 0])) == 256 for x in drawn)
    assert len({v for x in drawn for v in x[:, 0]}) > 0.98 * n  # 25,600 draws miss 0.5 % of the rows
    again = rf.subsamples(rows.repartition(7), trees=100, size=256)
    assert all((a == b).all() for a, b in zip(drawn, again))
    few = rf.subsamples(rows.limit(40), trees=3, size=256)
    assert [len(x) for x in few] == [40] * 3
    # copies of one row hash alike: still as many rows a tree as asked for
    copies = rows.where("doc_id < 300").union(rows.where("doc_id = 7").crossJoin(spark.range(4000)).drop("id"))
    assert all(len(x) == 256 for x in rf.subsamples(copies, trees=3, size=256))


def test_the_threshold_reads_every_labelled_row(spark):
    rng = np.random.default_rng(8)
    for n in (1, 3, 25_000):  # the last beyond the 20,000 rows once read
        scores, good = np.round(rng.beta(2, 5, 2 * n), 3 if n < 1000 else 9), np.arange(2 * n) % 2 == 0
        scores[~good] += 0.4
        df = spark.createDataFrame([(int(g), float(s)) for g, s in zip(good, scores)], "q int, anomaly double")
        for keep in (0.995, 1.0):
            assert rf.threshold(df, keep) == rf.calibrate(scores, good, keep)
    for q in (0, 1):
        assert rf.threshold(df.where(F.col("q") == q), 0.995) == np.inf
