import contextlib
import io
import math
import random
import re

import duckdb
import numpy as np
import pytest

from tallystar.llm import topk_search as tk

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k):
    best = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            best[i] = min(best.get(i, v), v)
    ints = {i: [math.floor(64 * x) for x in v] for i, v in best.items()}
    out = []
    for q, a in ints.items():
        if q % 20 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in ints.items() if c != q and len(a) == len(b))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, k=20):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in tk.search(df, k=k).collect())


@pytest.mark.parametrize("dim,scale", [(8, 1.0), (64, 0.2), (3, 1e6), (5, 5e6)])
def test_matches_brute_force(spark, monkeypatch, dim, scale):
    monkeypatch.setattr(tk, "BLOCK", 40)
    monkeypatch.setattr(tk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(tk, "FAN", 2)
    rng = random.Random(dim)
    rows = [(i * 2, [rng.gauss(0, scale) for _ in range(dim)], 0) for i in range(300)]
    assert run(spark, rows, 7) == brute(rows, 7)


def test_ties_bad_vectors_and_few_candidates(spark):
    one = [0.5, -0.25]
    rows = [(i, one, 0) for i in range(90)]
    rows += [(200, None, 1), (220, [None, 1.0], 1), (240, [float("nan"), 1.0], 1), (260, [float("inf"), 1.0], 1), (None, one, 1),
             (300, [1.0, 2.0, 3.0], 1), (301, [1.0, 0.0, 3.0], 1), (400, [9.0], 1), (1, [-9.0, 9.0], 1), (0, one, 1), (500, [], 1), (501, [], 1)]
    got = run(spark, rows)
    assert got == brute(rows, 20)
    assert [r[2] for r in got if r[0] == 0][:3] == [2, 3, 4]  # ties: smaller ids first; id 1 counts with its least vector
    assert [r for r in got if r[0] == 300] == [(300, 1, 301, 64 * 64 * 10)]


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(0, [1.0], 5, 6, 7), (1, [2.0], 5, 6, 7)], "vec_id long, embedding array<float>, rank int, score long, dim int")
    assert [tuple(r) for r in tk.search(df).collect()] == [(0, 1, 1, 8192)]


def test_oracle_sql(spark):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(16)], 0) for i in range(120)]
    con = duckdb.connect()
    con.register("embeddings", spark.createDataFrame(rows, SCHEMA).toArrow())
    assert run(spark, rows) == sorted(con.sql(tk.oracle()).fetchall())


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_no_block_is_broadcast_or_repeated_for_each_block_it_meets(spark, monkeypatch):
    """The query blocks, repeated for every candidate block, looked small enough to broadcast: out of memory."""
    monkeypatch.setattr(tk, "BLOCK", 4)
    monkeypatch.setattr(tk, "QUERY_BLOCK", 4)
    plans, written, kept = [], [], tk.stored

    def stored(df, name):
        plans.append(plan(df))
        written.append((out := kept(df, name)).count())
        return out

    monkeypatch.setattr(tk, "stored", stored)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)], 0) for i in range(400)]
    found = tk.search(spark.createDataFrame(rows, SCHEMA), k=3, is_query=tk.F.col("vec_id") % 2 == 0)
    for p in [*plans, plan(found)]:
        lines = p.splitlines()
        depth = [len(re.match(r"[ :]*", x)[0]) for x in lines]
        for i, x in enumerate(lines):
            if "BroadcastExchange" in x:
                below = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
                assert not re.search(r"\bdata#|Generate", "\n".join(lines[i:below]))
    assert max(written) <= 400  # 50 query blocks meet 100 candidate blocks


@pytest.mark.parametrize("cell", [1, 700, 32 << 20])
def test_cells_of_any_size(spark, monkeypatch, cell):
    """Blocks without rows, equal vectors in many cells, lists merged in several rounds."""
    monkeypatch.setattr(tk, "BLOCK", 2)
    monkeypatch.setattr(tk, "QUERY_BLOCK", 1)
    monkeypatch.setattr(tk, "FAN", 3)
    monkeypatch.setattr(tk, "CELL", cell)
    rng = random.Random(1)
    some = [[rng.gauss(0, 0.3) for _ in range(5)] for _ in range(4)]
    rows = [(i * 4, rng.choice(some), 0) for i in range(40)] + [(i * 10 + 1000, [rng.gauss(0, 0.3) for _ in range(3)], 0) for i in range(6)]
    assert run(spark, rows, 6) == brute(rows, 6)


@pytest.mark.parametrize("dim,scale", [(1, 20), (7, 20), (7, 2 ** 20), (7, 2 ** 28), (0, 1)])
def test_phases_on_one_cell(monkeypatch, dim, scale):
    monkeypatch.setattr(tk, "_ROWS", 5)
    monkeypatch.setattr(tk, "_COLUMNS", 16)
    monkeypatch.setattr(tk, "_HELD", 20)
    rng, k = np.random.default_rng(dim), 3
    c = rng.integers(-scale, scale, (90, dim))
    c[40:80] = c[40]  # many ties
    c_ids = np.arange(90) * 2
    q_ids, q = c_ids[35:47], c[35:47]
    truth = {int(i): sorted((-int(x @ y), int(j)) for j, y in zip(c_ids, c) if j != i)[:k] for i, x in zip(q_ids, q)}
    lists = tk.local_lists(q_ids, q, c_ids, c, k)
    cutoff = lists.min(axis=1)
    for i, least in zip(q_ids, cutoff):
        assert least <= -truth[int(i)][-1][0]  # k candidates reach it
    for limit in (cutoff, np.full(len(q), tk._NONE)):
        got = {}
        for i, j, score in sorted(zip(*(x.tolist() for x in tk.sufficient(q_ids, q, c_ids, c, limit, k))), key=lambda x: (-x[2], x[1])):
            got.setdefault(i, []).append((-score, j))
        assert got == truth


def test_packed_lists():
    for held in ([[5, -3, tk._NONE]], [[127, -127, -128]], [[2 ** 40, tk._NONE, -1]], [[tk._NONE] * 3], [[2 ** 63 - 1, tk._NONE + 1, 0]]):
        lists, kind = tk._packed(np.array(held))
        schema = tk.pa.scalar(lists, tk.pa.binary()), tk.pa.scalar(kind)
        assert tk._unpacked(*schema, 3).tolist() == held


def test_places():
    rng = np.random.default_rng(2)
    for shape in ((3, 8), (5, 7), (4, 64), (1, 0)):
        mask = rng.random(shape) < 0.2
        assert tk._places(mask).tolist() == np.flatnonzero(mask).tolist()
