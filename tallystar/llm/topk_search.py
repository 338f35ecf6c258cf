"""Exact top-k search by inner product: a three-phase uniform threshold.

Vectors become integer vectors floor(64 x). Candidates and queries are dealt by
hash into blocks (integer matrices). Some query blocks and some candidate blocks
meet in a cell, each a group of its own; a block goes once to each cell it is
part of, not to each block it meets, and none is broadcast. A cell holds as many
candidate blocks as leave four cells a core, and at most ``CELL`` bytes of either
side. A vector's score is the sum of ``LISTS`` partial scores, one a slice of the
dimensions.

1. Each cell gathers local score lists: for every query the ``k`` best of
   each partial score list, resolved to total scores. The k-th best total over
   all cells is a safe cutoff t: k candidates reach it.
2. The cutoff goes back to the cells. A candidate that reaches t has some
   partial score of at least t / LISTS (the uniform threshold), so these
   entries suffice; they are collected.
3. The other partial scores of collected entries are resolved exactly; those
   that reach t enter the final ranking (ties to the smaller vec_id).

Both phases multiply every query with every candidate, tile by tile: the time is
in proportion to their product. Memory is bounded by the cell.

Arithmetic is exact: float matrices while every sum stays below their integer
range, 64-bit integers beyond.

Defined cases: vectors that are null or hold a null or non-finite component,
and rows without vec_id, take no part. Rows that repeat a vec_id count once,
with the vector that sorts first. Vectors meet only vectors of their length. A
query with fewer than k candidates gets them all; one without any gets no row.
Extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from .common import shipped, stored

K = 20
SCALE = 64
LISTS = 2
BLOCK = 4096               # candidates of a block
QUERY_BLOCK = 2048
FAN = 64                   # score lists merged at a time
CELL = 32 << 20            # bytes of the candidate blocks, and of the query blocks, of a cell
_ROWS = 256                # queries multiplied at a time
_COLUMNS = 1024            # candidates multiplied at a time
_HELD = 1 << 16            # entries collected before the k best are kept


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, v: one finite integer vector (as doubles) for each id."""
    x = F.col("embedding")
    usable = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double")) != F.lit(float("inf"))))
    return (vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(usable)
            .groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(x).alias("v"))
            .select("vec_id", F.size("v").alias("dim"),
                    F.transform("v", lambda c: F.rint(F.floor(c.cast("double") * SCALE).cast("double"))).alias("v")))


def _least_kind(most: float) -> str:
    return next(k for k, top in (("<i1", 2 ** 7), ("<i2", 2 ** 15), ("<i4", 2 ** 31), ("<i8", np.inf)) if most < top)


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """dim, block, ids, data, kind, n_blocks, n_bytes: the rows of each hashed block as one matrix."""
    counts = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # by length
    spark = rows.sparkSession
    many = spark.createDataFrame([(d, -(-n // size)) for d, n in counts.items()], "dim int, n_blocks int")

    def matrix(part: pa.Table) -> pa.Table:
        order = np.argsort(part.column("vec_id").to_numpy(), kind="stable")
        ids = part.column("vec_id").to_numpy()[order].astype("<i8")
        dim = part.column("dim")[0].as_py()
        flat = part.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        values = flat.reshape(len(ids), dim)[order]
        most = float(np.abs(values).max()) if values.size else 0.0
        kind = _least_kind(most)
        data = values.astype(kind).tobytes()
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([part.column("block")[0].as_py()], pa.int64()),
                         "ids": pa.array([ids.tobytes()], pa.binary()),
                         "data": pa.array([data], pa.binary()),
                         "kind": pa.array([kind], pa.string()), "n_blocks": part.column("n_blocks").slice(0, 1).combine_chunks(),
                         "n_bytes": pa.array([len(data) + ids.nbytes], pa.int64())})

    dealt = (rows.join(F.broadcast(many), "dim")
             .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("n_blocks").cast("long"))))
    return stored(shipped(dealt).groupBy("dim", "block").applyInArrow(
        matrix, "dim int, block long, ids binary, data binary, kind string, n_blocks int, n_bytes long"), name)


def _matrices(part: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ids and the matrix of each block."""
    for ids, data, kind, dim in zip(*(part.column(c) for c in ("ids", "data", "kind", "dim"))):
        ids = np.frombuffer(ids.as_buffer(), dtype="<i8")
        yield ids, np.frombuffer(data.as_buffer(), dtype=kind.as_py()).reshape(len(ids), dim.as_py())


def _joined(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The ids, ascending, and the matrix of all blocks."""
    ids, values = (np.concatenate(x) for x in zip(*_matrices(part)))
    order = np.argsort(ids, kind="stable")
    return ids[order], values[order]


def _most(x: np.ndarray) -> float:
    return float(max(x.max(initial=0), -float(x.min(initial=0))))


def _exact(a: np.ndarray, b: np.ndarray) -> type:
    """The type in which every sum of products is exact."""
    most = float(a.shape[1]) * (_most(a) * _most(b))
    return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64


def _slices(dim: int) -> list[slice]:
    cuts = np.linspace(0, dim, LISTS + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts, cuts[1:]) if b > a] or [slice(0, 0)]


def _tiles(q: np.ndarray, c: np.ndarray, kind: type) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The partial scores of the queries ``q`` and some candidates at a time, with the place of the first of these."""
    slices = _slices(q.shape[1])
    held = [q[:, s].astype(kind) for s in slices]
    made = [np.empty((len(q), min(len(c), _COLUMNS)), dtype=kind) for _ in slices]  # each tile overwrites the last
    for at in range(0, len(c), _COLUMNS):
        some = c[at:at + _COLUMNS].astype(kind)
        if len(some) < made[0].shape[1]:
            made = [np.empty((len(q), len(some)), dtype=kind) for _ in slices]
        yield at, [np.matmul(x, some[:, s].T, out=p) for x, s, p in zip(held, slices, made)]


def _places(mask: np.ndarray) -> np.ndarray:
    """``np.flatnonzero``, eight at a time: few are true."""
    if mask.size % 8:
        return np.flatnonzero(mask)
    eights = mask.reshape(-1, 8)
    some = np.flatnonzero(eights.view(np.uint64))
    return (some[:, None] * 8 + np.arange(8))[eights[some]]


_NONE = np.iinfo(np.int64).min
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _extended(values: np.ndarray, places: np.ndarray, p: np.ndarray, at: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n best entries of each row of a score list and of its next partial scores ``p``, whose places begin at ``at``."""
    if values.shape[1] < n:
        new, found = p, np.broadcast_to(np.arange(at, at + p.shape[1]), p.shape)
    else:  # a full list: only what beats its least entry
        which = _places(p > values.min(axis=1)[:, None])
        row, col = np.divmod(which, p.shape[1])
        count = np.bincount(row, minlength=len(p))
        slot = np.arange(len(row)) - (np.cumsum(count) - count)[row]
        new = np.full((len(p), count.max(initial=0)), -np.inf if p.dtype.kind == "f" else _NONE, dtype=p.dtype)
        found = np.full(new.shape, -1)
        new[row, slot], found[row, slot] = p.ravel()[which], at + col
    values, places = np.concatenate((values, new), axis=1), np.concatenate((places, found), axis=1)
    if values.shape[1] <= n:
        return values, places
    top = np.argpartition(values, values.shape[1] - n, axis=1)[:, -n:]
    return np.take_along_axis(values, top, axis=1), np.take_along_axis(places, top, axis=1)


def local_lists(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """Phase 1: for each query, k total scores (padded with _NONE)."""
    kind = _exact(q, c)
    out = np.full((len(q), k), _NONE, dtype=np.int64)
    for at in range(0, len(q) if len(c) else 0, _ROWS):
        some = q[at:at + _ROWS]
        lists = [(np.empty((len(some), 0), dtype=kind), np.empty((len(some), 0), dtype=np.int64)) for _ in _slices(q.shape[1])]
        for first, parts in _tiles(some, c, kind):  # one more than k: its own row may be there
            lists = [_extended(*held, p, first, k + 1) for held, p in zip(lists, parts)]
        places = np.sort(np.concatenate([places for _, places in lists], axis=1), axis=1)
        left_out = (places < 0) | (c_ids[places] == q_ids[at:at + _ROWS, None])
        left_out[:, 1:] |= places[:, 1:] == places[:, :-1]  # in two lists
        total = np.full(places.shape, _NONE, dtype=np.int64)
        for i, (x, these, skip) in enumerate(zip(some.astype(kind), places, left_out)):
            total[i, ~skip] = (c[these[~skip]].astype(kind) @ x).astype(np.int64)
        best = np.sort(total, axis=1)[:, ::-1][:, :k]
        out[at:at + _ROWS, :best.shape[1]] = best
    return out


def _ranked(entries: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """Of (query, place, score), the k best of each query; ties beyond k have larger places."""
    row, place, total = (np.concatenate(x) for x in zip(*entries))
    order = np.lexsort((place, -total, row))
    row, place, total = row[order], place[order], total[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], place[keep], total[keep]


def sufficient(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, cutoff: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phases 2 and 3: (query_id, vec_id, score) of entries that reach the cutoff, k a query. ``c_ids`` ascend."""
    kind = _exact(q, c)
    got: list[list[np.ndarray]] = [[], [], []]
    n_lists = len(_slices(q.shape[1]))
    for at in range(0, len(q), _ROWS):
        own, limit = q_ids[at:at + _ROWS], cutoff[at:at + _ROWS]
        # partial scores and LISTS are integers: p >= t / LISTS is p >= ceil(t / LISTS)
        def threshold():
            return np.where(limit == _NONE, _NONE, -((-limit) // n_lists)).astype(kind)[:, None]
        least, entries, n_held = threshold(), [], 0
        for first, parts in _tiles(q[at:at + _ROWS], c, kind):
            best = parts[0]
            for p in parts[1:]:
                best = np.maximum(best, p)
            which = _places(best >= least)
            row, col = np.divmod(which, best.shape[1])
            total = sum(p.ravel()[which].astype(np.int64) for p in parts)
            keep = (total >= limit[row]) & (c_ids[first + col] != own[row])
            entries.append((row[keep], first + col[keep], total[keep]))
            n_held += np.count_nonzero(keep)
            if n_held > _HELD:
                entries = [_ranked(entries, k)]
                row, _, total = entries[0]
                n_held = len(row)
                full = np.flatnonzero(np.bincount(row, minlength=len(limit)) == k)
                limit = limit.copy()  # those of later, larger ids must beat the k-th
                limit[full] = total[np.searchsorted(row, full, side="right") - 1] + 1
                least = threshold()
        if entries:
            row, place, total = _ranked(entries, k)
            for held, x in zip(got, (own[row], c_ids[place], total)):
                held.append(x)
    return tuple(np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in got)


def _packed(lists: np.ndarray) -> tuple[bytes, str]:
    """Score lists in the least kind that holds them; its smallest number is _NONE."""
    none = lists == _NONE
    kind = _least_kind(_most(lists[~none]))
    return np.where(none, np.iinfo(kind).min, lists).astype(kind).tobytes(), kind


def _unpacked(lists: pa.Scalar, kind: pa.Scalar, k: int) -> np.ndarray:
    held = np.frombuffer(lists.as_buffer(), dtype=kind.as_py()).reshape(-1, k)
    return np.where(held == np.iinfo(held.dtype).min, _NONE, held.astype(np.int64))


def _cells(queries: DataFrame, candidates: DataFrame, tasks: int) -> DataFrame:
    """dim, q_side, c_side (blocks of a cell), n_q, n_c (cells): a row for each length of vectors."""

    def sides(blocks: DataFrame, side: str, least: Column) -> DataFrame:
        most = F.greatest(F.lit(1), F.floor(CELL / F.max("n_bytes")))
        return (blocks.groupBy("dim").agg(F.max("n_blocks").alias("n"), F.least(most, least).cast("long").alias(f"{side}_side"))
                .select("dim", f"{side}_side", F.ceil(F.col("n") / F.col(f"{side}_side")).cast("long").alias(f"n_{side}")))

    cells = (sides(queries, "q", F.max("n_blocks"))
             .join(sides(candidates, "c", F.ceil(F.max("n_blocks") / tasks)), "dim"))
    return queries.sparkSession.createDataFrame(cells.collect(), cells.schema)


def _met(queries: DataFrame, candidates: DataFrame, cells: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table],
         schema: str, parts: int) -> DataFrame:
    """``fn`` of the query blocks and the candidate blocks of each cell."""
    cell = "dim", "q_cell", "c_cell"

    def dealt(blocks: DataFrame, own: str, other: str) -> GroupedData:
        met = (blocks.join(F.broadcast(cells), "dim")  # a few numbers a length
               .withColumn(f"{own}_cell", F.floor(F.col("block") / F.col(f"{own}_side")).cast("long"))
               .withColumn(f"{other}_cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"n_{other}") - 1)))
               .select(*cell, *(c for c in blocks.columns if c not in ("dim", "n_blocks", "n_bytes"))))
        return met.repartition(parts, *cell).groupBy(*cell)

    return dealt(queries, "q", "c").cogroup(dealt(candidates, "c", "q")).applyInArrow(fn, schema)


def search(vectors: DataFrame, *, k: int = K, is_query: Column | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of each query."""
    spark = vectors.sparkSession
    is_query = F.col("vec_id") % 20 == 0 if is_query is None else is_query
    rows = stored(integers(vectors), "vectors")
    candidates = blocks(rows, BLOCK, "candidates")
    queries = blocks(rows.where(is_query), QUERY_BLOCK, "queries")
    tasks = 4 * spark.sparkContext.defaultParallelism
    cells = _cells(queries, candidates, tasks)
    n_cells, n_lists = (x or 0 for x in cells.agg(F.sum(F.col("n_q") * F.col("n_c")), F.max("n_c")).first())
    # some more partitions than cells, as their hashes may meet
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(4 * n_cells, 4 * tasks))

    def gather(q_blocks: pa.Table, c_blocks: pa.Table) -> pa.Table:
        lists = []
        if q_blocks.num_rows and c_blocks.num_rows:
            c_ids, c = _joined(c_blocks)
            lists = [_packed(local_lists(*q, c_ids, c, k)) for q in _matrices(q_blocks)]
        q_blocks = q_blocks.slice(0, len(lists))
        return pa.table({"dim": q_blocks.column("dim"), "block": q_blocks.column("block"), "c_cell": q_blocks.column("c_cell"),
                         "lists": pa.array([x for x, _ in lists], pa.binary()), "kind": pa.array([x for _, x in lists], pa.string())})

    def best(part: pa.Table) -> np.ndarray:
        best = None  # of FAN lists at most, one by one
        for x in map(_unpacked, part.column("lists"), part.column("kind"), repeat(k)):
            best = x if best is None else np.sort(np.concatenate((best, x), axis=1), axis=1)[:, ::-1][:, :k]
        return best

    def merge(part: pa.Table) -> pa.Table:
        lists, kind = _packed(best(part))
        return pa.table({**{c: part.column(c).slice(0, 1) for c in ("dim", "block", "c_cell")},
                         "lists": pa.array([lists], pa.binary()), "kind": pa.array([kind], pa.string())})

    def cut(part: pa.Table) -> pa.Table:
        cutoff = np.ascontiguousarray(best(part).min(axis=1))
        return pa.table({**{c: part.column(c).slice(0, 1) for c in ("dim", "block")}, "cutoff": pa.array([cutoff.tobytes()], pa.binary())})

    schema = "dim int, block long, c_cell long, lists binary, kind string"
    lists = _met(queries, candidates, cells, gather, schema, parts)
    while n_lists > FAN:  # FAN lists meet in a group
        lists = (lists.withColumn("c_cell", F.floor(F.col("c_cell") / FAN).cast("long"))
                 .groupBy("dim", "block", "c_cell").applyInArrow(merge, schema))
        n_lists = -(-n_lists // FAN)
    cutoffs = stored(lists.groupBy("dim", "block").applyInArrow(cut, "dim int, block long, cutoff binary"), "cutoffs")

    def resolve(q_blocks: pa.Table, c_blocks: pa.Table) -> pa.Table:
        found = [_FOUND.empty_table()]
        if q_blocks.num_rows and c_blocks.num_rows:
            c_ids, c = _joined(c_blocks)
            for q, cutoff in zip(_matrices(q_blocks), q_blocks.column("cutoff")):
                cutoff = np.frombuffer(cutoff.as_buffer(), dtype="<i8")
                found.append(pa.table(dict(zip(_FOUND.names, sufficient(*q, c_ids, c, cutoff, k))), _FOUND))
        return pa.concat_tables(found)

    # merge: by the size of their files the blocks look small enough to broadcast
    cut_queries = queries.join(cutoffs.hint("merge"), ["dim", "block"])
    found = _met(cut_queries, candidates, cells, resolve, "query_id long, vec_id long, score long", parts)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def oracle(k: int = K) -> str:
    """DuckDB SQL for the rows of ``search(embeddings)``."""
    return f"""
    WITH vectors AS (
      SELECT vec_id, list_transform(min(embedding), lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      GROUP BY vec_id),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM vectors q JOIN vectors c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
    ranked AS (
      SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
             vec_id, score FROM scored)
    SELECT * FROM ranked WHERE rank <= {k}
    """
