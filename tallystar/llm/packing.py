"""Best-fit packing by a configuration linear program.

Documents are tokenized, ended by ``eos`` and cut into pieces of at most
``capacity`` tokens. Sequences are planned on the histogram of piece lengths
(at most ``capacity`` numbers, whatever the corpus):

1. Configuration LP: fewest sequences whose contents cover every length's
   count. Solved by multiplicative weights: lengths have prices; knapsack
   dynamic programming finds the best-priced configuration of what is left,
   again and again until every count is covered; lengths that were packed with
   waste get dearer by a factor, and the next round begins.
2. Rounding: a round takes each configuration a whole number of times, as
   often as the counts allow, so every round is a rounded solution; the one with
   the fewest sequences is the plan. Prices also give a lower bound (LP
   duality), and a plan that meets it ends the rounds.

Pieces then take the plan's slots: each piece is ranked among those of its
length by a two-level count (hash bucket, then row number inside it), so no
task holds all pieces of one length, and looks its slot up in the broadcast
plan (at most ``capacity`` configurations).

Defined cases: a null or empty text is the piece [eos]. Longer documents are
cut into ``capacity`` pieces; a shorter one comes first. Repeated rows are
packed each. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder, read_vocabulary
from .common import shipped, stored

CAPACITY = 1024
EOS = 2
STEPS = 3                  # multiplicative-weight rounds after the first ones, unless the bound is met before
RATE = 1.0                 # how fast the price of a length packed with waste rises
LEANS = (0.6, 1.0, 0.3, 3.0)  # how much more than in proportion long pieces are worth in the first rounds


def pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, eos: int = EOS,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the packed ids) of each row's pieces."""
    kind = dict(docs.dtypes)["doc_id"]
    source = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer_path))
    end = int(eos).to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(source.value).ids
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                part = batch.slice(at, 250)
                owner, piece, start, length, crc, held = [], [], [], [], [], []
                for row, text in enumerate(part.column("text")):
                    ids = encode(text.as_py() or "") + end
                    n = len(ids) // 4
                    cuts = [0, n] if n <= capacity else [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        owner.append(row), piece.append(k), start.append(a), length.append(b - a)
                        crc.append(zlib.crc32(ids[4 * a:4 * b]))
                        if with_ids:
                            held.append(ids[4 * a:4 * b])
                cols = [part.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(held, pa.binary())] * with_ids, names=names)

    return shipped(docs).select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def best_configuration(lengths: np.ndarray, price: np.ndarray, most: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """Knapsack by dynamic programming: how often each length is taken in the best-priced
    sequence, at most ``most`` times, and its value.

    A length that may be taken m times becomes the bundles of 1, 2, 4, ... that
    add up to m; each bundle is taken or not, for every room at once."""
    most = np.minimum(most, capacity // lengths)
    bundles: list[tuple[int, int]] = []
    for i in np.flatnonzero(most > 0).tolist():
        m, k = int(most[i]), 1
        while m > 0:
            bundles.append((i, min(k, m)))
            m -= k
            k *= 2
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(bundles), capacity + 1), dtype=bool)
    sizes = [int(lengths[i]) * k for i, k in bundles]
    for row, (i, k), size in zip(taken, bundles, sizes):
        value = best[:capacity + 1 - size] + price[i] * k
        np.greater(value, best[size:], out=row[size:])
        np.maximum(value, best[size:], out=best[size:])
    counts, room = np.zeros(len(lengths), dtype=np.int64), capacity
    for k in range(len(bundles) - 1, -1, -1):
        if taken[k, room]:
            counts[bundles[k][0]] += bundles[k][1]
            room -= sizes[k]
    return counts, float(best[capacity])


def lp_bound(lengths: np.ndarray, demand: np.ndarray, price: np.ndarray, capacity: int) -> float:
    """A lower bound of the configuration LP: prices under which no sequence is worth more than 1."""
    _, worth = best_configuration(lengths, price, np.full(len(lengths), capacity), capacity)
    return float(demand @ price) / worth


def cover(lengths: np.ndarray, demand: np.ndarray, price: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole amounts of configurations that cover ``demand`` exactly: again and again the
    best-priced one of what is left, as often as that allows. Each uses up a length at least."""
    out, left = [], demand.copy()
    while left.any():
        counts, _ = best_configuration(lengths, price, left, capacity)
        used = np.flatnonzero(counts)
        times = int((left[used] // counts[used]).min())
        left[used] -= times * counts[used]
        out.append((counts, times))
    return out


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, steps: int = STEPS) -> tuple[list[tuple[np.ndarray, int]], float]:
    """The configurations and their amounts, and the best lower bound found.

    Every round covers all counts under the round's prices, so the mean of the
    rounds is a solution of the LP, and each of them a rounded one; the best is
    kept. Between rounds the price of a length is multiplied by exp(RATE x the
    mean empty share of the sequences that hold it): what was packed with waste
    is packed earlier. Prices begin above proportion to length, by several powers
    (``LEANS``), so that long pieces go first; ``steps`` more follow from the best. Ends when the bound is met."""
    size = lengths / capacity
    bound = max(lp_bound(lengths, demand, p, capacity) for p in (size, (size > 1 / 2) + 0.0, (size > 1 / 2) + (size > 1 / 3) + 0.0) if p.any())
    best: tuple[int, list, np.ndarray] | None = None
    for k in range(len(LEANS) + steps):
        price = size ** (1 + LEANS[k]) if k < len(LEANS) else best[2]
        made = cover(lengths, demand, price, capacity)
        waste = np.zeros(len(lengths))
        for counts, times in made:
            waste += counts * (times * (1 - float(counts @ lengths) / capacity))
        dearer = price * np.exp(RATE * waste / demand)
        total = sum(t for _, t in made)
        if best is None or total < best[0]:
            best = total, made, dearer
        elif k >= len(LEANS):
            best = *best[:2], dearer
        bound = max(bound, lp_bound(lengths, demand, price, capacity))
        if best[0] <= math.ceil(bound - 1e-6):
            break
    return best[1], bound


def plan(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> list[tuple[list[tuple[int, int]], int]]:
    """Sequences as ([(length, times in it), ...] longest first, how many alike)."""
    out: list[tuple[list[tuple[int, int]], int]] = []
    left = {n: c for n, c in histogram.items() if c > 0}
    if full := left.pop(capacity, 0):
        out.append(([(capacity, 1)], full))
    if not left:
        return out
    lengths = np.array(sorted(left), dtype=np.int64)
    made, _ = solve(lengths, np.array([left[int(n)] for n in lengths], dtype=np.int64), capacity, steps)
    for counts, times in made:
        out.append(([(int(lengths[i]), int(counts[i])) for i in np.flatnonzero(counts)[::-1]], times))
    return out


def summary(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[str, float]:
    """How good the plan is: its sequences, those made by the program (all but pieces that
    are full by themselves), and the lower bound."""
    made = plan(histogram, capacity)
    left = {n: c for n, c in histogram.items() if c > 0 and n < capacity}
    lengths = np.array(sorted(left), dtype=np.int64)
    bound = solve(lengths, np.array([left[int(n)] for n in lengths], dtype=np.int64), capacity)[1] if left else 0.0
    alone = histogram.get(capacity, 0)
    total = sum(t for _, t in made)
    return {"sequences": total, "from_program": total - alone, "bound": bound + alone}


@dataclass
class Slots:
    """For each length: first rank, first sequence, how many in one sequence, offset there."""

    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(planned: list[tuple[list[tuple[int, int]], int]]) -> Slots:
        rows: dict[int, list] = {}
        taken: dict[int, int] = {}
        sequence = 0
        for pattern, times in planned:
            offset = 0
            for length, count in pattern:
                rank = taken.get(length, 0)
                rows.setdefault(length, []).append((rank, sequence, count, offset))
                taken[length] = rank + times * count
                offset += length * count
            sequence += times
        return Slots({n: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for n, r in rows.items()})

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty_like(rank), np.empty_like(rank)
        for n in np.unique(length):
            where = np.flatnonzero(length == n)
            first, base, count, at = self.by_length[int(n)]
            k = np.searchsorted(first, rank[where], side="right") - 1
            inner = rank[where] - first[k]
            sequence[where] = base[k] + inner // count[k]
            offset[where] = at[k] + inner % count[k] * n
        return sequence, offset


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, eos: int = EOS,
         with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of each piece."""
    spark = docs.sparkSession
    made = pieces(docs, tokenizer_path, capacity=capacity, eos=eos, with_ids=with_ids)
    if with_ids:  # a number for each written piece: only numbers are ranked and placed, the ids join them after
        made = made.withColumn("_uid", F.monotonically_increasing_id())
    whole = stored(made, "pieces")
    cut = whole.drop("ids")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = stored(keyed.groupBy("length", "_bucket").agg(F.count("*").alias("n")), "piece_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(Slots.of(plan(histogram, capacity)))

    before = (Window.partitionBy("length").orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))  # one row a bucket
    starts = counts.select("length", "_bucket", (F.sum("n").over(before) - F.col("n")).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (keyed.withColumn("_row", F.row_number().over(inside)).join(starts, ["length", "_bucket"])
              .withColumn("_rank", F.col("_before") + F.col("_row") - 1))
    names = cut.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots.value.place(batch.column("length").to_numpy(), batch.column("_rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    schema = cut.schema.add("sequence_id", "long").add("offset", "long")
    placed = ranked.select(*names, "_rank").mapInArrow(run, schema)
    return placed.join(whole.select("_uid", "ids"), "_uid").drop("_uid") if with_ids else placed


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length and ids (little-endian unsigned 32-bit) of each sequence of a
    ``pack(..., with_ids=True)``; a sequence's pieces, at most ``capacity``, meet in one group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("p")).select(
        "sequence_id", "length", F.aggregate("p", F.lit(b""), lambda all_, x: F.concat(all_, x["ids"])).alias("ids"))
