"""MinHash near-dedup with sequential Bayesian verification.

Words are the runs of ``[^\\x20\\x09-\\x0D]`` of the A-Z lower-cased text; a
document's set holds its distinct 4-word shingles (the whole sequence as one
where there are fewer words). Documents whose sets have Jaccard similarity of
0.8 or more are linked; a component's smallest doc_id is kept.

1. One pass over the texts writes, per row: set size, a 128-bit key of the word
   sequence, ``BANDS`` band keys and the MinHash signature (16-bit lanes).
2. Rows with one key are copies: their smallest doc_id represents them.
3. Candidates come from equal band keys. First each member of a bucket meets
   two hubs (smallest and largest id), which joins large groups in linear work;
   then every pair of a bucket whose two documents are still in different
   components is taken: as rows in small buckets, inside blocks in large ones. Pairs inside one component
   need no test, so no link between components is lost and no group is
   expanded into all its pairs.
4. Candidates are compared signature batch by batch; a pair leaves as soon as
   the posterior probability (uniform prior) that its similarity reaches 0.8
   is below ``MISS``.
5. Survivors are verified exactly, on the full shingle sets of both texts.
6. Components: alternating large-star and small-star steps on edge tables.

A pair at similarity 0.8 shares no band with probability
(1 - 0.8^ROWS)^BANDS = 5e-7, less above. Nothing is capped.

Defined cases: null, empty or blank texts have set size 0 and are linked with
nothing. Rows that repeat a doc_id are one node with all its texts. A null
doc_id is linked with nothing: component_id null, kept true. Extra columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_row, shipped, stored, with_ids

WORDS = 4
SHARE = 80                 # 100 * intersection >= SHARE * union
BANDS, ROWS = 48, 6
LANES = BANDS * ROWS
BATCH = 32                 # signature lanes compared at a time
MISS = 1e-9
SMALL = 16                 # members of a bucket whose pairs are written out
BLOCK = 1024               # members on each side of a block

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SEEDS = np.random.default_rng(20_01)
_MUL = _SEEDS.integers(0, 2 ** 31, LANES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _SEEDS.integers(0, 2 ** 32, LANES, dtype=np.uint32)
_LANE = _SEEDS.integers(0, 2 ** 63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _avalanche(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _STEP
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def words_of(text: str | None) -> list[bytes]:
    # bytes.lower touches A-Z only; bytes.split splits at space and \t-\r
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes]) -> np.ndarray:
    """The distinct shingles as sorted 64-bit hashes."""
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    width = min(n, WORDS)
    acc = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        acc = acc * _MIX + h[k:n - width + 1 + k]
    return np.unique(_avalanche(acc))


def signature(shingles: np.ndarray) -> np.ndarray:
    """LANES minima of 32-bit hashes over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(LANES, 2 ** 32 - 1, dtype=np.uint32)
    for at in range(0, len(x), 256):
        np.minimum(least, (x[at:at + 256, None] * _MUL + _ADD).min(axis=0), out=least)
    return least


def band_keys(sig: np.ndarray) -> np.ndarray:
    parts = (sig.astype(np.uint64) * _LANE).reshape(BANDS, ROWS)
    total = parts.sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX
    return _avalanche(total).view(np.int64)


@lru_cache(None)
def least_matches(n: int, miss: float = MISS) -> int:
    """Fewest matches among n lanes with P(similarity >= 0.8 | matches) >= miss."""
    t = SHARE / 100
    # posterior Beta(m+1, n-m+1): P(S >= t) = P(Binomial(n+1, t) <= m)
    below = 0.0
    for m in range(n + 1):
        below += comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        if below >= miss:
            return m
    return n


def survives(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two signature matrices pass every batch's bound."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), dtype=np.int64)
    for at in range(0, LANES, BATCH):
        if not len(alive):
            break
        matches[alive] += (a[alive, at:at + BATCH] == b[alive, at:at + BATCH]).sum(axis=1)
        alive = alive[matches[alive] >= least_matches(min(at + BATCH, LANES))]
    out = np.zeros(len(a), dtype=bool)
    out[alive] = True
    return out


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < SHARE * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SHARE * (len(a) + len(b) - both)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, key, bands, sig for each row (null key: no words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                size, key, bands, sig = [], [], [], []
                for text in part.column("text"):
                    words = words_of(text.as_py())
                    found = shingle_set(words)
                    size.append(len(found))
                    if not words:
                        key.append(None), bands.append(None), sig.append(None)
                        continue
                    lanes = signature(found)
                    key.append(xxhash.xxh3_128_digest(b" ".join(words)))
                    bands.append(band_keys(lanes))
                    sig.append((lanes & np.uint32(0xFFFF)).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(key, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                    names=["doc_id", "n_shingles", "key", "bands", "sig"])

    return shipped(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, key binary, bands array<long>, sig binary")


def prune(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """Pairs (a, b) that pass the signature bounds."""
    sigs = prints.where("key IS NOT NULL").select("doc_id", "sig")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2").reshape(-1, LANES)
                    for c in ("sig_a", "sig_b"))
            yield batch.select(["a", "b"]).filter(pa.array(survives(x, y)))

    return (pairs.join(sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b")
            .select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long"))


def verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = with_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(256)  # hubs recur
        def of(text: str | None) -> np.ndarray:
            return shingle_set(words_of(text))

        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                same = [linked(of(x.as_py()), of(y.as_py()))
                        for x, y in zip(part.column("text_a"), part.column("text_b"))]
                yield part.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    return (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of the edges (a, b), as a stored table.

    Alternating large-star and small-star steps until every edge leads from a
    node to the smallest id of its component. The least neighbour is found by a
    map-side combined aggregate and joined back, so a node with very many
    neighbours is split like any skewed join key.
    """
    def starred(df: DataFrame) -> DataFrame:
        return df.join(df.groupBy("a").agg(F.min("b").alias("m")), "a")

    now = (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        # large star: every larger neighbour moves to the least of the node and its neighbours
        both = starred(now.union(now.select("b", "a")))
        large = both.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        # small star: the node and its smaller neighbours move to the least of them
        small = starred(large)
        now = stored(small.select("a", F.col("m").alias("b"))
                     .union(small.where("b <> m").select("b", "m")).distinct(), "stars")
        ends = now.select(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(
            now.select("b", F.lit(0), F.lit(1)))
        moving = (ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("root").alias("root"))
                  .where("child > 1 OR (child = 1 AND root = 1)"))
        if moving.isEmpty():
            break
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(now.select("b").distinct().select("b", F.col("b")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``."""
    prints = stored(fingerprints(docs), "prints")
    rows = prints.where("key IS NOT NULL AND doc_id IS NOT NULL")
    reps = stored(rows.groupBy("key").agg(F.min(F.struct("doc_id", "bands")).alias("r"))
                  .select("key", "r.doc_id", "r.bands"), "reps")
    bands = reps.select("doc_id", F.explode("bands").alias("band"))
    # the hubs of a bucket come from a map-side combined aggregate, not from a sorted group
    hubs = (bands.groupBy("band").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi"))
    members = stored(bands.join(hubs, "band").select("band", "doc_id", "lo", "hi"), "members")

    # rows that repeat a doc_id with other texts are one node
    twice = (rows.groupBy("doc_id").agg(F.min("key").alias("k"), F.max("key").alias("l")).where("k <> l")
             .select(F.col("doc_id").alias("a")))
    edges = None
    if not twice.isEmpty():
        same = rows.select("key", F.col("doc_id").alias("a")).join(twice, "a", "left_semi").join(reps, "key")
        edges = stored(same.select("a", F.col("doc_id").alias("b")).distinct(), "links")

    def test(pairs: DataFrame, known: DataFrame | None) -> DataFrame:
        found = verify(stored(prune(pairs.distinct(), prints), "candidates"), docs)
        return stored(found if known is None else known.union(found), "links")

    stars = members.where("doc_id > lo").select(F.col("lo").alias("a"), F.col("doc_id").alias("b")).union(
        members.where("lo < doc_id AND doc_id < hi").select("doc_id", "hi"))
    edges = test(stars, edges)
    of = stored(components(edges), "components")
    mixed = stored(_mixed(members, of), "mixed")
    if not mixed.isEmpty():
        rest = verify(stored(prune(small_pairs(mixed).distinct(), prints), "candidates"), docs)
        more = stored(rest.union(large_links(mixed, prints, docs)), "links")
        if not more.isEmpty():
            joined = of.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
            of = stored(components(joined.union(more)), "components")

    named = (reps.join(of, reps.doc_id == of.node, "left")
             .select("key", F.coalesce("component", "doc_id").alias("component_id")))
    out = prints.select("doc_id", "n_shingles", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` but for near-duplicates of a smaller doc_id.

    Rows that repeat a kept doc_id are reduced to the one that sorts first.
    """
    found = stored(near_duplicates(docs), "groups").where("doc_id IS NOT NULL")
    per_id = found.groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("n"))
    gone = stored(per_id.where("NOT kept OR n > 1"), "gone")
    held = docs.select(as_row(docs), F.col("doc_id").cast("long").alias("doc_id"))
    kept = with_ids(held, gone.select("doc_id"), "doc_id", "left_anti")
    again = gone.where("kept").select("doc_id")
    if not again.isEmpty():
        least = with_ids(held, again, "doc_id").groupBy("doc_id").agg(F.min("row").alias("row"))
        kept = kept.unionByName(least)
    return kept.select("row.*")


def _mixed(members: DataFrame, of: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with their
    component, the bucket's most frequent one, and the counts of members (n)
    and of members outside that component (f)."""
    label = of.select(F.col("node").alias("doc_id"), "component")
    placed = stored(members.select("band", "doc_id").join(label, "doc_id", "left")
                    .select("band", "doc_id", F.coalesce("component", "doc_id").alias("c")), "placed")
    most = (placed.groupBy("band", "c").agg(F.count("*").alias("k"))
            .groupBy("band").agg(F.max(F.struct("k", "c")).alias("top"), F.sum("k").alias("n"))
            .where("top.k < n").select("band", F.col("top.c").alias("most"), "n", (F.col("n") - F.col("top.k")).alias("f")))
    return placed.join(most, "band")


def small_pairs(mixed: DataFrame) -> DataFrame:
    """Every pair of two components in buckets of at most SMALL members (so
    their number stays in proportion to the members)."""
    small = mixed.where(F.col("n") <= SMALL)
    few = small.where("c <> most").select("band", F.col("doc_id").alias("x"), F.col("c").alias("cx"))
    # both outside the most frequent component: taken once, by id order
    return (few.join(small, "band").where("cx <> c AND (c = most OR x < doc_id)")
            .select(F.least("x", "doc_id").alias("a"), F.greatest("x", "doc_id").alias("b")))


def large_links(mixed: DataFrame, prints: DataFrame, docs: DataFrame) -> DataFrame:
    """The links between components in larger buckets, found block by block.

    The members outside a bucket's most frequent component meet all members in
    blocks of at most BLOCK by BLOCK, each its own task unit. Inside a block a
    pair is compared only in the first band that it shares, by signature
    batches, and confirmed on the full sets; only links leave the block.
    """
    big = mixed.where(F.col("n") > SMALL)
    ids = big.select("doc_id").distinct()
    texts = with_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids, "doc_id")
    content = texts.join(with_ids(prints.where("key IS NOT NULL").select("doc_id", "bands", "sig"), ids, "doc_id"), "doc_id")
    cut = big.select("band", "doc_id", "c", (F.col("c") != F.col("most")).alias("few"),
                     F.ceil(F.col("f") / BLOCK).alias("nf"), F.ceil(F.col("n") / BLOCK).alias("nn"))
    place = F.xxhash64("doc_id", "band")
    outside = (cut.where("few").withColumn("i", F.pmod(place, F.col("nf")))
               .withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nn") - 1))).withColumn("side", F.lit(0)))
    every = (cut.withColumn("j", F.pmod(place, F.col("nn")))
             .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nf") - 1))).withColumn("side", F.lit(1)))
    cols = "band", "i", "j", "side", "few", "doc_id", "c"
    rows = outside.select(*cols).union(every.select(*cols)).join(content, "doc_id")

    def block(part: pa.Table) -> pa.Table:
        a, b = _block_links(part)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("band", "i", "j").applyInArrow(block, "a long, b long").distinct()


def _block_links(part: pa.Table) -> tuple[list[int], list[int]]:
    band = part.column("band")[0].as_py()
    side, few, ids, comp = (part.column(c).to_numpy() for c in ("side", "few", "doc_id", "c"))
    bands = np.array(part.column("bands").to_pylist(), dtype=np.int64)
    sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), dtype="<u2").reshape(-1, LANES)
    texts = part.column("text")
    sets: dict[int, np.ndarray] = {}

    def of(row: int) -> np.ndarray:
        if row not in sets:
            sets[row] = shingle_set(words_of(texts[row].as_py()))
        return sets[row]

    a, b = [], []
    members = np.flatnonzero(side == 1)
    for x in np.flatnonzero(side == 0):
        # pairs of two outside members: once, by id order
        other = members[(comp[members] != comp[x]) & (~few[members] | (ids[members] > ids[x]))]
        shared = bands[other] == bands[x]
        other = other[bands[x][shared.argmax(axis=1)] == band]
        other = other[survives(np.broadcast_to(sig[x], (len(other), LANES)), sig[other])]
        for y in other:
            if linked(of(x), of(y)):
                a.append(min(ids[x], ids[y])), b.append(max(ids[x], ids[y]))
    return a, b
