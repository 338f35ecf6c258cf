"""Periodic run detection by block convolution.

Words are the maximal stretches of characters other than blank and U+0009 to
U+000D, numbered from 0. A run is a stretch of consecutive words with smallest
period q (words q apart are equal) and at least ``max(12, 2 * q)`` words, that
no neighbouring word extends. ``find_runs`` finds all runs of a text:

1. Scales. Periods are split by size; a scale compares aligned blocks of b
   words, b a power of two, at distances q of [2b-1, 4b-2] (the first scale
   takes 1 to 6). A run of period q is at least q + 2b - 1 words long, so it
   holds a whole block together with that block's copy q words on.
2. Convolution. Words are numbered; a block and the stretch behind it differ
   by the sum of (x - y)^2 = sum x^2 + sum y^2 - 2 sum x*y. The last term is a
   product of number-theoretic transforms over the integers modulo a prime, so
   nothing is rounded; a distance whose sum is 0 modulo the prime is a seed.
   Blocks holding a word that does not recur within the scale's largest
   distance have no copy there and are left out.
3. Extension. A seed is extended word by word to both sides, which also
   confirms it. Stretches that have a smaller period are left to that period.

Texts are taken in groups of some 100,000 words, so that one transform serves
the blocks of many; a longer text is a group by itself. Memory follows the
longest text (some hundred bytes a word), not the number of texts.

Defined results: a null or empty text, or one without words, has no run and
collapses to the empty text; repeated rows each get their own result; an empty
table gives an empty one; input columns are kept in ``row`` and clash with
nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from .common import as_row, shipped

WORD = re.compile("[^\x20\x09-\x0D]+")
LEAST = 12                  # words of the shortest run
GROUP_WORDS = 100_000       # texts are taken together up to so many words
CHUNK = 1 << 18             # numbers in one transform, unless one block needs more
LONGEST_BLOCK = 1 << 20     # longer periods are searched with blocks of this length
# 2^23 divides PRIME - 1, and ROOT generates the multiplicative group: fixed values
PRIME, ROOT = 998_244_353, 3
MADE = "n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


# ------------------------------------------------------------------ transform
def _mod(a: np.ndarray) -> np.ndarray:
    return a - (a // PRIME) * PRIME


def _powers(root: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.int64)
    have = 1
    while have < n:  # doubling: the next stretch is the last one times root^have
        step = pow(root, have, PRIME)
        out[have:2 * have] = _mod(out[:min(have, n - have)] * step)
        have *= 2
    return out


class Transform:
    """Transforms of length ``n`` (a power of two) down the first axis of a matrix.

    ``forward`` leaves its result in bit-reversed order and ``backward`` takes
    it so; products need no order."""

    def __init__(self, n: int):
        self.n = n
        whole = _powers(pow(ROOT, (PRIME - 1) // n, PRIME), n // 2 or 1)
        back = _powers(pow(ROOT, PRIME - 1 - (PRIME - 1) // n, PRIME), n // 2 or 1)
        self.steps = []
        half = n // 2
        while half:
            stride = (n // 2) // half
            self.steps.append((half, whole[::stride][:half, None].copy(), back[::stride][:half, None].copy()))
            half //= 2
        self.scale = pow(n, PRIME - 2, PRIME)

    def forward(self, a: np.ndarray) -> np.ndarray:
        cols = a.shape[1]
        for half, twiddle, _ in self.steps:
            v = a.reshape(-1, 2, half, cols)
            low, high = v[:, 0], v[:, 1]
            total = low + high
            high_new = _mod((low - high + PRIME) * twiddle)
            np.subtract(total, PRIME, out=total, where=total >= PRIME)
            a = np.stack([total, high_new], axis=1)
        return a.reshape(self.n, cols)

    def backward(self, a: np.ndarray) -> np.ndarray:
        cols = a.shape[1]
        for half, _, twiddle in reversed(self.steps):
            v = a.reshape(-1, 2, half, cols)
            low, high = v[:, 0], _mod(v[:, 1] * twiddle)
            total = low + high
            other = low - high + PRIME
            np.subtract(total, PRIME, out=total, where=total >= PRIME)
            np.subtract(other, PRIME, out=other, where=other >= PRIME)
            a = np.stack([total, other], axis=1)
        return _mod(a.reshape(self.n, cols) * self.scale)


_TRANSFORMS: dict[int, Transform] = {}


def transform_of(n: int) -> Transform:
    if n not in _TRANSFORMS:
        _TRANSFORMS[n] = Transform(n)
    return _TRANSFORMS[n]


def block_distances(x: np.ndarray, squares: np.ndarray, starts: np.ndarray, b: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """The (start, distance) at which a block of ``b`` numbers of ``x`` equals,
    modulo the prime, the stretch a distance of [first, first + b) behind it.

    ``squares`` holds the running sums of x^2 modulo the prime. Cyclic products
    of length 2b have no wrap at the distances read."""
    n, (found_start, found_distance) = 2 * b, ([], [])
    t = transform_of(n)
    per = max(1, CHUNK // n)
    inside, behind = np.arange(b)[:, None], np.arange(n)[:, None]
    for at in range(0, len(starts), per):
        s = starts[at:at + per][None, :]
        block = np.zeros((n, s.shape[1]), dtype=np.int64)
        block[-inside % n, np.arange(s.shape[1])] = x[s + inside]
        product = t.backward(_mod(t.forward(block) * t.forward(x[s + first + behind])))[:b]
        copy = s + first + inside
        differ = (squares[s + b] - squares[s]) + (squares[copy + b] - squares[copy]) - 2 * product
        d, k = np.nonzero(differ % PRIME == 0)
        found_start.append(s[0, k])
        found_distance.append(d + first)
    return np.concatenate(found_start), np.concatenate(found_distance)


# ----------------------------------------------------------------------- runs
def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(block length, smallest period, largest period) up to half of ``longest``."""
    yield 2, 1, 6
    low = 7
    while low <= longest // 2:
        yield min((low + 1) // 2, LONGEST_BLOCK), low, 2 * low
        low = 2 * low + 1


def _equal_after(x: np.ndarray, at: int, q: int, end: int) -> int:
    """The first position of [at, end - q] from which x and its copy q on differ."""
    size, stop = 64, end - q
    while at < stop:
        to = min(at + size, stop)
        wrong = x[at:to] != x[at + q:to + q]
        k = int(wrong.argmax())
        if wrong[k]:
            return at + k
        at, size = to, size * 2
    return stop


def _equal_before(x: np.ndarray, at: int, q: int, begin: int) -> int:
    """The first position of the stretch before ``at`` on which x equals its copy q on."""
    size = 64
    while at > begin:
        to = max(at - size, begin)
        wrong = x[to:at] != x[to + q:at + q]
        if wrong.any():
            return at - int(wrong[::-1].argmax())
        at, size = to, size * 2
    return begin


def _prime_factors(n: int) -> list[int]:
    out, r = [], 2
    while r * r <= n:
        if n % r == 0:
            out.append(r)
            while n % r == 0:
                n //= r
        r += 1
    return out + [n] * (n > 1)


def find_runs(texts: Sequence[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Every run (start, length, period) of each text, given as word numbers.

    The numbers are below the prime; equal numbers are equal words within a text."""
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    total, longest = int(lengths.sum()), int(lengths.max(initial=0))
    if longest < LEAST:
        return runs
    ends = np.cumsum(lengths)
    begins = ends - lengths
    plan = list(scales(longest))
    tail = max(high + 3 * b for b, _, high in plan) + 2
    x = np.zeros(total + tail, dtype=np.int64)
    x[:total] = np.concatenate(texts) + 1
    squares = np.concatenate([[0], np.cumsum(_mod(x * x))])
    # distance to the word's next place, and its maximum over the b words from each position on
    order = np.argsort(x[:total], kind="stable")
    recurs = np.full(len(x), len(x), dtype=np.int64)
    same = x[order[1:]] == x[order[:-1]]
    recurs[order[:-1][same]] = np.diff(order)[same]
    widest, width = recurs, 1
    period_at, until = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
    for b, low, high in plan:
        while width < b:
            widest = np.maximum(widest, np.concatenate([widest[width:], widest[-width:]]))
            width *= 2
        counts = np.maximum((lengths - low) // b, 0)
        texts_of = np.repeat(np.arange(len(texts)), counts)
        starts = begins[texts_of] + b * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
        keep = widest[starts] <= high
        starts, texts_of = starts[keep], texts_of[keep]
        if not len(starts):
            continue
        seeds = [block_distances(x, squares, starts, b, first) for first in range(low, high + 1, b)]
        at, q = (np.concatenate(c) for c in zip(*seeds))
        owner = texts_of[np.searchsorted(starts, at)]
        known = (period_at[at] > 0) & (q % np.maximum(period_at[at], 1) == 0) & (at + q + b <= until[at])
        good = (q <= high) & (at + q + b <= ends[owner]) & ~known
        at, q, owner = at[good], q[good], owner[good]
        done = (-1, 0, 0)  # text and period of the last stretch, and where it ends
        for k in np.lexsort((at, q, owner)):
            i, period, text = int(at[k]), int(q[k]), int(owner[k])
            if done[:2] == (text, period) and i < done[2]:
                continue
            if period_at[i] and period % period_at[i] == 0 and i + period + b <= until[i]:
                continue  # inside a run of a period that divides this one
            if not np.array_equal(x[i:i + b], x[i + period:i + period + b]):
                continue
            end = _equal_after(x, i + b, period, int(ends[text]))
            start = _equal_before(x, i, period, int(begins[text]))
            done = (text, period, end)
            length = end + period - start
            if length < max(LEAST, 2 * period) or any(
                    np.array_equal(x[start:start + length - d], x[start + d:start + length])
                    for d in (period // r for r in _prime_factors(period))):
                continue
            runs[text].append((start - int(begins[text]), length, period))
            part = slice(start, start + length)
            further = until[part] < start + length
            until[part][further] = start + length
            period_at[part][further] = period
    return [sorted(r, key=lambda v: (v[0], v[2])) for r in runs]


def collapse(words: Sequence[str], runs: Sequence[tuple[int, int, int]]) -> str:
    """The words without those that a run holds after its first period."""
    drop = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    dropped = np.cumsum(drop[:-1]) > 0
    return " ".join(w for w, gone in zip(words, dropped.tolist()) if not gone) if runs else " ".join(words)


def runs_of_texts(texts: Sequence[str | None]) -> list[tuple[int, list[tuple[int, int, int]], str]]:
    """(number of words, runs, collapsed text) of each text."""
    words = [WORD.findall(t or "") for t in texts]
    number: dict[str, int] = {}
    coded = [np.array([number.setdefault(w, len(number)) for w in ws], dtype=np.int64) for ws in words]
    return [(len(ws), r, collapse(ws, r)) for ws, r in zip(words, find_runs(coded))]


def detect(df: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``df``), ``n_words``, ``runs`` (by start, then
    period) and ``collapsed`` (the kept words, joined by a blank) per row."""
    rows = df.select(as_row(df))
    made = _parse_datatype_string(MADE)
    types = [f.type for f in to_arrow_schema(made)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field(text)
            # a group ends where its characters would hold some GROUP_WORDS words
            size = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.utf8_length(texts), 0))) // (6 * GROUP_WORDS)
            cuts = [0, *(np.nonzero(np.diff(size))[0] + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                cols = zip(*runs_of_texts(texts.slice(lo, hi - lo).to_pylist()))
                arrays = [pa.array([[dict(zip(("start", "length", "period"), r)) for r in v] for v in c] if k == 1 else c, type=types[k])
                          for k, c in enumerate(cols)]
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(lo, hi - lo), *arrays], names=["row", *made.names])

    return shipped(rows).mapInArrow(run, StructType(list(rows.schema.fields) + list(made.fields)))


# ------------------------------------------------------------- of the contract
def repeated_words(doc_id: Column, text: Column) -> Column:
    """The text, of one document in ten with its words from some place on replaced by
    repeats of those that stand there first (place and period follow from the id's crc32)."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def replaced(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.concat_ws(" ", F.transform(words, lambda w, i: F.when(i < a, w).otherwise(
            F.get(words, (a + (i - a) % p).cast("int")))))

    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    # bound to a lambda variable, so the words are split once and not for every word
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, replaced(w)).otherwise(text))[0]
    return F.when(h % 10 == 0, made).otherwise(text)


def digest(df: DataFrame) -> DataFrame:
    """One row per document: its number of runs, the longest one, and checksums."""
    found = detect(df.select("doc_id", repeated_words(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("neg"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), (-F.col("best.neg")).alias("length"), F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.neg") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
