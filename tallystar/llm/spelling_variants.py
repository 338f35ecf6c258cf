"""Spelling variants: each word led back to a far more frequent one near it.

Two words are near if exactly one inserted, deleted or replaced code point
leads from one to the other. ``near_pairs`` finds all such pairs by pivotal
grams:

1. Bigrams (with their places in the word) are ordered by how many words hold
   them, rare ones first. The first three of a word, with all that tie with
   the third, are its prefix.
2. Two disjoint bigrams of the prefix are the word's pivots; dynamic
   programming picks the cheapest two by the number of words that hold them.
   One edit touches at most one of the two, so the other stands in every near
   word, at the same place or one beside it.
3. Of two near words, let s be the one whose prefix ends first in the order
   (or as early): a pivot of s that stands in r belongs to r's prefix. So pivots are
   looked up among the prefix bigrams of other words only, at the places and
   word lengths that one edit allows, by an equi-join on bigram, place and
   length; the order of the prefix ends prunes, an edit distance confirms.

Bigrams are counted in ``GRAM_BUCKETS`` hashed buckets, so what is sent to the
tasks is bounded for any alphabet; a bucket count orders them as well as an
exact one does, and the pairs do not depend on it.

``group`` picks for each word its form, the near word of largest count (ties:
the smallest in code-point order) if that count is at least ``factor`` times
its own, and follows forms to a root. Counts grow by ``factor`` along forms,
so there are no circles and at most 27 steps for 64-bit counts; doubling needs five
rounds at most.

Defined results: null texts hold no words; rows without id keep their words
as they are in the contract's edit; empty tables give empty ones; words of any
length are taken; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_row, stored

LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAM_BUCKETS = 1 << 16
ROUNDS = 5                  # doubled steps: 2^5 exceeds log5(2^63)
TYPO_EVERY = 199
PREFIX, PIVOTS = 3, 2       # bigrams of a prefix for one edit, and the pivots among them
# (place, length) of a kept bigram in the other word, against its own: one replaced,
# inserted behind it, inserted before it, deleted behind it, deleted before it
MOVES = ((0, 0), (0, 1), (1, 1), (0, -1), (-1, -1))


def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % GRAM_BUCKETS


def disjoint_pivots(grams: Sequence[tuple[int, str, int]], picks: int = PIVOTS, width: int = 2) -> list[tuple[int, str, int]]:
    """``picks`` pairwise disjoint grams (weight, gram, place) of least total weight.

    By place: the best choice of k among the first i grams either leaves out the
    i-th or adds it to the best k - 1 among those that end before it begins."""
    by_place = sorted(grams, key=lambda g: g[2])
    best: list[list[tuple[int, list]]] = [[(0, [])] * (len(by_place) + 1)]
    none = (float("inf"), [])
    for k in range(1, picks + 1):
        row = [none]
        for i, gram in enumerate(by_place):
            before = i
            while before and by_place[before - 1][2] > gram[2] - width:
                before -= 1
            weight, chosen = best[k - 1][before]
            row.append(min(row[-1], (weight + gram[0], [*chosen, gram]), key=lambda c: c[0]))
        best.append(row)
    return best[picks][-1][1]


def signature(word: str, weights: np.ndarray) -> tuple[list[dict], list[dict], dict] | None:
    """Pivots, prefix bigrams and the end of the prefix in the order; words of fewer
    than four code points have no two disjoint bigrams in every prefix: None."""
    grams = sorted((int(weights[_bucket(word[i:i + 2])]), word[i:i + 2], i) for i in range(len(word) - 1))
    if len(grams) < PREFIX:
        return None
    end = grams[PREFIX - 1][:2]
    prefix = [g for g in grams if g[:2] <= end]
    return ([{"gram": g, "place": p} for _, g, p in disjoint_pivots(prefix)],
            [{"gram": g, "place": p} for _, g, p in prefix], {"weight": end[0], "gram": end[1]})


def near_pairs(words: DataFrame) -> DataFrame:
    """(word_a, n_a, word_b, n_b), a before b, of all pairs of near words of ``words`` (word, n),
    which holds each word once, of at least four code points."""
    gram = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2))))
    counted = (words.where(F.length("word") >= PREFIX + 1).select(gram.alias("gram"))
               .groupBy(F.pmod(F.crc32(F.col("gram").cast("binary")), F.lit(GRAM_BUCKETS)).alias("bucket"))
               .agg(F.count(F.lit(1)).alias("words")))
    weights = np.zeros(GRAM_BUCKETS, dtype=np.int64)
    for r in counted.collect():  # at most GRAM_BUCKETS rows
        weights[r["bucket"]] = r["words"]
    held = words.sparkSession.sparkContext.broadcast(weights)
    entry = "array<struct<gram: string, place: int>>"
    signed = per_row(words.select("word", "n"), lambda w: signature(w, held.value) or ([], [], None),
                     f"pivots {entry}, prefix {entry}, last struct<weight: bigint, gram: string>", "word")
    signed = stored(signed.select("row.word", "row.n", F.length("row.word").alias("size"), "pivots", "prefix", "last"), "grams")
    moved = F.array(*[F.struct((F.col("g.place") + p).alias("place"), (F.col("size") + s).alias("size")) for p, s in MOVES])
    probe = (signed.select("word", "n", "size", "last", F.explode("pivots").alias("g"))
             .select(F.col("word").alias("s"), F.col("n").alias("n_s"), F.col("last").alias("last_s"), F.col("g.gram").alias("gram"),
                     F.explode(moved).alias("m")).select("s", "n_s", "last_s", "gram", "m.place", "m.size"))
    index = signed.select(F.col("word").alias("r"), F.col("n").alias("n_r"), F.col("last").alias("last_r"), "size",
                          F.explode("prefix").alias("g")).select("r", "n_r", "last_r", "size", "g.gram", "g.place")
    met = probe.join(index, ["gram", "place", "size"]).where(
        (F.col("last_s") <= F.col("last_r")) & (F.col("s") != F.col("r")) & (F.levenshtein("s", "r", 1) == 1))
    first = F.col("s") < F.col("r")
    return met.select(F.least("s", "r").alias("word_a"), F.when(first, F.col("n_s")).otherwise(F.col("n_r")).alias("n_a"),
                      F.greatest("s", "r").alias("word_b"), F.when(first, F.col("n_r")).otherwise(F.col("n_s")).alias("n_b")).distinct()


def group(words: DataFrame, factor: int = 5) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for each row of ``words`` (word, n)."""
    both = near_pairs(words).select(F.explode(F.array(
        F.struct(F.col("word_a").alias("word"), F.col("word_b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("word_b").alias("word"), F.col("word_a").alias("near"), F.col("n_a").alias("near_n")))).alias("x")).select("x.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("neg"), F.col("near"))).alias("best"))
    has = -F.col("best.neg") >= factor * F.col("n")
    formed = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best.near")).alias("form"), F.when(has, -F.col("best.neg")).alias("form_n")), "forms")
    steps = formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(ROUNDS):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = stored(steps.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return formed.join(steps.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def misspelt(doc_id: Column, run: Column) -> Column:
    """The run, of one in ``TYPO_EVERY`` (by the crc32 of ``<doc_id>:<run>``) without one code point."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    k = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), k), F.substring(run, k + 2, F.length(run)))
    return F.when(h % TYPO_EVERY == 0, cut).otherwise(run)


def word_counts(df: DataFrame, min_length: int = 6, min_count: int = 5, edit=misspelt) -> DataFrame:
    """``word`` and ``n``: the lower-cased letter runs of all texts, edited, of at least
    ``min_length`` code points that occur at least ``min_count`` times. ``edit=None`` leaves the runs as they are."""
    runs = df.select("doc_id", F.explode(F.expr(f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{LETTERS}', 0)")).alias("run"))
    runs = runs.where(F.length("run") >= min_length)
    words = runs.select((edit(F.col("doc_id"), F.col("run")) if edit else F.col("run")).alias("word"))
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") >= min_count) & (F.length("word") >= min_length)))


def variants(df: DataFrame) -> DataFrame:
    """``group`` of the ``word_counts`` of ``df``."""
    return group(stored(word_counts(df), "words"))


def oracle() -> str:
    """DuckDB SQL for ``variants`` of ``documents``. A crc32 is the exclusive or of what each
    byte adds by its value and its distance from the end, and of a constant of the length."""
    table = [0] * 256
    for b in range(256):
        c = b
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table[b] = c
    listed = ", ".join(map(str, table))
    return f"""
WITH RECURSIVE step AS (
  SELECT b, [{listed}][b + 1]::BIGINT AS v FROM range(256) t(b)),
found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents),
runs AS (
  SELECT doc_id, run, count(*) AS times FROM found WHERE length(run) >= 6 GROUP BY ALL),
keyed AS (
  SELECT doc_id, run, times, concat(doc_id, ':', run) AS key FROM runs),
longest AS (
  SELECT coalesce(max(octet_length(encode(key))), 0) AS m FROM keyed),
grown(k, b, v) AS (
  SELECT 0, b, v FROM step
  UNION ALL
  SELECT g.k + 1, g.b, xor(g.v >> 8, s.v) FROM grown g JOIN step s ON s.b = g.v & 255
  WHERE g.k < (SELECT m FROM longest)),
start(k, c) AS (
  SELECT 0, 4294967295::BIGINT
  UNION ALL
  SELECT k + 1, xor(c >> 8, s.v) FROM start JOIN step s ON s.b = c & 255
  WHERE k < (SELECT m FROM longest)),
bytes AS (
  SELECT key, octet_length(encode(key)) AS size, unnest(range(octet_length(encode(key)))) AS i, hex(encode(key)) AS digits
  FROM (SELECT DISTINCT key FROM keyed)),
crc AS (
  SELECT key, any_value(size) AS size, bit_xor(g.v) AS x FROM bytes JOIN grown g
    ON g.k = size - 1 - i AND g.b = ('0x' || substr(digits, 2 * i + 1, 2))::INTEGER GROUP BY key),
hashed AS (
  SELECT key, xor(xor(x, s.c), 4294967295) AS h FROM crc JOIN start s ON s.k = size),
edited AS (
  SELECT CASE WHEN doc_id IS NOT NULL AND h % {TYPO_EVERY} = 0
              THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
  FROM keyed JOIN hashed USING (key)),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM edited WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
cuts AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, min({{'neg': -near_n, 'near': near}}) AS best FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.neg >= 5 * w.n THEN best.near END AS form,
         CASE WHEN -best.neg >= 5 * w.n THEN -best.neg END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
chain AS (
  SELECT word, word AS here, 0 AS depth FROM formed
  UNION ALL
  SELECT c.word, f.form, depth + 1 FROM chain c JOIN formed f ON c.here = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM formed f JOIN (SELECT word, arg_max(here, depth) AS root FROM chain GROUP BY word) c ON c.word = f.word"""
