"""Document fingerprints by spot signatures, in DataFrame functions only.

Words are runs of letters, marks and digits, lower-cased in A-Z. Common words
(``ANCHORS``) are the anchors: each place where one stands gives a signature,
the anchor with the chain of the next ``chain`` content words (words that are
no anchors), every ``distance``-th of them. At the end of a text a chain holds
the content words that are left, at least one. A signature is the first 64
bits of an md5, as 16 hex digits. Anchors are spread evenly over natural text
and rare in menus and lists, so the set follows the prose.

``fingerprint``  the sorted set of a text's signatures, joined by blanks.
``likeness``     Jaccard similarity of two sets, 0 where the sizes alone keep
                 it below a wanted least.
``similar``      all links of at least a threshold in a table: documents with
                 one fingerprint form a class; classes are dealt into ranges
                 of set size such that linked ones lie in the same or in
                 neighbouring ranges, meet there on one of their rarest
                 signatures, and are compared by ``likeness``.
``with_next``    each row with the text of the next one in falling id order.

Defined results: a null text counts as empty. A text without an anchor before
a content word has one signature, made of its words, or of the text if it has
none; so equal texts, and only those, are alike there. In ``with_next`` rows
without id come last; rows with one id are ordered by their texts, and
repeated rows follow each other. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# Function words of English, German, French and Spanish.
ANCHORS = ("a an and are as at be but by for from had has have he in is it not of on or that the this to was were with "
           "als am auf aus das dass dem den der des die ein eine einen er es für hat im ist mit nach nicht sich sie "
           "und vom von war wie zu zum "
           "au aux avec ce cette dans du elle en est et il la le les leur mais ne ou par pas plus pour que qui se sur un une "
           "al como con del el ha las lo los más no para pero por su una y").split()
WORD_GAP = r"[^\p{L}\p{M}\p{N}]+"
HEX = 16                    # digits of a signature
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS_PER_PARTITION = 4   # id ranges of ``with_next`` for each shuffle partition


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once: inside a lambda over an array,
    an expression of the outer row would be computed again for every element."""
    return F.transform(F.array(value), use)[0]


# ----------------------------------------------------------------- signatures
def _hashed(text: Column) -> Column:
    return F.substring(F.md5(text.cast("binary")), 1, HEX)


def spots(text: Column, anchors: Sequence[str] = ANCHORS, chain: int = 2, distance: int = 1) -> Column:
    """The sorted set of a text's signatures, never empty."""
    plain = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(F.translate(plain, UPPER, LOWER), WORD_GAP), "")

    def signed(w: Column, content: Column, places: Column) -> Column:
        def at(place: Column, before: Column) -> Column:
            # of the words before an anchor, those that are no anchors: its chain starts behind them
            first = place - before
            chained = F.concat_ws(":", F.get(w, place), *[F.get(content, first + k * distance) for k in range(chain)])
            return F.when(first < F.size(content), _hashed(chained))
        made = F.array_distinct(F.array_compact(F.transform(places, at)))
        whole = F.when(F.size(w) > 0, F.concat(F.lit("="), F.array_join(w, " "))).otherwise(F.concat(F.lit("#"), plain))
        return bound(made, lambda m: F.when(F.size(m) > 0, F.sort_array(m)).otherwise(F.array(_hashed(whole))))

    def of_words(w: Column) -> Column:
        content = F.filter(w, lambda x: ~x.isin(*anchors))
        places = F.filter(F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1)).otherwise(F.array().cast("array<int>")),
                          lambda i: F.get(w, i).isin(*anchors))
        return bound(content, lambda c: bound(places, lambda p: signed(w, c, p)))

    return bound(words, of_words)


def fingerprint(spot_set: Column) -> Column:
    return F.array_join(spot_set, " ")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two signature sets; 0 where the smaller set holds less
    than ``least`` of the larger, as the similarity is then below ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    exact = bound(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n))
    return F.when(small < least * large, F.lit(0.0)).otherwise(exact) if least > 0 else exact


def fingerprints(df: DataFrame, text: str = "text", **how) -> DataFrame:
    """``df`` with ``spots`` and ``fingerprint`` of the column ``text``."""
    return df.withColumn("spots", spots(F.col(text), **how)).withColumn("fingerprint", fingerprint(F.col("spots")))


# ---------------------------------------------------------------------- links
def similar(df: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text", **how) -> tuple[DataFrame, DataFrame]:
    """All links of at least ``threshold``: (``members``, ``links``).

    ``members`` has one row per row of ``df``: ``key`` and ``class_id``, the
    smallest key with the same fingerprint (rows without a key form no class
    of their own). ``links`` has ``class_a < class_b`` and ``similarity``: one
    row per linked pair of classes, so copies are not expanded into pairs.

    A set of n signatures that has ``threshold`` in common with another shares
    one of its n - ceil(threshold * n) + 1 rarest with the other's as many;
    only those are listed and looked up."""
    signed = stored(df.select(F.col(key).alias("key"), spots(F.col(text), **how).alias("spots")), "spots")
    named = signed.withColumn("print", F.sha2(fingerprint(F.col("spots")), 256))
    classes = stored(named.groupBy("print").agg(F.min("key").alias("class_id"), F.first("spots").alias("spots"))
                     .where(F.col("class_id").isNotNull()), "spot-classes")
    members = named.select("key", "print").join(classes.select("print", "class_id"), "print").select(
        F.col("key").alias(key), "class_id")
    each = classes.select("class_id", F.size("spots").alias("n"), F.explode("spots").alias("spot"))
    rarity = each.groupBy("spot").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1)  # the others link nothing
    ranked = each.join(rarity, "spot").groupBy("class_id", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "spot"))).alias("shared"))
    # signatures that stand in one class only come first in the order of rarity
    listed = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1 - (F.col("n") - F.size("shared"))
    # the range of a set size: linked sizes differ by a factor of at most 1 / threshold
    size_class = F.floor(F.log(F.col("n").cast("double")) / (-math.log(threshold)) + 1e-9) if threshold < 1 else F.col("n").cast("long")
    rare = (ranked.where(listed > 0).withColumn("range", size_class)
            .select("class_id", "n", "range", F.explode(F.slice("shared", 1, listed.cast("int"))).alias("s"))
            .select("class_id", "n", "range", F.col("s.spot").alias("spot")))
    probe = rare.select(F.col("class_id").alias("class_b"), F.col("n").alias("n_b"), "spot",
                        F.explode(F.array("range", F.col("range") + 1)).alias("range"))
    low = F.least("n", "n_b") >= F.lit(threshold) * F.greatest("n", "n_b") - 1e-9
    met = rare.join(probe, ["range", "spot"]).where(low & (F.col("class_id") != F.col("class_b"))).select(
        F.least("class_id", "class_b").alias("class_a"), F.greatest("class_id", "class_b").alias("class_b")).distinct()
    sets = classes.select("class_id", "spots")
    both = met.join(sets.select(F.col("class_id").alias("class_a"), F.col("spots").alias("a")), "class_a") \
        .join(sets.select(F.col("class_id").alias("class_b"), F.col("spots").alias("b")), "class_b")
    links = both.select("class_a", "class_b", likeness(F.col("a"), F.col("b"), threshold - 1e-9).alias("similarity")) \
        .where(F.col("similarity") >= threshold - 1e-9)
    return members, links


# ------------------------------------------------------------------ neighbours
def _below(bounds: Sequence[int], value: Column) -> Column:
    """How many of the sorted ``bounds`` lie below ``value``, by bisection."""
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    at = F.array(*map(F.lit, bounds))
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, step: F.when(
        (low + step <= len(bounds)) & (F.get(at, low + step - 1) < value), low + step).otherwise(low))


def with_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``text`` and ``next_text``: the text of the next row in falling order of
    ``key``; after the last comes the first.

    The keys are cut at quantiles into ranges, each sorted by one task. A range ends
    at a key that occurs, so the rows with that key, which follow those of the range
    above, are sent there as well."""
    spark = df.sparkSession
    rows = df.select(key, text, F.coalesce(F.col(key).cast("long"), F.lit(-2 ** 63)).alias("_k"))
    n = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("_k", [(i + 1) / n for i in range(n)], max(10_000, 4 * n)), F.max("_k")).first()
    bounds = sorted({*(cuts[0] or []), cuts[1]}) if cuts[1] is not None else [0]
    # n numbers: the ranges of keys, not the keys
    at = F.array(*map(F.lit, bounds))
    placed = rows.withColumn("_b", _below(bounds, F.col("_k")))
    ends = F.get(at, F.col("_b")) == F.col("_k")
    last = F.col("_b") == len(bounds) - 1
    guest = F.when(ends, F.struct(F.when(last, 0).otherwise(F.col("_b") + 1).alias("bucket"), F.when(last, 2).otherwise(1).alias("guest")))
    dealt = placed.withColumn("_to", F.explode(F.array_compact(F.array(
        F.struct(F.col("_b").alias("bucket"), F.lit(0).alias("guest")), guest)))).select(key, text, "_k", "_to.bucket", "_to.guest")
    order = Window.partitionBy("bucket").orderBy(F.col("guest") == 2, F.desc("_k"), F.col(key).isNull(), F.xxhash64(text), text)
    return (dealt.withColumn("next_text", F.lead(text).over(order)).where(F.col("guest") == 0)
            .select(key, text, "next_text"))


# ------------------------------------------------------------- of the contract
def digest(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text (the last half
    replaced from the next document), and the likeness to both neighbours."""
    plain = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(plain).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2)
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                      F.substring("next_text", F.lit(1), half.cast("int")))
    sets = rows.withColumn("edited", edited).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), spots(F.col("text")).alias("own"),
        spots(F.col("edited")).alias("changed"), spots(F.col("next_text")).alias("next"))
    return sets.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))


def oracle() -> str:
    """DuckDB SQL for ``digest`` of ``documents``."""
    stop = ", ".join(f"'{a}'" for a in ANCHORS)
    gap = WORD_GAP
    return f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
                  first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next_text
  FROM documents),
made AS (
  SELECT *, left(text, n_chars - n_chars // 2) || left(next_text, n_chars // 2) AS edited FROM base),
kinds AS (
  SELECT doc_id, 'own' AS kind, text AS t FROM made UNION ALL
  SELECT doc_id, 'changed', edited FROM made UNION ALL
  SELECT doc_id, 'next', next_text FROM made),
cut AS (
  SELECT doc_id, kind, t, list_filter(regexp_split_to_array(translate(t, '{UPPER}', '{LOWER}'), '{gap}'), lambda w: w <> '') AS words
  FROM kinds),
each AS (
  SELECT doc_id, kind, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM cut),
marked AS (
  SELECT *, w IN ({stop}) AS anchor, sum(CASE WHEN w IN ({stop}) THEN 0 ELSE 1 END)
    OVER (PARTITION BY doc_id, kind ORDER BY i ROWS UNBOUNDED PRECEDING) AS c FROM each),
chained AS (
  SELECT doc_id, kind, c, w, lead(w) OVER (PARTITION BY doc_id, kind ORDER BY i) AS w2 FROM marked WHERE NOT anchor),
spots AS (
  SELECT DISTINCT a.doc_id, a.kind, substr(md5(concat_ws(':', a.w, b.w, b.w2)), 1, {HEX}) AS s
  FROM marked a JOIN chained b ON a.doc_id = b.doc_id AND a.kind = b.kind AND b.c = a.c + 1 WHERE a.anchor),
listed AS (
  SELECT doc_id, kind, list_sort(list(s)) AS s FROM spots GROUP BY ALL),
sets AS (
  SELECT cut.doc_id, cut.kind, coalesce(l.s, [substr(md5(CASE WHEN len(words) > 0 THEN '=' || array_to_string(words, ' ')
                                                           ELSE '#' || t END), 1, {HEX})]) AS s
  FROM cut LEFT JOIN listed l ON cut.doc_id = l.doc_id AND cut.kind = l.kind),
wide AS (
  SELECT m.doc_id, m.n_chars, sha256(m.edited) AS edited_sha256, o.s AS own, c.s AS changed, x.s AS nxt
  FROM made m JOIN sets o ON o.doc_id = m.doc_id AND o.kind = 'own' JOIN sets c ON c.doc_id = m.doc_id AND c.kind = 'changed'
  JOIN sets x ON x.doc_id = m.doc_id AND x.kind = 'next')
SELECT doc_id, n_chars, edited_sha256, array_to_string(own, ' ') AS fingerprint, array_to_string(changed, ' ') AS edited_fingerprint,
       len(list_intersect(own, changed))::DOUBLE / (len(own) + len(changed) - len(list_intersect(own, changed))) AS near_edited,
       len(list_intersect(own, nxt))::DOUBLE / (len(own) + len(nxt) - len(list_intersect(own, nxt))) AS near_next
FROM wide"""
