"""Suggestions for names that two sources spell differently.

A name of one source without an equal in the other is met with the other's
names that share rare words with it or lie within ``EDITS`` edits of it, and
the best few are suggested, as input for ``renames``.

Names are compared lower-cased, ``&`` as ``and``, and other marks as blanks.
``score`` is, in thousandths, the larger of two: the letters in words common
to both over those of the shorter name, and 1 less the edits over the length
of the longer name. Pairs come from two kinds of block, both without loss:

* words: names that share half of the shorter one's letters share one of
  its rarest words that make up more than the other half (prefix filter), so
  words that most names hold form no block unless a name has nothing else;
* edits: of ``EDITS + 1`` pieces of a name at least one stands unchanged in
  a name within ``EDITS`` edits, at most ``EDITS`` places away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EDITS = 2
SHARE = 500  # thousandths of the shorter name's letters that must be shared


def plain_name(c: Column) -> Column:
    spelled = F.regexp_replace(F.lower(F.replace(c, F.lit("&"), F.lit(" and "))), r"[^\p{L}\p{N}]+", " ")
    return F.trim(spelled)


def _letters(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda acc, w: acc + F.length(w))


def _names(df: DataFrame, col: str) -> DataFrame:
    named = df.select(F.col(col).alias("name")).where(F.col("name").isNotNull()).distinct()
    named = named.withColumn("plain", plain_name(F.col("name"))).where(F.col("plain") != "")
    words = F.array_distinct(F.split("plain", " "))
    return named.withColumn("words", words).withColumn("letters", _letters(F.col("words")))


def _word_blocks(names: DataFrame, frequency: DataFrame) -> DataFrame:
    """name, word, prefix: a name's words; in the prefix if the letters of it and of all more
    frequent words could still reach ``SHARE``."""
    each = names.select("name", "letters", F.explode("words").alias("word")).join(frequency, "word")
    rest = Window.partitionBy("name").orderBy(F.desc("n"), F.desc("word")).rowsBetween(Window.unboundedPreceding, 0)
    return each.select("name", "word", (F.sum(F.length("word")).over(rest) * 1000 >= F.col("letters") * SHARE).alias("prefix"))


def _pieces(names: DataFrame, edits: int) -> DataFrame:
    """name, size, part, piece: the pieces of a name, which tell its length."""
    size = F.length("plain")
    part = F.explode(F.sequence(F.lit(0), F.lit(edits))).alias("part")
    cut = names.select("name", "plain", size.alias("size"), part)
    start, end = _piece(F.col("size"), F.col("part"), edits)
    return cut.select("name", "size", "part", F.substring("plain", start + 1, end - start).alias("piece"))


def _piece(size: Column, part: Column, edits: int) -> tuple[Column, Column]:
    n = edits + 1
    return F.floor(size * part / n).cast("int"), F.floor(size * (part + 1) / n).cast("int")


def _windows(names: DataFrame, edits: int) -> DataFrame:
    """name, size, part, piece: what a name holds where another name of length ``size`` may have a piece."""
    near = F.sequence(F.length("plain") - edits, F.length("plain") + edits)
    spread = (names.select("name", "plain", F.explode(near).alias("size")).where(F.col("size") >= 0)
              .select("*", F.explode(F.sequence(F.lit(0), F.lit(edits))).alias("part"))
              .select("*", F.explode(F.sequence(F.lit(-edits), F.lit(edits))).alias("shift")))
    start, end = _piece(F.col("size"), F.col("part"), edits)
    at = start + F.col("shift")
    return (spread.where((at >= 0) & (at + end - start <= F.length("plain")))
            .select("name", "size", "part", F.substring("plain", at + 1, end - start).alias("piece")).distinct())


def suggest_renames(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
                    k: int = 3, edits: int = EDITS) -> DataFrame:
    """``(name, rank, suggestion, score, edits)``: for each name of ``left`` that ``right`` does not
    have, its ``k`` most similar names of ``right``, ties by edits, then by name.

    NULL and names without a letter or digit take no part; a name without any candidate has no row."""
    b = _names(right, right_col)
    a = _names(left, left_col).join(b.select("name"), "name", "left_anti")
    frequency = (a.select("words").unionAll(b.select("words")).select(F.explode("words").alias("word"))
                 .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    wa, wb = _word_blocks(a, frequency).alias("a"), _word_blocks(b, frequency).alias("b")
    # the shorter of two names is the one whose prefix counts: it may be either
    by_word = wa.join(wb, (F.col("a.word") == F.col("b.word")) & (F.col("a.prefix") | F.col("b.prefix")))
    pa, wb = _pieces(a, edits).alias("a"), _windows(b, edits).alias("b")
    by_edit = pa.join(wb, (F.col("a.size") == F.col("b.size")) & (F.col("a.part") == F.col("b.part"))
                      & (F.col("a.piece") == F.col("b.piece")))
    pairs = by_word.select("a.name", F.col("b.name").alias("suggestion")).unionAll(
        by_edit.select("a.name", F.col("b.name").alias("suggestion"))).distinct()

    other = b.select(F.col("name").alias("suggestion"), F.col("plain").alias("plain_b"), F.col("words").alias("words_b"),
                     F.col("letters").alias("letters_b"))
    met = pairs.join(a, "name").join(other, "suggestion")
    common = F.floor(_letters(F.array_intersect("words", "words_b")) * 1000 / F.least("letters", "letters_b")).cast("int")
    n = F.levenshtein("plain", "plain_b")
    longer = F.greatest(F.length("plain"), F.length("plain_b"))
    scored = (met.withColumn("edits", n).withColumn("_common", common).where((F.col("_common") >= SHARE) | (n <= edits))
              .withColumn("score", F.greatest("_common", F.floor((longer - n) * 1000 / longer).cast("int"))))
    order = Window.partitionBy("name").orderBy(F.desc("score"), "edits", "suggestion")
    return (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("name", "rank", "suggestion", "score", "edits"))
