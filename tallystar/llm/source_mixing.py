"""Mixing sources to target weights by Poisson replication.

A source of ``size`` characters and target weight ``w`` gets the mean
repetition rate ``w * total / size``. Each document draws its number of copies
by inverting that Poisson distribution at a uniform number hashed from
(seed, doc_id); copies are exploded and shuffled globally by a hashed key. The
draws need no state, so a lost task repeats them, and the expected mix meets
the targets exactly. Only DataFrame functions are used.

Without ``weights`` the targets are ``size ** alpha``, normalised.

Rates above ``SPLIT`` are drawn as a sum of independent draws of smaller rate
(a sum of Poisson variables is Poisson), so no term underflows.

Defined cases: a null source is a source of its own; a null or empty text
counts one character, so every source has a rate; a null doc_id hashes as the
empty string; a weight of zero, null or a source without weight drops the
source; negative weights are an error. Rows that repeat a doc_id draw the same
number. Extra columns are kept; the columns ``copy`` and ``shuffle_key`` are
added (a column of that name in the input is replaced). An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_row, small_enough, stored

SPLIT = 16.0               # largest rate drawn at once
TERMS = 80                 # P(Poisson(16) > 80) < 1e-27
ALPHA = 0.5
SEED = 17


def uniform(*parts: Column) -> Column:
    """A number in [0, 1): the first 52 bits of the md5 of the joined parts."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def distribution(rate: Column) -> Column:
    """The running sums of the Poisson terms 0..TERMS-1 for ``rate`` <= SPLIT."""
    start = F.struct(F.exp(-rate).alias("term"), F.array(F.exp(-rate)).alias("sums"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * rate / k
        return F.struct(term.alias("term"),
                        F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + term)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), start, step, lambda acc: acc["sums"])


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, *, alpha: float = ALPHA) -> DataFrame:
    """_source, rate, draws, sums for each source that has a weight."""
    if weights is not None and any(w is not None and w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative")
    size = (docs.groupBy(F.col("source").alias("_source"))
            .agg(F.sum(F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1))).alias("size")))
    if weights is None:
        size = size.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(alpha)))
    else:
        given = docs.sparkSession.createDataFrame(
            [(k, float(w)) for k, w in weights.items() if w], "_key string, weight double")
        size = size.join(given, F.col("_source").cast("string").eqNullSafe(F.col("_key"))).drop("_key")
    size = stored(size, "source_sizes")
    total = size.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()  # two numbers
    rate = (F.col("weight") / F.lit(total["weight"])) * F.lit(total["size"]) / F.col("size")
    return (size.withColumn("rate", rate)
            .withColumn("draws", F.greatest(F.ceil(F.col("rate") / SPLIT), F.lit(1)).cast("int"))
            .withColumn("sums", distribution(F.col("rate") / F.col("draws")))
            .select("_source", "rate", "draws", "sums"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, *, alpha: float = ALPHA,
        seed: int = SEED, max_broadcast: int = 10_000) -> DataFrame:
    """The columns of ``docs`` with ``copy`` (from 0) and ``shuffle_key``, in global random order."""

    per_source = stored(rates(docs, weights, alpha=alpha), "rates")
    rows = docs.drop("copy", "shuffle_key")
    rows = rows.select(as_row(rows), F.col("source").alias("source"), F.col("doc_id").alias("doc_id"))
    # counted: one row a source, each of about a kilobyte; beyond the bound AQE joins (and splits hot sources)
    side = F.broadcast(per_source) if small_enough(per_source, max_broadcast) else per_source.hint("merge")
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("draws")), F.lit(0),
        lambda acc, d: acc + F.size(F.filter(
            F.col("sums"), lambda s: s <= uniform(F.lit(seed), F.col("doc_id"), d))))
    copies = (rows.join(side, rows["source"].eqNullSafe(F.col("_source")))
              .withColumn("copies", drawn).where("copies > 0")
              .select("row", "doc_id", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy")))
    keyed = copies.withColumn("shuffle_key", uniform(F.lit(f"{seed}s"), F.col("doc_id"), F.col("copy")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a hashed key deals documents at random, whatever their source or group of copies
    return (keyed.repartition(parts, "shuffle_key").sortWithinPartitions("shuffle_key")
            .select("row.*", "copy", "shuffle_key"))


def oracle(alpha: float = ALPHA, seed: int = SEED) -> str:
    """DuckDB SQL for the rows of ``mix(documents)``."""
    def number(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / 4503599627370496.0"

    return f"""
    WITH RECURSIVE size AS (
      SELECT source, sum(greatest(length(coalesce(text, '')), 1)) AS size FROM documents GROUP BY source),
    rate AS (
      SELECT source, (pow(size::DOUBLE, {alpha}) / sum(pow(size::DOUBLE, {alpha})) OVER ())
             * (sum(size) OVER ())::DOUBLE / size AS rate FROM size),
    split AS (
      SELECT source, greatest(ceil(rate / {SPLIT}), 1)::INT AS draws,
             rate / greatest(ceil(rate / {SPLIT}), 1) AS rate FROM rate),
    cdf(source, rate, k, term, total) AS (
      SELECT source, rate, 0, exp(-rate), exp(-rate) FROM split
      UNION ALL
      SELECT source, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1)
      FROM cdf WHERE k + 1 < {TERMS}),
    sums AS (SELECT source, list(total ORDER BY k) AS sums FROM cdf GROUP BY source),
    drawn AS (
      SELECT d.*, list_sum(list_transform(range(1, s.draws + 1), lambda x: len(list_filter(c.sums,
               lambda t: t <= {number(f"'{seed}:' || coalesce(d.doc_id::VARCHAR, '') || ':' || x")})))) AS copies
      FROM documents d JOIN split s ON d.source IS NOT DISTINCT FROM s.source
           JOIN sums c ON d.source IS NOT DISTINCT FROM c.source),
    copied AS (
      SELECT * EXCLUDE (copies), unnest(range(0, copies::BIGINT))::INT AS copy FROM drawn WHERE copies > 0)
    SELECT *, {number(f"'{seed}s:' || coalesce(doc_id::VARCHAR, '') || ':' || copy")} AS shuffle_key FROM copied
    """
