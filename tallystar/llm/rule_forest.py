"""Quality rules: an isolation forest on rule statistics.

Each text is reduced to rule statistics (shares, not raw sizes, apart from the
logarithm of the word count). Isolation trees split random statistics at random
values between the least and the greatest of the points in the node, widened by
a small share (``MARGIN``) of the span that the statistic can take (``SPAN``);
documents that few splits isolate are anomalous. The margin lets a split fall
just outside of the points, where good rows are all alike (no symbols at all)
and others are not; as it is fixed, no document, however extreme, moves the
splits that judge the others. As the method has it, each tree is grown on a random
subsample of its own, drawn from all rows labelled good (from all rows, where none is):
``subsamples``. The verdict's threshold is found on all labelled rows, by exact
selection (``threshold``). The verdicts cover all documents.

The threshold is the one that catches the most rows labelled bad among those
that keep at least ``keep_good`` of the rows labelled good, so clean documents
stay. Base rules fail a document on their own (see ``stats``).

Defined cases: a null or empty text has no words and fails the base rules.
Without both labels the threshold is infinite (the forest rejects nothing). A
constant statistic is split in its margin only; ties go to the left branch. Repeated rows
are judged alike; extra columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.operators.quantiles import exact_quantiles

from .common import per_text, stored

MIN_WORDS = 10
MAX_REPEAT_SHARE = 20      # percent of words inside repeated windows
WINDOW = 5
SYMBOLS = "#*$%&|<>"
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
FEATURES = ("log_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share",
            "upper_share", "digit_share", "stop_share", "distinct_share", "same_next_share")
# the span that each statistic takes in texts: shares by definition, the others by what words and lengths there are
SPAN = np.array([12, 16, 1, 1, 1, 1, 1, 1, 2.5, 1], dtype=float)
MARGIN = 0.05
TREES, SUBSAMPLE, DEPTH_LIMIT = 100, 256, 14
_BLANKS = " \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of WINDOW words that occur twice or more (exact)."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    size = len(ids)
    code, span = seq, 1
    for step in (1, 2, 1):  # windows of 2, 4, then 5 words, renumbered so codes never overflow
        tail = seq if step == 1 else code
        width = size if step == 1 else int(code.max()) + 1
        joined = code[:len(tail) - span if step == 1 else len(code) - step]
        joined = joined[:len(words) - span - step + 1] * width + tail[span:span + len(words) - span - step + 1]
        code = np.unique(joined, return_inverse=True)[1].astype(np.int64)
        span += step
    twice = np.bincount(code)[code] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[:n] += twice
    edge[WINDOW:WINDOW + n] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


def stats(text: str | None) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """The base counts and the features of one text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # at space and \t-\r only
    n = len(words)
    chars = len(text) - sum(map(text.count, _BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    base = (n, chars, symbols, dup, repeat)
    upper = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    same = sum(a == b for a, b in zip(words, words[1:]))
    short = sum(len(w) <= 3 for w in words)
    per = max(n, 1)
    # distinct words fall with length; compared with a typical growth of n ** 0.85
    return base, [math.log1p(n), chars / per, symbols / max(chars, 1), dup / max(len(lines), 1), repeat / per,
                  upper / max(chars, 1), digits / max(chars, 1), short / per,
                  len(set(words)) / per ** 0.85, same / per]


def _path_norm(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Trees as flat arrays: feature (-1: leaf), cut, left, right, depth reached."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    norm: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / norm) for each row; higher is more anomalous."""
        if not self.trees or not len(x):
            return np.zeros(len(x))
        total = np.zeros(len(x))
        row = np.arange(len(x))
        for feature, cut, left, right, depth in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                f = feature[node]
                if (f < 0).all():
                    break
                go_left = x[row, np.maximum(f, 0)] <= cut[node]
                node = np.where(f < 0, node, np.where(go_left, left[node], right[node]))
            total += depth[node]
        return 2.0 ** (-total / len(self.trees) / self.norm)


def grow(sample: np.ndarray, lo: np.ndarray, hi: np.ndarray, *, trees: int = TREES, subsample: int = SUBSAMPLE,
         depth_limit: int = DEPTH_LIMIT, seed: int = 11) -> Forest:
    """Trees over subsamples of ``sample``, which is all rows in memory."""
    rng = np.random.default_rng(seed)
    size = min(subsample, len(sample))
    return grow_each([sample[rng.choice(len(sample), size, replace=False)] for _ in range(trees)], lo, hi,
                     depth_limit=depth_limit, seed=seed)


def grow_each(samples: Sequence[np.ndarray], lo: np.ndarray, hi: np.ndarray, *, depth_limit: int = DEPTH_LIMIT,
              seed: int = 11) -> Forest:
    """One tree over each of ``samples``; ``hi - lo`` is the span of each statistic. A split in
    the margin leaves one side without sample points: that side is a leaf, reached by
    what the sample does not look like."""
    rng = np.random.default_rng(seed)
    size = max(map(len, samples), default=0)
    margin = MARGIN * (hi - lo)
    usable = np.flatnonzero(margin > 0)
    if size < 2 or not len(usable):
        return Forest([], 1.0)
    grown = []
    for sample in samples:
        feature, cut, left, right, depth = [], [], [], [], []

        def node(x: np.ndarray, d: int) -> int:
            at = len(feature)
            feature.append(-1), cut.append(0.0), left.append(at), right.append(at)
            depth.append(d + _path_norm(len(x)))
            if len(x) > 1 and d < depth_limit:
                f = int(rng.choice(usable))
                c = float(rng.uniform(x[:, f].min() - margin[f], x[:, f].max() + margin[f]))
                goes = x[:, f] <= c
                feature[at], cut[at] = f, c
                left[at], right[at] = node(x[goes], d + 1), node(x[~goes], d + 1)
            return at

        node(sample, 0)
        grown.append(tuple(np.array(a) for a in (feature, cut, left, right, depth)))
    return Forest(grown, max(_path_norm(size), 1e-9))


def subsamples(rows: DataFrame, trees: int = TREES, size: int = SUBSAMPLE, seed: int = 11) -> list[np.ndarray]:
    """For each tree the features of its own ``size`` of all ``rows`` (doc_id, features), those
    whose keys hash smallest with the tree's number: every row may be drawn for every tree.

    Of many rows, only those below the hash that about four times ``size`` fall under are numbered
    (counted, and not relied on). Trees * size rows reach the driver."""
    def order(tree: Column) -> Column:
        return F.xxhash64(F.lit(seed), tree, F.col("doc_id"), F.col("features"))

    def draw(chosen: Column) -> list[np.ndarray]:
        each = rows.select("doc_id", "features", F.explode(chosen).alias("tree"))
        by_tree = Window.partitionBy("tree").orderBy(order(F.col("tree")), "doc_id", "features")
        got = (each.withColumn("n", F.row_number().over(by_tree)).where(F.col("n") <= size)
               .select("tree", "n", "features").toArrow().sort_by([("tree", "ascending"), ("n", "ascending")]))
        x = np.array(got.column("features").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
        tree = got.column("tree").to_numpy()
        return [x[tree == t] for t in range(trees)]

    total, numbers = rows.count(), F.sequence(F.lit(0), F.lit(trees - 1))
    share = 4 * size / max(total, 1)
    if share < 1:
        bound = F.lit(int(-2 ** 63 + 2 ** 64 * share))
        drawn = draw(F.filter(numbers, lambda t: order(t) < bound))
        if min(map(len, drawn)) == size:
            return drawn
    return draw(numbers)


def calibrate(scores: np.ndarray, good: np.ndarray, keep_good: float) -> float:
    """Scores above the result are rejected."""
    if not good.any() or good.all():
        return math.inf
    # of the cuts that keep enough good rows, the lowest catches the most bad ones
    ordered = np.sort(scores[good])
    cut = ordered[min(len(ordered) - 1, math.ceil(keep_good * len(ordered)) - 1)]
    above = scores[~good][scores[~good] > cut]
    # half way to the next bad score: unseen good rows just above the cut stay too
    return float(cut + (above.min() - cut) / 2) if len(above) else math.inf


def threshold(scored: DataFrame, keep_good: float) -> float:
    """``calibrate`` over a table (q, anomaly) of any size, in passes of bounded memory: the same number."""
    good, bad = (scored.where(F.col("q") == q).select("anomaly") for q in (1, 0))
    n = good.count()
    if not n or bad.isEmpty():
        return math.inf
    rank = min(n - 1, math.ceil(keep_good * n) - 1)
    near = exact_quantiles(good, ["anomaly"], [rank / max(n - 1, 1)])["anomaly"][0]
    # the score of that rank: the quantile may lie a rounding beside it
    cut = good.agg(F.min_by("anomaly", F.abs(F.col("anomaly") - F.lit(near)))).first()[0]
    above = bad.where(F.col("anomaly") > F.lit(cut)).agg(F.min("anomaly")).first()[0]
    return math.inf if above is None else float(cut + (above - cut) / 2)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and the feature array of each row."""
    def one(text: str | None) -> tuple:
        base, features = stats(text)
        failed = base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEAT_SHARE * base[0]
        return (*base, failed, features)

    return per_text(docs.select("doc_id", "text"), one, f"{BASE}, base_failed boolean, features array<double>")


def judge(docs: DataFrame, labels: DataFrame, *, keep_good: float = 0.995, seed: int = 11) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, anomaly for each row of ``docs``."""
    rows = stored(measure(docs), "rule_stats")
    known = (labels.where("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("q"),
                                                                    F.max("quality").alias("hi")).where("q = hi"))
    # the forest describes documents the base rules pass; those it has not to judge stay out
    usable = rows.where("NOT base_failed")
    good = usable.join(known.where("q = 1").select("doc_id"), "doc_id").select("doc_id", "features")
    base = stored(good, "rule_good")
    drawn = subsamples(usable.select("doc_id", "features") if base.isEmpty() else base, seed=seed)
    shared = rows.sparkSession.sparkContext.broadcast(  # trees * subsample * depth_limit nodes at most
        grow_each(drawn, np.zeros(len(FEATURES)), SPAN, seed=seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(batch.column("features").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in out], pa.array(shared.value.score(values))],
                                             names=[*out, "anomaly"])

    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    scored = stored(rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, {BASE}, base_failed boolean, "
                                         "anomaly double"), "rule_scores")
    marked = stored(scored.where("NOT base_failed").join(known.select("doc_id", "q"), "doc_id").select("q", "anomaly"),
                    "rule_marked")
    limit = threshold(marked, keep_good)
    kept = ~F.col("base_failed") & ~(F.col("anomaly") > F.lit(limit))
    return scored.select(*out, kept.alias("kept"), "anomaly")
