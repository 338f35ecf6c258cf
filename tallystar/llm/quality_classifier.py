"""Quality classifier: Naive Bayes support vectors.

Binary n-gram indicators are scaled by the log ratio of their class counts
(Naive Bayes), then a linear hinge-loss model is fitted on the scaled, length
normalised rows by dual coordinate descent. Margins are mapped to 0..1 by a
logistic curve fitted on cross-fitted margins.

N-grams of a text: lower-cased words; word shapes (lower-case letters left
out, runs collapsed, punctuation kept) as 1- and 2-grams; a mark when a word
equals the one before it, and when a line equals an earlier one.

The model is fitted on at most ``max_train`` labelled rows per call, taken in
a reproducible pseudo-random order; every other row is only scored. The
sample's n-grams, not its texts, reach the driver: of every text, all that
``min_count`` texts of the sample share.

Defined cases: a null or empty text, or one with none of the learned n-grams,
has margin equal to the bias. Rows with a null or conflicting label are not
learned from (conflict: both classes for one id). With one class only, or no
labelled row at all, every score is the smoothed share of good rows (0.5
without labels). Repeated rows are scored one by one; extra columns are
ignored by the score and pass through ``score_quality``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, held_out, per_row, per_text, stored

_LOWER = bytes(b for b in range(256) if 97 <= b <= 122 or b >= 128)
_CLASS = bytes.maketrans(
    bytes(range(256)),
    bytes(ord("X") if 65 <= b <= 90 else ord("9") if 48 <= b <= 57
          else 32 if 9 <= b <= 13 else b for b in range(256)))
_RUN = re.compile(rb"(.)\1+", re.S)


def grams(text: str | None) -> set[bytes]:
    """The n-gram indicators of one text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.lower().split()
    if not words:
        return set()
    out = set(words)
    # one pass over the bytes: lower-case letters go, so a plain word is empty
    shapes = data.translate(_CLASS, _LOWER).split(b" ")
    short = {s: _RUN.sub(rb"\1", s) for s in set(shapes)}
    out.update(b"\x01" + s for s in short.values())
    out.update(b"\x02" + short[a] + b" " + short[b] for a, b in set(zip(shapes, shapes[1:])))
    same = sum(map(eq, words, words[1:]))
    if same:
        out.add(b"\x03")
        if same * 10 > len(words):
            out.add(b"\x03\x03")
    lines = [x for x in data.split(b"\n") if x]
    if len(set(lines)) < len(lines):
        out.add(b"\x04")
    return out


@dataclass
class NbSvm:
    """Learned weights: for each n-gram its weight times ratio, and ratio²."""

    weight: dict[bytes, tuple[float, float]] = field(default_factory=dict)
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, found: set[bytes]) -> float:
        # sorted: sums do not depend on the order of a set
        known = [self.weight[g] for g in sorted(found & self.weight.keys())]
        if not known:
            return self.bias
        size = sum(r2 for _, r2 in known)
        return self.bias + sum(w for w, _ in known) / math.sqrt(size)

    def score(self, text: str | None) -> float:
        z = self.slope * self.margin(grams(text)) + self.offset
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dim: int, cost: float,
                  epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Hinge loss with L2 penalty; one dual variable per row, box [0, cost·balance]."""
    rng = np.random.default_rng(seed)
    n_pos = max(1, int((y > 0).sum()))
    n_neg = max(1, len(y) - n_pos)
    box = np.where(y > 0, cost * len(y) / (2 * n_pos), cost * len(y) / (2 * n_neg))
    w, b, alpha = np.zeros(dim), 0.0, np.zeros(len(y))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])  # 1.0: the constant feature of the bias
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            idx, v = rows[i]
            gradient = y[i] * (float(w[idx] @ v) + b) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), box[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                w[idx] += step * v
                b += step
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w, b


def _platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve on margins with smoothed targets, by Newton steps."""
    n_pos, n_neg = int((y > 0).sum()), int((y <= 0).sum())
    target = np.where(y > 0, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([np.sum((p - target) * margins) + 1e-3 * a, np.sum(p - target)])
        s = p * (1 - p) + 1e-9
        h = np.array([[np.sum(s * margins ** 2) + 1e-3, np.sum(s * margins)],
                      [np.sum(s * margins), np.sum(s) + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-3), float(b)


def fit(sample: Iterable[tuple[Iterable[bytes], int]], *, min_count: int = 3, smoothing: float = 1.0,
        cost: float = 1.0, epochs: int = 15, seed: int = 7, folds: int = 4) -> NbSvm:
    """Fit on (n-grams, 0/1) rows; each n-gram is held once, rows as numbers."""
    index: dict[bytes, int] = {}
    coded, signs = [], []
    for found, label in sample:
        coded.append(np.array(sorted({index.setdefault(g, len(index)) for g in found}), dtype=np.int32))
        signs.append(1.0 if label else -1.0)
    y, names = np.array(signs), list(index)
    del index
    n_pos, n_neg = int((y > 0).sum()), int((y < 0).sum())
    if not n_pos or not n_neg:
        share = (n_pos + 1) / (len(y) + 2)
        return NbSvm(offset=math.log(share / (1 - share)), slope=0.0)

    def counts(rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(names))
        for i in rows:
            out[coded[i]] += 1
        return out

    def learn(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(weight times ratio, ratio², bias); ratio² is 0 for n-grams left out."""
        p, q = counts(part[y[part] > 0]), counts(part[y[part] < 0])
        a, b = max(1, int((y[part] > 0).sum())), max(1, int((y[part] < 0).sum()))
        ratio = np.log(((p + smoothing) / (a + 2 * smoothing)) / ((q + smoothing) / (b + 2 * smoothing)))
        ratio[p + q < min_count] = 0.0
        rows = []
        for i in part:
            idx = coded[i][ratio[coded[i]] != 0]
            v = ratio[idx]
            size = math.sqrt(float(v @ v))
            rows.append((idx, v / size if size else v))
        w, bias = _dual_descent(rows, y[part], len(names), cost, epochs, seed)
        return w * ratio, ratio ** 2, bias

    every = np.arange(len(y))
    fold = np.random.default_rng(seed).permutation(len(y)) % folds
    cross = np.zeros(len(y))
    for f in range(folds):
        part = every[fold != f]
        if (y[part] > 0).any() and (y[part] < 0).any():
            weight, square, bias = learn(part)
            for i in every[fold == f]:
                size = float(square[coded[i]].sum())
                cross[i] = bias + (float(weight[coded[i]].sum()) / math.sqrt(size) if size else 0.0)
    weight, square, bias = learn(every)
    slope, offset = _platt(cross, y)
    return NbSvm({names[k]: (float(weight[k]), float(square[k])) for k in np.flatnonzero(square)}, bias, slope, offset)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", learn_from: Column | None = None,
          max_train: int = 4000, min_count: int = 3) -> NbSvm:
    """Fit on a bounded, reproducible sample of the labelled rows of ``docs``.

    A text of the sample keeps every n-gram that ``min_count`` texts of the sample
    hold, however long it is; the others have no say in the fit and are dropped
    before anything reaches the driver."""
    good = (labels.where(F.col(label).isin(0, 1)).groupBy("doc_id")
            .agg(F.min(label).alias("lo"), F.max(label).alias("hi")).where("lo = hi")
            .select("doc_id", F.col("lo").cast("int").alias("label")))
    rows = docs.select("doc_id", "text")
    if learn_from is not None:
        rows = rows.where(learn_from)
    ids = bounded_sample(rows.select("doc_id").join(good, "doc_id").distinct(), max_train, "doc_id")
    # at most max_train ids and labels: a proven bound for the broadcast
    chosen = rows.join(F.broadcast(ids), "doc_id").select("doc_id", "label", "text")
    # copies of one id: the first in gram order
    got = stored(per_text(chosen, lambda t: (sorted(grams(t)),), "grams array<binary>")
                 .groupBy("doc_id").agg(F.min(F.struct("label", "grams")).alias("r")).select("doc_id", "r.label", "r.grams"), "grams")
    each = got.select("doc_id", F.explode("grams").alias("gram"))
    common = each.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") >= min_count).select("gram")
    held = each.join(common, "gram").groupBy("doc_id").agg(F.sort_array(F.collect_list("gram")).alias("grams"))
    # max_train rows of n-grams that at least min_count of them share
    table = (got.select("doc_id", "label").join(held, "doc_id", "left").orderBy("doc_id")
             .select("label", F.coalesce("grams", F.array().cast("array<binary>")).alias("grams")).toArrow())
    rows = ((found.as_py(), label.as_py()) for label, found in zip(table.column("label"), table.column("grams")))
    return fit(rows, min_count=min_count)


def score_quality(docs: DataFrame, model: NbSvm, *, threshold: float = 0.3) -> DataFrame:
    """Append ``score`` and ``predicted`` (1 if score >= threshold) to the other columns than text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # n-grams that min_count of max_train texts share

    def one(text: str | None) -> tuple:
        s = shared.value.score(text)
        return s, int(s >= threshold)

    return per_text(docs, one, "score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = train(docs, labels, learn_from=~held_out(F.col("doc_id")))
    slim = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return score_quality(slim, model)


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3) -> DataFrame:
    """The rows and columns of ``docs`` whose score reaches the threshold."""
    model = train(docs, labels, learn_from=~held_out(F.col("doc_id")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = per_row(docs, lambda t: (shared.value.score(t),), "score double")
    return scored.where(F.col("score") >= threshold).select("row.*")
