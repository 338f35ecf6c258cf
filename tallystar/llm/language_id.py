"""Language ID: a byte convolutional network in numpy.

Texts are cut into windows of ``WINDOW`` UTF-8 bytes. A window's bytes are
embedded, passed through convolutions of several widths, max-pooled over the
window, and classified by softmax. A text's log-probabilities are the means
over all its windows, weighted by their bytes.

Training takes at most ``per_lang`` rows of each language (reproducible
pseudo-random order) and at most ``windows`` evenly spread windows of each.
Every row is predicted from all its windows.

Defined cases: null, empty and letterless texts give ``und`` with score 0. Rows
without a language are not learned from. With no labelled row every text is
``und``; with one language that is predicted. Ties go to the language that
sorts first. Repeated rows are predicted alike; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, sample_order, shipped

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8                # of each width
DIM = 6
UNKNOWN = "und"
_SPAN = max(WIDTHS)
_ASCII_LETTER = re.compile(r"[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text)))


def windows_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(n, WINDOW) byte windows, zero padded, and their byte counts."""
    n = -(-len(data) // WINDOW)
    flat = np.zeros(n * WINDOW, dtype=np.uint8)
    flat[:len(data)] = np.frombuffer(data, dtype=np.uint8)
    sizes = np.full(n, WINDOW, dtype=np.int64)
    if n:
        sizes[-1] = len(data) - (n - 1) * WINDOW
    return flat.reshape(n, WINDOW), sizes


def _columns(x: np.ndarray) -> np.ndarray:
    """(B, L, DIM) -> (B, L - _SPAN + 1, _SPAN * DIM), every window of the widest filter."""
    b, length, dim = x.shape
    s0, s1, s2 = x.strides
    return np.lib.stride_tricks.as_strided(x, (b, length - _SPAN + 1, _SPAN * dim), (s0, s1, s2))


@dataclass
class ByteCnn:
    langs: list[str]
    embed: np.ndarray       # (256, DIM); row 0 is padding
    conv: np.ndarray        # (_SPAN * DIM, len(WIDTHS) * FILTERS), narrower filters zero below their width
    conv_b: np.ndarray
    out: np.ndarray
    out_b: np.ndarray

    def log_probs(self, windows: np.ndarray, step: int = 512) -> np.ndarray:
        parts = [np.empty((0, len(self.langs)), dtype=np.float32)]
        for at in range(0, len(windows), step):
            hidden, _, _ = self.forward(windows[at:at + step])
            z = hidden @ self.out + self.out_b
            z -= z.max(axis=1, keepdims=True)
            parts.append(z - np.log(np.exp(z).sum(axis=1, keepdims=True)))
        return np.concatenate(parts)

    def forward(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x = np.ascontiguousarray(self.embed[windows])
        cols = _columns(x).reshape(-1, _SPAN * DIM)
        maps = (cols @ self.conv).reshape(len(windows), WINDOW - _SPAN + 1, -1)
        top = maps.max(axis=1)
        return np.maximum(top + self.conv_b, 0), maps, x


def _mask() -> np.ndarray:
    mask = np.zeros((_SPAN * DIM, len(WIDTHS) * FILTERS), dtype=np.float32)
    for k, width in enumerate(WIDTHS):
        mask[:width * DIM, k * FILTERS:(k + 1) * FILTERS] = 1
    return mask


def fit(windows: np.ndarray, target: np.ndarray, langs: list[str], *, epochs: int = 8, batch: int = 64,
        rate: float = 0.01, seed: int = 5) -> ByteCnn:
    """Adam on class-balanced cross entropy."""
    rng = np.random.default_rng(seed)
    mask, n_out = _mask(), len(WIDTHS) * FILTERS
    p = {"embed": rng.normal(0, 0.5, (256, DIM)), "conv": rng.normal(0, 0.3, mask.shape) * mask,
         "conv_b": np.zeros(n_out), "out": rng.normal(0, 0.3, (n_out, len(langs))), "out_b": np.zeros(len(langs))}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    p["embed"][0] = 0
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    share = np.bincount(target, minlength=len(langs)) / max(1, len(target))
    weight = (1 / np.maximum(share * len(langs), 1e-6)).astype(np.float32)
    t = 0
    for epoch in range(epochs):
        lr = rate * (0.5 if epoch >= epochs // 2 else 1.0)
        order = rng.permutation(len(target))
        for at in range(0, len(order), batch):
            idx = order[at:at + batch]
            wins, y = windows[idx], target[idx]
            # short texts: random left-over lengths teach the net to judge few bytes
            cut = rng.integers(8, WINDOW + 1, len(idx))
            wins = np.where((np.arange(WINDOW) < cut[:, None]) | (rng.random(len(idx)) < 0.7)[:, None], wins, 0)
            net = ByteCnn(langs, **p)
            hidden, maps, x = net.forward(wins)
            z = hidden @ p["out"] + p["out_b"]
            z -= z.max(axis=1, keepdims=True)
            prob = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
            prob[np.arange(len(y)), y] -= 1
            dz = prob * weight[y][:, None] / len(y)
            g = {"out": hidden.T @ dz, "out_b": dz.sum(axis=0)}
            dh = (dz @ p["out"].T) * (hidden > 0)
            g["conv_b"] = dh.sum(axis=0)
            where = maps.argmax(axis=1)                      # (B, n_out)
            rows = np.arange(len(y))[:, None]
            seen = _columns(x)[rows, where]                  # (B, n_out, _SPAN * DIM)
            g["conv"] = np.einsum("bfk,bf->kf", seen, dh) * mask
            back = (dh[:, :, None] * p["conv"].T[None]).reshape(len(y), n_out, _SPAN, DIM)
            which = wins[rows[:, :, None], where[:, :, None] + np.arange(_SPAN)]
            g["embed"] = np.zeros_like(p["embed"])
            np.add.at(g["embed"], which.ravel(), back.reshape(-1, DIM))
            g["embed"][0] = 0
            t += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - lr * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
                p[k] = p[k].astype(np.float32)
    return ByteCnn(langs, **p)


def train(docs: DataFrame, *, learn_from: Column | None = None, per_lang: int = 400, windows: int = 4,
          max_langs: int = 200) -> ByteCnn | None:
    """Fit on a bounded, reproducible sample of the labelled rows; None without any.

    The sample has at most ``per_lang`` texts of each of the ``max_langs`` most
    frequent languages, and ``windows`` evenly spaced windows of a text."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    if learn_from is not None:
        rows = rows.where(learn_from)
    key = sample_order("doc_id")
    order = Window.partitionBy("lang").orderBy(key, "doc_id")
    # the hash below which about 4 per_lang rows of a language fall, as a constant per
    # language: each task drops the others before any row is sent to its language's window
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()
    if not sizes:
        return None
    least = F.create_map(*[F.lit(x) for r in sizes for x in (
        r["lang"], -2.0 ** 63 + 2.0 ** 64 * min(1.0, 4.0 * per_lang / r["n"]))])
    near = rows.select("doc_id", "lang").where(key.cast("double") <= F.try_element_at(least, "lang"))
    ids = (near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= per_lang)
           .select("doc_id", "lang").distinct())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, data = [], []
            for name, text in zip(batch.column("lang"), batch.column("text")):
                text = text.as_py()
                if has_letter(text):
                    wins, _ = windows_of(text.encode("utf-8", "surrogatepass"))
                    for k in sorted({int(i) for i in np.linspace(0, len(wins) - 1, min(windows, len(wins)))}):
                        lang.append(name.as_py()), data.append(wins[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(data, pa.binary())],
                                             names=["lang", "bytes"])

    # at most per_lang ids a language reach the broadcast
    got = (shipped(rows).join(F.broadcast(ids), ["doc_id", "lang"]).select("lang", "text")
           .mapInArrow(cut, "lang string, bytes binary").orderBy("lang", "bytes").toArrow())
    if not got.num_rows:
        return None
    names = got.column("lang").to_pylist()
    langs = sorted(set(names))
    place = {x: k for k, x in enumerate(langs)}
    data = np.frombuffer(b"".join(got.column("bytes").to_pylist()), dtype=np.uint8).reshape(-1, WINDOW)
    return fit(data, np.array([place[x] for x in names]), langs)


def predict_texts(net: ByteCnn | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, probability) of each text, from all its windows."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    if net is None:
        return out
    held, size, owner = [], [], []
    for k, text in enumerate(texts):
        if has_letter(text):
            wins, sizes = windows_of(text.encode("utf-8", "surrogatepass"))
            held.append(wins), size.append(sizes), owner.append(np.full(len(wins), k))
    if not held:
        return out
    logs = net.log_probs(np.concatenate(held)).astype(np.float64)
    share, who = np.concatenate(size).astype(np.float64), np.concatenate(owner)
    total = np.zeros((len(texts), len(net.langs)))
    np.add.at(total, who, logs * share[:, None])
    weight = np.bincount(who, weights=share, minlength=len(texts))
    for k in np.unique(who):
        mean = total[k] / weight[k]
        p = np.exp(mean - mean.max())
        best = int(p.argmax())
        out[k] = (net.langs[best], float(p[best] / p.sum()))
    return out


def predict(docs: DataFrame, net: ByteCnn | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few kilobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                got = predict_texts(shared.value, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"),
                     pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    kind = dict(docs.dtypes)["doc_id"]
    return (shipped(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double"))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the learning folds and predict every row."""
    return predict(docs, train(docs, learn_from=~held_out(F.col("doc_id"))))
