"""Token counts by a map-side two-tier lookup.

A byte-level BPE never merges across a pre-token, and a space before a visible
character always starts one. So a text splits at its spaces into runs of whole
pre-tokens whose counts add up. Tier one is a broadcast table of the most
frequent runs and their token counts; a run that is not in it goes to tier two,
the worker's cache, which encodes it once. No pre-token is shuffled.

The frequent runs are found over all texts: each task keeps a bounded counter
(rare entries are dropped when it is full) and emits its ``TOP`` most frequent
runs as one row; those summaries are merged in a tree of ``FAN`` branches. The
table only saves time: counts do not depend on it.

What is kept is bounded in bytes, too: runs longer than ``LONGEST`` characters
(sentences of scripts without spaces, data in one piece) are neither counted
nor remembered but encoded where they stand, and a summary or table ends at
``TABLE_BYTES`` of text. So a merge holds at most ``FAN * TABLE_BYTES``, and
counters and caches at most ``LONGEST`` characters an entry.

Defined cases: a null or empty text has 0 bytes and 0 tokens. Texts with white
space that does not split this way are encoded whole; special strings in a text
count as the vocabulary's library counts them. A sentencepiece ``.model`` or a
vocabulary that is not byte-level BPE is counted by its library on whole texts.
Repeated rows are counted each; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Encoder, encoder, read_vocabulary
from .common import per_text, shipped, stored

LIMIT = 1024
TOP = 32_768               # runs in a summary and in the table
COUNTER = 200_000          # entries a task counts at a time
CACHE = 200_000            # runs a worker remembers
FAN = 32
LONGEST = 64               # characters of a run that is counted or remembered
TABLE_BYTES = 1 << 20      # bytes of the runs in a summary or the table
_SUMMARY = "task long, runs string, counts binary"


def _packed(top: list[tuple[str, int]]) -> tuple[str, bytes]:
    return " ".join(w for w, _ in top), np.array([n for _, n in top], dtype="<i8").tobytes()


def _most(counts: Counter, k: int) -> list[tuple[str, int]]:
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]


def _table(counts: Counter, k: int) -> list[tuple[str, int]]:
    """The ``k`` most frequent, or as many as ``TABLE_BYTES`` hold."""
    most, held = _most(counts, k), 0
    for n, (run, _) in enumerate(most):
        held += len(run.encode("utf-8", "surrogatepass")) + 1
        if held > TABLE_BYTES:
            return most[:n]
    return most


def _read(runs: str, sizes: bytes) -> dict[str, int]:
    return dict(zip(runs.split(" "), np.frombuffer(sizes, dtype="<i8").tolist())) if sizes else {}


def splits(run: str) -> bool:
    """True for a run that a space before it always separates from what precedes."""
    return bool(run) and not run[0].isspace()


def frequent_runs(docs: DataFrame, *, top: int = TOP) -> list[str]:
    """The most frequent space-separated runs over all texts (bounded summaries)."""
    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update([w for w in (text.as_py() or "").split(" ")[1:] if len(w) <= LONGEST])
                if len(counts) > COUNTER:
                    counts = Counter(dict(_most(counts, COUNTER // 2)))
        runs, sizes = _packed(_table(Counter({w: n for w, n in counts.items() if splits(w)}), top))
        context = TaskContext.get()
        yield pa.RecordBatch.from_arrays(
            [pa.array([context.partitionId() if context else 0], pa.int64()), pa.array([runs], pa.string()),
             pa.array([sizes], pa.binary())], names=["task", "runs", "counts"])

    def merge(key: tuple, summaries: pd.DataFrame) -> pd.DataFrame:
        counts: Counter = Counter()  # of at most FAN summaries of ``top`` runs
        for runs, sizes in zip(summaries["runs"], summaries["counts"]):
            counts.update(_read(runs, sizes))
        runs, sizes = _packed(_table(counts, top))
        return pd.DataFrame({"task": [int(key[0])], "runs": [runs], "counts": [sizes]})

    level = stored(shipped(docs).select("text").mapInArrow(summarize, _SUMMARY), "runs")
    while (last := level.agg(F.max("task")).first()[0] or 0) > 0:
        grouped = level.withColumn("task", F.floor(F.col("task") / FAN).cast("long")).groupBy("task")
        level = stored(grouped.applyInPandas(merge, _SUMMARY), "runs")
        if last < FAN:
            break
    total: Counter = Counter()
    for r in level.collect():  # one row of at most ``top`` runs (none for an empty table)
        total.update(_read(r["runs"], r["counts"]))
    return [w for w, _ in _table(total, top)]


class Counts:
    """Token counts of texts by the two tiers."""

    def __init__(self, encode: Encoder, runs: str, sizes: bytes):
        self.encode = encode
        self.table = dict(zip(runs.split(" "), np.frombuffer(sizes, dtype="<u2").tolist())) if sizes else {}
        self.cache: dict[str, int] = {}

    def of(self, text: str | None) -> int:
        if not text:
            return 0
        if any(s in text for s in self.encode.special):
            return self.encode.count(text)
        first, *runs = text.split(" ")
        found = list(map(self.table.get, runs))
        total = self.encode.count(first) if first else 0
        if None in found:
            for k, n in enumerate(found):
                if n is None:
                    run = runs[k]
                    n = self.cache.get(run)
                    if n is None:
                        if not splits(run):
                            return self.encode.count(text)
                        if len(run) > LONGEST:
                            found[k] = self.encode.count(" " + run)
                            continue
                        if len(self.cache) >= CACHE:
                            self.cache.clear()
                        n = self.cache[run] = self.encode.count(" " + run)
                    found[k] = n
        return total + sum(found)


@lru_cache(2)
def _counts(source: str, runs: str, sizes: bytes) -> Counts:
    return Counts(encoder(source), runs, sizes)


@lru_cache(2)
def _pieces(model: bytes):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def count_tokens(docs: DataFrame, tokenizer_path: str, *, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``docs``."""
    sc = docs.sparkSession.sparkContext
    if tokenizer_path.endswith(".model"):
        with open(tokenizer_path, "rb") as f:
            model = sc.broadcast(f.read())

        def tokens(text: str | None) -> int:
            return len(_pieces(model.value).encode(text or ""))
    else:
        source = read_vocabulary(tokenizer_path)
        local = encoder(source)
        if local.core is None:
            held = sc.broadcast(source)

            def tokens(text: str | None) -> int:
                return encoder(held.value).count(text or "")
        else:
            # at most TOP runs; one longer than 65535 tokens stays out
            runs = [(w, n) for w in frequent_runs(docs) if (n := local.count(" " + w)) < 2 ** 16]
            table = sc.broadcast((source, " ".join(w for w, _ in runs),
                                  np.array([n for _, n in runs], dtype="<u2").tobytes()))

            def tokens(text: str | None) -> int:
                return _counts(*table.value).of(text)

    def one(text: str | None) -> tuple:
        n = tokens(text)
        return len((text or "").encode("utf-8", "surrogatepass")), n, n > limit

    return per_text(docs.select("doc_id", "text"), one, "n_bytes long, n_tokens long, over_limit boolean")
