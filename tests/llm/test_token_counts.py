import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallystar.llm import token_counts as tc

PATH = public_tokenizers.path("byte_bpe_50k.json")


def corpus(n=200):
    rng = random.Random(4)
    parts = ["the", "river", "don't", "we'll", "Öl", "字", "12", "***", "\n", "\n\n", " ", "  ", "\t", "<|endoftext|>", "　", "x1y2"]
    return [(i, "".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("top", [5, tc.TOP])
def test_counts_equal_the_library(docs, top, monkeypatch):
    monkeypatch.setattr(tc, "TOP", top)
    lib = Tokenizer.from_file(PATH)
    rows = corpus() + [(900, None), (901, ""), (902, "word " * 80_000), (903, "x" * 30_000), (904, "same"), (904, "same"), (None, "id")]
    got = tc.count_tokens(docs(rows).repartition(5), PATH).collect()
    want = sorted((str(i), len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == want


def test_frequent_runs_over_many_tasks(docs, monkeypatch):
    monkeypatch.setattr(tc, "FAN", 2)
    rows = [(i, f"a common words here only{i}") for i in range(60)]
    runs = tc.frequent_runs(docs(rows).repartition(9), top=3)
    assert sorted(runs) == ["common", "here", "words"]
    assert tc.frequent_runs(docs([])) == []


def test_edges_and_other_vocabularies(docs):
    assert tc.count_tokens(docs([]), PATH).count() == 0
    d = docs([(1, "Hello there world", "en", "s", 3, 1, 2)], ", n_tokens long, n_bytes long")
    assert tc.count_tokens(d, PATH).first()["n_bytes"] == 17
    import sentencepiece
    piece = public_tokenizers.path("piece_bpe_32k.model")
    want = len(sentencepiece.SentencePieceProcessor(model_file=piece).encode("Hello there world"))
    assert tc.count_tokens(d, piece).first()["n_tokens"] == want
    word = public_tokenizers.path("word_bpe_49k.json")
    want = len(Tokenizer.from_file(word).encode("Hello there world", add_special_tokens=False).ids)
    assert tc.count_tokens(d, word).first()["n_tokens"] == want


def test_long_runs_are_neither_counted_nor_remembered(docs, monkeypatch):
    rng = random.Random(6)
    long = ["".join(rng.choice("字語文道理水") for _ in range(500)) for _ in range(30)]
    rows = [(i, f"start {long[i % 30]} the end {long[(i + 1) % 30]} the x" + "y" * 70) for i in range(90)] + [(200, long[0]), (201, " " + long[1])]
    runs = tc.frequent_runs(docs(rows).repartition(4))
    assert {"the", "end"} == set(runs)
    lib = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: r["n_tokens"] for r in tc.count_tokens(docs(rows), PATH).collect()}
    assert got == {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in rows}
    counts = tc.Counts(tc.encoder(tc.read_vocabulary(PATH)), "", b"")
    for _, t in rows:
        counts.of(t)
    assert set(counts.cache) == {"the", "end"}


def test_tables_end_at_their_bytes(docs, monkeypatch):
    monkeypatch.setattr(tc, "TABLE_BYTES", 100)
    rows = [(i, " ".join(["x", *(f"wörd{k}" for k in range(i % 40))])) for i in range(200)]
    runs = tc.frequent_runs(docs(rows).repartition(6))
    assert 0 < sum(len(r.encode()) + 1 for r in runs) <= 100 and runs[0] == "wörd0"
    lib = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: r["n_tokens"] for r in tc.count_tokens(docs(rows), PATH).collect()}
    assert got == {i: len(lib.encode(t, add_special_tokens=False).ids) for i, t in rows}
