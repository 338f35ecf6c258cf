import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallystar.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library):
    """Every token, every code point, special strings and random texts."""
    mine = bpe.encoder(bpe.read_vocabulary(PATH))
    assert mine.core is not None
    vocab = library.get_vocab()
    alone = [t for t, i in vocab.items() if i != 50256]
    # each token encodes to itself: both libraries meet the same merges in the same order
    assert all([x.value for x in library.model.tokenize(t)] == [t] for t in alone)
    texts = [f"a{chr(i)}b {chr(i)}{chr(i)} {chr(i)}1" for i in range(0x30000) if not 0xD800 <= i < 0xE000]
    for at in range(0, len(texts), 20_000):
        part = texts[at:at + 20_000]
        assert [mine.core.encode_ordinary(t) for t in part] == [e.ids for e in library.encode_batch_fast(part, add_special_tokens=False)]
    rng = random.Random(1)
    parts = ["<|endoftext|>", " ", "  ", "\n", "the", "'ll", "é", "😀", "***", "12", "　", "\r", "<|", "aaaaaaaa"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 15)))
        assert np.frombuffer(mine.ids(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def expected(rows, library):
    out = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        n = len(ids)
        first = n if n <= 1024 else (n % 1024 or 1024)
        cuts = [0, *range(first, n + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def check_sequences(rows, capacity=1024):
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_pieces_and_sequences(docs, library):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["river", "stone", "light"]) for _ in range(rng.choice([1, 5, 40, 300, 700, 1023, 1024, 2500])))) for i in range(200)]
    rows += [(500, None), (501, ""), (502, "long " * 50_000), (503, "twice"), (503, "twice"), (None, "no id"), (504, "a <|endoftext|> b")]
    got = packing.pack(docs(rows), PATH).collect()
    names = "doc_id", "piece", "start", "length", "ids_crc32"
    assert Counter(tuple(r[c] for c in names) for r in got) == Counter(expected(rows, library))
    n = check_sequences(got)
    tokens = sum(r["length"] for r in got)
    assert n <= 1.03 * -(-tokens // 1024) + 1


def test_ids_round_trip_and_edges(docs, library):
    assert packing.pack(docs([]), PATH).count() == 0
    d = docs([(1, "hello world", "en", "s", 3, 4, 5)], ", length long, offset long")
    r = packing.pack(d, PATH, with_ids=True).first()
    assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode("hello world").ids + [2]
    assert r["offset"] == 0 and r["start"] == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_covers_the_histogram(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 1024])
    hist = {rng.randint(1, capacity): rng.randint(1, 10 ** rng.randint(0, 6)) for _ in range(rng.randint(1, 60))}
    planned = packing.plan(hist, capacity, steps=60)
    count = Counter()
    for pattern, times in planned:
        assert sum(n * c for n, c in pattern) <= capacity and times > 0
        for n, c in pattern:
            count[n] += c * times
    assert count == Counter(hist)


def test_lp_finds_perfect_pairs():
    # 600 fits only with 400, 700 only with 300: best-fit alone would do too, the program must not lose it
    planned = packing.plan({600: 1000, 400: 1000, 700: 500, 300: 500}, 1000)
    assert sum(t for _, t in planned) <= 1.01 * 1500


def fewest(histogram, capacity):
    """The least number of sequences, by trying every way to fill the next one."""
    from functools import cache

    lengths = sorted(histogram, reverse=True)

    @cache
    def need(left):
        if not any(left):
            return 0
        first = next(i for i, c in enumerate(left) if c)  # the longest left goes into the next sequence
        best = sum(left)

        def fill(i, room, now):
            nonlocal best
            if i == len(lengths):
                best = min(best, 1 + need(now))
                return
            for k in range(min(now[i], room // lengths[i]), -1, -1):
                fill(i + 1, room - k * lengths[i], (*now[:i], now[i] - k, *now[i + 1:]))
        start = (*left[:first], left[first] - 1, *left[first + 1:])
        fill(first, capacity - lengths[first], start)
        return best
    return need(tuple(histogram[n] for n in lengths))


def test_small_histograms_against_the_optimum():
    rng = random.Random(17)
    over = 0
    for _ in range(150):
        capacity = rng.choice([10, 13, 20])
        hist = {rng.randint(2, capacity - 1): rng.randint(1, 4) for _ in range(rng.randint(1, 5))}
        total, best = sum(t for _, t in packing.plan(hist, capacity)), fewest(hist, capacity)
        report = packing.summary(hist, capacity)
        assert report["sequences"] == total and report["bound"] <= best + 1e-6 and total <= best + 1
        over += total - best
    assert over <= 3


def best_fit(histogram, capacity):
    """Best-fit decreasing: the longest piece that fits goes next."""
    left, total = dict(histogram), 0
    while any(left.values()):
        room, pattern = capacity, Counter()
        while fits := [n for n in left if n <= room and left[n] > pattern[n]]:
            pattern[max(fits)] += 1
            room -= max(fits)
        times = min(left[n] // c for n, c in pattern.items())
        for n, c in pattern.items():
            left[n] -= times * c
        total += times
    return total


@pytest.mark.parametrize("hist,want", [
    ({n: 1000 for n in range(1, 1024)}, 511_500), ({n: 1000 for n in range(300, 341)}, 13_667),
    ({n: 1000 for n in range(400, 601)}, 100_500), ({n: 1 + n * 7919 % 50 for n in range(200, 400)}, None),
    ({n: 1 + n * 7919 % 500 for n in range(250, 520)}, None), ({n: 10 ** (n % 8) for n in range(90, 1000, 13)}, None)])
def test_never_worse_than_best_fit(hist, want):
    total = packing.summary(hist)
    assert total["from_program"] == total["sequences"] <= best_fit(hist, 1024)
    assert want is None or total["sequences"] == want
    assert total["bound"] <= total["sequences"] + 1e-6


def test_knapsack_is_the_best_configuration():
    rng = random.Random(3)
    for _ in range(60):
        lengths = np.array(sorted(rng.sample(range(1, 15), 4)))
        most, price = np.array([rng.randint(0, 4) for _ in lengths]), np.array([rng.random() for _ in lengths])
        counts, worth = packing.best_configuration(lengths, price, most, 20)
        assert (counts <= most).all() and counts @ lengths <= 20 and worth == pytest.approx(counts @ price)
        every = np.array(np.meshgrid(*[range(m + 1) for m in most])).reshape(4, -1).T
        assert worth == pytest.approx(max((c @ price for c in every if c @ lengths <= 20)))


def test_sequences_hold_the_ids_in_order(docs, library):
    rows = [(i, " ".join(["river", "stone", "light"][i % 3:]) * (20 + 40 * i)) for i in range(30)]
    packed = packing.pack(docs(rows), PATH, with_ids=True)
    made = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    assert sum(r["length"] for r in made.values()) == sum(r["length"] for r in packed.collect())
    for r in packed.collect():
        whole = made[r["sequence_id"]]["ids"]
        assert whole[4 * r["offset"]:4 * (r["offset"] + r["length"])] == r["ids"]
        assert len(whole) == 4 * made[r["sequence_id"]]["length"] <= 4096
