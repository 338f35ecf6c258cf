import random
import zlib

import numpy as np

from tallystar.llm import language_id as li

WORDS = {"en": ["the", "thing", "with", "and", "ought", "shall"], "de": ["und", "schön", "nicht", "über", "straße"],
         "fr": ["été", "façon", "que", "eaux", "très"]}


def corpus(n=240):
    rng = random.Random(2)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(3, 150))), lang)
            for i in range(n) for lang in [sorted(WORDS)[i % 3]]]


def test_held_out_accuracy_and_columns(docs):
    rows = corpus()
    got = li.identify(docs([(i, t, lang, "s", len(t)) for i, t, lang in rows])).collect()
    truth = {i: lang for i, _, lang in rows}
    assert len(got) == len(rows)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95


def test_held_out_languages_do_not_move_a_prediction(docs):
    rows = corpus(90)
    a = li.identify(docs([(i, t, lang, "s", 1) for i, t, lang in rows])).collect()
    b = li.identify(docs([(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, "t", 2) for i, t, lang in rows])).collect()
    assert sorted(a) == sorted(b)


def test_edges(docs):
    rows = [(i, t, lang, "s", 0) for i, t, lang in corpus(60)]
    odd = [(901, None, "en", None, None), (902, "", None, None, None), (903, "12 34 !! ²", "de", None, None),
           (904, "und " * 100_000, None, None, None), (905, "the", None, None, None), (905, "the", None, None, None)]
    got = {}
    for r in li.identify(docs(rows + odd)).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert got[901] == got[902] == got[903] == [("und", 0.0)]
    assert got[904][0][0] == "de" and len(set(got[905])) == 1
    assert li.identify(docs([])).count() == 0
    assert li.identify(docs([(1, "abc", None, "s", 3)])).first()["lang_pred"] == "und"
    only = li.identify(docs([(1, "abc", "en", "s", 3, "x", 0.1)], ", lang_pred string, score double")).first()
    assert only["lang_pred"] == "en"


def test_windows_cover_every_byte():
    data = bytes(range(1, 256)) * 3
    wins, sizes = li.windows_of(data)
    assert sizes.sum() == len(data) and wins.tobytes()[:len(data)] == data
    assert li.windows_of(b"")[0].shape == (0, li.WINDOW)


def test_forward_matches_plain_convolution():
    net = li.fit(*[np.array(x) for x in ([li.windows_of(b"ab cd" * 60)[0][0], li.windows_of(b"xy zw" * 60)[0][0]], [0, 1])],
                 ["a", "b"], epochs=2)
    win = li.windows_of(b"hello world, this is a window")[0]
    hidden, _, _ = net.forward(win)
    x = net.embed[win[0]]
    for k, width in enumerate(li.WIDTHS):
        for f in range(li.FILTERS):
            w = net.conv[:width * li.DIM, k * li.FILTERS + f]
            best = max(float(x[p:p + width].ravel() @ w) for p in range(li.WINDOW - li._SPAN + 1))
            assert abs(max(best + net.conv_b[k * li.FILTERS + f], 0) - hidden[0, k * li.FILTERS + f]) < 1e-3


def test_a_hot_language_and_the_bound_on_languages(docs):
    rows = [(i, t, lang, "s", 1) for i, t, lang in corpus(90)]
    rows += [(1000 + i, f"thing with and the {i} ought", "en", "s", 1) for i in range(1500)]
    net = li.train(docs(rows), per_lang=20)
    assert net.langs == ["de", "en", "fr"]
    assert li.train(docs(rows), per_lang=20, max_langs=1).langs == ["en"]
    got = {r["doc_id"]: r["lang_pred"] for r in li.predict(docs(rows), net).collect()}
    assert sum(got[r[0]] == r[2] for r in rows) / len(rows) > 0.95
