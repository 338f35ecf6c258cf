import math
import random
from itertools import product

import numpy as np
import pytest

from tallystar.llm import html_extraction as hx

PAGE = "page_id long, url string, html string"


def page(k, article=True, broken=False):
    rng = random.Random(k)
    words = ["river", "town", "stone", "light", "walks", "&amp;", "caf&eacute;", "over"]
    paras = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) + "." for _ in range(rng.randint(1, 6))]
    import html
    text = "\n\n".join(" ".join(html.unescape(p).split()) for p in ["A title", *paras])
    body = "<h1>A title</h1>" + "".join(f"<p>\n {p.replace(' over', '<br>over')}  " + ("" if broken else "</p>") for p in paras)
    body = f"<article>{body}</article>" if article else f'<div class="content">{body}</div>'
    nav = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words[:4])
    return (k, f"http://h/{k}", f"<html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul>{nav}</ul></nav>"
            f'<!-- ad --><div class="ad">Buy this now.</div>{body}<footer>&copy; h. All rights.</footer></body></html>'), text


def test_extracts_articles(spark):
    made = [page(k, broken=k % 3 == 0) for k in range(60)]
    got = {r["page_id"]: r for r in hx.extract(spark.createDataFrame([p for p, _ in made], PAGE)).collect()}
    for (k, url, _), text in made:
        assert (got[k]["url"], got[k]["text"], got[k]["n_chars"]) == (url, text, len(text))


def test_pages_without_article_tag(spark):
    model = hx.train(spark.createDataFrame([page(k)[0] for k in range(80)], PAGE))
    right = sum(hx.main_text(p[2], model) == text for p, text in (page(1000 + k, article=False) for k in range(40)))
    assert right >= 38


def test_edges(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<script>x"), (4, "u", "<article><p>" + "long text here " * 50_000), (5, None, page(5)[0][2]),
            (5, None, page(5)[0][2]), (None, "u", "<<<>>><a b='"), (6, "u", "<div>" * 20_000 + "deep")]
    got = hx.extract(spark.createDataFrame([(*r, "x", 1) for r in rows], PAGE + ", text string, n_chars long")).collect()
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    assert len(got) == len(rows)
    assert all(by[k][0]["text"] == "" and by[k][0]["n_chars"] == 0 for k in (1, 2, 3))
    assert by[4][0]["text"] == ("long text here " * 50_000).strip() and by[5][0] == by[5][1]
    assert hx.extract(spark.createDataFrame([], PAGE)).count() == 0


def test_leaf_blocks():
    blocks = hx.leaf_blocks("<p>a <b>b</b>c<p>d&nbsp;&lt;e<br>f<ul><li>x<li>y</ul>z<div>q<p>r</div>s")
    assert [b.text for b in blocks] == ["a bc", "d <e f", "x", "y", "z", "q", "r", "s"]
    assert [b.tag for b in blocks][:4] == ["p", "p", "li", "li"]


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_is_the_best_path(seed):
    rng = np.random.default_rng(seed)
    model = hx.Field({f"f{k}": float(rng.normal()) for k in range(6)}, rng.normal(size=(2, 2)))
    page_ = [frozenset(f"f{k}" for k in rng.choice(6, 2)) for _ in range(7)]

    def value(path):
        e = model.scores(page_)
        return sum(e[t] for t, s in enumerate(path) if s) + sum(model.step[a, b] for a, b in zip(path, path[1:]))

    best = max(product((0, 1), repeat=7), key=value)
    assert math.isclose(value(model.decode(page_)), value(best))
    assert model.decode([]) == []


def test_sample_is_drawn_from_pages_with_labels(spark, monkeypatch):
    marked = "<body><nav>Menu</nav><article><p>Rain all week.</p></article></body>"
    rows = [(k, "u", marked if k % 20 == 0 else "<body><!-- <main> --><p>Rain all week.</p></body>") for k in range(400)]
    learned = []
    fit = hx.fit
    monkeypatch.setattr(hx, "fit", lambda pages: (learned.extend(pages), fit(pages))[1])
    hx.train(spark.createDataFrame(rows, "page_id long, url string, html string"), max_pages=15)
    named = [y for features, y in learned if y == [0, 1] and any("named in:article" in x for x in features)]
    assert len(named) == 15


def test_formulas_listings_and_objects_are_text():
    blocks = hx.leaf_blocks("<article><p>Let <math><mi>x</mi>=<mn>3</mn></math> be the root</p><xmp>if a &lt; b: <p>print</p></xmp>"
                            "<object data='f'>a chart of rain</object><svg><text>axis</text></svg><canvas>drawn</canvas>"
                            "<noembed>clip</noembed><template><p>never shown</p></template><iframe>nor this</iframe></article>")
    assert [b.text for b in blocks] == ["Let x=3 be the root", "if a &lt; b: <p>print</p>", "a chart of rainaxisdrawnclip"]
    assert hx.leaf_blocks("a<xmp>open <b>")[1].text == "open <b>"
