"""HTML extraction: a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, each
with its open elements. Every block gets features from its ancestor tags, the
words of their class, id and role attributes, and its text (length, links, end
mark). A two-state chain (main text or not) is trained by its conditional
likelihood on labelled pages and decoded by Viterbi; blocks of state one are the
main text.

Labelled pages are a few fixed examples with marked blocks (``EXAMPLES``) and a
bounded, reproducible sample of the given pages whose markup names the article
(``article`` or ``main``): their blocks count as main text inside it, apart from
menus, asides, forms, adverts, notices and comments. Part of the sample is
learned without those two tags, so pages lacking them are decoded by their other
features. Every page is decoded whole.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined in page order by two line feeds. ``br`` is
white space; other inline tags join. Scripts, styles, comments and markup go, and what
browsers never show (``template``, frames); formulas, listings, graphics' labels
and embedded objects' texts are text like any other.

Defined cases: a null or empty page, or one without text, gives the empty
string. An unclosed script, style or comment runs to the end of the page, an
unclosed tag or attribute too; unmatched end tags are ignored. Repeated rows
are extracted each; extra columns are not read; an empty table gives an empty
result (the fixed examples alone train the field).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, per_text, stored

# fixed values: block-level elements of HTML, void elements, elements whose content is not text
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript "
    "ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style iframe template noframes".split())
LITERAL_TAGS = frozenset(("xmp",))  # their content is text as it stands, tags and references too
# an opening tag on the left ends an open element of those on the right
IMPLIED_ENDS = {
    **{t: ("p",) for t in ("address article aside blockquote center details dialog dir div dl fieldset figcaption "
                           "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section "
                           "table ul").split()},
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"),
          "th": ("table", "tr")}
# attribute words that name parts around the article
AROUND = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice alert popup modal overlay comment comments reply replies discussion disqus respond sidebar aside widget "
    "menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar footer foot header masthead topbar "
    "share sharing social follow related recommended recommendations more subscribe subscription newsletter signup "
    "login form search tags meta byline copyright legal disclaimer skip hidden".split())
ARTICLE = frozenset(("article", "main"))
OUTSIDE = frozenset("nav aside footer form button select textarea noscript title head menu dialog label legend".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role|data-main)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    features: frozenset[str]   # of its open elements
    tag: str                   # innermost block-level element
    links: float               # share of characters inside links


def leaf_blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a page in order."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str], str]] = [("", frozenset(), "")]
    open_: dict[str, int] = {}
    runs: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal runs, linked
        if runs:
            raw = "".join(runs)
            text = " ".join(raw.split())
            if text:
                out.append(Block(text, stack[-1][1], stack[-1][2], min(1.0, linked / max(1, len(raw)))))
            runs, linked = [], 0

    def pop_to(names: tuple[str, ...], stops: tuple[str, ...]) -> None:
        """End the innermost open element of ``names``, not beyond one of ``stops``."""
        if not any(open_.get(n) for n in names):
            return
        k = len(stack) - 1
        while k > 0 and stack[k][0] not in names:
            if stack[k][0] in stops:
                return
            k -= 1
        if k > 0:
            for name, _, _ in stack[k:]:
                open_[name] -= 1
            del stack[k:]

    def take(piece: str) -> None:
        nonlocal linked
        if piece:
            if "&" in piece:
                piece = unescape(piece)
            runs.append(piece)
            if open_.get("a"):
                linked += len(piece)

    html = html or ""
    at = 0
    while True:
        m = _TOKEN.search(html, at)
        if m is None:
            take(html[at:])
            break
        take(html[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        closing, attributes = (m[1], m[3]) if m[2] else (m[4], m[6])
        if closing:
            if name in BLOCK_TAGS:
                flush()
            if open_.get(name):
                pop_to((name,), ())
            continue
        if name in RAW_TAGS:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if name in LITERAL_TAGS:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            flush()
            runs.append(html[at:end.start() if end else len(html)])
            flush()
            at = end.end() if end else len(html)
            continue
        if name == "br":
            runs.append(" ")
            continue
        if name in BLOCK_TAGS:
            flush()
            if name in IMPLIED_ENDS:
                for ended in IMPLIED_ENDS[name]:
                    pop_to((ended,), SCOPES.get(name, ()))
        if name in VOID_TAGS:
            continue
        _, features, tag = stack[-1]
        new = {f"in:{name}"} if name in BLOCK_TAGS else set()
        if attributes and "=" in attributes:
            for a, b, c in _NAMES.findall(attributes):
                words = _WORD.findall((a or b or c).lower())
                new.update(f"word:{w}" for w in words)
                if not AROUND.isdisjoint(words):
                    new.add("around")
        stack.append((name, features if new <= features else features | new, name if name in BLOCK_TAGS else tag))
        open_[name] = open_.get(name, 0) + 1
    flush()
    return out


def _text_features(block: Block) -> list[str]:
    words = block.text.count(" ") + 1
    size = min(6, int(math.log2(words + 1)))
    link = "none" if not block.links else "part" if block.links < 0.5 else "most"
    end = block.text[-1]
    mark = "stop" if end in ".!?。！？\"”»)" else "bar" if end in "|:>»" else "open"
    return [f"size:{size}", f"link:{link}", f"mark:{mark}", f"tag:{block.tag}", f"size:{size}:{link}"]


def page_features(blocks: list[Block], *, blind: bool = False) -> list[frozenset[str]]:
    """Features of each block; ``blind`` leaves out the article's own tags."""
    named = not blind and any(not ARTICLE.isdisjoint(f[3:] for f in b.features if f.startswith("in:")) for b in blocks)
    side = "named " if named else "plain "
    out = []
    for b in blocks:
        own = [f for f in b.features if not (blind and f[3:] in ARTICLE)]
        out.append(frozenset(side + f for f in [*own, *_text_features(b), "any"]))
    return out


@dataclass
class Field:
    """Weights for state one against state zero, and the chain's transitions."""

    weight: dict[str, float] = field(default_factory=dict)
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def scores(self, features: list[frozenset[str]]) -> list[float]:
        get = self.weight.get
        return [sum(sorted(get(f, 0.0) for f in x)) for x in features]

    def decode(self, features: list[frozenset[str]]) -> list[int]:
        """The best state sequence (Viterbi); ties go to state zero."""
        (s00, s01), (s10, s11) = self.step.tolist()
        back, a, b = [], 0.0, 0.0
        for k, e in enumerate(self.scores(features)):
            if k:
                from0, from1 = (0 if a + s00 >= b + s10 else 1), (0 if a + s01 >= b + s11 else 1)
                a, b = (a + s00 if from0 == 0 else b + s10), (a + s01 if from1 == 0 else b + s11)
                back.append((from0, from1))
            b += e
        if not features:
            return []
        state = 1 if b > a else 0
        path = [state]
        for pair in reversed(back):
            state = pair[state]
            path.append(state)
        return path[::-1]


def fit(pages: list[tuple[list[frozenset[str]], list[int]]], *, epochs: int = 12, rate: float = 0.5,
        decay: float = 1e-4, seed: int = 3) -> Field:
    """Conditional likelihood by adaptive gradient steps, page by page (forward-backward)."""
    names = sorted({f for page, _ in pages for x in page for f in x})
    index = {f: k for k, f in enumerate(names)}
    coded = [([np.array(sorted(index[f] for f in x)) for x in page], np.array(y)) for page, y in pages if page]
    w, gw = np.zeros(len(names)), np.full(len(names), 1e-6)
    step, gs = np.zeros((2, 2)), np.full((2, 2), 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(coded)):
            blocks, y = coded[i]
            n = len(y)
            e = np.zeros((n, 2))
            e[:, 1] = [w[b].sum() for b in blocks]
            forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
            forward[0] = e[0]
            for t in range(1, n):
                forward[t] = e[t] + np.logaddexp.reduce(forward[t - 1][:, None] + step, axis=0)
            for t in range(n - 2, -1, -1):
                backward[t] = np.logaddexp.reduce(step + (e[t + 1] + backward[t + 1])[None, :], axis=1)
            total = np.logaddexp(*forward[-1])
            p1 = np.exp(forward[:, 1] + backward[:, 1] - total)
            grad_step = np.zeros((2, 2))
            for t in range(1, n):
                both = forward[t - 1][:, None] + step + (e[t] + backward[t])[None, :] - total
                grad_step -= np.exp(both)
                grad_step[y[t - 1], y[t]] += 1
            grad = np.zeros(len(names))
            for b, d in zip(blocks, y - p1):
                grad[b] += d
            seen = np.flatnonzero(grad)
            grad[seen] -= decay * w[seen]
            gw[seen] += grad[seen] ** 2
            w[seen] += rate * grad[seen] / np.sqrt(gw[seen])
            grad_step -= decay * step
            gs += grad_step ** 2
            step = step + rate * grad_step / np.sqrt(gs)
    return Field({f: float(w[k]) for f, k in index.items() if w[k]}, step)


def marked_labels(blocks: list[Block]) -> list[int]:
    """Labels from markup that names the article: inside it, and in none of the parts around a text."""
    out = []
    for b in blocks:
        tags = {f[3:] for f in b.features if f.startswith("in:")}
        out.append(int(not ARTICLE.isdisjoint(tags) and OUTSIDE.isdisjoint(tags) and "around" not in b.features))
    return out


# labelled by hand: blocks inside data-main="text" are main text
EXAMPLES = (
    """<body><header><a href=/>Site</a></header><div class=content><div data-main=text><h1>A long day at the harbour</h1>
    <p>The boats came in late, and nobody on the pier could say why the fog had not lifted.</p><p>By noon the market
    was full again.</p></div></div><div class=sidebar><p>Most read this week</p><ul><li><a href=/1>Ten ways home</a></li>
    <li><a href=/2>Old maps</a></li></ul></div><footer>Copyright 2020</footer></body>""",
    """<body><div id=cookie-notice>We use cookies. <button>Accept</button></div><nav><a href=/a>Home</a> <a href=/b>News</a></nav>
    <main><article><div data-main=text><h1>Bridges</h1><p>Old bridges carry more than traffic. They carry the habits of a
    town.</p><blockquote>We cross them without looking down.</blockquote></div><aside>Read also: tunnels</aside>
    <section class=comments><h2>Comments</h2><p>I liked this very much, thank you for writing it.</p></section></article></main>
    <form><label>Your e-mail</label><button>Subscribe</button></form></body>""",
    """<body><table><tr><td class=menu><a href=/x>Start</a></td><td><div data-main=text><h2>Notes</h2><p>Rain all week; the
    river rose by a hand's breadth each night.</p><ul><li>Monday: rain</li><li>Tuesday: more rain</li></ul></div></td></tr>
    </table><p class=copyright>All rights reserved.</p></body>""",
    """<body><div class="ad">Buy now and save.</div><div class="post"><div data-main=text><h1>Bread</h1><p>Flour, water, salt
    and time make a loaf worth eating.</p><p>Knead it well.</p></div><div class="share"><a href=#>Share</a><a href=#>Print</a>
    </div><div class="related"><h3>Related</h3><ul><li><a href=/r1>Butter at home</a></li></ul></div></div></body>""",
)


def _example_pages() -> list[tuple[list[frozenset[str]], list[int]]]:
    out = []
    for html in EXAMPLES:
        blocks = leaf_blocks(html)
        y = [int("word:text" in b.features) for b in blocks]
        for b in blocks:
            b.features = b.features - {"word:text"}
        out.append((page_features(blocks), y))
    return out


def train(pages: DataFrame, *, max_pages: int = 400, max_blocks: int = 200) -> Field:
    """Fit on the examples and a bounded sample of pages whose markup names the article.

    A page longer than ``max_blocks`` blocks is learned from in that many evenly
    spread neighbours-keeping stretches; decoding always sees whole pages.
    """
    def usable(html: str | None) -> tuple:
        y = marked_labels(leaf_blocks(html))
        return (any(y) and not all(y),)

    def code(html: str | None) -> tuple:
        blocks = leaf_blocks(html)
        y = marked_labels(blocks)
        if not any(y) or all(y):
            return None, None, None
        if len(blocks) > max_blocks:
            first = range(0, len(blocks), max(1, len(blocks) // 8))
            picked = sorted({i for f in first for i in range(f, min(len(blocks), f + max_blocks // 9))})
            blocks, y = [blocks[i] for i in picked], [y[i] for i in picked]
        return ([sorted(f) for f in page_features(blocks)], [sorted(f) for f in page_features(blocks, blind=True)], y)

    # a block inside an article needs its tag; written once, as the sample reads the ids several times
    filled = pages.where(F.col("html").rlike("(?i)<(?:" + "|".join(sorted(ARTICLE)) + ")")).select("page_id", "html")
    labelled = stored(per_text(filled, usable, "usable boolean", text="html").where("usable").select("page_id").distinct(),
                      "labelled_pages")
    ids = bounded_sample(labelled, max_pages, "page_id")
    sample = filled.join(F.broadcast(ids), "page_id")  # at most max_pages ids
    rows = per_text(sample, code, "named array<array<string>>, plain array<array<string>>, y array<int>", text="html")
    learned = _example_pages() * 3
    for r in sorted((r for r in rows.collect() if r["y"]), key=lambda r: (r["page_id"], r["named"])):
        learned.append(([frozenset(x) for x in r["named"]], r["y"]))
        if len(learned) % 3 == 0:
            learned.append(([frozenset(x) for x in r["plain"]], r["y"]))
    return fit(learned)


def main_text(html: str | None, model: Field) -> str:
    blocks = leaf_blocks(html)
    states = model.decode(page_features(blocks))
    return "\n\n".join(b.text for b, s in zip(blocks, states) if s)


def extract(pages: DataFrame, model: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages``."""
    model = train(pages) if model is None else model
    shared = pages.sparkSession.sparkContext.broadcast(model)  # bounded by the sample's features

    def one(html: str | None) -> tuple:
        text = main_text(html, shared.value)
        return text, len(text)

    return per_text(pages.select("page_id", "url", "html"), one, "text string, n_chars long", text="html")
