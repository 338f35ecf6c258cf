"""Secret scans: fixed patterns, and password guess-cost dynamic programming.

Patterns find assignments to credential names, access-key ids and long hex
runs. Beside them, every value in a credential context (a name such as
``pwd``, ``passphrase``, ``auth key``, then a separator) is cut by dynamic
programming into the cheapest sequence of dictionary words, dates, repeats,
keyboard walks, unknown words and brute-force characters; a run of letters is
an unknown word only if its letter pairs are those of words. A value whose
cheapest guess cost (log10 of guesses) reaches ``threshold`` is reported as
kind ``guess`` unless a pattern's span holds it whole; placeholders and prose
stay below.

Offsets are code points, ends exclusive. Spans are ordered by start, then by
kind in the order of ``KINDS``.

Defined cases: a null text counts as empty and has no span. Texts are scanned
whole, whatever their length. Repeated rows give the same spans; extra columns
pass through ``redact`` and are not read.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from math import log10

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_row, per_text

KINDS = ("assign", "access", "hex", "guess")
MARK = "[SECRET]"

# fixed values: the patterns of the contract
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
_ASSIGN_HINTS = ("passw", "secret", "token", "api")

_CONTEXT = re.compile(
    r"""(?<![a-z0-9])(?:pass(?:word|wd|phrase|code|wort)?|pwd|kennwort|geheimnis|mot[ _-]de[ _-]passe|mdp|contrase(?:[nñÑ]|ny)a|clave"""
    r"""|cl(?:e|é|É)(?:[ _-](?:api|secr[eèÈ]te|priv(?:e|é|É)e))?|schl(?:ü|Ü|ue)ssel|secret|token"""
    r"""|(?:api|access|auth|private|client|encryption|signing|session|master|storage|account|service|admin|root|db|database|user)"""
    r"""[ _-]?(?:key|token|secret|password|passwd|pwd)|credentials?|auth|bearer)["']?[\x20\t]*(?::=|=>|[:=]|\x20is\x20)[\x20\t]*(?:bearer\x20+)?"""
    r"""(?:"([^"\n]{6,})"|'([^'\n]{6,})'|([^\s"'<>|]{6,}))""", re.I | re.A)
_CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "kennwort", "geheimnis", "mdp",
                  "contrase", "clave", "cle", "clé", "schl")

# fixed values: common words of passwords, most frequent first, and keyboard rows
COMMON = (
    "password", "qwerty", "abc", "admin", "letmein", "welcome", "monkey", "dragon", "master", "login", "love",
    "hello", "secret", "sunshine", "princess", "football", "shadow", "superman", "batman", "trustno", "iloveyou",
    "changeme", "change", "me", "pass", "test", "testing", "example", "sample", "demo", "user", "username",
    "guest", "root", "default", "temp", "dummy", "placeholder", "your", "my", "the", "this", "here", "key",
    "token", "api", "access", "redacted", "hidden", "none", "null", "true", "false", "value", "string", "xxx",
    "replace", "insert", "enter", "todo", "fixme", "foo", "bar", "baz", "foobar", "spring", "summer", "autumn",
    "winter", "monday", "friday", "january", "baseball", "starwars", "michael", "jordan", "george", "michelle",
    "jessica", "charlie", "andrew", "daniel", "thomas", "freedom", "computer", "internet", "cookie", "cheese",
    "banana", "orange", "purple", "yellow", "flower", "ginger", "pepper", "hunter", "killer", "soccer", "hockey",
    "ranger", "tigger", "buster", "correct", "horse", "battery", "staple", "server", "system", "public", "private",
)
_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_RANK = {w: k + 1 for k, w in enumerate(COMMON)}
_LONGEST = max(map(len, COMMON))
_LEET = str.maketrans("0134578@$!", "oieastbasi")
_PLACE = {c: (y, x) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
_DATE = re.compile(r"(?:(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?"
                   r"|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)\d\d)")
_WORDLIKE = re.compile(r"[^\W\d_]+")
# fixed values: -2 log10 of the chance of a letter after another, from word lists in English, German, French and
# Spanish; rows: the start of a word, then a to z; columns: a to z, then its end
_PAIRS = (
    "232223343543333253233345647", "732255443542327352223465452", "254415542352543452342555354", "263626612633661663423666563",
    "256416662664552563352566562", "443334443553325452234453642", "266623461663652663442666563", "264615543643534462342666651",
    "255415552552432552434555452", "332323356643312443226375734", "144414444444442444442444443", "255525353553541453323545452",
    "254414462652552565322456352", "236515462655252265343646663", "253224253555533456323356541", "533365453753214352232445552",
    "254524543652662261433566563", "444444444444444444440444444", "244414452644332564323547542", "363525442755553356223657451",
    "265515542775553572333657432", "333523443562325362226354543", "255515552555552554554555553", "144414432444432443443444443",
    "353424342554555255415555452", "344434443444323344223444441", "254515552554453555532535332",
)
_LETTERS = "abcdefghijklmnopqrstuvwxyz "
_PAIR_COST = {a + b: int(d) / 2 for a, row in zip(" " + _LETTERS, _PAIRS) for b, d in zip(_LETTERS, row)}
_PLAIN_LETTERS = str.maketrans({"æ": "ae", "œ": "oe", "ø": "o"})
_LONGEST_UNIT, _LONGEST_DATE = 8, 10
INFINITE = float("inf")
_JOIN = log10(2)           # each further piece doubles the guesses


def _char_cost(c: str) -> float:
    if c.isdigit():
        return 1.0
    if c.isascii() and c.isalpha():
        return log10(26)
    return log10(33) if c.isascii() else 2.0


def word_like(run: str) -> bool:
    """Whether a run of letters is likelier as a word, by its letter pairs, than as letters drawn evenly.

    Accents are left off; a letter that is none of a to z then is in no word."""
    plain = unicodedata.normalize("NFD", run.casefold().translate(_PLAIN_LETTERS))
    plain = "".join(c for c in plain if not unicodedata.combining(c))
    pairs = [_PAIR_COST.get(a + b) for a, b in zip(" " + plain, plain + " ")]
    return None not in pairs and sum(pairs) <= len(plain) * log10(26)


def _neighbours(a: str, b: str) -> bool:
    """Whether two keys touch on the keyboard."""
    p, q = _PLACE.get(a), _PLACE.get(b)
    return bool(p and q and p != q) and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def _word_cost(part: str, low: str, plain: str) -> float:
    """A common word, by rank; letters written as digits or signs, and capitals, cost extra."""
    rank, extra = _RANK.get(low), 0.0
    if rank is None:
        rank, extra = _RANK.get(plain), _JOIN
    if rank is None:
        return INFINITE
    upper = sum(c.isupper() for c in part)
    return log10(rank) + extra + (_JOIN * min(upper, len(part) - upper + 1) if upper else 0.0)


def _unknown_cost(part: str) -> float:
    """A run of letters in one case as a word of some dictionary; other runs are brute force."""
    if not (part.islower() or part.isupper() or part.istitle()) or not word_like(part):
        return INFINITE
    return min(sum(map(_char_cost, part)), 5.3 + 0.2 * max(0, len(part) - 12))


def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation needs.

    Every kind of piece is tried at every start and end that it can have: brute
    force, common words, dates, keyboard walks (three keys or more), repeats
    (two times or more of a unit of up to eight characters), and maximal runs of
    letters as unknown words. Walks are carried on key by key, as each further one
    adds the same. Of the starts of repeats of one unit that end at one place, those
    are dropped that cost no less than an earlier one: it stays cheaper, as the
    cost of k times grows by the ratio of k only. So the time is in proportion to the length."""
    n, low = len(value), value.lower()
    if len(low) != n:  # a lower case of other length: compare as it is
        low = value
    plain = low.translate(_LEET)
    single = [_char_cost(c) for c in value]
    unit_single = [_char_cost(c) for c in low]
    words_end = {m.end(): m.start() for m in _WORDLIKE.finditer(value)}
    best = [0.0] + [INFINITE] * n
    walk, steps = INFINITE, 0                     # the cheapest walk to here, and how many neighbours in a row
    same = [0] * (_LONGEST_UNIT + 1)              # by unit length: how long the text has equalled itself that far back
    starts: list[list[list[int]]] = [[[] for _ in range(u)] for u in range(_LONGEST_UNIT + 1)]

    def opened(i: int) -> float:
        return best[i] + (_JOIN if i else 0.0)

    for j in range(1, n + 1):
        least = best[j - 1] + single[j - 1]       # brute force goes on from any piece
        for i in range(max(0, j - _LONGEST), j - 1):
            cost = opened(i) + _word_cost(value[i:j], low[i:j], plain[i:j])
            least = min(least, cost)
        if value[j - 1].isdigit():
            for i in range(max(0, j - _LONGEST_DATE), j - 3):
                if value[i].isdigit() and _DATE.fullmatch(value, i, j):
                    least = min(least, opened(i) + log10(366 * 120))
        steps = steps + 1 if j > 1 and _neighbours(low[j - 2], low[j - 1]) else 0
        walk = INFINITE if steps < 2 else min(walk + 0.4, opened(j - 3) + log10(len(_PLACE)) + 0.8)
        least = min(least, walk)
        for u in range(1, min(_LONGEST_UNIT, j - 1) + 1):
            same[u] = same[u] + 1 if low[j - 1] == low[j - 1 - u] else 0
            if same[u] < u:
                continue
            unit, first = low[j - u:j], j - u - same[u]
            each = min(sum(unit_single[j - u:j]), log10(_RANK[unit]) if unit in _RANK else INFINITE)
            kept: list[int] = []
            cheapest = INFINITE
            held = starts[u][j % u]
            for i in held:
                if i < first:
                    continue
                if i > j - 2 * u:
                    kept.append(i)
                    continue
                cost = opened(i) + log10((j - i) // u)
                if cost < cheapest:
                    cheapest = cost
                    kept.append(i)
            starts[u][j % u] = kept
            least = min(least, cheapest + each)
        if j in words_end:
            least = min(least, opened(words_end[j]) + _unknown_cost(value[words_end[j]:j]))
        best[j] = least
        for u in range(1, _LONGEST_UNIT + 1):
            if j == 1:
                starts[u][0].append(0)
            place = starts[u][j % u]
            if same[u] < u:  # no earlier start reaches beyond here
                place[:] = [i for i in place if i > j - 2 * u]
            place.append(j)
    return best[n]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    low = text.lower()
    found = []
    if any(h in low for h in _ASSIGN_HINTS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return _ordered(found)


def _ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def guess_spans(text: str, base: list[tuple[str, int, int]], threshold: float) -> list[tuple[str, int, int]]:
    low = text.lower()
    if not any(h in low for h in _CONTEXT_HINTS):
        return []
    out = []
    for m in _CONTEXT.finditer(text):
        group = next(g for g in (1, 2, 3) if m[g] is not None)
        start, end = m.span(group)
        if group == 3:  # closing punctuation of a sentence is not part of a bare value
            end = start + len(m[3].rstrip(".,;:!?)]}"))
        if end - start < ASSIGN_LEAST or any(s <= start and end <= e for _, s, e in base):
            continue
        if guess_cost(text[start:end]) >= threshold:
            out.append(("guess", start, end))
    return out


def find_secrets(text: str | None, threshold: float = 9.0) -> tuple[list, list]:
    """(base spans, all spans) of one text as (kind, start, end)."""
    text = text or ""
    base = base_spans(text)
    return base, _ordered(base + guess_spans(text, base, threshold))


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame, *, threshold: float = 9.0) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row."""
    def one(text: str | None) -> tuple:
        base, every = find_secrets(text, threshold)
        kinds = [k for k, _, _ in base]
        return (*(kinds.count(k) for k in KINDS[:3]), hashlib.sha256(_written(base).encode()).hexdigest(),
                _written(every))

    return per_text(docs.select("doc_id", "text"), one,
                    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def masked(text: str | None, threshold: float = 9.0) -> str | None:
    """The text with every span replaced by ``MARK`` (overlapping spans as one)."""
    if text is None:
        return None
    _, spans = find_secrets(text, threshold)
    parts, at = [], 0
    end = -1
    for _, s, e in spans:
        if s >= end:
            parts += [text[at:s], MARK]
        end = max(end, e)
        at = end
    return "".join(parts) + text[at:]


def redact(docs: DataFrame, *, threshold: float = 9.0) -> DataFrame:
    """The rows and columns of ``docs`` with secrets masked; ``n_chars`` follows the new text."""
    made = per_row(docs, lambda t: (masked(t, threshold),), "masked string")
    kinds = dict(docs.dtypes)
    new = {"text": F.col("masked")}
    if "n_chars" in kinds:
        new["n_chars"] = F.length("masked").cast(kinds["n_chars"])
    return made.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
