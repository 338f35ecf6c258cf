"""Suggested renames against comparing every pair, and the published renames."""
import random
import re

import pytest

from tallystar.operators.names import EDITS, SHARE, suggest_renames
from tallystar.plans.model import COUNTRY_RENAMES


def plain(s):
    return re.sub(r"[\W_]+", " ", s.replace("&", " and ").lower()).strip()


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(left, right, k, edits=EDITS):
    out = []
    right = {r for r in right if r and plain(r)}
    for name in {n for n in left if n and plain(n)} - right:
        found = []
        for other in right:
            a, b = plain(name), plain(other)
            wa, wb = set(a.split()), set(b.split())
            common = sum(map(len, wa & wb)) * 1000 // min(sum(map(len, wa)), sum(map(len, wb)))
            n, longer = levenshtein(a, b), max(len(a), len(b))
            if common >= SHARE or n <= edits:
                found.append((-max(common, (longer - n) * 1000 // longer), n, other))
        out += [(name, i + 1, o, -s, n) for i, (s, n, o) in enumerate(sorted(found)[:k])]
    return sorted(out)


def run(spark, left, right, k=3, **more):
    a = spark.createDataFrame([(x, 1) for x in left], "name string, score int")
    b = spark.createDataFrame([(x, 1) for x in right], "suggestion string, words int")
    return sorted(map(tuple, suggest_renames(a, b, "name", "suggestion", k, **more).collect()))


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_equals_comparing_every_pair(spark, edits):
    rng = random.Random(edits)
    words = ["north", "south", "the", "republic", "of", "and", "mali", "chad", "oman", "togo", "a", "é", "saint"]

    def spoilt(name):
        name = list(name)
        for _ in range(rng.randint(0, edits + 1)):
            at = rng.randrange(len(name) + 1)
            name[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "a", "&", "-"])
        return "".join(name)

    base = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    left, right = [spoilt(n) for n in base], base[:30] + [spoilt(n) for n in base]
    assert run(spark, left, right, 4, edits=edits) == brute(left, right, 4, edits)


def test_nulls_empty_names_and_tables(spark):
    left = [None, "", "  ", "&&", "-", "Abc", "abc", "Abc", "same"]
    right = [None, "", "abd", "same", "ABC"]
    assert run(spark, left, right) == brute(left, right, 3)
    assert run(spark, [], right) == [] and run(spark, left, []) == []


# English country names, some near to a renamed one
COUNTRIES = ["Belgium", "China", "Congo", "Cyprus", "Dominica", "Dominican Republic", "Kyrgyzstan", "Macedonia", "Mali",
             "Niger", "Nigeria", "North Korea", "Northern Mariana Islands", "Republic North Macedonia", "South Korea",
             "Taiwan", "Tajikistan", "Tobago", "Trinidad and Tobago", "Turkmenistan", "former Yugoslavia"]


def test_published_renames_come_first(spark):
    got = {name: s for name, rank, s, *_ in run(spark, [*COUNTRY_RENAMES, "Kyrgystan"], COUNTRIES) if rank == 1}
    assert got == {**COUNTRY_RENAMES, "Kyrgystan": "Kyrgyzstan"}
