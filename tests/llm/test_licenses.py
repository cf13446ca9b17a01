"""License scan against all windows by brute force, and against its SQL."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pandas as pd
import pytest

from lakezones.llm.licenses import TEMPLATES, license_matches, license_sql, template_bigrams, words_of

SMALL = {"one": "a b c a b", "two": "b c d", "three": "a a a a", "four": "c d e f g h a b", "none": "word", "odd": "", "five": "h b"}


def brute(text: str, templates: dict[str, str], threshold: float = 0.8) -> dict[str, float]:
    """Best Dice of any run of words for each template that reaches the threshold."""
    w = words_of(text)
    grams = [f"{a} {b}" for a, b in zip(w, w[1:])]
    out = {}
    for name, t in templates.items():
        bag = template_bigrams(t)
        b = sum(bag.values())
        best = 0.0
        for i in range(len(grams) if b else 0):
            window = Counter()
            for j in range(i, min(len(grams), i + int(b * 1.5) + 2)):
                window[grams[j]] += 1
                best = max(best, 2.0 * sum((window & bag).values()) / (j - i + 1 + b))
        if best >= threshold:
            out[name] = best
    return out


def scanned(spark, rows, templates):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {(r.doc_id, r.license): (r.dice, r.n_segments) for r in license_matches(docs, templates).collect()}


def in_sql(rows, templates):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    return {(d, k): (dice, n) for d, k, dice, n in con.sql(license_sql(templates)).fetchall()}


@pytest.mark.parametrize("seed", [1, 2])
def test_all_windows(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice("abcdefgh") + rng.choice([" ", "  ", "\n", ", ", "\r\n", ". "]) for _ in range(rng.randrange(40))))
            for i in range(300)]
    rows += [(300 + i, " ".join(rng.choice(list(SMALL.values())) for _ in range(rng.randrange(8)))) for i in range(100)]
    got = scanned(spark, rows, SMALL)
    want = {(i, k): d for i, t in rows for k, d in brute(t, SMALL).items()}
    assert {k: v[0] for k, v in got.items()} == want and {k for _, k in want} == set(SMALL) - {"none", "odd"}
    assert in_sql(rows, {k: v for k, v in SMALL.items() if template_bigrams(v)}) == got


def test_notices_anywhere(spark):
    header = TEMPLATES["apache-2.0-header"]
    code = "def f(x):\n    return x + 1\n" * 40
    wrapped = "\r\n".join(" # " + " ".join(header.split()[i:i + 9]) for i in range(0, len(header.split()), 9))
    changed = header.replace("You may obtain a copy of", "A copy can be had of").replace("express", "stated")
    rows = [(1, "Note: this project is released under the MIT License. Enjoy!"),  # within a line
            (2, "Copyright (c) 2020 Foo Inc. All rights reserved."),
            (3, wrapped + "\r\n" + code),  # CRLF, code right below
            (4, code + changed + code),
            (5, TEMPLATES["mit-text"] + "\n" + "words between " * 200 + TEMPLATES["mit-text"].upper()),  # two places
            (6, "all rights\n\nreserved"), (7, "all the rights are reserved; the MIT people released a license under it"),
            (8, ("rights reserved all " * 20_000) + "all rights reserved"), (9, "x" * 300_000), (10, None), (11, "")]
    got = scanned(spark, rows, TEMPLATES)
    assert got[1, "mit"] == (1.0, 1) and got[2, "all-rights-reserved"] == (1.0, 1)
    assert got[3, "apache-2.0-header"] == (1.0, 1) and 0.8 <= got[4, "apache-2.0-header"][0] < 1.0
    assert got[5, "mit-text"] == (1.0, 2) and got[6, "all-rights-reserved"] == (1.0, 1)
    assert got[8, "all-rights-reserved"][0] == 1.0
    assert not {d for d, _ in got} & {7, 9, 10, 11}
    assert {k: v[0] for k, v in got.items() if k[0] < 8} == {(i, k): d for i, t in rows[:7] for k, d in brute(t, TEMPLATES).items()}
    assert in_sql(rows, TEMPLATES) == got
