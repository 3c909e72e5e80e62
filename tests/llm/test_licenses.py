"""Licence scans against Dice coefficients computed one by one."""

from __future__ import annotations

from collections import Counter

import pytest

from parcelscope.llm import licenses
from parcelscope.llm.shipping import ship
from parcelscope.llm.text import table


def plain_scan(text, least=licenses.LEAST_DICE):
    """Best Dice per licence over lines, paragraphs and the whole, nearest licence per unit."""
    lines = text.split("\n")
    blocks, block = [], []
    for line in [*lines, ""]:
        if licenses._WORD.search(line):
            block.append(line)
        elif block:
            blocks.append("\n".join(block))
            block = []
    units = lines + [b for b in blocks if "\n" in b] + ([text] if len(blocks) > 1 else [])
    found = {}
    for unit in units:
        own = Counter(licenses.bigrams(unit))
        scores = {}
        for name, template in licenses.templates():
            other = Counter(licenses.bigrams(template))
            dice = 2 * sum((own & other).values()) / max(1, sum(own.values()) + sum(other.values()))
            scores[name] = max(dice, scores.get(name, 0))
        top = max(scores.values())
        if top >= least:
            for name, dice in scores.items():
                if dice == top:
                    found[name] = max(dice, found.get(name, 0))
    return found


MIT = licenses._MIT_GRANT + "\n\n" + licenses._MIT_WARRANTY
TEXTS = [
    "", "nothing", "a text.\nReleased under the MIT License.\nmore", "RELEASED!! UNDER!! THE!! MIT!! LICENSE.!!",
    "Licensed under the Apache License, Version 1.1.", "Licensed under CC BY-SA 4.0", "under the license of the king",
    f"Copyright 2020 somebody\n\n{MIT}\n\nint main() {{}}", licenses._APACHE_HEADER.replace(" ", "\n"), "word " * 3000, MIT,
    licenses._ISC.upper(), "Licensed under the GNU General Public License, version 2\nLicensed under CC BY-NC 4.0.",
]


def scan(text):
    return licenses.prepared(tuple(licenses.templates()), licenses.LEAST_DICE).scan(text)


def dice_of(name, text):
    own = Counter(licenses.bigrams(text))
    others = [Counter(licenses.bigrams(t)) for n, t in licenses.templates() if n == name]
    return max(2 * sum((own & o).values()) / (sum(own.values()) + sum(o.values())) for o in others)


@pytest.mark.parametrize("text", TEXTS)
def test_scan(text):
    """What lines, paragraphs and the whole give is found, with a value at least as high."""
    got, plain = scan(text), plain_scan(text)
    assert got.keys() >= plain.keys()
    for name, (dice, start, end) in got.items():
        assert dice == pytest.approx(dice_of(name, text[start:end])) and dice >= plain.get(name, 0) - 1e-9


WRAPPED = licenses._GPL_HEADER.format(name="", version="3")
for _start in (" This program is distributed", " You should have"):
    WRAPPED = WRAPPED.replace(_start, "\n\n" + _start[1:])


@pytest.mark.parametrize("text,name,inside", [
    (f"# readme\n\nSome words here.\n\n{WRAPPED}\n\nint main() {{}}\nmore text", "GPL-3.0", WRAPPED[:-2]),
    (f"/* x */\n\nint a;\n\n{licenses._BSD_GRANT}\n\n{licenses._BSD_WARRANTY}\n\nint b;", "BSD-2-Clause", None),
    ("Photos by the author. Licensed under CC BY-NC 4.0. Please ask before you print them.", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("x " * 9000 + "released under the MIT license" + " y" * 9000, "MIT", "released under the MIT license"),
    (f"one two {MIT} three four " * 3, "MIT", None),
    ("a // b " + licenses._APACHE_HEADER.replace(" ", "\n * ", 40), "Apache-2.0", None),
])
def test_licences_inside_other_text(text, name, inside):
    got = scan(text)
    assert got.keys() == {name}
    dice, start, end = got[name]
    assert dice > 0.95
    if inside is not None:
        assert text[start:end] == inside


def test_stretches_against_all_windows():
    """The nearest licence of a text is found wherever it begins and ends."""
    short = [(n, t) for n, t in licenses.templates() if len(t) < 60]
    known = licenses.Templates(short, licenses.LEAST_DICE)
    words = "we say released under the under mit license and also licensed under cc by nc sa 3 0 or cc by 4 0 the end".split()
    for cut in range(0, len(words), 3):
        text = " ".join(words[cut:] + words[:cut])
        got = known.scan(text)
        tokens = text.split()
        best = 0.0
        for a in range(len(tokens)):
            for b in range(a + 2, min(len(tokens), a + 20) + 1):
                own = Counter(zip(tokens[a:b], tokens[a + 1 : b]))
                for _, t in short:
                    other = Counter(licenses.bigrams(t))
                    best = max(best, 2 * sum((own & other).values()) / (sum(own.values()) + sum(other.values())))
        assert max((hit[0] for hit in got.values()), default=0) == pytest.approx(best if best >= licenses.LEAST_DICE else 0)


@pytest.mark.parametrize("text", ["of the " * 20_000, "under the license of the king " * 3000, "licensed " * 30_000, "a " * 200_000])
def test_texts_that_repeat_what_templates_have(text):
    assert scan(text) == {}


def test_rows(spark):
    ship(spark)
    rows = [(1, TEXTS[2]), (1, TEXTS[2]), (2, None), (3, ""), (None, TEXTS[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS license")
    got = [tuple(r) for r in licenses.licenses(docs).collect()]
    assert sorted(got, key=str) == [(1, "MIT", 1.0, 8, 39), (1, "MIT", 1.0, 8, 39), (None, "CC-BY-SA-4.0", 1.0, 0, 27)]
    assert licenses.licenses(docs.limit(0)).count() == 0


def test_documents(spark):
    ship(spark)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {(r["doc_id"], r["license"]): r["dice"] for r in licenses.licenses(docs).collect()}
    texts = [r for r in docs.collect() if "licen" in r["text"].lower()]
    plain = {(r["doc_id"], n): d for r in texts for n, d in plain_scan(r["text"]).items()}
    assert got.keys() == plain.keys() and all(got[k] >= plain[k] - 1e-9 for k in plain)
