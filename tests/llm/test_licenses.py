from __future__ import annotations

import re

import pytest
from llm.conftest import docs_of

from repopulse.llm import licenses

MIT = licenses.TEMPLATES["MIT text"]


def pairs(text):
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return set(zip(words, words[1:]))


def plain(text, least=0.8):
    """Best template of every line, by comparing all."""
    out = {}
    for place, line in enumerate((text or "").split("\n")):
        own = pairs(line)
        for name, template in licenses.TEMPLATES.items():
            other = pairs(template)
            dice = 2 * len(own & other) / (len(own) + len(other))
            if dice >= least and (dice, name) > out.get(place, (0, "")):
                out[place] = (dice, name)
    return out


LINES = [
    "Released under the MIT License.", "released  UNDER the (MIT) license!!", "under the MIT License",
    "Licensed under CC BY 4.0.", "Licensed under CC BY-NC 4.0 today", "license", "",
    MIT, MIT.replace("person", "human being"), MIT[:400], MIT + " " + MIT, "This work is licensed",
]


def test_lines_equal_the_comparison_with_every_template(spark):
    texts = ["\n".join(LINES), "some words\n" + LINES[0] + "\nmore words", *LINES, None]
    found = licenses.scan(docs_of(spark, texts)).where("kind = 'line'").collect()
    got = {}
    for r in found:
        got.setdefault(r["row"]["doc_id"], {})[r["place"]] = (pytest.approx(r["dice"]), r["license"])
    assert got == {i: m for i, t in enumerate(texts) if (m := plain(t))}


def test_wrapped_texts_match_as_paragraph_or_whole(spark):
    words = MIT.split()
    wrapped = "\n".join(" ".join(words[i : i + 8]) for i in range(0, len(words), 8))
    half = len(words) // 2
    apart = " ".join(words[:half]) + "\n\n" + " ".join(words[half:])
    found = licenses.scan(docs_of(spark, ["intro\n\n" + wrapped + "\n \nend", apart])).collect()
    assert {(r["row"]["doc_id"], r["kind"], r["place"], r["license"]) for r in found} == {
        (0, "paragraph", 1, "MIT text"),
        (0, "text", 0, "MIT text"),
        (1, "text", 0, "MIT text"),
    }


def test_size_bounds_exclude_nothing_that_could_match():
    for size in range(1, 80):
        low, high = licenses._bounds(size, 0.8)
        able = [n for n in range(1, 200) if 2 * min(n, size) / (n + size) >= 0.8]
        assert (low, high) == (able[0], able[-1])


def test_every_match_has_a_telling_bigram():
    for template in licenses.TEMPLATES.values():
        own = licenses.template_bigrams(template)
        telling = licenses.telling_bigrams(own, 0.8)
        low, _ = licenses._bounds(len(own), 0.8)
        left = len(own) - len(telling)
        # Without them even the smallest passage falls short.
        assert telling and 2 * left / (max(left, low) + len(own)) < 0.8


def test_odd_rows(spark, odd_docs, no_docs):
    assert licenses.scan(odd_docs).count() == 0
    assert licenses.scan(no_docs).count() == 0
    assert licenses.scan(odd_docs, {}).count() == 0


def test_other_licences_and_wordings_are_told_apart(spark):
    wanted = {
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
        "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under the MIT License.": "MIT",
        "Licensed under the Mozilla Public License, version 2.0.": "MPL-2.0",
        "Released under the BSD 3-Clause License.": "BSD-3-Clause",
        "Licensed under CC BY-ND 4.0.": "CC-BY-ND-4.0",
        licenses.GENERAL["GPL-2.0 whole"].replace("\n", " "): "GPL-2.0",
    }
    found = licenses.scan(docs_of(spark, list(wanted))).where("kind = 'line'").collect()
    got = {r["row"]["doc_id"]: r["license"].split()[0] for r in found}
    assert got == dict(enumerate(wanted.values()))


def test_notices_inside_longer_passages_are_found(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    texts = [
        f"Copyright 2020 The Authors. {notice} All other words of this line say nothing about it at all.",
        "one two three four\nfive six seven. Licensed under the Apache\nLicense, Version 2.0. eight nine ten\neleven twelve",
        f"a line before\n{notice}\na line after",
        "none of it, under the terms of nobody, is licensed",
    ]
    found = licenses.scan(docs_of(spark, texts)).collect()
    assert [(r["row"]["doc_id"], r["kind"], r["place"], r["license"], r["dice"]) for r in found] == [
        (0, "window", 4, "Apache-2.0", 1.0), (1, "window", 7, "Apache-2.0", 1.0), (2, "line", 1, "Apache-2.0", 1.0)
    ]
