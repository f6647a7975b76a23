"""Licence scans: passages compared with licence templates by their word bigrams."""

from __future__ import annotations

import math
from functools import reduce

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.llm.expressions import let
from repopulse.llm.license_templates import general_templates

# Notices of public licences by SPDX id, and parts of their texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "ISC text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:"
    ),
}
NO_WORD = r"[^\p{L}\p{N}]+"
#: The templates of the SQL check, notices of all common licences, and whole texts.
GENERAL = general_templates() | TEMPLATES
#: Numbers of bigrams up to which templates share a set of telling ones.
TIERS = (100, 700)


def _template_words(text: str) -> list[str]:
    return regex.sub(NO_WORD, " ", text.lower()).split()


def template_bigrams(text: str) -> list[str]:
    words = _template_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def _bounds(size: int, least: float) -> tuple[int, int]:
    """Sizes of bigram sets that can reach the Dice coefficient with one of `size`."""
    return math.ceil(size * least / (2 - least) - 1e-9), math.floor(size * (2 - least) / least + 1e-9)


def telling_bigrams(pairs: list[str], least: float) -> list[str]:
    """Bigrams of which a passage has at least one if it matches a template of these.

    A match may lack only so many of the template's bigrams; the longest ones, one
    more than that, are taken. None if it may lack all.
    """
    low, _ = _bounds(len(pairs), least)
    lacking = len(pairs) - math.ceil(least * (low + len(pairs)) / 2 - 1e-9)
    longest = sorted(pairs, key=lambda p: (-len(p), p))
    return longest[: lacking + 1] if lacking < len(pairs) else []


def _passages(text: Column) -> Column:
    """Lines, paragraphs of several lines, and the text if it has several paragraphs.

    Each with its kind, number and normalised words, separated by one space.
    """
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")

    def of(normal: Column) -> Column:
        lines = F.transform(
            F.split(normal, "\n"),
            lambda x, i: F.struct(F.lit("line").alias("kind"), i.alias("place"), F.trim(x).alias("words")),
        )
        blocks = F.transform(
            F.split(normal, r"\n[ \n]*\n"),
            lambda x, i: F.struct(F.lit("paragraph").alias("kind"), i.alias("place"), x.alias("words")),
        )
        # What holds no line break inside is a line already, and a sole paragraph the text.
        several = F.filter(blocks, lambda b: F.trim(b["words"], F.lit(" \n")).contains("\n"))
        whole = F.when(
            F.size(blocks) > 1,
            F.array(F.struct(F.lit("text").alias("kind"), F.lit(0).alias("place"), normal.alias("words"))),
        ).otherwise(F.array().cast("array<struct<kind:string,place:int,words:string>>"))
        return F.concat(lines, several, whole)

    return let(plain, of)


def _pairs(words: Column) -> Column:
    """All pairs of neighbouring words, in order."""
    return let(
        words,
        lambda w: F.zip_with(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))),
            F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))),
            lambda a, b: F.concat_ws(" ", a, b),
        ),
    )


def _one_space(words: Column) -> Column:
    return F.regexp_replace(F.trim(F.translate(words, "\n", " ")), " +", " ")


def _strings(texts: list[str]) -> Column:
    """A literal array; the texts hold no line break."""
    return F.split(F.lit("\n".join(texts)), "\n")


MATCH = "struct<kind:string,place:int,license:string,shared:bigint,n_bigrams:bigint,dice:double,words:string>"


def _rated(pairs: Column, t: Column, least: float) -> Column:
    """Dice coefficient of different bigrams with a template's, and what orders equal ones."""
    shared = F.size(F.array_intersect(pairs, t["pairs"]))
    return F.struct(
        (2 * shared / (F.size(pairs) + t["size"])).alias("dice"),
        t["own"].alias("own"),
        t["name"].alias("name"),
        shared.cast("long").alias("shared"),
        F.size(pairs).cast("long").alias("n"),
    )


def _matching(passages: Column, shared: Column, templates: Column, fewest: int, least: float) -> Column:
    """MATCH of each passage that matches; `shared` are the text's bigrams that any template has."""

    def best(pairs: Column, passage: Column, words: Column) -> Column:
        able = F.filter(templates, lambda t: F.size(pairs).between(t["low"], t["high"]))
        rated = F.array_max(F.transform(able, lambda t: _rated(pairs, t, least)))
        # A match has at least this share of its bigrams in common with one template.
        enough = F.size(F.array_intersect(pairs, shared)) >= F.size(pairs) * (least / (2 - least)) - 1e-9
        return F.when(enough, let(rated, lambda r: F.when(r["dice"] >= least, F.struct(
            passage["kind"].alias("kind"), passage["place"].alias("place"), r["name"].alias("license"),
            r["shared"].alias("shared"), r["n"].alias("n_bigrams"), r["dice"].alias("dice"), words.alias("words"),
        ))))

    def of(passage: Column, words: Column) -> Column:
        """A set of n bigrams needs n + 1 words at least; repeats may add any number."""
        spaces = F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit("")))
        pairs = F.array_distinct(_pairs(F.split(words, " ")))
        return F.when(spaces >= max(fewest, 1), let(pairs, lambda x: best(x, passage, words)))

    found = F.transform(passages, lambda p: let(_one_space(p["words"]), lambda w: of(p, w)))
    return F.filter(found.cast(f"array<{MATCH}>"), lambda m: m.isNotNull())


def _unmatched_words(plain: Column, matched: Column) -> Column:
    """Words of a text in order, each a line break where a matching passage lies."""
    of = lambda kind: F.transform(F.filter(matched, lambda m: m["kind"] == kind), lambda m: m["words"])
    split = lambda t: F.filter(F.split(t, " "), lambda w: w != "")
    hidden = lambda t: F.transform(split(t), lambda w: F.lit("\n"))

    def lines(block: Column) -> Column:
        each = F.transform(F.split(block, "\n"), lambda x: _one_space(x))
        return F.flatten(
            F.transform(each, lambda x: F.when(F.array_contains(of("line"), x), hidden(x)).otherwise(split(x)))
        )

    blocks = F.transform(
        F.split(plain, r"\n[ \n]*\n"),
        lambda b: let(
            _one_space(b),
            lambda w: F.when(F.array_contains(of("paragraph"), w), hidden(w)).otherwise(lines(b)),
        ),
    )
    return F.when(F.size(of("text")) > 0, F.array().cast("array<string>")).otherwise(F.flatten(blocks))


def _windows(words: Column, shared: Column, templates: Column, least: float) -> Column:
    """MATCH of runs of as many words as a template has, the best of those that overlap.

    Only runs that start with one of the template's bigrams, or end the text, are
    compared: moving any other one on loses none of the shared bigrams.
    """
    share = least / (2 - least)

    def of_template(pairs: Column, own: Column, t: Column) -> Column:
        last = F.size(pairs) - t["length"]

        def runs(have: Column) -> Column:
            starts = F.filter(
                F.sequence(F.lit(0), last), lambda i: (i == last) | F.array_contains(have, pairs[i])
            )
            rated = F.transform(
                starts,
                lambda i: let(
                    F.array_distinct(F.slice(pairs, i + 1, t["length"])),
                    lambda x: F.struct(_rated(x, t, least).alias("r"), (-i).alias("back"), t["length"].alias("length")),
                ),
            )
            return F.filter(rated, lambda x: x["r"]["dice"] >= least)

        # No run can match if the whole text holds too few of the template's bigrams.
        return let(
            F.array_intersect(own, t["pairs"]),
            lambda have: F.when((last >= 0) & (F.size(have) >= t["size"] * share - 1e-9), runs(have)),
        )

    def apart(found: Column) -> Column:
        def add(kept: Column, x: Column) -> Column:
            meets = F.exists(
                kept, lambda k: (x["back"] - x["length"] <= k["back"]) & (k["back"] - k["length"] <= x["back"])
            )
            return F.when(meets, kept).otherwise(F.concat(kept, F.array(x)))

        return F.aggregate(F.sort_array(found, asc=False), F.slice(found, 1, 0), add)

    def all_of(pairs: Column) -> Column:
        each = lambda own: F.flatten(
            F.filter(F.transform(templates, lambda t: of_template(pairs, own, t)), lambda x: x.isNotNull())
        )
        return let(let(F.array_intersect(shared, pairs), each), apart)

    return F.transform(
        let(_pairs(words), all_of),
        lambda x: F.struct(
            F.lit("window").alias("kind"), (-x["back"]).cast("int").alias("place"), x["r"]["name"].alias("license"),
            x["r"]["shared"].alias("shared"), x["r"]["n"].alias("n_bigrams"), x["r"]["dice"].alias("dice"),
            F.lit("").alias("words"),
        ),
    )


def scan(
    docs: DataFrame, templates: dict[str, str] = GENERAL, least: float = 0.8
) -> DataFrame:
    """All columns of `docs` in the struct `row`, one output row per passage that matches.

    `kind` is line, paragraph or text, `place` its number from 0, `license` the
    template with the highest Dice coefficient (of equal ones those of TEMPLATES
    first, then the last by name), `shared` and `n_bigrams` count different word
    bigrams, `dice` is the coefficient, `least` or more. Words are runs of letters
    and digits in lower case. What lies outside these passages is compared by runs
    of as many words as the template has; of runs that overlap, the best one is the
    kind window, and `place` the number of its first word in the text. Templates
    whose number of bigrams rules that coefficient out are not compared; documents
    without any of the bigrams of which a match must have one, by the same bounds,
    are not split. Null and empty texts and passages of fewer than two words match
    nothing; repeated rows match alike. No row is shuffled.
    """
    known = {name: template_bigrams(text) for name, text in sorted(templates.items())}
    known = {name: pairs for name, pairs in known.items() if pairs}
    row = F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")
    fields = ["kind", "place", "license", "shared", "n_bigrams", "dice"]
    if not known:
        none = F.lit(None).cast(MATCH).alias("m")
        return docs.limit(0).select(row, none).select("row", *(f"m.{c}" for c in fields))
    bounds = {name: _bounds(len(pairs), least) for name, pairs in known.items()}
    fewest = min(low for low, _ in bounds.values())
    tiers: dict[int, tuple[list[int], set[str]]] = {}
    for name, pairs in known.items():
        lows, any_of = tiers.setdefault(sum(len(pairs) > t for t in TIERS), ([], set()))
        lows.append(bounds[name][0])
        any_of.update(telling_bigrams(pairs, least))
    can_match = F.col("text").isNotNull()
    if all(telling_bigrams(pairs, least) for pairs in known.values()):
        flat = F.trim(F.regexp_replace(F.lower("text"), NO_WORD, " "))
        can_match = can_match & let(
            _pairs(F.split(flat, " ")),
            lambda p: reduce(
                lambda a, b: a | b,
                (
                    (F.size(p) >= min(lows)) & F.arrays_overlap(p, _strings(sorted(any_of)))
                    for lows, any_of in tiers.values()
                ),
            ),
        )
    literal = F.array(
        *(
            F.struct(
                F.lit(name).alias("name"), F.lit(name in TEMPLATES).alias("own"), _strings(pairs).alias("pairs"),
                F.lit(len(pairs)).alias("size"), F.lit(bounds[name][0]).alias("low"),
                F.lit(bounds[name][1]).alias("high"),
                F.lit(len(_template_words(templates[name])) - 1).alias("length"),
            )
            for name, pairs in known.items()
        )
    )
    every = _strings(sorted({pair for pairs in known.values() for pair in pairs}))

    def of(plain: Column, shared: Column) -> Column:
        matched = _matching(_passages(F.col("text")), shared, literal, fewest, least)
        return let(
            matched,
            lambda m: F.concat(
                m, let(_unmatched_words(plain, m), lambda w: _windows(w, shared, literal, least)).cast(f"array<{MATCH}>")
            ),
        )

    plain = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}\n]+", " ")
    shared = F.array_intersect(every, _pairs(F.split(_one_space(plain), " ")))
    found = docs.where(can_match).select(row, let(plain, lambda t: let(shared, lambda s: of(t, s))).alias("found"))
    # Of a plain explode, Spark would infer a filter that computes the array once more.
    found = found.select("row", F.explode_outer("found").alias("m")).where("m.kind is not null")
    return found.select("row", *(f"m.{c}" for c in fields))
