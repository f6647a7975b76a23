"""Quality rules by distribution divergence.

A document is described by two histograms, of character classes and of common
words, and is compared with one reference per language by Jensen-Shannon
distance. Both stand next to base rules on length and repetition.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from itertools import zip_longest
from math import log2, sqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repopulse.llm.expressions import count_of, let, words
from repopulse.session import staged

# The most common words of each language that has a reference.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als",
    "en": "the of and to a in is that it for was on with as be by this are at from",
    "es": "de la que el en y los se las del un por con no su una para es al lo",
    "fr": "de la le et les des en un du une que pour est par dans qui avec pas sur au",
}

#: Common words that are derived for each other language.
DERIVED = 20

# Character classes, each as a pattern of all other characters.
# The classes `space` and `letter` (all that is left: letters that are not upper
# case) complete them.
CLASSES = {
    "upper": r"[^\p{Lu}]+",
    "digit": r"[^0-9]+",
    "stop": r"[^.,;:!?'\"()-]+",
    "other": r"[\p{L}0-9.,;:!?'\"()\x20\x09-\x0D-]+",
}
LOWER_OR_SPACE = r"[a-z \u00DF-\u00F6\u00F8-\u00FF]+"
CLASS_NAMES = ["space", *CLASSES, "letter"]
#: Repeated windows up to which each window of a text is looked up among them.
FEW = 100


@dataclass(frozen=True)
class Rules:
    """Parameters of the rules.

    The distances are between 0 and 1. A histogram of fewer than `least_chars`
    characters or `least_words` words is not judged, as its noise alone may
    exceed the limit. `derived_words` are those of languages that `common_words`
    lacks, as `derived_words` finds them.
    """

    least_words_base: int = 50
    repeat_percent: int = 50
    class_distance: float = 0.3
    word_distance: float = 0.3
    least_chars: int = 200
    least_words: int = 100
    common_words: dict[str, str] = field(default_factory=lambda: dict(COMMON_WORDS))
    derived_words: dict[str, str] = field(default_factory=dict)

    @property
    def all_words(self) -> dict[str, str]:
        return self.derived_words | self.common_words


def _repeated_words(w: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more.

    Windows are told apart by 64-bit hashes within their text.
    """

    def covered(windows: Column, repeated: Column) -> Column:
        few = F.filter(
            F.sequence(F.lit(0), F.size(windows) - 1),
            lambda i: F.array_contains(repeated, windows[i]),
        )
        many = let(
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            lambda s: F.transform(
                F.filter(
                    s,
                    lambda x, k: (F.get(s, k - 1)["h"] == x["h"])
                    | (F.get(s, k + 1)["h"] == x["h"]),
                ),
                lambda x: x["i"],
            ),
        )
        starts = F.when(F.size(repeated) <= FEW, few).otherwise(many)
        return F.size(
            F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2))))
        )

    def counted(words_: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(words_) - 3),
            lambda i: F.xxhash64(words_[i], words_[i + 1], words_[i + 2]),
        )
        return F.when(F.size(words_) < 4, 0).otherwise(let(windows, judged))

    def judged(windows: Column) -> Column:
        repeated = let(
            F.sort_array(windows),
            lambda s: F.array_distinct(F.filter(s, lambda h, k: F.get(s, k - 1) == h)),
        )
        return let(
            repeated,
            lambda r: F.when(F.size(r) == 0, 0).otherwise(covered(windows, r)),
        )

    return let(w, counted).cast("long")


def _repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _class_counts(text: Column, rest: Column, word_chars: Column) -> Column:
    """Characters per class, in the order of CLASS_NAMES; `rest`: without LOWER_OR_SPACE."""
    known = [F.length(text) - word_chars, *(count_of(rest, others) for others in CLASSES.values())]
    return let(
        F.array(*(x.cast("long") for x in known)),
        lambda c: F.concat(
            c,
            F.array(F.length(text) - F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)),
        ),
    )


def _word_counts(w: Column, terms: list[str]) -> Column:
    """Occurrences of each of the terms among the words, in the order of the terms.

    Every common word becomes one character, so that counting it is a
    replacement in a short string.
    """
    letters = [chr(0x21 + i) for i in range(len(terms))]
    codes = F.create_map(*(F.lit(x) for pair in zip(terms, letters) for x in pair))
    common = F.filter(w, lambda x: F.lower(x).isin(terms))
    coded = F.array_join(F.transform(common, lambda x: F.element_at(codes, F.lower(x))), "")
    return let(
        coded,
        lambda s: F.transform(
            F.array(*map(F.lit, letters)),
            lambda x: F.length(s) - F.length(F.replace(s, x, F.lit(""))),
        ),
    )


def vocabulary(rules: Rules) -> list[str]:
    """All common words, the most common ones of every language first."""
    ranks = zip_longest(*(text.split() for text in rules.all_words.values()))
    return list(dict.fromkeys(w for rank in ranks for w in rank if w))


def derived_words(docs: DataFrame, rules: Rules = Rules()) -> dict[str, str]:
    """The DERIVED most common words of each language that has no common words yet.

    A word's share is averaged over the sources of a language, so that none
    outweighs the others. The driver receives DERIVED words per such language.
    """
    other = docs.where(F.col("lang").isNotNull() & ~F.col("lang").isin(sorted(rules.common_words)))
    source = F.coalesce("source", F.lit("")) if "source" in docs.columns else F.lit("")
    each = other.select("lang", source.alias("source"), F.explode(words(F.lower("text"))).alias("term"))
    counted = each.groupBy("lang", "source", "term").agg(F.count(F.lit(1)).alias("n"))
    totals = counted.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    shares = (
        counted.join(totals, ["lang", "source"])
        .groupBy("lang", "term")
        .agg(F.sum(F.col("n") / F.col("total")).alias("share"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("share"), "term")
    best = shares.withColumn("k", F.row_number().over(order)).where(F.col("k") <= DERIVED)
    found: dict[str, list[str]] = {}
    for row in best.orderBy("lang", "k").collect():
        found.setdefault(row["lang"], []).append(row["term"])
    return {lang: " ".join(terms) for lang, terms in found.items()}


def measures(docs: DataFrame, carry: list[str], rules: Rules = Rules()) -> DataFrame:
    """The columns named by `carry` in the struct `row`, with counts of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in carry)).alias("row"),
        F.col("lang"),
        text.alias("text"),
        words(text).alias("words"),
        F.regexp_replace(text, LOWER_OR_SPACE, "").alias("rest"),
    )
    spaces = (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))) + count_of(
        F.col("rest"), r"[^\x09-\x0D]+"
    )
    return bare.withColumn("word_chars", F.length("text") - spaces).select(
        "row",
        "lang",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        count_of(F.col("rest"), r"[^#*$%&|<>]+").alias("n_symbols"),
        _repeated_lines(F.col("text")).alias("n_dup_lines"),
        _repeated_words(F.col("words")).alias("n_repeat_words"),
        F.length("text").cast("long").alias("n_all_chars"),
        _class_counts(F.col("text"), F.col("rest"), F.col("word_chars")).alias("classes"),
        _word_counts(F.col("words"), vocabulary(rules)).alias("commons"),
    )


def language_references(measured: DataFrame, rules: Rules = Rules()) -> dict[str, dict]:
    """Share of each character class and common word over all texts of a language.

    One entry per language with common words, given or derived, that the column `lang` names;
    all documents of it count. `words` ends with the share of all other words.
    The driver receives one row per such language.
    """
    terms = vocabulary(rules)
    sums = [F.sum(F.col("classes")[i]).alias(f"class_{i}") for i in range(len(CLASS_NAMES))]
    sums += [F.sum(F.col("commons")[i]).alias(f"word_{i}") for i in range(len(terms))]
    known = measured.where(F.col("lang").isin(sorted(rules.all_words)))
    found = {}
    for row in known.groupBy("lang").agg(F.sum("n_words").alias("n_words"), *sums).collect():
        if not row["n_words"]:
            continue
        classes = [row[f"class_{i}"] for i in range(len(CLASS_NAMES))]
        own = [row[f"word_{terms.index(w)}"] for w in rules.all_words[row["lang"]].split()]
        found[row["lang"]] = {
            "classes": [x / sum(classes) for x in classes],
            "words": [x / row["n_words"] for x in [*own, row["n_words"] - sum(own)]],
        }
    return found


def _distance(shares: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance, with logarithms to base 2: 0 to 1."""

    def part(p: Column, q: Column) -> Column:
        mean = (p + q) / 2
        own = F.when(p > 0, p * F.log2(p / mean)).otherwise(0.0)
        return own + F.when(q > 0, q * F.log2(q / mean)).otherwise(0.0)

    parts = F.zip_with(shares, F.array(*map(F.lit, reference)), part)
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _bare(shares: list[float]) -> float:
    """Distance of a text without any common word from a reference by words."""
    *own, rest = shares
    part = lambda p, q: p * log2(2 * p / (p + q)) if p else 0.0
    return sqrt((sum(own) + part(1.0, rest) + part(rest, 1.0)) / 2)


def verdicts(found: DataFrame, references: dict, rules: Rules = Rules()) -> DataFrame:
    """Distances, failed rule and verdict of measured documents.

    `reference` is, of the languages with given common words, the one whose
    reference is nearest by common words, and the distances are those to it; which
    of these the language column names plays no part, and neither does a null. A
    document of a language with derived words has that one's reference, and of a
    language without any it has none, and only the base rule holds. Junk that lowers
    a reference's shares cannot hide a text with few of the common words: it
    fails from 0.9 of the distance that a text without any has. `reason` is the first failed rule: `base`,
    `classes`, `words`, or null for a document that is kept. Without references
    only the base rule holds.
    """
    terms = vocabulary(rules)

    def word_shares(lang: str) -> Column:
        places = F.array(*(F.lit(terms.index(w)) for w in rules.all_words[lang].split()))
        own = F.transform(places, lambda i: F.col("commons")[i])
        rest = F.col("n_words") - F.aggregate(own, F.lit(0), lambda a, x: a + x)
        return F.transform(F.concat(own, F.array(rest.cast("int"))), lambda x: x / F.col("n_words"))

    class_shares = F.transform("classes", lambda x: x / F.col("n_all_chars"))
    near = {
        lang: F.struct(
            _distance(word_shares(lang), ref["words"]).alias("word_distance"),
            F.lit(lang).alias("reference"),
            _distance(class_shares, ref["classes"]).alias("class_distance"),
        )
        for lang, ref in sorted(references.items())
    }
    nothing = F.lit(None).cast("struct<word_distance:double,reference:string,class_distance:double>")
    given = [x for lang, x in near.items() if lang in rules.common_words]
    nearest = F.when(
        F.col("lang").isNull() | F.col("lang").isin(sorted(rules.common_words)),
        F.least(*given, *given[:1]) if given else nothing,
    )
    for lang in near.keys() - rules.common_words.keys():
        nearest = nearest.when(F.col("lang") == lang, near[lang])
    nearest = F.when(F.col("n_words") > 0, nearest)
    base_failed = (F.col("n_words") < rules.least_words_base) | (
        100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words")
    )
    odd_classes = (F.col("n_all_chars") >= rules.least_chars) & (
        F.col("class_distance") > rules.class_distance
    )
    diluted = F.lit(False)
    for lang in sorted(references.keys() & rules.common_words.keys()):
        few = 1 - F.element_at(word_shares(lang), -1) < 1 - references[lang]["words"][-1]
        near_bare = F.col("word_distance") > 0.9 * _bare(references[lang]["words"])
        diluted = diluted | ((F.col("reference") == lang) & few & near_bare)
    odd_words = (F.col("n_words") >= rules.least_words) & (
        (F.col("word_distance") > rules.word_distance) | diluted
    )
    # A filter on what follows would compute the distances of a plain column once per mention.
    measured = found.select("*", F.explode(F.array(nearest)).alias("near")).select("*", "near.*")
    reason = (
        F.when(base_failed, "base").when(odd_classes, "classes").when(odd_words, "words")
    )
    return measured.select(
        "row",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "reference",
        "class_distance",
        "word_distance",
        base_failed.alias("base_failed"),
        reason.alias("reason"),
        reason.isNull().alias("kept"),
    )


def judge(
    spark: SparkSession,
    docs: DataFrame,
    rules: Rules = Rules(),
    carry: list[str] | None = None,
) -> DataFrame:
    """Counts, distances and verdict of every document, against references from all of them.

    `carry` names the columns kept in the struct `row`, by default all. Texts are
    read once: their measures are staged, and references and verdicts start from
    those. A null text counts as empty and fails the base rule; null ids and
    repeated rows are judged like any other; an empty table has no verdicts.
    """
    kept = docs.columns if carry is None else carry
    rules = replace(rules, derived_words=derived_words(docs, rules))
    measured = staged(spark, measures(docs, kept, rules), "measures")
    return verdicts(measured, language_references(measured, rules), rules)


def keep_good(spark: SparkSession, docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their columns, nulls and repeated rows as in `judge`."""
    return judge(spark, docs, rules).where("kept").select("row.*")
