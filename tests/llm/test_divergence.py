from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from conftest import SF_DIR
from llm.conftest import made_prose

from repopulse.llm import divergence
from repopulse.llm.divergence import Rules


def measured(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    inside = {p for i, w in enumerate(windows) if times[w] > 1 for p in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside))


TEXTS = [
    "a a a a", "a b a b a", "a a a", "a b c a b c", "x y z w x y z", "one\n\none\n \ntwo\r\none",
    "# * $ % & | < >", "É é é 1 2 3!", "tab\tand\x0bfeed\x0c", " ", "", None,
    " ".join(str(i % 150) for i in range(1000)),
]


def test_counts_equal_those_of_a_plain_program(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    found = {
        r["row"]["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        for r in divergence.measures(docs, ["doc_id"]).collect()
    }
    assert found == {i: measured(t) for i, t in enumerate(TEXTS)}


def test_classes_cover_every_character(spark):
    docs = spark.createDataFrame([(1, "Ab 1.\t#é Ñ中", "en")], "doc_id long, text string, lang string")
    row = divergence.measures(docs, ["doc_id"]).first()
    assert dict(zip(divergence.CLASS_NAMES, row["classes"])) == {
        "space": 3, "upper": 2, "digit": 1, "stop": 1, "other": 1, "letter": 3
    }


def distance(p, q):
    p, q = np.array(p, float), np.array(q, float)
    m = (p + q) / 2
    half = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a > 0)
    return np.sqrt((half(p) + half(q)) / 2)


def test_distances_are_jensen_shannon(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    found = divergence.measures(docs, ["doc_id"])
    refs = divergence.language_references(found)
    terms = divergence.vocabulary(Rules())
    counted = {r["row"]["doc_id"]: r for r in found.collect()}
    judged = divergence.verdicts(found, refs).where("n_words > 0").collect()
    assert judged
    for row in judged:
        r = counted[row["row"]["doc_id"]]
        by_lang = {}
        for lang, ref in refs.items():
            own = [r["commons"][terms.index(w)] for w in Rules().common_words[lang].split()]
            words = [x / r["n_words"] for x in [*own, r["n_words"] - sum(own)]]
            classes = [x / r["n_all_chars"] for x in r["classes"]]
            by_lang[lang] = (distance(words, ref["words"]), distance(classes, ref["classes"]))
        nearest = min(by_lang, key=lambda k: by_lang[k][0])
        assert row["reference"] == nearest
        assert (row["word_distance"], row["class_distance"]) == pytest.approx(by_lang[nearest])


def test_odd_rows_are_judged_and_kept_whole(spark, odd_docs):
    found = divergence.judge(spark, odd_docs).collect()
    assert len(found) == 9
    by_id = {r["row"]["doc_id"]: r for r in found}
    assert by_id[2]["base_failed"] and by_id[2]["n_words"] == 0 and by_id[2]["word_distance"] is None
    assert by_id[5]["n_words"] == 78_000
    kept = divergence.keep_good(spark, odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 1, 5]


def test_short_texts_are_not_judged_by_histograms(spark, prose):
    junk = " ".join(f"###{i}" for i in range(60))
    rows = [(1, prose, "en"), (2, junk, "en"), (3, "brief " + junk[:30], "en")]
    rows += [(10 + i, made_prose(3, 100 * i), "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    loose = Rules(least_chars=10_000, least_words=10_000)
    reasons = lambda rules: {
        r["row"]["doc_id"]: r["reason"] for r in divergence.judge(spark, docs, rules).collect() if r["reason"]
    }
    assert reasons(Rules()) == {2: "classes", 3: "base"}
    assert reasons(loose) == {3: "base"}


def test_an_empty_table_has_no_verdicts(spark, no_docs):
    assert divergence.judge(spark, no_docs).count() == 0


def test_other_languages_are_judged_by_their_own_words(spark):
    russian = "и в не на я быть он с что а по это она этот к но они мы весь который".split()
    text = lambda i: " ".join(f"{w} слово{i}у{k} дело{k * i + k}" for k, w in enumerate(russian * 3))
    rows = [(i, text(i), "ru", f"s{i % 2}") for i in range(1, 11)]
    rows += [(20 + i, made_prose(3, 100 * i), "en", "s0") for i in range(10)]
    rows += [(40, " ".join(f"zork{i} blip{i}" for i in range(80)), "en", "s0")]
    rows += [(41, " ".join(f"зорк{i} блип{i}" for i in range(80)), "ru", "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r["row"]["doc_id"]: r for r in divergence.judge(spark, docs).collect()}
    assert {i for i, r in found.items() if not r["kept"]} == {40, 41}
    assert {found[i]["reference"] for i in range(1, 11)} == {"ru"}


def test_junk_rows_do_not_loosen_the_word_rule(spark):
    rows = [(i, made_prose(3, 100 * i), "en") for i in range(10)]
    rows += [(20 + i, " ".join(f"zork{i}x{k} blip{k}" for k in range(90)), "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["row"]["doc_id"]: r["reason"] for r in divergence.judge(spark, docs).collect()}
    assert found == {i: None for i in range(10)} | {20 + i: "words" for i in range(20)}
