from __future__ import annotations

import pytest
import public_tokenizers

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves, as columns of the input.
CLASHING = "row string, n_words long, print long, text_key long, score double, place int, found string, part long"


def docs_of(spark, texts, first_id=0):
    rows = [(first_id + i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def made_prose(times, first=0):
    words = "the of and to a in is that it for was on with as be by this are at from".split()
    return " ".join(f"{w} {w}word{i} other{i * i}." for i, w in enumerate(words * times, first))


@pytest.fixture(scope="session")
def prose():
    return made_prose(3)


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Nulls in every column, empty and very long texts, repeated rows, and clashing names."""
    long = made_prose(1300, 1000)
    rows = [
        (1, prose, "en", "s0", 10),
        (1, prose, "en", "s0", 10),
        (2, None, None, None, None),
        (3, "", "en", "s0", 0),
        (4, " \t\n\x0b ", "fr", "s1", 4),
        (5, long, "en", "s1", len(long)),
        (None, prose, "en", None, 10),
        (None, None, None, None, None),
        (6, "É", None, "s2", 1),
    ]
    extra = ("x", -1, -2, -3, 0.5, -4, "y", -5)
    return spark.createDataFrame([(*r, *extra) for r in rows], f"{DOCS}, {CLASHING}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def word_vocabulary():
    return public_tokenizers.path("word_bpe_49k.json")
