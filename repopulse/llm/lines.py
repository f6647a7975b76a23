"""Removal of lines that many documents hold.

Long enough lines are normalised, hashed and exploded; the documents of each hash
are counted; and what is left of a text is put together by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm.expressions import LOWER, UPPER
from repopulse.session import staged

KEY = ["doc_id", "text_key"]
# The white space that is stripped from both ends of a line.
BLANK = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    """The text's lines; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keyed_lines(text: Column, least_chars: int) -> Column:
    """(place, h1, h2) of the lines whose key has at least that many code points.

    The key is the stripped line with A-Z lower-cased, known by 128 bits of hash.
    """
    keys = F.transform(
        lines_of(F.translate(text, UPPER, LOWER)),
        lambda line, place: F.struct(place.alias("place"), F.btrim(line, F.lit(BLANK)).alias("key")),
    )
    long = F.filter(keys, lambda x: F.length(x["key"]) >= least_chars)
    return F.transform(
        long,
        lambda x: F.struct(
            x["place"].alias("place"),
            F.xxhash64(x["key"]).alias("h1"),
            F.xxhash64(F.lit("second"), x["key"]).alias("h2"),
        ),
    )


def repeated_lines(
    spark: SparkSession, docs: DataFrame, least_chars: int = 40, least_docs: int = 5
) -> DataFrame:
    """(doc_id, text_key, n_lines, n_dropped, kept_digest, kept_text) of every row.

    A line is dropped if its key has at least `least_chars` code points and occurs
    in at least `least_docs` documents, of which this is not the one with the
    largest doc_id; that one keeps all its lines. `kept_digest` is the SHA-256 of
    the lines left, joined by a line feed, and `kept_text` these, or null where
    nothing is dropped. `text_key` tells apart texts of one id.

    Null and empty texts have one empty line, which is never long enough. A row
    without id counts for no line and loses none. Rows of one id are one document,
    however often they are repeated. An empty table gives none. Texts of any length
    are taken whole; of two keys with equal hashes (128 bits) one would pass for
    the other.

    What a line's documents share is counted before the shuffle, and the frequent
    lines are staged before they are joined, so one that many documents hold can
    be split among tasks. Only lines' hashes and, once, the texts are shuffled.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    long = _keyed_lines(F.col("text"), least_chars)
    found = staged(
        spark, keyed.dropna(subset=["doc_id", "text"]).select(*KEY, F.inline(long)), "lines"
    )
    frequent = staged(
        spark,
        found.groupBy("h1", "h2")
        .agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last"))
        .where(F.col("n_docs") >= least_docs)
        .select("h1", "h2", "last"),
        "frequent",
    )
    dropped = staged(
        spark,
        found.join(frequent, ["h1", "h2"])
        .where("doc_id < last")
        .groupBy(*KEY)
        .agg(F.collect_set("place").alias("places")),
        "dropped",
    )
    # Nothing bounds the lines dropped, so they are never broadcast.
    joined = keyed.join(dropped.hint("merge"), KEY, "left").withColumn("lines", lines_of(F.col("text")))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    return joined.select(
        *KEY,
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long").alias("n_dropped"),
        F.when(F.col("places").isNotNull(), kept).alias("kept_text"),
        "text",
    ).select(
        *KEY,
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("kept_text", "text", F.lit("")), 256).alias("kept_digest"),
        "kept_text",
    )


def without_repeated_lines(
    spark: SparkSession, docs: DataFrame, least_chars: int = 40, least_docs: int = 5
) -> DataFrame:
    """All documents with their columns, the text without the lines that are dropped.

    Nulls, empty tables and repeated rows as in `repeated_lines`; a text that loses
    nothing stays as it is, and one that loses all its lines becomes empty.
    """
    found = repeated_lines(spark, docs, least_chars, least_docs)
    changed = found.where("n_dropped > 0").select(*KEY, "kept_text").dropDuplicates(KEY)
    rows = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        "doc_id",
        F.xxhash64("text").alias("text_key"),
    )
    text = F.coalesce("kept_text", "row.text")
    return rows.join(changed, KEY, "left").select(
        *(text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns)
    )
