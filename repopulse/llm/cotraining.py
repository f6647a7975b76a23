"""Quality classifier by co-training.

Two views of a document, its text and its metadata, each have a classifier. Over
some rounds either one labels the unlabelled documents it is sure of for the other
to learn from. Both are then calibrated on labelled rows that neither has seen,
and the calibrated views are combined to score every document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm.expressions import count_of, words
from repopulse.session import staged

VIEWS = ("text", "meta")


@dataclass(frozen=True)
class Settings:
    """Bounds of what the classifiers are fitted on, and how the rounds go.

    About `labelled` rows with a label are drawn by a hash of their id; rows without
    one all take part. `sure` is the probability from which a label is passed on.
    """

    labelled: int = 10_000
    rounds: int = 2
    sure: float = 0.97
    text_features: int = 1 << 12
    meta_features: int = 1 << 8
    iterations: int = 15
    penalty: float = 1e-3


def views(docs: DataFrame, settings: Settings, *kept: str) -> DataFrame:
    """The kept columns with the vectors `text_view` and `meta_view`, which share no column.

    The text view hashes the words, in lower case, and their shapes, in which each
    run of letters is one sign, and has the shares of different words, of words
    that repeat the one before, of capitals, digits, marks and white space, and the
    number and length of lines. The metadata view holds source, language and the
    stated number of characters, each by itself and language and size together.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    shapes = words(F.regexp_replace(text, r"\p{L}+", "a"))
    rest = F.regexp_replace(text, r"[\p{Ll}]+", "")
    n = F.greatest(F.length(text), F.lit(1))
    lines = F.size(F.split(text, "\n"))
    figures = F.array(
        F.log1p(F.length(text)) / 10,
        F.log1p(lines) / 5,
        F.log1p(n / lines) / 5,
        count_of(rest, r"[^\p{Lu}]+") / n,
        count_of(rest, r"[^\p{Nd}]+") / n,
        count_of(rest, r"[\p{L}\p{N}\s]+") / n,
        count_of(rest, r"\S+") / n,
    )
    stated = F.greatest(F.coalesce(F.col("n_chars"), F.lit(-1)), F.lit(-1)) + 2
    source, lang = (F.coalesce(c, F.lit("")) for c in ("source", "lang"))
    size = F.floor(2 * F.log2(stated)).cast("string")
    named = F.array(
        F.concat(F.lit("source="), source),
        F.concat(F.lit("lang="), lang),
        F.concat(F.lit("size="), size),
        F.concat(F.lit("lang and size="), lang, F.lit(" "), size),
    )
    found = docs.select(
        *kept,
        F.concat(
            F.transform(words(F.lower(text)), lambda w: F.concat(F.lit("w "), w)),
            F.transform(shapes, lambda w: F.concat(F.lit("s "), w)),
        ).alias("terms"),
        words(text).alias("words"),
        named.alias("named"),
        *(figures[i].cast("double").alias(f"figure{i}") for i in range(7)),
    )
    count = F.greatest(F.size("words"), F.lit(1))
    echoes = F.zip_with("words", F.slice("words", 2, 1 << 30), lambda a, b: a == b)
    found = found.withColumns(
        {
            "variety": F.size(F.array_distinct("words")) / count,
            "echoes": F.size(F.filter(echoes, lambda x: x)) / count,
        }
    )
    stages = [
        HashingTF(inputCol="terms", outputCol="counts", numFeatures=settings.text_features),
        Normalizer(inputCol="counts", outputCol="frequencies"),
        VectorAssembler(
            inputCols=["frequencies", "variety", "echoes", *(f"figure{i}" for i in range(7))],
            outputCol="text_view",
        ),
        HashingTF(inputCol="named", outputCol="meta_view", numFeatures=settings.meta_features),
    ]
    for stage in stages:
        found = stage.transform(found)
    return found.select(*kept, "text_view", "meta_view")


def _share(column: Column, bound: int, total: int, salt: int) -> Column:
    """True for about `bound` of `total` rows, by a hash of the column."""
    return F.pmod(F.xxhash64(column, F.lit(salt)), F.lit(1 << 30)) < (bound << 30) // max(total, 1)


def _fit(rows: DataFrame, features: str, settings: Settings, plain: bool = False):
    return LogisticRegression(
        featuresCol=features,
        labelCol="label",
        maxIter=settings.iterations,
        regParam=0.0 if plain else settings.penalty,
        standardization=not plain,
        rawPredictionCol="raw",
        probabilityCol="probability",
        predictionCol="class",
    ).fit(rows)


def _odds(model, rows: DataFrame, to: str) -> DataFrame:
    """Rows with the model's log odds of the label 1."""
    found = model.transform(rows)
    return found.withColumn(to, vector_to_array("raw")[1]).drop("raw", "probability", "class")


class CoTrained:
    """Fitted views, their calibration, and how they are combined."""

    def __init__(self, models: dict, scales: dict, weights: tuple, constant: float | None) -> None:
        self.models, self.scales, self.weights, self.constant = models, scales, weights, constant

    def score(self, viewed: DataFrame) -> DataFrame:
        """Rows of views with p_text, p_meta and score, each the probability of good quality."""
        probability = lambda x: 1 / (1 + F.exp(-x))
        if self.constant is not None:
            kept = viewed.drop("text_view", "meta_view")
            return kept.select("*", *(F.lit(self.constant).alias(c) for c in ("p_text", "p_meta", "score")))
        total = F.lit(self.weights[0])
        for view, weight in zip(VIEWS, self.weights[1:]):
            viewed = _odds(self.models[view], viewed, f"{view}_odds")
            factor, offset = self.scales[view]
            total = total + weight * (factor * F.col(f"{view}_odds") + offset)
        return viewed.select(
            *(c for c in viewed.columns if not c.endswith(("_view", "_odds"))),
            *(
                probability(self.scales[v][0] * F.col(f"{v}_odds") + self.scales[v][1]).alias(f"p_{v}")
                for v in VIEWS
            ),
            probability(total).alias("score"),
        )


def fit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, settings: Settings = Settings()
) -> tuple[CoTrained, DataFrame]:
    """Classifiers fitted on a bounded sample of labelled rows and all others; and all rows' views.

    `labels` has doc_id and quality (0 or 1); null fields are passed over, and
    several labels of an id count by majority. Labelled rows that are not drawn take
    part like unlabelled ones. Unless the sample has both labels for learning and
    for calibration, every score is the share of good labels, or a half without any.

    The views of all documents are made once and staged, with the labels drawn,
    whose number is bounded by the settings, broadcast to them. No text is shuffled.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    )
    known = staged(spark, known, "known")
    drawn = known.where(_share(F.col("doc_id"), settings.labelled, known.count(), 1))
    columns = docs.select("doc_id", "text", "source", "lang", "n_chars")
    marked = views(columns, settings, "doc_id").join(F.broadcast(drawn), "doc_id", "left")
    held = staged(spark, marked, "views")
    # One labelled row in four is kept for calibration.
    quarter = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) == 0
    calibration = held.where(F.col("label").isNotNull() & quarter)
    learning = held.where(F.col("label").isNotNull() & ~quarter)
    pool = held.where("label is null and doc_id is not null")
    both = [rows.select("label").distinct().count() == 2 for rows in (learning, calibration)]
    if not all(both):
        share = known.agg(F.avg("label")).first()[0]
        return CoTrained({}, {}, (), 0.5 if share is None else float(share)), held
    models = {v: _fit(learning, f"{v}_view", settings) for v in VIEWS}
    for _ in range(settings.rounds):
        scored = pool
        for v in VIEWS:
            scored = _odds(models[v], scored, f"{v}_odds")
        sure = float(settings.sure / (1 - settings.sure))
        limit = F.log(F.lit(sure))
        for giver, taker in (VIEWS, VIEWS[::-1]):
            odds, other = F.col(f"{giver}_odds"), F.col(f"{taker}_odds")
            # Sure, and not against what the other is sure of.
            passed = scored.where((F.abs(odds) >= limit) & ~((odds * other < 0) & (F.abs(other) >= limit)))
            passed = passed.select("doc_id", (odds > 0).cast("double").alias("label"), *(f"{v}_view" for v in VIEWS))
            models[taker] = _fit(learning.unionByName(passed), f"{taker}_view", settings)
    scales, rated = {}, calibration
    for v in VIEWS:
        rated = _odds(models[v], rated, f"{v}_odds")
    for v in VIEWS:
        one = VectorAssembler(inputCols=[f"{v}_odds"], outputCol="x").transform(rated)
        line = _fit(one, "x", settings, plain=True)
        scales[v] = (float(line.coefficients[0]), float(line.intercept))
        rated = rated.withColumn(f"{v}_even", scales[v][0] * F.col(f"{v}_odds") + scales[v][1])
    two = VectorAssembler(inputCols=[f"{v}_even" for v in VIEWS], outputCol="x").transform(rated)
    last = _fit(two, "x", settings)
    weights = (float(last.intercept), *map(float, last.coefficients))
    return CoTrained(models, scales, weights, None), held


def classify(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """doc_id, p_text, p_meta, score and good (score of a half or more) of every document.

    `docs` has doc_id, text, source, lang and n_chars; other columns are not looked
    at, whatever their names. Null texts count as empty, null metadata as values of
    their own; null ids and repeated rows are scored like any other; an empty table
    has no scores. Texts of any length count whole. A score of exactly a half is good.
    """
    model, viewed = fit(spark, docs, labels, settings)
    found = model.score(viewed.drop("label"))
    return found.withColumn("good", F.col("score") >= 0.5)
