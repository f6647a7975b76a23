"""Breakout scoring of repositories with Spark ML (Q12)."""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repopulse import schemas
from repopulse.session import folder_names, staged
from repopulse.sources.tables import Tables

BACKTEST = (
    "day string, repos bigint, grew bigint, hits bigint, log_loss double, growth_error double"
)
FEATURES = ["stars", "forks", "velocity", "fork_velocity", "active_days"]


def scored_days(weekly: DataFrame) -> DataFrame:
    """One row per repository and active day: features so far, and the next day's velocity.

    The next velocity is null on a repository's latest day, the one to score.
    """
    by_day = Window.partitionBy("name").orderBy("day")
    return weekly.select(
        "name",
        "day",
        *FEATURES[:-1],
        F.row_number().over(by_day).alias("active_days"),
        F.lead("velocity").over(by_day).alias("next_velocity"),
    )


@dataclass(frozen=True)
class BreakoutModels:
    """Fitted scaling, chance, size and cluster of growth."""

    scaling: PipelineModel
    chance: LogisticRegressionModel
    growth: LinearRegressionModel
    groups: KMeansModel

    def score(self, days: DataFrame, *kept: str) -> DataFrame:
        """Q12: predictions for rows of `scored_days`, with the kept columns."""
        scored = self.scaling.transform(days)
        for model in (self.chance, self.growth, self.groups):
            scored = model.transform(scored)
        return scored.select(
            "name",
            *kept,
            vector_to_array("chances")[1].alias("probability"),
            F.concat(F.lit("cluster-"), F.col("group").cast("string")).alias("cluster"),
            "predicted_growth",
        )

    def save(self, path: str) -> None:
        """Replace the models stored at a path."""
        for field in fields(self):
            getattr(self, field.name).write().overwrite().save(f"{path}/{field.name}")

    @staticmethod
    def load(path: str) -> BreakoutModels:
        return BreakoutModels(
            PipelineModel.load(f"{path}/scaling"),
            LogisticRegressionModel.load(f"{path}/chance"),
            LinearRegressionModel.load(f"{path}/growth"),
            KMeansModel.load(f"{path}/groups"),
        )


def fit_models(days: DataFrame, clusters: int = 4, seed: int = 7) -> BreakoutModels | None:
    """Models of rows of `scored_days` whose next day is known; none without such rows.

    `days` should be a written table, as the estimators pass over it many times.
    """
    known = days.where(F.col("next_velocity").isNotNull()).withColumns(
        {
            "grows": (F.col("next_velocity") > 0).cast("double"),
            "growth": F.col("next_velocity").cast("double"),
        }
    )
    if known.isEmpty():
        return None
    scaling = Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
        ]
    ).fit(known)
    training = scaling.transform(known).select("features", "grows", "growth")
    chance = LogisticRegression(
        labelCol="grows", probabilityCol="chances", predictionCol="class", rawPredictionCol="odds"
    )
    growth = LinearRegression(labelCol="growth", predictionCol="predicted_growth", solver="normal")
    groups = KMeans(k=clusters, seed=seed, predictionCol="group")
    return BreakoutModels(scaling, *(e.fit(training) for e in (chance, growth, groups)))


def breakout_scores(
    spark: SparkSession, weekly: DataFrame, clusters: int = 4, seed: int = 7
) -> DataFrame:
    """Q12: chance, cluster and size of growth on each repository's next active day.

    The models learn from days whose next day is known and score each
    repository's latest day.
    """
    days = staged(spark, scored_days(weekly), "breakout")
    models = fit_models(days, clusters, seed)
    if models is None:
        return schemas.empty(spark, schemas.PREDICTIONS)
    return models.score(days.where(F.col("next_velocity").isNull()))


def refresh_predictions(
    spark: SparkSession, tables: Tables, weekly: DataFrame, refit: bool = True
) -> bool:
    """Q12: store predictions for each repository's latest day; False without any model.

    With `refit` new models are fitted and stored first; otherwise the stored ones
    are loaded, so a daily run need not learn anew.
    """
    days = staged(spark, scored_days(weekly), "breakout")
    if refit:
        models = fit_models(days)
        if models is None:
            return False
        models.save(tables.models)
    elif not folder_names(spark, tables.models, ""):
        return False
    models = BreakoutModels.load(tables.models)
    write_predictions(models.score(days.where(F.col("next_velocity").isNull())), tables)
    return True


def backtest(spark: SparkSession, weekly: DataFrame, days: int = 3) -> DataFrame:
    """Q12: how predictions of the last days would have fared, one row per day.

    For each of the last `days` days but the newest, models learn from what was
    known on that day and score its repositories; the velocity of their next active
    day, where there is one, tells how well. Columns: day, repos (with a next day), grew,
    hits (probability of a half or more if and only if it grew), log_loss, growth_error.
    """
    rows = staged(spark, scored_days(weekly), "backtest")
    newest = rows.select("day").distinct().orderBy(F.desc("day")).limit(days + 1).collect()
    found = [schemas.empty(spark, BACKTEST)]
    for day in sorted(row["day"] for row in newest)[:-1]:
        # What came after the day is not known on it.
        past = staged(spark, scored_days(weekly.where(F.col("day") <= day)), "past")
        models = fit_models(past)
        if models is None:
            continue
        due = rows.where((F.col("day") == day) & F.col("next_velocity").isNotNull())
        scored = models.score(due, "day", "next_velocity")
        grew = F.col("next_velocity") > 0
        chance = F.when(grew, F.col("probability")).otherwise(1 - F.col("probability"))
        found.append(
            scored.groupBy("day").agg(
                F.count("*").alias("repos"),
                F.count_if(grew).alias("grew"),
                F.count_if((F.col("probability") >= 0.5) == grew).alias("hits"),
                F.avg(-F.log(F.greatest(chance, F.lit(1e-15)))).alias("log_loss"),
                F.avg(F.abs(F.col("predicted_growth") - F.col("next_velocity"))).alias("growth_error"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def write_predictions(predictions: DataFrame, tables: Tables) -> None:
    """Replace the predictions table."""
    predictions.write.mode("overwrite").parquet(tables.predictions)
