from __future__ import annotations

import random

from conftest import records
from test_panels import weekly

from repopulse import schemas
from repopulse.plans import breakout
from repopulse.sources.tables import read_table


def history(spark, repos=30, days=6, seed=5):
    rng = random.Random(seed)
    rows = []
    for repo in range(repos):
        for day in range(1, days + 1):
            stars = rng.randint(0, 20) + repo
            rows.append((f"2026-04-{day:02d}", f"r{repo:02d}", "Go", stars, rng.randint(-9, 9), rng.randint(-3, 3)))
    return weekly(spark, rows)


def test_scores_are_probabilities_one_per_repository(spark, tables):
    scores = breakout.breakout_scores(spark, history(spark), clusters=3)
    breakout.write_predictions(scores, tables)
    stored = read_table(spark, tables.predictions, schemas.PREDICTIONS)
    assert [f"{name} {kind}" for name, kind in stored.dtypes] == schemas.PREDICTIONS.split(", ")
    rows = stored.collect()
    assert len(rows) == len({row.name for row in rows}) == 30
    assert all(0 <= row.probability <= 1 for row in rows)
    assert {row.cluster for row in rows} <= {"cluster-0", "cluster-1", "cluster-2"}


def test_each_day_is_labelled_by_the_next_active_one(spark):
    data = weekly(
        spark,
        [("2026-04-01", "a", "Go", 1, 1, 0), ("2026-04-05", "a", "Go", 3, 2, 0), ("2026-04-05", "b", "Go", 1, 1, 0)],
    )
    found = records(breakout.scored_days(data), "name", "day", "active_days", "next_velocity")
    assert found == [
        ("a", "2026-04-01", 1, 2),
        ("a", "2026-04-05", 2, None),
        ("b", "2026-04-05", 1, None),
    ]


def test_a_single_day_cannot_train(spark):
    data = weekly(spark, [("2026-04-01", "a", "Go", 1, 1, 0)])
    assert breakout.breakout_scores(spark, data).count() == 0


def test_kept_models_predict_as_when_they_were_fitted(spark, tables):
    rows = history(spark)
    assert not breakout.refresh_predictions(spark, tables, rows, refit=False)
    assert breakout.refresh_predictions(spark, tables, rows)
    fitted = records(read_table(spark, tables.predictions, schemas.PREDICTIONS))
    assert breakout.refresh_predictions(spark, tables, rows, refit=False)
    assert records(read_table(spark, tables.predictions, schemas.PREDICTIONS)) == fitted
    assert len(fitted) == 30


def test_a_backtest_learns_only_from_earlier_days(spark, monkeypatch):
    learned, fit = [], breakout.fit_models
    monkeypatch.setattr(breakout, "fit_models", lambda days: learned.append(days) or fit(days))
    found = breakout.backtest(spark, history(spark), days=2).orderBy("day").collect()
    assert [(r["day"], r["repos"]) for r in found] == [("2026-04-04", 30), ("2026-04-05", 30)]
    assert all(0 <= r["hits"] <= 30 and r["grew"] <= 30 and r["log_loss"] > 0 for r in found)
    for day, rows in zip(("2026-04-04", "2026-04-05"), learned):
        known = rows.where("next_velocity is not null").agg({"day": "max"}).first()[0]
        assert known < day and rows.agg({"day": "max"}).first()[0] == day
    assert breakout.backtest(spark, history(spark, days=1)).count() == 0
