from __future__ import annotations

import numpy as np
from conftest import SF_DIR
from llm.conftest import docs_of

from repopulse.llm import cotraining


def test_labels_are_learned(spark):
    docs = spark.read.parquet(SF_DIR.replace("sf0.001", "sf0.01") + "/documents.parquet")
    labels = spark.read.parquet(SF_DIR.replace("sf0.001", "sf0.01") + "/labels.parquet")
    found = cotraining.classify(spark, docs, labels)
    assert found.count() == docs.count()
    rated = found.join(labels, "doc_id").collect()
    right = sum(r["good"] == (r["quality"] == 1) for r in rated)
    clean = [r for r in rated if r["quality"] == 1]
    assert right > 0.93 * len(rated)
    assert sum(r["good"] for r in clean) > 0.98 * len(clean)
    assert all(0 <= r[c] <= 1 for r in rated for c in ("p_text", "p_meta", "score"))


def test_without_both_labels_the_share_is_the_score(spark, odd_docs, no_docs):
    schema = "doc_id long, quality int"
    for labels, score in (([(1, 1), (1, 1), (2, 1), (None, 0), (3, None)], 1.0), ([], 0.5), ([(1, 0)], 0.0)):
        found = cotraining.classify(spark, odd_docs, spark.createDataFrame(labels, schema)).collect()
        assert len(found) == 9 and {r["score"] for r in found} == {score}
    assert cotraining.classify(spark, no_docs, spark.createDataFrame([], schema)).count() == 0


def test_odd_rows_are_scored(spark, odd_docs):
    good = [f"the {i} words of a page that is fine, as they are" for i in range(60)]
    bad = [f"### {i} $$$ %%%{i} ###" for i in range(60)]
    docs = docs_of(spark, good + bad, 100)
    labels = spark.createDataFrame([(100 + i, int(i < 60)) for i in range(0, 120, 2)], "doc_id long, quality int")
    both = docs.unionByName(odd_docs.select(docs.columns))
    found = {r["doc_id"]: r for r in cotraining.classify(spark, both, labels).collect() if r["doc_id"]}
    assert all(found[100 + i]["good"] == (i < 60) for i in range(120))
    assert {1, 2, 3, 4, 5, 6} <= set(found)


def test_views_do_not_share_columns(spark, odd_docs):
    rows = cotraining.views(odd_docs, cotraining.Settings(), "doc_id")
    assert rows.columns == ["doc_id", "text_view", "meta_view"] and rows.count() == 9


def test_every_unlabelled_row_takes_part(spark, monkeypatch):
    texts = [f"the {i} words of a page" if i % 2 else f"### {i} $$$ %%%{i}" for i in range(12_000)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    seen, stage = [], cotraining.staged
    monkeypatch.setattr(cotraining, "staged", lambda s, df, name: seen.append(stage(s, df, name)) or seen[-1])
    cotraining.fit(spark, docs, labels, cotraining.Settings(rounds=1, iterations=2))
    assert seen[1].where("label is null").count() == 11_800


def test_labels_are_passed_on_as_in_a_plain_loop(spark, monkeypatch):
    """Which rows each fit learns from, against the rule applied to all rows one by one."""
    texts = [f"the {i} words of a page" if i % 3 else f"### {i} $$$ %%%{i}" for i in range(200)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 200, 4)], "doc_id long, quality int")
    fits, fit_one = [], cotraining._fit

    def noted(rows, features, settings, plain=False):
        model = fit_one(rows, features, settings, plain)
        if features != "x":
            fits.append((features, {(r["doc_id"], r["label"]) for r in rows.collect()}, model))
        return model

    monkeypatch.setattr(cotraining, "_fit", noted)
    settings = cotraining.Settings(sure=0.8)
    _, held = cotraining.fit(spark, docs, labels, settings)
    rows = held.collect()
    given = {i: float(i % 3 > 0) for i in range(0, 200, 4)}
    assert {r["doc_id"]: r["label"] for r in rows if r["label"] is not None} == given
    quarter = {r["doc_id"] for r in held.where("pmod(xxhash64(doc_id, 3), 4) = 0").collect()}
    learned = {(i, y) for i, y in given.items() if i not in quarter}
    assert [f for f, _, _ in fits] == ["text_view", "meta_view", "meta_view", "text_view", "meta_view", "text_view"]
    assert fits[0][1] == fits[1][1] == learned
    models = {"text": fits[0][2], "meta": fits[1][2]}
    limit = np.log(0.8 / 0.2)
    for number in range(2):
        odds = {
            v: {r["doc_id"]: float(r[f"{v}_view"].dot(m.coefficients) + m.intercept) for r in rows}
            for v, m in models.items()
        }
        for at, (giver, taker) in enumerate((("text", "meta"), ("meta", "text"))):
            passed = set()
            for r in rows:
                own, other = odds[giver][r["doc_id"]], odds[taker][r["doc_id"]]
                if r["label"] is None and abs(own) >= limit and not (own * other < 0 and abs(other) >= limit):
                    passed.add((r["doc_id"], float(own > 0)))
            features, rows_used, model = fits[2 + 2 * number + at]
            assert features == f"{taker}_view" and rows_used == learned | passed
            models[taker] = model
    assert any(rows_used > learned for _, rows_used, _ in fits)


def test_no_text_is_shuffled(spark, sf_dir, monkeypatch):
    """Also with more labels than may be broadcast."""
    monkeypatch.setattr(cotraining, "staged", lambda s, df, name: plans.append(df) or df)
    plans = []
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cotraining.fit(spark, docs, labels, cotraining.Settings(rounds=0, iterations=1))
        plan = plans[1]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "text" in plan and not [x for x in plan.split("\n") if "Exchange hash" in x and "text" in x]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_clashing_names(spark, odd_docs):
    named = odd_docs.withColumnsRenamed({"row": "p_text", "n_words": "label", "print": "kept", "text_key": "good"})
    found = cotraining.classify(spark, named, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert found.columns == ["doc_id", "p_text", "p_meta", "score", "good"] and found.count() == 9
