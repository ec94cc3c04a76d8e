import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from constituent360.operators import evaluation as E
from constituent360.operators import features as X
from constituent360.operators import models as L
from constituent360.operators import recommend as R

AS_OF = dt.date(2024, 8, 1)


def test_churn_feature_defaults(spark):
    df = spark.createDataFrame([("a", None, 0.4), ("b", AS_OF - dt.timedelta(days=73), None)], "constituent_id string, last_engagement_date date, email_open_rate_30d double")
    rows = {r["constituent_id"]: r for r in X.churn_features(df, AS_OF).collect()}
    assert (rows["a"]["days_since_last_engagement"], rows["a"]["days_since_last_donation"], rows["a"]["engagement_score"]) == (999.0, 999.0, 20.0)
    assert rows["b"]["engagement_score"] == pytest.approx(40.0) and rows["b"]["tenure_months"] == 0.0


def test_upgrade_feature_defaults(spark):
    absent = X.upgrade_features(spark.createDataFrame([("a",)], "constituent_id string"), AS_OF).first()
    assert (absent["tenure_months"], absent["days_since_gift"], absent["avg_gift"], absent["email_open_rate"]) == (12.0, 30.0, 50.0, 0.3)
    null = X.upgrade_features(spark.createDataFrame([("a", None)], "constituent_id string, last_donation_date date"), AS_OF).first()
    assert null["days_since_gift"] == 60.0


def test_tiers(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.29, 0.3, 0.6, 0.8, 0.85)], "s double")
    assert [r[0] for r in df.select(R.churn_tier(F.col("s"))).collect()] == ["low", "low", "medium", "high", "high", "critical"]
    assert [r[0] for r in df.select(R.dashboard_tier(F.col("s"))).collect()] == [None, "Low", "Low", "Medium", "High", "Critical"]


def test_recommendation_matrix(spark):
    up = spark.createDataFrame([("a", 0.5, "x"), ("b", 0.5, "x"), ("c", 0.4, "x"), ("d", 0.4, "x"), ("e", 0.9, "x")], "constituent_id string, upgrade_propensity double, best_path string")
    churn = spark.createDataFrame([("a", 0.4), ("b", 0.5), ("c", 0.1), ("d", 0.9)], "constituent_id string, churn_score double")
    got = {r["constituent_id"]: (r["action"], r["priority"]) for r in R.recommendations(up, churn).collect()}
    assert got == {"a": ("prime_target", 30.0), "b": ("careful_ask", 25.0), "c": ("nurture", 35.0), "d": ("save_first", 0.0), "e": ("prime_target", 75.0)}
    assert R.recommendations(up).first()["constituent_id"] == "e"


def test_best_path_tie(spark):
    df = spark.createDataFrame([(0.5, 0.5), (0.1, 0.2)], "x_score double, y_score double")
    assert [r["best_path"] for r in R.best_path(df, ["x", "y"]).collect()] == ["x", "y"]


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(4)
    rows = [(i, round(rng.random(), 2)) for i in range(1500)]
    pdf = pd.DataFrame(rows, columns=["i", "s"])
    pdf["y"] = [int(rng.random() < s) for s in pdf.s]
    return pdf, spark.createDataFrame(pdf)


def test_auc_and_lift(scored):
    pdf, df = scored
    pos, neg = pdf[pdf.y == 1].s.to_numpy(), pdf[pdf.y == 0].s.to_numpy()
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert E.auc(df, "s", "y").first()["auc_roc"] == pytest.approx(want)
    top = pdf.sort_values("s", ascending=False)
    above = top[top.s > top.s.iloc[149]]
    tied = top[top.s == top.s.iloc[149]]
    hits = above.y.sum() + tied.y.mean() * (150 - len(above))
    assert E.lift_at_k(df, "s", "y", 0.1).first()["lift"] == pytest.approx(hits / 150 / pdf.y.mean())


def test_deciles_equal_qcut(scored):
    pdf, df = scored
    want = pdf.groupby(pd.qcut(pdf.s, 10, labels=False, duplicates="drop") + 1).size().to_dict()
    assert {r["decile"]: r["count"] for r in E.decile_analysis(df, "s", "y").collect()} == want


def test_psi(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, 500), rng.normal(0.5, 1, 400)
    base, edges = np.histogram(a, bins=10)
    cur, _ = np.histogram(b, bins=edges)
    p, q = base / 500 + 1e-6, cur / 400 + 1e-6
    want = float(np.sum((q - p) * np.log(q / p)))
    frame = lambda v: spark.createDataFrame(pd.DataFrame({"x": v}))
    assert E.psi(frame(a), frame(b), "x").first()["psi"] == pytest.approx(want)


def test_stratified_split(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    train, valid = L.split(df, "id", 0.8, "y")
    assert train.where("y = 1").count() == 80 and valid.where("y = 1").count() == 20
    assert train.count() + valid.count() == 1000 and train.join(valid, "id").count() == 0


def test_split_keeps_null_classes(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 5 > 0, (F.col("id") % 5 == 1).cast("int")).alias("y"))
    train, valid = L.split(df, "id", 0.8, "y")
    assert train.count() + valid.count() == 1000 and train.where("y is null").count() == 160
    assert train.columns == valid.columns == ["id", "y"]
    empty = L.split(df.limit(0), "id", 0.8)
    assert empty[0].isEmpty() and empty[1].isEmpty()


def test_third_failure_across_years(spark):
    rows = [("a", dt.date(2023, 12, d), i, f) for i, (d, f) in enumerate([(1, True), (15, True)])] + [("a", dt.date(2024, 1, 1), 9, True), ("b", dt.date(2024, 1, 1), 1, True), ("b", dt.date(2024, 1, 1), 2, False)]
    df = spark.createDataFrame(rows, "constituent_id string, payment_date date, payment_id int, failed boolean")
    assert [tuple(r) for r in L.third_failures(df).collect()] == [("a", dt.date(2024, 1, 1))]


def test_train_save_predict(spark, tmp_path):
    rng = random.Random(6)
    rows = [(f"c{i}", AS_OF - dt.timedelta(days=rng.randint(0, 400)), rng.random(), rng.randint(0, 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "constituent_id string, last_engagement_date date, email_open_rate_30d double, consecutive_failed_payments int").withColumn(
        "churned", (F.col("consecutive_failed_payments") >= 2).cast("int")
    )
    params = L.TreeParams(trees=3, depth=2)
    model, metrics = L.train_churn(df, "churned", AS_OF, params)
    values = {r["measure"]: r["value"] for r in metrics.collect()}
    assert set(values) == {"auc", "precision", "recall", "f1"} and values["auc"] > 0.9
    assert L.feature_importance(model, X.CHURN_FEATURES).first()["feature"] == "consecutive_failed_payments"
    L.save_model(model, str(tmp_path / "m"))
    out = L.predict_churn(L.load_model(str(tmp_path / "m")), df, AS_OF)
    assert out.columns == ["constituent_id", "churn_score", "churn_tier", "prediction_date"] and out.count() == 200
    assert out.where("churn_score < 0 or churn_score > 1").count() == 0


def test_comparison_has_full_models(spark, sf, monkeypatch):
    """The query compares the models with the operators' default settings."""
    from constituent360.plans import models as M
    from constituent360.plans import registry

    monkeypatch.setattr(M, "model_features", lambda *_: None)
    monkeypatch.setattr(M.L, "compare_models", lambda rows, features, label, key, models, *_, **__: models)
    models = registry.RUN["model_comparison"](spark, sf)
    forest, boosted = models["random_forest"], models["gradient_boosting"]
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (100, 6)
    assert (boosted.getMaxIter(), boosted.getMaxDepth()) == (100, 6)
    assert models["logistic_regression"].getMaxIter() == 100


def test_training_rows_are_dealt_over_the_cores_and_models_are_fitted_at_a_time(spark):
    rows = spark.range(160000).select(F.col("id").cast("string").alias("constituent_id")).coalesce(1)
    parts = L.dealt(rows, "constituent_id").rdd.glom().map(len).collect()
    assert len(parts) == min(spark.sparkContext.defaultParallelism, 8) and sum(parts) == 160000 and max(parts) < 2 * 160000 / len(parts)
    few = L.dealt(rows.limit(5), "constituent_id")
    assert few.rdd.getNumPartitions() == 1 and few.count() == 5
    assert L.dealt(rows.limit(0), "constituent_id").count() == 0

    import threading

    both = threading.Barrier(2, timeout=60)  # neither ends before the other has begun
    assert L.concurrently([lambda: (both.wait(), "a")[1], lambda: (both.wait(), "b")[1]]) == ["a", "b"]
