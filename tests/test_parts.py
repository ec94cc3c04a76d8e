"""Profiles from stored parts, variant attributes, audited writes and validation in time."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from constituent360.functions.text import with_attributes
from constituent360.operators import models as L
from constituent360.operators import quality as Q
from constituent360.sources.writers import write_audited

START = dt.datetime(2024, 1, 1)


def test_merged_profile_equals_the_whole(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None]), r.choice([None, 1e8 + r.random()]), r.choice([None, "", "x", "y"])) for _ in range(600)] + [("c", None, None)]
    df = spark.createDataFrame(rows, "part string, v double, s string")
    got = {x["column"]: x for x in Q.merged_profile(Q.profile_parts(df, ["part"], ["v", "s"]), ranks=[0.0, 0.5, 1.0]).collect()}
    values = sorted(v for _, v, _ in rows if v is not None)
    v, s = got["v"], got["s"]
    assert (v["rows"], v["missing"]) == (601, 601 - len(values))
    assert v["mean"] == pytest.approx(statistics.mean(values), abs=1e-6) and v["stddev"] == pytest.approx(statistics.stdev(values), rel=1e-6)
    assert (float(v["least"]), float(v["greatest"]), v["q0"], v["q2"]) == (values[0], values[-1], values[0], values[-1])
    assert abs(sum(x < v["q1"] for x in values) / len(values) - 0.5) < 0.03 and abs(v["distinct_values"] / len(values) - 1) < 0.03
    # an empty text is a value
    assert (s["missing"], s["distinct_values"]) == (sum(x is None for *_, x in rows), 3)
    assert (s["least"], s["greatest"], s["mean"], s["stddev"], s["q1"]) == ("", "y", None, None, None)
    by_part = Q.merged_profile(Q.profile_parts(df, ["part"], ["v"]), ["part"])
    assert {x["part"]: x["rows"] for x in by_part.collect()} == {p: sum(q == p for q, *_ in rows) for p in ("a", "b", "c", None)}


def test_numbers_keep_their_order_across_parts(spark):
    df = spark.createDataFrame([("a", 9), ("b", 10), ("b", 100)], "part string, v int")
    x = Q.merged_profile(Q.profile_parts(df, ["part"], ["v"])).first()
    assert (x["least"], x["greatest"]) == ("9.0", "100.0")
    assert Q.merged_profile(Q.profile_parts(df.limit(0), ["part"], ["v"])).count() == 0


def test_attributes_of_any_shape(spark):
    texts = ['{"k": 3, "in": {"list": [1, {"deep": "x"}]}}', '{"k": "three"}', '{"k": null}', "[1]", '{"k": 3', "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = with_attributes(df, "t", {"k": ("$.k", "int"), "deep": ("$.in.list[1].deep", "string")}).orderBy("i").collect()
    assert [x["well_formed"] for x in out] == [True, True, True, True, False, out[5]["well_formed"], None]
    assert [x["k"] for x in out] == [3, None, None, None, None, None, None] and [x["deep"] for x in out] == ["x"] + [None] * 6


def test_audited_write(spark, tmp_path):
    clock = lambda: iter([START, START + dt.timedelta(seconds=5)]).__next__
    seven = lambda session: session.range(7)
    fine = write_audited(spark, seven, f"{tmp_path}/a", "parquet", "s", "t", clock(), least=7).first()
    assert (fine["success"], fine["records_extracted"], fine["duration_seconds"], fine["error_message"], fine["extracted_at"]) == (True, 7, 5.0, None, START)
    assert spark.read.parquet(f"{tmp_path}/a").count() == 7
    few = write_audited(spark, seven, f"{tmp_path}/b", "json", "s", "t", clock(), least=8).first()
    assert (few["success"], few["records_extracted"]) == (False, 7) and "8" in few["error_message"]
    gone = F.when(F.col("id") == 6, F.raise_error("gone")).otherwise(F.lit("x")).alias("v")
    for number, extract in enumerate([lambda session: session.range(9).select(gone), lambda session: session.read.parquet(f"{tmp_path}/nothing")]):
        lost = write_audited(spark, extract, f"{tmp_path}/lost{number}", "parquet", "s", "t", clock()).first()
        assert (lost["success"], lost["records_extracted"]) == (False, 0) and lost["error_message"]


def test_folds_in_time(spark):
    r = random.Random(2)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=r.randrange(900)) for _ in range(500)]
    rows = [(d, r.random(), r.randrange(2)) for d in days] + [(None, 0.5, 1), (days[0], 0.5, None)]
    df = spark.createDataFrame(rows, "d date, x double, y int")
    for f in L.time_folds(df, "d", 4, 30):
        assert f.after - f.train_to == dt.timedelta(days=30) and f.after < f.test_to
    model = LogisticRegression(featuresCol="_features", labelCol="_y", probabilityCol="_probability", rawPredictionCol="_margin", predictionCol="_prediction")
    out = L.cross_validate_in_time(df, ["x"], "y", "d", model, 4, 30).orderBy("fold").collect()
    assert [x["fold"] for x in out] == [1, 2, 3, 4] and all(0 <= x["auc"] <= 1 for x in out)
    for before, x in zip([None, *out], out):
        assert (x["test_from"] - x["train_to"]).days > 30 and (before is None or before["test_to"] < x["test_from"])
        assert x["train_rows"] == sum(d <= x["train_to"] for d in days)
    # every day after the first origin is tested once, and a gap longer than the past leaves nothing to train on
    assert sum(x["test_rows"] for x in out) == sum(d >= out[0]["test_from"] for d in days)
    assert [x["auc"] for x in L.cross_validate_in_time(df, ["x"], "y", "d", model, 2, 9999).collect()] == [None, None]
    assert L.time_folds(df.limit(0), "d") == [] and L.cross_validate_in_time(df.limit(0), ["x"], "y", "d").count() == 0
