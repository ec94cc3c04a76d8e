import datetime as dt

import pytest
from pyspark.sql import functions as F

from constituent360.operators import quality as Q


def results(df, checks):
    return {r["check_name"]: r for r in Q.validate(df, checks).collect()}


def test_standard_checks(spark):
    df = spark.createDataFrame(
        [("UC-001", "test@example.com", "sustainer", 0.5), ("UC-002", "bad", "prospect", 0.8), ("UC-003", "good@test.org", "invalid", 1.5)],
        "constituent_id string, canonical_email string, lifecycle_stage string, churn_risk_score double",
    )
    out = Q.validate(df, Q.constituent_checks())
    assert [r["passed"] for r in out.collect()] == [True, True, False, False, False]
    report = Q.report(out, "test").first()
    assert (report["checks_passed"], report["checks_failed"], report["overall_pass"]) == (2, 3, False)
    assert results(df, Q.constituent_checks())["email_format"]["failure_rate"] == 0.3333


def test_edges(spark):
    df = spark.createDataFrame([(None, 1.0, "a"), (" ", float("nan"), None), ("x", 2.0, None), ("x", None, None)], "id string, v double, w string")
    got = results(df, [
        Q.Check("present", "completeness", field="id"), Q.Check("nan", "completeness", field="v"), Q.Check("unique", "uniqueness", field="id"),
        Q.Check("null_unique", "uniqueness", field="w"), Q.Check("range", "validity", field="v", low=0), Q.Check("absent", "validity", field="q", low=0),
        Q.Check("text_range", "validity", field="w", high=3), Q.Check("tolerant", "completeness", field="id", threshold=0.5), Q.Check("vacuous", "timeliness", field="v"),
    ])
    seen = {k: (r["passed"], r["records_checked"], r["records_failed"]) for k, r in got.items()}
    assert seen == {
        "present": (False, 4, 2), "nan": (False, 4, 2), "unique": (False, 4, 2), "null_unique": (False, 4, 3), "range": (True, 2, 0),
        "absent": (False, 4, 4), "text_range": (False, 0, 0), "tolerant": (True, 4, 2), "vacuous": (True, 4, 0),
    }


def test_empty_data_passes(spark):
    df = spark.createDataFrame([], "constituent_id string, canonical_email string, lifecycle_stage string, churn_risk_score double")
    assert all(r["passed"] for r in Q.validate(df, Q.constituent_checks()).collect())


def test_timeliness_and_consistency(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8), True, None), (dt.datetime(2024, 1, 1, 9), False, None)], "ts timestamp_ntz, s boolean, start date")
    age = lambda h: Q.Check(f"h{h}", "timeliness", field="ts", as_of=dt.datetime(2024, 1, 1, 13), max_age_hours=h)
    got = results(df, [age(4), age(3), Q.Check("start", "consistency", rule="NOT s OR start IS NOT NULL")])
    assert [got[k]["passed"] for k in ("h4", "h3", "start")] == [True, False, False]


def test_quarantine(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "id string")
    assert Q.failing_rows(df, Q.Check("u", "uniqueness", field="id")).count() == 4
    assert Q.failing_rows(df, Q.Check("c", "completeness", field="id")).count() == 2


def test_pattern_is_anchored_at_start(spark):
    df = spark.createDataFrame([("abc1",), ("1abc",)], "v string")
    assert results(df, [Q.Check("p", "validity", field="v", pattern="[a-z]+")])["p"]["records_failed"] == 1


def test_constraints(spark):
    child = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "zz"), (None, "zz"), ("3", None)], "id string, parent string")
    parent = spark.createDataFrame([("a",), ("b",)], "id string")
    got = {r["constraint_name"]: r["violations"] for r in Q.check_constraints({"c": child, "p": parent}, [
        Q.Constraint("pk", "c", "primary_key", ("id",)), Q.Constraint("uq", "c", "unique", ("id",)), Q.Constraint("nn", "c", "not_null", ("id", "parent")),
        Q.Constraint("fk", "c", "foreign_key", ("parent",), parent="p", parent_columns=("id",)), Q.Constraint("ck", "c", "check", rule="parent <> 'zz'"),
    ]).collect()}
    assert got == {"pk": 3, "uq": 2, "nn": 2, "fk": 2, "ck": 2}
    with pytest.raises(ValueError):
        Q.check_constraints({"c": child}, [Q.Constraint("x", "c", "other")])


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "donation_id int, amount double")
    assert Q.required_columns(df, ["donation_id", "amount", "donation_date"]) == ["donation_date"]


def test_flags(spark):
    df = spark.createDataFrame([("a@b.org", "3125551234", "1 Oak"), ("bad", None, " ")], "e string, p string, a string")
    assert [r["data_quality_score"] for r in Q.quality_flags(df, "e", "p", "a").collect()] == [1.0, 0.0]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, "b")], "n int, s string")
    got = {r["column"]: r for r in Q.profile(df, exact_distinct=True).collect()}
    assert (got["n"]["missing"], got["n"]["distinct_values"], got["n"]["mean"]) == (1, 2, 1.5)
    assert (got["s"]["least"], got["s"]["greatest"], got["s"]["distinct_values"]) == ("a", "b", 2)
