"""Data-quality queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from constituent360.functions.text import norm_phone
from constituent360.operators import quality as Q
from constituent360.plans.golden import GOLDEN_TABLES, _GOLDEN, golden
from constituent360.plans.registry import query
from constituent360.session import scratch
from constituent360.sources import tpch
from constituent360.sources import writers as OUT

EMAIL_RE = Q.PATTERNS["email"]


def _row(pos, name, severity, checked, failed, threshold=0):
    return f"""SELECT {pos} AS position, '{name}' AS check_name, CASE WHEN c = 0 THEN true ELSE f / CAST(c AS DOUBLE) <= {threshold} END AS passed, '{severity}' AS severity,
  c AS records_checked, f AS records_failed, CASE WHEN c = 0 THEN 0 ELSE round(f / CAST(c AS DOUBLE), 4) END AS failure_rate, CAST(NULL AS VARCHAR) AS details
FROM (SELECT {checked} AS c, {failed} AS f FROM golden)"""


CHECKS_SQL = " UNION ALL ".join([
    _row(0, "constituent_id_not_null", "error", "count(*)", "count(*) FILTER (constituent_id IS NULL OR trim(constituent_id) = '')"),
    _row(1, "constituent_id_unique", "error", "count(*)", "count(*) - count(DISTINCT constituent_id)"),
    _row(2, "email_format", "warning", "count(canonical_email)", f"count(*) FILTER (NOT regexp_matches(canonical_email, '{EMAIL_RE}'))", 0.05),
    _row(3, "lifecycle_valid", "error", "count(lifecycle_stage)",
         "count(*) FILTER (lifecycle_stage NOT IN ('prospect', 'one_time_donor', 'sustainer', 'major_donor', 'lapsed'))"),
    _row(4, "churn_score_range", "warning", "count(churn_risk_score)", "count(*) FILTER (churn_risk_score < 0 OR churn_risk_score > 1)"),
])


@query("quality_standard_checks", f"WITH {_GOLDEN} {CHECKS_SQL}", GOLDEN_TABLES)
def _(spark, sf_dir):
    return Q.validate(golden(spark, sf_dir), Q.constituent_checks())


@query("quality_report", f"""WITH {_GOLDEN}, r AS ({CHECKS_SQL}) SELECT 'constituents' AS dataset_name, count(*) AS checks_run, count(*) FILTER (passed) AS checks_passed,
  count(*) FILTER (NOT passed) AS checks_failed, count(*) FILTER (NOT passed AND severity = 'error') = 0 AS overall_pass FROM r""", GOLDEN_TABLES)
def _(spark, sf_dir):
    return Q.report(Q.validate(golden(spark, sf_dir), Q.constituent_checks()), "constituents")


ALL_KINDS = [
    Q.Check("props_present", "completeness", "error", "props"),
    Q.Check("text_not_here", "completeness", "error", "text"),
    Q.Check("user_unique", "uniqueness", "warning", "user_id"),
    Q.Check("props_json", "validity", "error", "props", pattern=r"^\{.*\}$"),
    Q.Check("known_type", "validity", "error", "event_type", allowed=("view", "click", "purchase")),
    Q.Check("value_range", "validity", "warning", "value", low=0, high=100, threshold=0.5),
    Q.Check("type_range", "validity", "warning", "event_type", low=0, high=1),
    Q.Check("errors_small", "consistency", "warning", rule="event_type <> 'error' OR value < 50"),
    Q.Check("no_rule", "consistency", "info"),
    Q.Check("fresh", "timeliness", "error", "ts", as_of=dt.datetime(2024, 1, 31, 3, 0), max_age_hours=4),
]
_A = lambda pos, name, sev, c, f, th=0: _row(pos, name, sev, c, f, th).replace("FROM golden", "FROM events")


@query("quality_all_check_kinds", " UNION ALL ".join([
    _A(0, "props_present", "error", "count(*)", "count(*) FILTER (props IS NULL OR trim(props) = '')"),
    "SELECT 1, 'text_not_here', false, 'error', count(*), count(*), 1, 'Field ''text'' not found' FROM events",
    _A(2, "user_unique", "warning", "count(*)", "(SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM events GROUP BY user_id) WHERE n > 1)").replace(
        "SELECT count(*) AS c", "SELECT count(*) AS c"),
    _A(3, "props_json", "error", "count(props)", "count(*) FILTER (NOT regexp_matches(props, '^\\{.*\\}$'))"),
    _A(4, "known_type", "error", "count(event_type)", "count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase'))"),
    _A(5, "value_range", "warning", "count(value)", "count(*) FILTER (value < 0 OR value > 100)", 0.5),
    "SELECT 6, 'type_range', false, 'warning', 0, 0, 0, 'Field ''event_type'' is not numeric'",
    _A(7, "errors_small", "warning", "count(*)", "count(*) FILTER (NOT (event_type <> 'error' OR value < 50))"),
    _A(8, "no_rule", "info", "count(*)", "0"),
    _A(9, "fresh", "error", "count(*)", "CASE WHEN datediff('second', max(ts), TIMESTAMP '2024-01-31 03:00:00') > 14400 THEN count(*) ELSE 0 END"),
]))
def _(spark, sf_dir):
    return Q.validate(tpch.table(spark, sf_dir, "events"), ALL_KINDS)


@query("quality_failing_rows", f"""WITH {_GOLDEN} SELECT constituent_id, canonical_email FROM golden WHERE canonical_email IS NOT NULL AND NOT regexp_matches(canonical_email, '{EMAIL_RE}')""", GOLDEN_TABLES)
def _(spark, sf_dir):
    bad = Q.failing_rows(golden(spark, sf_dir), Q.constituent_checks()[2])
    return bad.select("constituent_id", "canonical_email")


@query("quality_duplicate_rows", """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def _(spark, sf_dir):
    orders = tpch.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return Q.failing_rows(orders, Q.Check("one_order", "uniqueness", field="o_custkey"))


@query("quality_duplicate_keys", """SELECT CAST(sum(n) AS BIGINT) AS records_checked, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS records_failed, count(*) AS distinct_keys, max(n) AS largest_group
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def _(spark, sf_dir):
    return Q.duplicate_keys(tpch.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_P = lambda c, num: f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS missing, count(DISTINCT {c}) AS distinct_values,
  """ + (f"min({c}) AS least, max({c}) AS greatest, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev" if not num else
         f"CAST(CAST(min({c}) AS DOUBLE) AS VARCHAR) AS least, CAST(CAST(max({c}) AS DOUBLE) AS VARCHAR) AS greatest, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev") + " FROM customer"


@query("quality_profile", " UNION ALL ".join([_P("c_custkey", True), _P("c_nationkey", True), _P("c_name", False), _P("c_acctbal", True), _P("c_mktsegment", False)]))
def _(spark, sf_dir):
    columns = ["c_custkey", "c_nationkey", "c_name", "c_acctbal", "c_mktsegment"]
    p = Q.profile(tpch.table(spark, sf_dir, "customer"), columns, exact_distinct=True)
    return p.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


_M = lambda c, num: f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS missing, true AS distinct_close, true AS median_close,
  """ + (f"min({c}) AS least, max({c}) AS greatest, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev" if not num else
         f"CAST(CAST(min({c}) AS DOUBLE) AS VARCHAR) AS least, CAST(CAST(max({c}) AS DOUBLE) AS VARCHAR) AS greatest, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev") + " FROM lineitem"


@query("quality_merged_profile", " UNION ALL ".join([_M("l_quantity", True), _M("l_partkey", True), _M("l_linestatus", False)]))
def _(spark, sf_dir):
    """Profiles of months, stored as they come in and merged without the rows; held against exact counts and ranks."""
    columns = ["l_quantity", "l_partkey", "l_linestatus"]
    lines = tpch.table(spark, sf_dir, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    path, cut = scratch(spark, "profiles"), "2001-01"
    for new in (lines.where(F.col("month") < cut), lines.where(F.col("month") >= cut)):
        OUT.replace_partitions(Q.profile_parts(new, ["month"], columns), path, ["month"])
    found = Q.merged_profile(spark.read.parquet(path), ranks=[0.5])
    exact = lines.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"), F.expr(f"try_cast({c} AS double)").alias("x")) for c in columns])))
    exact = exact.groupBy("column", "v", "x").agg(F.count("*").alias("n"))
    held = exact.join(found.select("column", "q0"), "column").groupBy("column").agg(
        F.count("v").alias("_d"), (F.sum(F.when(F.col("x") < F.col("q0"), F.col("n"))) / F.sum("n")).alias("_low"),
        (F.sum(F.when(F.col("x") <= F.col("q0"), F.col("n"))) / F.sum("n")).alias("_high"),
    )
    return found.join(held, "column").select(
        "column", "rows", "missing", (F.abs(F.col("distinct_values") / F.col("_d") - 1) < 0.03).alias("distinct_close"),
        (F.col("q0").isNull() | ((F.coalesce("_low", F.lit(0)) <= 0.52) & (F.col("_high") >= 0.48))).alias("median_close"),
        "least", "greatest", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
    )


CONSTRAINTS = [
    Q.Constraint("pk_constituents", "constituents", "primary_key", ("constituent_id",)),
    Q.Constraint("uq_lines", "lines", "unique", ("l_orderkey", "l_linenumber")),
    Q.Constraint("nn_email", "constituents", "not_null", ("canonical_email",)),
    Q.Constraint("chk_churn_score", "constituents", "check", rule="churn_risk_score IS NULL OR (churn_risk_score >= 0 AND churn_risk_score <= 0.9)"),
    Q.Constraint("fk_gift_constituent", "donations", "foreign_key", ("constituent_id",), parent="constituents", parent_columns=("constituent_id",)),
    Q.Constraint("fk_event_giver", "events", "foreign_key", ("constituent_id",), parent="givers", parent_columns=("constituent_id",)),
]


@query("quality_constraints", """WITH v AS (SELECT 'pk_constituents' AS constraint_name, 'constituents' AS "table", 'primary_key' AS kind, count(*) - count(DISTINCT constituent_id) AS violations FROM constituents
UNION ALL SELECT 'uq_lines', 'lines', 'unique', CAST(sum(n) FILTER (n > 1) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'nn_email', 'constituents', 'not_null', count(*) FROM constituents WHERE canonical_email IS NULL
UNION ALL SELECT 'chk_churn_score', 'constituents', 'check', count(*) FROM constituents WHERE churn_risk_score > 0.9
UNION ALL SELECT 'fk_gift_constituent', 'donations', 'foreign_key', count(*) FROM donations WHERE constituent_id NOT IN (SELECT constituent_id FROM constituents)
UNION ALL SELECT 'fk_event_giver', 'events', 'foreign_key', count(*) FROM engagement WHERE constituent_id NOT IN (SELECT constituent_id FROM constituents WHERE total_gift_count > 3))
SELECT *, violations = 0 AS passed FROM v""", ("constituents", "donations", "engagement"))
def _(spark, sf_dir):
    c = tpch.constituents(spark, sf_dir)
    return Q.check_constraints({
        "constituents": c, "lines": tpch.table(spark, sf_dir, "lineitem"), "donations": tpch.donations(spark, sf_dir),
        "events": tpch.engagement_events(spark, sf_dir), "givers": c.where("total_gift_count > 3"),
    }, CONSTRAINTS)


@query("quality_flags", f"""SELECT record_key, has_valid_email, has_valid_phone, has_valid_address,
  round((has_valid_email::INT + has_valid_phone::INT + has_valid_address::INT) / CAST(3 AS DOUBLE), 2) AS data_quality_score
FROM (SELECT record_key, coalesce(regexp_matches(email, '{EMAIL_RE}'), false) AS has_valid_email, coalesce(regexp_matches(phone, '^\\d{{10,11}}$'), false) AS has_valid_phone,
  coalesce(trim(address_line1) <> '', false) AS has_valid_address FROM records)""", ("records",))
def _(spark, sf_dir):
    from constituent360.operators.matching import prepare

    r = prepare(tpch.source_records(spark, sf_dir))
    return Q.quality_flags(r, "email", "phone", "address_line1").select(
        "record_key", "has_valid_email", "has_valid_phone", "has_valid_address", "data_quality_score"
    )


@query("quality_agreement", """WITH a AS (SELECT source_id[2:] AS k, * FROM source_records WHERE source_system = 'donations'), b AS (SELECT source_id[2:] AS k, * FROM source_records WHERE source_system = 'subscriptions'),
j AS (SELECT a.city IS NOT DISTINCT FROM b.city AS c, a.first_name IS NOT DISTINCT FROM b.first_name AS f, a.zip_code IS NOT DISTINCT FROM b.zip_code AS z FROM a JOIN b USING (k))
SELECT 'city' AS "column", count(*) AS compared, count(*) FILTER (c) AS agreeing, count(*) FILTER (c) * 100.0 / count(*) AS match_rate FROM j
UNION ALL SELECT 'first_name', count(*), count(*) FILTER (f), count(*) FILTER (f) * 100.0 / count(*) FROM j
UNION ALL SELECT 'zip_code', count(*), count(*) FILTER (z), count(*) FILTER (z) * 100.0 / count(*) FROM j""", ("source_records",))
def _(spark, sf_dir):
    r = tpch.source_records(spark, sf_dir).withColumn("k", F.expr("substring(source_id, 2)"))
    side = lambda system: r.where(F.col("source_system") == system)
    return Q.agreement(side("donations"), side("subscriptions"), ["k"], ["city", "first_name", "zip_code"])


@query("quality_health_score", f"""WITH {_GOLDEN}, r AS ({CHECKS_SQL}), k AS (SELECT CASE check_name WHEN 'constituent_id_not_null' THEN 'completeness' WHEN 'constituent_id_unique' THEN 'uniqueness' ELSE 'validity' END AS dimension,
  CASE WHEN records_checked > 0 THEN 1 - records_failed / CAST(records_checked AS DOUBLE) ELSE 1 END AS p FROM r),
s AS (SELECT dimension, avg(p) * 100 AS score FROM k GROUP BY 1)
SELECT dimension, score, target, score >= target AS met FROM (SELECT *, CAST(CASE dimension WHEN 'completeness' THEN 95 WHEN 'uniqueness' THEN 99.9 ELSE 99 END AS DOUBLE) AS target FROM s)
UNION ALL SELECT 'overall', avg(score), NULL, NULL FROM s""", GOLDEN_TABLES)
def _(spark, sf_dir):
    checks = Q.constituent_checks()
    return Q.health_score(Q.dimension_scores(Q.validate(golden(spark, sf_dir), checks), checks))
