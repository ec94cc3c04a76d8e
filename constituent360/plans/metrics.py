"""Metric catalogue queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from constituent360.operators import metrics as M
from constituent360.plans.registry import query
from constituent360.plans.sql_domain import AS_OF, EVENTS_AS_OF
from constituent360.session import cut_lineage
from constituent360.sources import tpch

ACTIVE = f"""SELECT {{label}}count(DISTINCT constituent_id) AS {{name}} FROM constituents c
WHERE EXISTS (SELECT 1 FROM donations d WHERE d.constituent_id = c.constituent_id
  AND d.donation_date >= CAST({AS_OF} - INTERVAL {{months}} MONTH AS DATE) AND d.donation_status = 'completed') {{group}}"""
SUSTAINING = f"""SELECT {{label}}count(DISTINCT constituent_id) AS sustaining_member_count FROM constituents
WHERE is_sustainer AND recurring_status = 'active' AND last_successful_payment_date >= {AS_OF} - 90 {{group}}"""
LAPSED = f"""SELECT {{label}}count(DISTINCT constituent_id) AS lapsed_member_count FROM constituents
WHERE total_lifetime_giving > 0 AND last_donation_date < CAST({AS_OF} - INTERVAL 12 MONTH AS DATE) {{group}}"""
RECENT = f"FROM donations WHERE donation_status = 'completed' AND donation_date >= CAST({AS_OF} - INTERVAL 12 MONTH AS DATE)"
REVENUE = f"SELECT {{label}}CAST(sum(donation_amount) AS DECIMAL(18,2)) AS total_revenue_t12m {RECENT} {{group}}"
AVERAGE = f"""SELECT CAST(sum(donation_amount) AS DOUBLE) / count(*) AS average_gift_amount,
  CAST(sum(donation_amount) AS DECIMAL(18,2)) AS total_revenue, count(*) AS gift_count {RECENT}"""
RETENTION = f"""WITH prior AS (SELECT DISTINCT constituent_id FROM donations WHERE donation_status = 'completed'
    AND donation_date BETWEEN CAST({AS_OF} - INTERVAL 24 MONTH AS DATE) AND CAST({AS_OF} - INTERVAL 12 MONTH AS DATE)),
  kept AS (SELECT DISTINCT d.constituent_id FROM donations d JOIN prior p ON d.constituent_id = p.constituent_id
    WHERE donation_status = 'completed' AND donation_date >= CAST({AS_OF} - INTERVAL 12 MONTH AS DATE))
SELECT CAST((SELECT count(*) FROM kept) AS DOUBLE) * 100.0 / nullif((SELECT count(*) FROM prior), 0) AS retention_rate,
  (SELECT count(*) FROM prior) AS prior_year_count, (SELECT count(*) FROM kept) AS retained_count"""
CHURN = f"""SELECT CAST(churn_count AS DOUBLE) * 100.0 / nullif(start_count, 0) AS churn_rate, churn_count, start_count
FROM (SELECT count(DISTINCT constituent_id) AS start_count FROM constituents WHERE is_sustainer AND recurring_status = 'active'),
  (SELECT count(DISTINCT constituent_id) AS churn_count FROM status_changes
   WHERE change_type IN ('cancelled', 'payment_failed_final') AND change_date >= date_trunc('month', {{day}}))"""
OPEN = f"""SELECT {{label}}CAST(sum(CASE WHEN opened THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / nullif(count(*), 0) AS open_rate,
  count(*) AS emails_sent, CAST(sum(CASE WHEN opened THEN 1 ELSE 0 END) AS BIGINT) AS emails_opened
FROM emails WHERE send_date >= {EVENTS_AS_OF} - 30 AND delivery_status = 'delivered' {{group}}"""
SUBSCRIBERS = f"""SELECT {{label}}count(DISTINCT constituent_id) AS active_subscriber_count FROM subscriptions
WHERE subscription_status = 'active' AND (end_date IS NULL OR end_date > {AS_OF}) {{group}}"""
LTV = f"""SELECT constituent_id, total_lifetime_giving,
  date_part('year', {AS_OF}) - date_part('year', first_donation_date) AS tenure_years,
  CAST(total_lifetime_giving AS DOUBLE) / nullif(date_part('year', {AS_OF}) - date_part('year', first_donation_date), 0) AS avg_annual_giving,
  lifetime_value_estimate AS estimated_ltv FROM constituents WHERE total_lifetime_giving > 0"""


def months_sql(col: str) -> str:
    return f"datediff('month', {col}, {AS_OF})"


def band_sql(c: str, edges, labels) -> str:
    whens = " ".join(f"WHEN {c} < {e} THEN '{label}'" for e, label in zip(edges, labels))
    return f"CASE {whens} ELSE '{labels[-1]}' END"


def load(spark, sf_dir, *names):
    readers = {
        "constituents": tpch.constituents, "donations": tpch.donations, "emails": tpch.email_engagement,
        "subscriptions": tpch.subscriptions, "status_changes": tpch.status_changes,
    }
    return {n: readers[n](spark, sf_dir) for n in names}


def plain(template: str, **kw) -> str:
    return template.format(label="", group="", **kw)


def cut(template: str, expr: str, **kw) -> str:
    return template.format(label=f"{expr} AS dimension_value, ", group="GROUP BY 1", **kw)


_active = {"name": "active_member_count", "months": 12}
_CASES = [
    # name, dimension, tables, as_of, sql
    ("active_member", None, ("constituents", "donations"), tpch.AS_OF, plain(ACTIVE, **_active)),
    ("active_member", "by_source", ("constituents", "donations"), tpch.AS_OF, cut(ACTIVE, "primary_source", **_active)),
    ("active_member", "by_gift_type", ("constituents", "donations"), tpch.AS_OF,
     cut(ACTIVE, "CASE WHEN is_sustainer THEN 'Recurring' ELSE 'One-time' END", **_active)),
    ("active_member", "by_acquisition_year", ("constituents", "donations"), tpch.AS_OF,
     cut(ACTIVE, "year(first_donation_date)", **_active)),
    ("active_member_with_grace", None, ("constituents", "donations"), tpch.AS_OF,
     plain(ACTIVE, name="active_member_grace_count", months=13)),
    ("active_member_fiscal", None, ("constituents", "donations"), tpch.AS_OF,
     plain(ACTIVE, name="active_member_fiscal_count", months=1)),
    ("sustaining_member", None, ("constituents",), tpch.AS_OF, plain(SUSTAINING)),
    ("sustaining_member", "by_monthly_amount", ("constituents",), tpch.AS_OF,
     cut(SUSTAINING, band_sql("recurring_monthly_amount", *M.MONTHLY_AMOUNT))),
    ("sustaining_member", "by_tenure", ("constituents",), tpch.AS_OF,
     cut(SUSTAINING, band_sql(months_sql("sustainer_start_date"), *M.TENURE))),
    ("lapsed_member", None, ("constituents",), tpch.AS_OF, plain(LAPSED)),
    ("lapsed_member", "by_lapse_duration", ("constituents",), tpch.AS_OF,
     cut(LAPSED, band_sql(months_sql("last_donation_date"), *M.LAPSE))),
    ("total_revenue_t12m", None, ("donations",), tpch.AS_OF, plain(REVENUE)),
    ("total_revenue_t12m", "by_gift_type", ("donations",), tpch.AS_OF, cut(REVENUE, "donation_type")),
    ("total_revenue_t12m", "by_campaign", ("donations",), tpch.AS_OF, cut(REVENUE, "campaign_code")),
    ("total_revenue_t12m", "by_channel", ("donations",), tpch.AS_OF, cut(REVENUE, "source_channel")),
    ("average_gift_amount", None, ("donations",), tpch.AS_OF, AVERAGE),
    ("donor_retention_rate", None, ("donations",), tpch.AS_OF, RETENTION),
    # the last month with status changes in the data
    ("sustainer_churn_rate", None, ("constituents", "status_changes"), dt.date(2001, 7, 31),
     CHURN.format(day="DATE '2001-07-31'")),
    ("email_open_rate", None, ("emails",), tpch.EVENTS_AS_OF, plain(OPEN)),
    ("email_open_rate", "by_email_type", ("emails",), tpch.EVENTS_AS_OF, cut(OPEN, "email_type")),
    ("email_open_rate", "by_audience_segment", ("emails",), tpch.EVENTS_AS_OF, cut(OPEN, "audience_segment")),
    ("active_subscriber", None, ("subscriptions",), tpch.AS_OF, plain(SUBSCRIBERS)),
    ("active_subscriber", "by_subscription_type", ("subscriptions",), tpch.AS_OF, cut(SUBSCRIBERS, "subscription_type")),
    ("lifetime_value", None, ("constituents",), tpch.AS_OF, LTV),
]


def _register(name, dimension, tables, as_of, sql):
    @query(f"metric_{name}" + (f"_{dimension}" if dimension else ""), sql, tables)
    def run(spark, sf_dir):
        return M.metric(load(spark, sf_dir, *tables), name, as_of, dimension)


# the fiscal year that began on 2001-07-01
_CASES = [
    (*c[:4], c[4].replace(f"CAST({AS_OF} - INTERVAL 1 MONTH AS DATE)", "DATE '2001-07-01'")) if c[0] == "active_member_fiscal" else c
    for c in _CASES
]
_LONG = []
for _name, _dim, _tables, _day, _sql in _CASES:
    _register(_name, _dim, _tables, _day, _sql)
    _value = M.CATALOG[_name].value
    _label = "CAST(dimension_value AS VARCHAR)" if _dim else "CAST(NULL AS VARCHAR)"
    _LONG.append(
        f"SELECT '{_name}' AS metric, CAST({_value} AS DOUBLE) AS value, DATE '{_day}' AS as_of, '1.0.0' AS version, "
        + (f"'{_dim}'" if _dim else "CAST(NULL AS VARCHAR)")
        + f" AS dimension, {_label} AS dimension_value FROM ({_sql})"
    )


@query("metric_results", " UNION ALL ".join(_LONG), ("constituents", "donations", "subscriptions", "emails", "status_changes"))
def _(spark, sf_dir):
    """All metrics with all their dimensions; the constituents are put together once for all of them."""
    t = load(spark, sf_dir, "constituents", "donations", "subscriptions", "emails", "status_changes")
    t["constituents"] = cut_lineage(t["constituents"])
    out = None
    for as_of in sorted({c[3] for c in _CASES}):
        part = M.compute_metrics(t, list(dict.fromkeys(c[0] for c in _CASES if c[3] == as_of)), as_of)
        out = part if out is None else out.unionByName(part)
    return out


def monthly_values(spark, sf_dir):
    """Monthly gift revenue and monthly givers as metric results, one row per metric and month."""
    gifts = M.completed(tpch.donations(spark, sf_dir)).groupBy(F.trunc("donation_date", "month").alias("as_of")).agg(
        F.sum("donation_amount").cast("double").alias("total_revenue_t12m"),
        F.countDistinct("constituent_id").cast("double").alias("active_member"),
        F.countDistinct(F.when(F.col("donation_type") == "recurring", F.col("constituent_id"))).cast("double").alias("sustaining_member"),
    )
    return gifts.unpivot("as_of", ["total_revenue_t12m", "active_member", "sustaining_member"], "metric", "value")


MONTHLY = """results AS (UNPIVOT (SELECT CAST(date_trunc('month', donation_date) AS DATE) AS as_of,
    CAST(sum(donation_amount) AS DOUBLE) AS total_revenue_t12m, CAST(count(DISTINCT constituent_id) AS DOUBLE) AS active_member,
    CAST(count(DISTINCT CASE WHEN donation_type = 'recurring' THEN constituent_id END) AS DOUBLE) AS sustaining_member
  FROM donations WHERE donation_status = 'completed' GROUP BY 1)
  ON total_revenue_t12m, active_member, sustaining_member INTO NAME metric VALUE value),
lagged AS (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY as_of) AS previous_value FROM results)"""


@query("metric_anomalies", f"""WITH {MONTHLY}
SELECT metric, as_of, value, previous_value, abs(value - previous_value) / nullif(previous_value, 0) AS change FROM lagged
WHERE abs(value - previous_value) / nullif(previous_value, 0) > 0.05""", ("donations",))
def _(spark, sf_dir):
    return M.metric_anomalies(monthly_values(spark, sf_dir))


@query("metric_rule_checks", f"""WITH {MONTHLY}, rules AS (
  SELECT metric, as_of, value, previous_value, unnest(CASE metric
    WHEN 'active_member' THEN [{{'r': 'positive_count', 's': 'error', 'p': value >= 0}},
      {{'r': 'reasonable_range', 's': 'warning', 'p': value BETWEEN 50000 AND 150000}},
      {{'r': 'day_over_day_change', 's': 'warning', 'p': abs(value - previous_value) / nullif(previous_value, 0) < 0.05}}]
    WHEN 'total_revenue_t12m' THEN [{{'r': 'revenue_positive', 's': 'error', 'p': value >= 0}},
      {{'r': 'month_over_month_variance', 's': 'warning', 'p': abs(value - previous_value) / nullif(previous_value, 0) < 0.20}}]
    ELSE [] END) AS c FROM lagged)
SELECT metric, as_of, value, previous_value, c.r AS rule, c.s AS severity, coalesce(c.p, true) AS passed FROM rules""", ("donations",))
def _(spark, sf_dir):
    return M.check_metrics(monthly_values(spark, sf_dir))


@query("metric_subset_check", f"""WITH {MONTHLY}
SELECT as_of, max(value) FILTER (metric = 'sustaining_member') AS part_value, max(value) FILTER (metric = 'active_member') AS whole_value,
  max(value) FILTER (metric = 'sustaining_member') <= max(value) FILTER (metric = 'active_member') AS passed FROM results GROUP BY 1""", ("donations",))
def _(spark, sf_dir):
    return M.check_subset(monthly_values(spark, sf_dir))


@query("active_member_summary", f"""SELECT constituent_id, count(*) AS gift_count, CAST(sum(donation_amount) AS DECIMAL(18,2)) AS total
FROM donations WHERE donation_date >= CAST({AS_OF} - INTERVAL 12 MONTH AS DATE) GROUP BY 1""", ("donations",))
def _(spark, sf_dir):
    return M.active_member_summary(tpch.donations(spark, sf_dir), tpch.AS_OF)


@query("giving_summary", """SELECT constituent_id, CAST(sum(donation_amount) AS DECIMAL(18,2)) AS total_lifetime_giving,
  count(*) AS total_gift_count, max(donation_amount) AS largest_single_gift,
  CAST(sum(donation_amount) AS DOUBLE) / count(*) AS average_gift_amount,
  min(donation_date) AS first_donation_date, max(donation_date) AS last_donation_date
FROM donations WHERE donation_status = 'completed' GROUP BY 1""", ("donations",))
def _(spark, sf_dir):
    return M.giving_summary(tpch.donations(spark, sf_dir))


@query("acquisition_cost", """SELECT acquisition_channel, spend, new_donors, CAST(spend AS DOUBLE) / nullif(new_donors, 0) AS acquisition_cost
FROM (SELECT acquisition_channel, CAST(sum(lifetime_value_estimate) AS DECIMAL(18,2)) AS spend FROM constituents GROUP BY 1) s
LEFT JOIN (SELECT acquisition_channel, count(*) AS new_donors FROM constituents WHERE first_donation_date >= DATE '2001-01-01' GROUP BY 1) n
USING (acquisition_channel)""", ("constituents",))
def _(spark, sf_dir):
    c = tpch.constituents(spark, sf_dir)
    new = c.where(F.col("first_donation_date") >= dt.date(2001, 1, 1))
    spend = c.select("acquisition_channel", F.col("lifetime_value_estimate").alias("spend"))
    return M.acquisition_cost(new, spend, "acquisition_channel").withColumn("spend", F.col("spend").cast("decimal(18,2)"))


@query("email_engagement_score", f"""SELECT constituent_id, count(*) FILTER (opened) * CAST(1 AS DOUBLE) + count(*) FILTER (clicked) * CAST(2 AS DOUBLE) AS email_engagement_score
FROM emails WHERE send_date >= {EVENTS_AS_OF} - 30 GROUP BY 1""", ("emails",))
def _(spark, sf_dir):
    return M.email_engagement_score(tpch.email_engagement(spark, sf_dir), tpch.EVENTS_AS_OF)
