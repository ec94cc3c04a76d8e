"""Golden layer, features and calendar queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from constituent360.functions import text as T
from constituent360.operators import features as X
from constituent360.operators import golden as G
from constituent360.operators import metrics as M
from constituent360.operators import recommend as R
from constituent360.operators.totals import quantiles
from constituent360.plans.registry import query
from constituent360.plans.sql_domain import AS_OF, EVENTS_AS_OF, listed
from constituent360.sources import tpch

CUT12 = f"CAST({AS_OF} - INTERVAL 12 MONTH AS DATE)"
CUT24 = f"CAST({AS_OF} - INTERVAL 24 MONTH AS DATE)"


def boundaries(c: str, end: str = AS_OF) -> str:
    return f"datediff('month', {c}, {end})"


@query("v_active_members", f"""SELECT constituent_id, canonical_email, last_donation_date, total_lifetime_giving,
  datediff('day', last_donation_date, {AS_OF}) AS days_since_last_gift FROM constituents WHERE last_donation_date >= {CUT12}""", ("constituents",))
def _(spark, sf_dir):
    return G.v_active_members(tpch.constituents(spark, sf_dir), tpch.AS_OF).select(
        "constituent_id", "canonical_email", "last_donation_date", "total_lifetime_giving", "days_since_last_gift"
    )


_SUSTAINERS = """SELECT constituent_id, canonical_email, canonical_first_name, canonical_last_name, recurring_monthly_amount,
  sustainer_start_date, last_successful_payment_date, consecutive_failed_payments, churn_risk_score, {tenure} AS sustainer_months
FROM constituents WHERE is_sustainer AND recurring_status = 'active'"""
_FULL_MONTHS = f"""CASE WHEN day(sustainer_start_date) = day({AS_OF}) OR (last_day(sustainer_start_date) = sustainer_start_date AND last_day({AS_OF}) = {AS_OF})
  THEN CAST({boundaries('sustainer_start_date')} AS DOUBLE)
  ELSE round({boundaries('sustainer_start_date')} + CAST(day({AS_OF}) - day(sustainer_start_date) AS DOUBLE) / 31, 8) END"""


@query("v_sustainers", _SUSTAINERS.format(tenure=_FULL_MONTHS), ("constituents",))
def _(spark, sf_dir):
    return G.v_sustainers(tpch.constituents(spark, sf_dir), tpch.AS_OF)


@query("v_sustainers_days_30", _SUSTAINERS.format(tenure=f"CAST(floor(datediff('day', sustainer_start_date, {AS_OF}) / 30) AS BIGINT)"), ("constituents",))
def _(spark, sf_dir):
    return G.v_sustainers(tpch.constituents(spark, sf_dir), tpch.AS_OF, "days_30")


@query("v_sustainers_boundaries", _SUSTAINERS.format(tenure=boundaries("sustainer_start_date")), ("constituents",))
def _(spark, sf_dir):
    return G.v_sustainers(tpch.constituents(spark, sf_dir), tpch.AS_OF, "boundaries")


@query("v_churn_risk", """SELECT c.constituent_id, canonical_email, is_sustainer, recurring_monthly_amount, churn_risk_score, p.top_features AS churn_factors
FROM constituents c LEFT JOIN predictions p ON c.constituent_id = p.constituent_id AND p.model_name = 'churn_prediction'
  AND p.prediction_date = (SELECT max(prediction_date) FROM predictions WHERE model_name = 'churn_prediction')
WHERE churn_risk_score >= 0.6 ORDER BY churn_risk_score DESC""", ("constituents", "predictions"))
def _(spark, sf_dir):
    return G.v_churn_risk(tpch.constituents(spark, sf_dir), tpch.predictions(spark, sf_dir))


_GOLDEN = f"""golden AS (SELECT c.*, coalesce(c.canonical_first_name, '') || ' ' || coalesce(c.canonical_last_name, '') AS canonical_full_name,
  s.constituent_id IS NOT NULL AS is_subscriber, s.r.subscription_type AS subscription_type, s.r.subscription_status AS subscription_status,
  s.r.start_date AS subscription_start_date, e.email_open_rate_30d, e.email_click_rate_30d, e.last_email_open_date,
  CASE WHEN total_gift_count = 0 THEN 'prospect' WHEN last_donation_date < {CUT12} THEN 'lapsed'
    WHEN largest_single_gift >= 400000 THEN 'major_donor' WHEN is_sustainer AND recurring_status = 'active' THEN 'sustainer' ELSE 'one_time_donor' END AS lifecycle_stage
FROM constituents c
LEFT JOIN (SELECT constituent_id, max_by({{'subscription_type': subscription_type, 'subscription_status': subscription_status, 'start_date': start_date}},
    {{'a': start_date, 'b': subscription_id}}) AS r FROM subscriptions GROUP BY 1) s USING (constituent_id)
LEFT JOIN (SELECT constituent_id, CAST(count(*) FILTER (opened AND recent) AS DOUBLE) / nullif(count(*) FILTER (recent), 0) AS email_open_rate_30d,
    CAST(count(*) FILTER (clicked AND recent) AS DOUBLE) / nullif(count(*) FILTER (recent), 0) AS email_click_rate_30d,
    max(send_date) FILTER (opened) AS last_email_open_date
  FROM (SELECT *, send_date >= {EVENTS_AS_OF} - 30 AS recent FROM emails) GROUP BY 1) e USING (constituent_id))"""
GOLDEN_TABLES = ("constituents", "subscriptions", "emails")


def golden(spark, sf_dir):
    """Gifts are as of the order calendar, e-mail behaviour as of the event calendar."""
    c = tpch.constituents(spark, sf_dir)
    wide = G.build_golden(
        c, tpch.donations(spark, sf_dir), tpch.subscriptions(spark, sf_dir), tpch.email_engagement(spark, sf_dir), tpch.EVENTS_AS_OF
    )
    return wide.withColumn("lifecycle_stage", G.lifecycle_stage(tpch.AS_OF, 400000))


@query("golden_constituents", f"WITH {_GOLDEN} SELECT * FROM golden", GOLDEN_TABLES)
def _(spark, sf_dir):
    return golden(spark, sf_dir)


@query("lifecycle_stages", f"WITH {_GOLDEN} SELECT lifecycle_stage, count(*) AS n FROM golden GROUP BY 1", GOLDEN_TABLES)
def _(spark, sf_dir):
    return golden(spark, sf_dir).groupBy("lifecycle_stage").agg(F.count("*").alias("n"))


_PROFILE = f"""WITH {_GOLDEN} SELECT constituent_id, json_extract_string(p, '$.canonical_email') AS email, CAST(json_extract(p, '$.g') AS DOUBLE) AS total_lifetime,
  json_extract_string(p, '$.s') AS lifecycle_stage, CAST(json_extract(p, '$.r') AS DOUBLE) AS open_rate
FROM (SELECT constituent_id, to_json({{'canonical_email': canonical_email, 'g': CAST(total_lifetime_giving AS DOUBLE), 's': lifecycle_stage, 'r': email_open_rate_30d}}) AS p FROM golden)"""


@query("profile_360", _PROFILE, GOLDEN_TABLES)
def _(spark, sf_dir):
    p = G.profile_360(golden(spark, sf_dir))
    get = lambda path: F.get_json_object("profile", path)
    return p.select(
        "constituent_id", get("$.canonical_email").alias("email"),
        get("$.giving_summary.total_lifetime").cast("double").alias("total_lifetime"),
        get("$.lifecycle_stage").alias("lifecycle_stage"),
        get("$.engagement.email_open_rate_30d").cast("double").alias("open_rate"),
    )


@query("churn_summary", """SELECT churn_tier, n AS sustainers, n * 100.0 / sum(n) OVER () AS share_pct,
  CASE WHEN churn_tier IN ('high', 'critical') THEN amount ELSE 0 END AS monthly_at_risk
FROM (SELECT CASE WHEN churn_risk_score >= 0.85 THEN 'critical' WHEN churn_risk_score >= 0.6 THEN 'high' WHEN churn_risk_score >= 0.3 THEN 'medium' ELSE 'low' END AS churn_tier,
  CAST(count(*) AS DOUBLE) AS n, CAST(sum(recurring_monthly_amount) AS DECIMAL(18,2)) AS amount FROM constituents WHERE is_sustainer GROUP BY 1)""", ("constituents",))
def _(spark, sf_dir):
    return G.churn_summary(tpch.constituents(spark, sf_dir), R.churn_tier(F.col("churn_risk_score")))


def _mart(name, columns):
    @query(f"mart_{name}", f"WITH {_GOLDEN} SELECT {columns} FROM golden", GOLDEN_TABLES)
    def run(spark, sf_dir):
        return G.department_marts(golden(spark, sf_dir))[name]


_mart("membership", "constituent_id, lifecycle_stage, is_sustainer, recurring_status, recurring_monthly_amount, sustainer_start_date, last_donation_date")
_mart("development", "constituent_id, total_lifetime_giving, total_gift_count, largest_single_gift, average_gift_amount, first_donation_date, last_donation_date, lifecycle_stage")
_mart("marketing", "constituent_id, email_open_rate_30d, email_click_rate_30d, subscription_type, subscription_status, acquisition_channel, primary_source")


@query("date_dimension", """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, dayofweek(d) + 1 AS day_of_week, dayname(d) AS day_name,
  day(d) AS day_of_month, dayofyear(d) AS day_of_year, dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday,
  weekofyear(d) AS week_of_year, d - CAST(dayofweek(d) AS INTEGER) AS week_start_date, d - CAST(dayofweek(d) AS INTEGER) + 6 AS week_end_date,
  month(d) AS month_number, monthname(d) AS month_name, CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
  day(last_day(d)) AS days_in_month, quarter(d) AS quarter, 'Q' || quarter(d) AS quarter_name, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
  CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH AS DATE) - 1 AS quarter_end_date, year(d) AS year, CAST(date_trunc('year', d) AS DATE) AS year_start_date,
  CAST(date_trunc('year', d) + INTERVAL 12 MONTH AS DATE) - 1 AS year_end_date, CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS fiscal_year,
  ((month(d) + 5) % 12) // 3 + 1 AS fiscal_quarter, (month(d) + 5) % 12 + 1 AS fiscal_month,
  d BETWEEN DATE '1997-03-10' AND DATE '1997-03-21' AS is_pledge_drive, CASE WHEN d BETWEEN DATE '1997-03-10' AND DATE '1997-03-21' THEN 'spring' END AS pledge_drive_name,
  strftime(d, '%m-%d') IN ('01-01', '12-25') AS is_holiday, CASE strftime(d, '%m-%d') WHEN '01-01' THEN 'new year' WHEN '12-25' THEN 'christmas' END AS holiday_name
FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""")
def _(spark, sf_dir):
    """Every day from the first order to the last."""
    day = F.col("o_orderdate").cast("date")
    ends = tpch.table(spark, sf_dir, "orders").agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
    drives = ((dt.date(1997, 3, 10), dt.date(1997, 3, 21), "spring"),)
    return G.dim_date(spark, ends["a"], ends["b"], drives=drives, holidays=((1, 1, "new year"), (12, 25, "christmas")))


_CAMPAIGNS = """SELECT campaign_code, min(donation_date) AS start_date, CAST('2001-08-31' AS DATE) AS end_date,
  CAST(sum(donation_amount) AS DECIMAL(18,2)) AS goal_amount FROM donations GROUP BY 1"""


@query("campaign_dimension", f"""SELECT c.*, actual_amount, actual_donors, {AS_OF} BETWEEN start_date AND end_date AS is_active FROM ({_CAMPAIGNS}) c
LEFT JOIN (SELECT campaign_code, CAST(sum(donation_amount) AS DECIMAL(18,2)) AS actual_amount, count(DISTINCT constituent_id) AS actual_donors
  FROM donations WHERE donation_status = 'completed' GROUP BY 1) a USING (campaign_code)""", ("donations",))
def _(spark, sf_dir):
    d = tpch.donations(spark, sf_dir)
    campaigns = d.groupBy("campaign_code").agg(
        F.min("donation_date").alias("start_date"), F.lit(dt.date(2001, 8, 31)).alias("end_date"),
        F.sum("donation_amount").cast("decimal(18,2)").alias("goal_amount"),
    )
    return G.dim_campaign(d, campaigns, tpch.AS_OF)


@query("stage_counts", """WITH s AS (SELECT 'donations' AS stage, count(*) AS records FROM donations UNION ALL SELECT 'subscriptions', count(*) FROM subscriptions
  UNION ALL SELECT 'emails', count(*) FROM emails) SELECT * FROM s UNION ALL SELECT 'total', sum(records) FROM s""", ("donations", "subscriptions", "emails"))
def _(spark, sf_dir):
    return G.stage_counts({
        "donations": tpch.donations(spark, sf_dir), "subscriptions": tpch.subscriptions(spark, sf_dir), "emails": tpch.email_engagement(spark, sf_dir),
    })


#: Days by which event dates lie behind the order calendar.
EVENT_SHIFT = 8200


def churn_inputs(spark, sf_dir):
    """Constituents with an engagement date from their web events."""
    seen = tpch.engagement_events(spark, sf_dir).groupBy("constituent_id").agg(F.max("event_date").alias("d"))
    rates = G.email_rates(tpch.email_engagement(spark, sf_dir), tpch.EVENTS_AS_OF).select(
        "constituent_id", "email_open_rate_30d", "email_click_rate_30d"
    )
    c = tpch.constituents(spark, sf_dir).join(seen, "constituent_id", "left").join(rates, "constituent_id", "left")
    return c.withColumn("last_engagement_date", F.date_sub("d", EVENT_SHIFT)).drop("d")


_INPUTS = f"""inputs AS (SELECT c.*, d - 8200 AS last_engagement_date, email_open_rate_30d, email_click_rate_30d FROM constituents c
LEFT JOIN (SELECT constituent_id, max(event_date) AS d FROM engagement GROUP BY 1) USING (constituent_id)
LEFT JOIN (SELECT constituent_id, CAST(count(*) FILTER (opened AND send_date >= {EVENTS_AS_OF} - 30) AS DOUBLE) / nullif(count(*) FILTER (send_date >= {EVENTS_AS_OF} - 30), 0) AS email_open_rate_30d,
    CAST(count(*) FILTER (clicked AND send_date >= {EVENTS_AS_OF} - 30) AS DOUBLE) / nullif(count(*) FILTER (send_date >= {EVENTS_AS_OF} - 30), 0) AS email_click_rate_30d
  FROM emails GROUP BY 1) USING (constituent_id))"""
INPUT_TABLES = ("constituents", "engagement", "emails")
CHURN_SQL = f"""WITH {_INPUTS}, f AS (SELECT constituent_id, CAST(coalesce(datediff('day', last_engagement_date, {AS_OF}), 999) AS DOUBLE) AS days_since_last_engagement,
  CAST(coalesce(datediff('day', last_donation_date, {AS_OF}), 999) AS DOUBLE) AS days_since_last_donation,
  coalesce(email_open_rate_30d, 0) AS email_open_rate_30d, coalesce(email_click_rate_30d, 0) AS email_click_rate_30d,
  coalesce(datediff('day', first_donation_date, {AS_OF}) / CAST(30.44 AS DOUBLE), 0) AS tenure_months, CAST(total_gift_count AS DOUBLE) AS total_gifts,
  coalesce(average_gift_amount, 0) AS avg_gift_amount, CAST(consecutive_failed_payments AS DOUBLE) AS consecutive_failed_payments,
  coalesce(datediff('day', sustainer_start_date, {AS_OF}) / CAST(30.44 AS DOUBLE), 0) AS sustainer_months FROM inputs)
SELECT *, greatest(least((1 - greatest(least(days_since_last_engagement, 365), 0) / CAST(365 AS DOUBLE)) * 50 + email_open_rate_30d * 50, 100), 0) AS engagement_score FROM f"""


@query("churn_features", CHURN_SQL, INPUT_TABLES)
def _(spark, sf_dir):
    return X.churn_features(churn_inputs(spark, sf_dir), tpch.AS_OF)


UPGRADE_SQL = f"""WITH {_INPUTS}, a AS (SELECT constituent_id, least(greatest(coalesce(datediff('day', first_donation_date, {AS_OF}) / CAST(30.44 AS DOUBLE), 12), 0), 120) AS tenure_months,
  CAST(total_gift_count AS DOUBLE) AS total_gifts, coalesce(average_gift_amount, 50) AS avg_gift, CAST(coalesce(largest_single_gift, 50) AS DOUBLE) AS max_gift,
  CAST(least(greatest(coalesce(datediff('day', last_donation_date, {AS_OF}), 60), 0), 365) AS DOUBLE) AS days_since_gift, coalesce(email_open_rate_30d, CAST(0.3 AS DOUBLE)) AS email_open_rate,
  CAST(0 AS DOUBLE) AS events_attended FROM inputs),
b AS (SELECT *, least(greatest(total_gifts / greatest(tenure_months / 12, 1), 0), 24) AS gift_frequency FROM a)
SELECT *, least(greatest((1 - days_since_gift / 365) * 40 + email_open_rate * 30 + least(gift_frequency, 4) / 4 * 30, 0), 100) AS engagement_score,
  least(greatest(ln(1 + max_gift) * 10 + ln(1 + total_gifts * avg_gift) * 5, 0), 100) AS capacity_score FROM b"""


@query("upgrade_features", UPGRADE_SQL, INPUT_TABLES)
def _(spark, sf_dir):
    return X.upgrade_features(churn_inputs(spark, sf_dir), tpch.AS_OF)


GIVING_SQL = f"""SELECT constituent_id, datediff('day', max(donation_date), {AS_OF}) AS recency_days, {boundaries('min(donation_date)')} AS tenure_months, count(*) AS total_gifts,
  CAST(sum(donation_amount) AS DECIMAL(18,2)) AS total_giving, avg(CAST(donation_amount AS DOUBLE)) AS avg_gift_amount, CAST(max(donation_amount) AS DOUBLE) AS max_gift_amount,
  CAST(min(donation_amount) AS DOUBLE) AS min_gift_amount, round(stddev_samp(CAST(donation_amount AS DOUBLE)), 4) AS stddev_gift_amount,
  count(*) FILTER (donation_date >= {CUT12}) AS gifts_last_12m, count(*) FILTER (donation_date >= {CUT24} AND donation_date < {CUT12}) AS gifts_prior_12m,
  CAST(coalesce(sum(donation_amount) FILTER (donation_date >= {CUT12}), 0) AS DECIMAL(18,2)) AS giving_last_12m,
  CAST(coalesce(sum(donation_amount) FILTER (donation_date >= {CUT24} AND donation_date < {CUT12}), 0) AS DECIMAL(18,2)) AS giving_prior_12m,
  count(*) / greatest(datediff('day', min(donation_date), {AS_OF}) / CAST(365.25 AS DOUBLE), 1) AS frequency_annual
FROM donations WHERE donation_status = 'completed' GROUP BY 1"""
GIVING_SCORED = f"""SELECT *, CASE WHEN giving_last_12m > giving_prior_12m * 1.1 THEN 'increasing' WHEN giving_last_12m < giving_prior_12m * 0.9 THEN 'decreasing' ELSE 'stable' END AS gift_amount_trend,
  (1 + (recency_days <= 30)::INT + (recency_days <= 90)::INT + (recency_days <= 180)::INT + (recency_days <= 365)::INT)
  * (1 + (frequency_annual >= 1)::INT + (frequency_annual >= 2)::INT + (frequency_annual >= 4)::INT + (frequency_annual >= 8)::INT)
  * (1 + (avg_gift_amount >= 25)::INT + (avg_gift_amount >= 50)::INT + (avg_gift_amount >= 100)::INT + (avg_gift_amount >= 250)::INT) AS rfm_score
FROM ({GIVING_SQL})"""


@query("giving_features", GIVING_SCORED, ("donations",))
def _(spark, sf_dir):
    return X.giving_features(tpch.donations(spark, sf_dir), tpch.AS_OF).withColumn("stddev_gift_amount", F.round("stddev_gift_amount", 4))


@query("constituent_features", f"""WITH giving AS ({GIVING_SCORED.replace(AS_OF, EVENTS_AS_OF)}),
pay AS (SELECT constituent_id, count(*) FILTER (donation_status <> 'completed' AND donation_date >= CAST({EVENTS_AS_OF} - INTERVAL 12 MONTH AS DATE)) AS failures FROM donations GROUP BY 1),
steps AS (SELECT constituent_id, donation_amount AS a, lag(donation_amount) OVER (PARTITION BY constituent_id ORDER BY donation_date, donation_id) AS b FROM donations
  WHERE donation_status = 'completed' AND donation_type = 'recurring'),
moved AS (SELECT constituent_id, count(*) FILTER (a > b) AS up, count(*) FILTER (a < b) AS down FROM steps GROUP BY 1),
mail AS (SELECT constituent_id, count(*) FILTER (m) AS received, count(*) FILTER (m AND opened) AS opened_30, count(*) FILTER (m AND clicked) AS clicked_30, count(*) FILTER (q) AS received_90,
  count(*) FILTER (q AND opened) AS opened_90, max(send_date) FILTER (opened) AS last_open
  FROM (SELECT *, send_date >= {EVENTS_AS_OF} - 30 AS m, send_date >= {EVENTS_AS_OF} - 90 AS q FROM emails WHERE send_date <= {EVENTS_AS_OF}) GROUP BY 1),
act AS (SELECT constituent_id, max(event_date) AS last_event, count(*) FILTER (event_type = 'purchase' AND event_date >= CAST({EVENTS_AS_OF} - INTERVAL 12 MONTH AS DATE)) AS year_of, count(*) FILTER (event_type = 'purchase') AS ever FROM engagement GROUP BY 1)
SELECT c.constituent_id, {EVENTS_AS_OF} AS feature_date, datediff('day', last_event, {EVENTS_AS_OF}) AS days_since_last_engagement, recency_days AS days_since_last_donation,
  datediff('day', last_open, {EVENTS_AS_OF}) AS days_since_last_email_open, CAST(opened_30 AS DOUBLE) / nullif(received, 0) AS email_open_rate_30d, CAST(opened_90 AS DOUBLE) / nullif(received_90, 0) AS email_open_rate_90d,
  CAST(clicked_30 AS DOUBLE) / nullif(received, 0) AS email_click_rate_30d, coalesce(received, 0) AS emails_received_30d, coalesce(opened_30, 0) AS emails_opened_30d, tenure_months,
  coalesce(total_gifts, 0) AS total_gifts, total_giving, avg_gift_amount, max_gift_amount, min_gift_amount, stddev_gift_amount, coalesce(gifts_last_12m, 0) AS gifts_last_12m, giving_last_12m,
  coalesce(gifts_prior_12m, 0) AS gifts_prior_12m, giving_prior_12m, gift_amount_trend, is_sustainer, {boundaries('sustainer_start_date', EVENTS_AS_OF)} AS sustainer_months,
  coalesce(failures, 0) AS payment_failures_12m, coalesce(up, 0) AS upgrade_count, coalesce(down, 0) AS downgrade_count, recency_days, frequency_annual, avg_gift_amount AS monetary_avg, rfm_score,
  coalesce(year_of, 0) AS events_attended_12m, coalesce(ever, 0) AS events_attended_all, (total_gifts IS NOT NULL)::INT + (s.constituent_id IS NOT NULL)::INT + coalesce(ever > 0, false)::INT AS num_source_systems,
  total_gifts IS NOT NULL AS has_donation, s.constituent_id IS NOT NULL AS has_subscription, coalesce(ever > 0, false) AS has_event_attendance
FROM constituents c LEFT JOIN giving USING (constituent_id) LEFT JOIN pay USING (constituent_id) LEFT JOIN moved USING (constituent_id) LEFT JOIN mail USING (constituent_id)
LEFT JOIN act USING (constituent_id) LEFT JOIN (SELECT DISTINCT constituent_id FROM subscriptions) s ON s.constituent_id = c.constituent_id""", ("constituents", "donations", "subscriptions", "emails", "engagement"))
def _(spark, sf_dir):
    """All columns of the feature table."""
    f = X.constituent_features(
        tpch.constituents(spark, sf_dir), tpch.donations(spark, sf_dir), tpch.subscriptions(spark, sf_dir),
        tpch.email_engagement(spark, sf_dir), tpch.engagement_events(spark, sf_dir), tpch.EVENTS_AS_OF,
    )
    return f.withColumn("stddev_gift_amount", F.round("stddev_gift_amount", 4))


@query("feature_refresh", f"""SELECT constituent_id, {AS_OF} AS feature_date, CAST(NULL AS INTEGER) AS days_since_last_engagement,
  datediff('day', last_donation_date, {AS_OF}) AS days_since_last_donation, {boundaries('first_donation_date')} AS tenure_months, total_gift_count AS total_gifts,
  total_lifetime_giving AS total_giving, average_gift_amount AS avg_gift_amount, is_sustainer FROM constituents WHERE total_gift_count > 0""", ("constituents",))
def _(spark, sf_dir):
    return X.refresh_rows(tpch.constituents(spark, sf_dir), tpch.AS_OF)


@query("rfm_summary", f"""SELECT constituent_id, count(*) - 1 AS frequency, datediff('day', min(donation_date), max(donation_date)) AS recency,
  datediff('day', min(donation_date), {AS_OF}) AS "T", CASE WHEN count(*) > 1 THEN CAST(sum(a) - arg_min(a, donation_date) AS DOUBLE) / (count(*) - 1) ELSE 0 END AS monetary_value
FROM (SELECT constituent_id, donation_date, sum(donation_amount) AS a FROM donations WHERE donation_status = 'completed' GROUP BY 1, 2) GROUP BY 1""", ("donations",))
def _(spark, sf_dir):
    return X.rfm_summary(tpch.donations(spark, sf_dir), tpch.AS_OF)


@query("gift_timing", f"""WITH d AS (SELECT constituent_id, donation_date, max(donation_amount) AS a FROM donations WHERE donation_status = 'completed' GROUP BY 1, 2),
l AS (SELECT *, lag(a) OVER (PARTITION BY constituent_id ORDER BY donation_date) AS p FROM d),
q AS (SELECT constituent_id, CAST(arg_max(a, donation_date) AS DOUBLE) / avg(CAST(a AS DOUBLE)) AS recent_to_mean_ratio, count(*) FILTER (a > p) AS upgrade_count,
  datediff('day', max(donation_date) FILTER (a > p), {AS_OF}) AS days_since_last_upgrade, [count(*) FILTER (quarter(donation_date) = 1), count(*) FILTER (quarter(donation_date) = 2),
  count(*) FILTER (quarter(donation_date) = 3), count(*) FILTER (quarter(donation_date) = 4)] AS c FROM l GROUP BY 1)
SELECT constituent_id, recent_to_mean_ratio, upgrade_count, days_since_last_upgrade, list_position(c, list_max(c)) AS peak_quarter FROM q""", ("donations",))
def _(spark, sf_dir):
    return X.gift_timing(tpch.donations(spark, sf_dir), tpch.AS_OF)


@query("attach_constituents", """SELECT event_id, e.constituent_id AS source_constituent, l.link AS constituent_id FROM engagement e
LEFT JOIN (SELECT 'UC-' || constituent_id AS link, constituent_id FROM constituents WHERE total_gift_count > 8) l ON l.constituent_id = e.constituent_id""", ("engagement", "constituents"))
def _(spark, sf_dir):
    facts = tpch.engagement_events(spark, sf_dir).select(
        "event_id", F.col("constituent_id").alias("source_constituent"), F.lit("web").alias("source_system"),
        F.col("constituent_id").alias("source_record_id"),
    )
    links = tpch.constituents(spark, sf_dir).where("total_gift_count > 8").select(
        F.lit("web").alias("source_system"), F.col("constituent_id").alias("source_record_id"),
        F.concat(F.lit("UC-"), "constituent_id").alias("constituent_id"),
    )
    return G.attach_constituents(facts, links).select("event_id", "source_constituent", "constituent_id")


@query("event_attributes", """SELECT event_type, CAST(sum(CAST(json_extract_string(event_attributes, '$.k') AS INTEGER)) AS BIGINT) AS k_total, count(*) AS n FROM engagement GROUP BY 1""", ("engagement",))
def _(spark, sf_dir):
    from constituent360.functions.text import parse_attributes

    e = tpch.engagement_events(spark, sf_dir)
    return e.groupBy("event_type").agg(
        F.sum(parse_attributes(F.col("event_attributes"))["k"].cast("int")).alias("k_total"), F.count("*").alias("n")
    )


@query("event_attribute_paths", """SELECT event_id, props IS NOT NULL AND event_id % 7 <> 0 AS well_formed, CASE WHEN event_id % 7 > 1 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
  CASE WHEN event_id % 7 = 1 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS inner_k, CASE WHEN event_id % 7 = 1 THEN event_type END AS second, CASE WHEN event_id % 7 = 1 THEN user_id END AS first
  FROM events""")
def _(spark, sf_dir):
    """Attributes of web events of which some are nested one level deeper, in lists, and some are cut off."""
    props, n = F.col("props"), F.col("event_id") % 7
    nested = F.concat(F.lit('{"outer": {"inner": '), props, F.lit(', "list": ['), F.col("user_id"), F.lit(', "'), F.col("event_type"), F.lit('"]}}'))
    events = tpch.table(spark, sf_dir, "events").select(
        "event_id", F.when(n == 0, F.expr("left(props, length(props) - 1)")).when(n == 1, nested).otherwise(props).alias("text")
    )
    paths = {
        "k": ("$.k", "long"), "inner_k": ("$.outer.inner.k", "long"), "first": ("$.outer.list[0]", "long"), "second": ("$.outer.list[1]", "string"),
    }
    return T.with_attributes(events, "text", paths).drop("text")


@query("extra_features", f"""SELECT c.constituent_id, c.canonical_state, coalesce(v, 0) AS website_visits_30d, kinds AS content_types, round(income, 4) AS median_income FROM constituents c
LEFT JOIN (SELECT constituent_id, count(*) FILTER (event_type = 'view' AND event_date >= {EVENTS_AS_OF} - 30) AS v, string_agg(DISTINCT event_type, '+' ORDER BY event_type) AS kinds FROM engagement GROUP BY 1) e USING (constituent_id)
LEFT JOIN (SELECT canonical_state, quantile_cont(CAST(lifetime_value_estimate AS DOUBLE), 0.5) AS income FROM constituents GROUP BY 1) i ON i.canonical_state = c.canonical_state""", ("constituents", "engagement"))
def _(spark, sf_dir):
    c = tpch.constituents(spark, sf_dir)
    incomes = quantiles(c, "lifetime_value_estimate", [0.5], ["canonical_state"]).withColumnRenamed("q0", "median_income")
    x = X.extra_features(tpch.engagement_events(spark, sf_dir), c, incomes, tpch.EVENTS_AS_OF, "canonical_state")
    return x.withColumns({"content_types": F.array_join("content_types", "+"), "median_income": F.round("median_income", 4)})
