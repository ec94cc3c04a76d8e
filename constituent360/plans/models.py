"""Model, evaluation and recommendation queries."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from constituent360.operators import evaluation as E
from constituent360.operators import features as X
from constituent360.operators import models as L
from constituent360.operators import recommend as R
from constituent360.operators import totals
from constituent360.operators import golden as G
from constituent360.plans.golden import EVENT_SHIFT
from constituent360.plans.registry import query
from constituent360.plans.sql_domain import AS_OF
from constituent360.session import cut_lineage, scratch
from constituent360.sources import tpch

CUTOFF = dt.date(2001, 3, 1)


def scored(spark, sf_dir):
    """Churn predictions with an outcome: did the event behind them have an even value in cents?"""
    p = tpch.predictions(spark, sf_dir).where("model_name = 'churn_prediction'")
    values = tpch.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("prediction_id"), (F.round(F.col("value") * 100).cast("bigint") % 2).alias("label")
    )
    return p.join(values, "prediction_id").select("prediction_id", "constituent_id", "prediction_date", F.col("prediction_score").alias("score"), "label")


SCORED = """scored AS (SELECT p.prediction_id, p.constituent_id, p.prediction_date, p.prediction_score AS score, CAST(round(e.value * 100) AS BIGINT) % 2 AS label
  FROM predictions p JOIN events e ON p.prediction_id = CAST(e.event_id AS VARCHAR) WHERE model_name = 'churn_prediction')"""
CURVE = f"""{SCORED}, pts AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1),
cur AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM pts WINDOW w AS (ORDER BY score DESC)),
f1 AS (SELECT score, CAST(tp AS DOUBLE) / (tp + fp) AS pr, CAST(tp AS DOUBLE) / p AS re FROM cur)"""
LIFT = lambda k: f"""SELECT sum(pos * greatest(least((SELECT floor(count(*) * {k}) FROM scored) - (tp + fp - pos - neg), pos + neg), 0) / CAST(pos + neg AS DOUBLE))
  / (SELECT floor(count(*) * {k}) FROM scored) / (SELECT avg(label) FROM scored) FROM cur"""
BEST = "SELECT {{'t': score, 'p': pr, 'r': re, 'f': 2 * pr * re / nullif(pr + re, 0)}} FROM f1 ORDER BY 2 * pr * re / nullif(pr + re, 0) DESC NULLS LAST, score DESC LIMIT 1".replace("{{", "{").replace("}}", "}")


@query("evaluation_suite", f"""WITH {CURVE}, best AS (SELECT ({BEST}) AS b)
SELECT 'auc_roc' AS measure, round((SELECT sum(neg * (tp - pos / CAST(2 AS DOUBLE))) / (max(p) * max(n)) FROM cur), 9) AS value
UNION ALL SELECT 'auc_pr', round((SELECT sum(pos * CAST(tp AS DOUBLE) / (tp + fp)) / max(p) FROM cur), 9)
UNION ALL SELECT 'log_loss', round((SELECT avg(-(label * ln(greatest(least(score, 1 - 1e-15), 1e-15)) + (1 - label) * ln(1 - greatest(least(score, 1 - 1e-15), 1e-15)))) FROM scored), 6)
UNION ALL SELECT 'brier_score', round((SELECT avg((score - label) * (score - label)) FROM scored), 9)
UNION ALL SELECT 'optimal_threshold', b.t FROM best UNION ALL SELECT 'precision_at_optimal', round(b.p, 9) FROM best
UNION ALL SELECT 'recall_at_optimal', round(b.r, 9) FROM best UNION ALL SELECT 'f1_at_optimal', round(b.f, 9) FROM best
UNION ALL SELECT 'lift_at_10pct', round(({LIFT('0.1')}), 9) UNION ALL SELECT 'lift_at_20pct', round(({LIFT('0.2')}), 9)""", ("predictions",))
def _(spark, sf_dir):
    out = E.evaluate(scored(spark, sf_dir), "score", "label")
    return out.withColumn("value", F.when(F.col("measure") == "log_loss", F.round("value", 6)).otherwise(F.round("value", 9)))


@query("evaluation_deciles", f"""WITH {SCORED}, q AS (SELECT list_sort(list_distinct(quantile_cont(score, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e FROM scored)
SELECT 1 + len(list_filter(e[2:-2], lambda x: x < score)) AS decile, count(*) AS count, round(avg(label), 9) AS positive_rate, round(avg(score), 9) AS avg_score FROM scored, q GROUP BY 1""", ("predictions",))
def _(spark, sf_dir):
    d = E.decile_analysis(scored(spark, sf_dir), "score", "label")
    return d.withColumns({c: F.round(c, 9) for c in ("positive_rate", "avg_score")})


@query("evaluation_point_metrics", f"""WITH {SCORED} SELECT round(sum(label) FILTER (score >= 0.5) / CAST(count(*) FILTER (score >= 0.5) AS DOUBLE), 9) AS precision,
  round(sum(label) FILTER (score >= 0.5) / CAST(sum(label) AS DOUBLE), 9) AS recall, round(2 * sum(label) FILTER (score >= 0.5) / CAST(count(*) FILTER (score >= 0.5) + sum(label) AS DOUBLE), 9) AS f1 FROM scored""", ("predictions",))
def _(spark, sf_dir):
    m = E.point_metrics(scored(spark, sf_dir), "score", "label")
    return m.select(*[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query("evaluation_group_metrics", f"""WITH {SCORED} SELECT constituent_id, count(*) AS n, count(*) FILTER (score >= 0.5) / CAST(count(*) AS DOUBLE) AS selection_rate, sum(label) / CAST(count(*) AS DOUBLE) AS positive_rate,
  CAST(count(*) FILTER (score >= 0.5 AND label = 1) AS DOUBLE) / nullif(count(*) FILTER (score >= 0.5), 0) AS precision, CAST(count(*) FILTER (score >= 0.5 AND label = 1) AS DOUBLE) / nullif(sum(label), 0) AS recall FROM scored GROUP BY 1""", ("predictions",))
def _(spark, sf_dir):
    return E.group_metrics(scored(spark, sf_dir), "constituent_id", "score", "label")


def drift_pair(spark, sf_dir):
    e = tpch.table(spark, sf_dir, "events")
    return e.where("ts < timestamp_ntz'2024-01-16 00:00:00'"), e.where("ts >= timestamp_ntz'2024-01-16 00:00:00'")


@query("drift_psi", """WITH b AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-16'), c AS (SELECT value FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
r AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS n FROM b), bins AS (SELECT unnest(range(10)) AS i),
hb AS (SELECT least(CAST(floor((value - lo) * 10 / (hi - lo)) AS INTEGER), 9) AS i, count(*) AS k FROM b, r GROUP BY 1),
hc AS (SELECT least(CAST(floor((value - lo) * 10 / (hi - lo)) AS INTEGER), 9) AS i, count(*) AS k FROM c, r WHERE value BETWEEN lo AND hi GROUP BY 1),
s AS (SELECT coalesce(hb.k, 0) / CAST((SELECT count(*) FROM b) AS DOUBLE) + 1e-6 AS x, coalesce(hc.k, 0) / CAST((SELECT count(*) FROM c) AS DOUBLE) + 1e-6 AS y FROM bins LEFT JOIN hb USING (i) LEFT JOIN hc USING (i))
SELECT 'value' AS feature, round(sum((y - x) * ln(y / x)), 9) AS psi, CASE WHEN sum((y - x) * ln(y / x)) < 0.1 THEN 'none' WHEN sum((y - x) * ln(y / x)) <= 0.25 THEN 'moderate' ELSE 'significant' END AS drift FROM s""")
def _(spark, sf_dir):
    return E.psi(*drift_pair(spark, sf_dir), "value").withColumn("psi", F.round("psi", 9))


MONITOR = """SELECT model_name, model_version, prediction_date, count(*) AS predictions_made, round(avg(prediction_score), 9) AS avg_score, round(stddev_samp(prediction_score), 9) AS score_stddev,
  count(*) FILTER (prediction_tier = 'critical') AS critical_count, count(*) FILTER (prediction_score < 0.3) / CAST(count(*) AS DOUBLE) AS pct_low,
  count(*) FILTER (prediction_score BETWEEN 0.3 AND 0.6) / CAST(count(*) AS DOUBLE) AS pct_medium, count(*) FILTER (prediction_score >= 0.6) / CAST(count(*) AS DOUBLE) AS pct_high FROM predictions GROUP BY 1, 2, 3"""


@query("prediction_monitor", MONITOR, ("predictions",))
def _(spark, sf_dir):
    m = E.prediction_monitor(tpch.predictions(spark, sf_dir))
    return m.withColumns({c: F.round(c, 9) for c in ("avg_score", "score_stddev")})


def evaluation_log(spark, sf_dir):
    """One evaluation per model and day; the mean score of the day stands in for the AUC."""
    return tpch.predictions(spark, sf_dir).groupBy("model_name", F.col("prediction_date").alias("evaluation_date")).agg(
        F.round(F.avg("prediction_score"), 6).alias("auc_roc")
    )


LOG = "log AS (SELECT model_name, prediction_date AS evaluation_date, round(avg(prediction_score), 6) AS auc_roc FROM predictions GROUP BY 1, 2)"


@query("model_drift", f"""WITH {LOG} SELECT *, lag(auc_roc) OVER w AS prev_auc, auc_roc - lag(auc_roc) OVER w AS auc_change FROM log WINDOW w AS (PARTITION BY model_name ORDER BY evaluation_date)""", ("predictions",))
def _(spark, sf_dir):
    return E.model_drift(evaluation_log(spark, sf_dir))


@query("retrain_flag", f"""WITH {LOG} SELECT model_name, arg_max(auc_roc, evaluation_date) AS auc_roc, max(abs(auc_roc - 0.5)) AS max_psi,
  arg_max(auc_roc, evaluation_date) < 0.75 OR max(abs(auc_roc - 0.5)) > 0.2 AS retrain FROM log GROUP BY 1""", ("predictions",))
def _(spark, sf_dir):
    log = evaluation_log(spark, sf_dir)
    return E.retrain_flag(log, log.select("model_name", F.abs(F.col("auc_roc") - 0.5).alias("psi")))


UP = """up AS (SELECT constituent_id, max(prediction_score) FILTER (model_name = 'upgrade_propensity' AND CAST(prediction_id AS BIGINT) % 3 = 0) AS to_sustainer_score,
  max(prediction_score) FILTER (model_name = 'upgrade_propensity' AND CAST(prediction_id AS BIGINT) % 3 = 1) AS sustainer_increase_score,
  min(prediction_score) FILTER (model_name = 'upgrade_propensity') AS to_major_score FROM predictions GROUP BY 1),
best AS (SELECT *, greatest(to_sustainer_score, sustainer_increase_score, to_major_score) AS upgrade_propensity FROM up),
pathed AS (SELECT *, CASE upgrade_propensity WHEN to_sustainer_score THEN 'to_sustainer' WHEN sustainer_increase_score THEN 'sustainer_increase' ELSE 'to_major' END AS best_path FROM best)"""


def upgrade_scores(spark, sf_dir):
    p = tpch.predictions(spark, sf_dir)
    mine = F.col("model_name") == "upgrade_propensity"
    n = F.col("prediction_id").cast("bigint") % 3
    s = F.col("prediction_score")
    up = p.groupBy("constituent_id").agg(
        F.max(F.when(mine & (n == 0), s)).alias("to_sustainer_score"), F.max(F.when(mine & (n == 1), s)).alias("sustainer_increase_score"),
        F.min(F.when(mine, s)).alias("to_major_score"),
    )
    return R.best_path(up, ["to_sustainer", "sustainer_increase", "to_major"])


@query("upgrade_best_path", f"WITH {UP} SELECT * FROM pathed", ("predictions",))
def _(spark, sf_dir):
    return upgrade_scores(spark, sf_dir)


@query("recommendations", f"""WITH {UP}, r AS (SELECT p.constituent_id, upgrade_propensity, best_path, coalesce(c.churn_risk_score, 0.3) AS churn_score FROM pathed p
  LEFT JOIN (SELECT * FROM constituents WHERE is_sustainer) c USING (constituent_id))
SELECT *, CASE WHEN upgrade_propensity >= 0.5 AND churn_score < 0.5 THEN 'prime_target' WHEN upgrade_propensity >= 0.5 THEN 'careful_ask' WHEN churn_score < 0.5 THEN 'nurture' ELSE 'save_first' END AS action,
  least(greatest(upgrade_propensity * 100 - churn_score * 50, 0), 100) AS priority FROM r ORDER BY priority DESC""", ("predictions", "constituents"))
def _(spark, sf_dir):
    churn = tpch.constituents(spark, sf_dir).where("is_sustainer").select("constituent_id", F.col("churn_risk_score").alias("churn_score"))
    return R.recommendations(upgrade_scores(spark, sf_dir), churn)


@query("expected_value", f"""WITH {UP} SELECT constituent_id, to_sustainer_score * 300 AS to_sustainer_value, sustainer_increase_score * 180 AS sustainer_increase_value, to_major_score * 1000 AS to_major_value,
  to_sustainer_score * 300 + sustainer_increase_score * 180 + to_major_score * 1000 AS expected_value FROM pathed""", ("predictions",))
def _(spark, sf_dir):
    v = R.expected_value(upgrade_scores(spark, sf_dir))
    return v.select("constituent_id", "to_sustainer_value", "sustainer_increase_value", "to_major_value", "expected_value")


DASH = """dash AS (SELECT c.constituent_id, churn_risk_score AS churn_risk, CAST(lifetime_value_estimate AS DOUBLE) / 50 AS lifetime_value,
  coalesce(u.s, 0) AS upgrade_propensity FROM constituents c LEFT JOIN (SELECT constituent_id, max(prediction_score) AS s FROM predictions GROUP BY 1) u USING (constituent_id))"""


def dashboard(spark, sf_dir):
    up = tpch.predictions(spark, sf_dir).groupBy("constituent_id").agg(F.max("prediction_score").alias("s"))
    c = tpch.constituents(spark, sf_dir).join(up, "constituent_id", "left")
    return c.select("constituent_id", F.col("churn_risk_score").alias("churn_risk"), (F.col("lifetime_value_estimate").cast("double") / 50).alias("lifetime_value"),
                    F.coalesce("s", F.lit(0.0)).alias("upgrade_propensity"))


@query("dashboard_actions", f"""WITH {DASH} SELECT *, CASE WHEN churn_risk > 0.7 AND lifetime_value > 100 THEN 'Save First' WHEN churn_risk > 0.6 AND lifetime_value > 50 THEN 'Careful Ask'
  WHEN upgrade_propensity > 0.7 THEN 'Prime Target' WHEN upgrade_propensity > 0.5 THEN 'Consider Ask' ELSE 'Nurture' END AS action,
  CASE WHEN churn_risk > 0.7 AND lifetime_value > 100 THEN 'CRITICAL' WHEN churn_risk > 0.6 AND lifetime_value > 50 OR upgrade_propensity > 0.7 THEN 'HIGH' WHEN upgrade_propensity > 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS priority FROM dash""", ("constituents", "predictions"))
def _(spark, sf_dir):
    return R.dashboard_action(dashboard(spark, sf_dir))


@query("dashboard_tiers", f"""WITH {DASH} SELECT tier, n, n * 100.0 / sum(n) OVER () AS pct FROM (SELECT CASE WHEN churn_risk > 0 AND churn_risk <= 0.3 THEN 'Low' WHEN churn_risk > 0.3 AND churn_risk <= 0.6 THEN 'Medium'
  WHEN churn_risk > 0.6 AND churn_risk <= 0.8 THEN 'High' WHEN churn_risk > 0.8 AND churn_risk <= 1 THEN 'Critical' END AS tier, CAST(count(*) AS DOUBLE) AS n FROM dash GROUP BY 1)""", ("constituents", "predictions"))
def _(spark, sf_dir):
    return R.tier_distribution(dashboard(spark, sf_dir), R.dashboard_tier(F.col("churn_risk")))


@query("at_risk_value", f"""WITH {DASH} SELECT count(*) FILTER (churn_risk > 0.6 AND lifetime_value > 100) AS high_value_at_risk, round(sum(lifetime_value) FILTER (churn_risk > 0.6), 4) AS at_risk_value FROM dash""", ("constituents", "predictions"))
def _(spark, sf_dir):
    return R.at_risk_value(dashboard(spark, sf_dir)).withColumn("at_risk_value", F.round("at_risk_value", 4))


@query("tier_actions", """SELECT prediction_id, prediction_tier, CASE prediction_tier WHEN 'low' THEN 'Standard communications' WHEN 'medium' THEN 'Engagement campaign; survey'
  WHEN 'high' THEN 'Personal outreach; retention offer' ELSE 'Urgent intervention; executive contact' END AS action FROM predictions""", ("predictions",))
def _(spark, sf_dir):
    p = tpch.predictions(spark, sf_dir)
    tier = R.churn_tier(F.col("prediction_score"))
    return p.select("prediction_id", tier.alias("prediction_tier"), R.tier_action(tier).alias("action"))


def payments(spark, sf_dir):
    """Every gift is a payment; one that was not completed failed."""
    return tpch.donations(spark, sf_dir).select(
        "constituent_id", F.col("donation_date").alias("payment_date"), F.col("donation_id").cast("bigint").alias("payment_id"),
        (F.col("donation_status") != "completed").alias("failed"),
    )


LABELS = f"""pay AS (SELECT constituent_id, donation_date AS d, donation_status <> 'completed' AS f,
    lag(donation_status <> 'completed') OVER w AS f1, lag(donation_status <> 'completed', 2) OVER w AS f2 FROM donations WINDOW w AS (PARTITION BY constituent_id ORDER BY donation_date, CAST(donation_id AS BIGINT))),
gone AS (SELECT constituent_id FROM status_changes WHERE change_type = 'cancelled' AND change_date > DATE '{CUTOFF}' AND change_date <= DATE '{CUTOFF}' + 90
  UNION SELECT constituent_id FROM pay WHERE f AND f1 AND f2 AND d > DATE '{CUTOFF}' AND d <= DATE '{CUTOFF}' + 90),
g AS (SELECT constituent_id, max(donation_date) FILTER (donation_date <= DATE '{CUTOFF}') AS l, min(donation_date) FILTER (donation_date > DATE '{CUTOFF}') AS n,
  count(*) FILTER (donation_date <= DATE '{CUTOFF}' AND donation_type = 'recurring') > 0 AS is_sustainer FROM donations WHERE donation_status = 'completed' GROUP BY 1),
labels_of AS (SELECT constituent_id, is_sustainer, CAST(CASE WHEN is_sustainer THEN constituent_id IN (SELECT constituent_id FROM gone)
  ELSE CAST(l + INTERVAL 13 MONTH AS DATE) <= DATE '{CUTOFF}' + 90 AND (n IS NULL OR n > CAST(l + INTERVAL 13 MONTH AS DATE)) END AS INTEGER) AS churned FROM g WHERE l IS NOT NULL)"""


def labels(spark, sf_dir):
    return L.churn_labels(tpch.donations(spark, sf_dir), tpch.status_changes(spark, sf_dir), payments(spark, sf_dir), CUTOFF)


@query("churn_labels", f"WITH {LABELS} SELECT * FROM labels_of", ("donations", "status_changes"))
def _(spark, sf_dir):
    return labels(spark, sf_dir)


def training_rows(spark, sf_dir):
    """Features from up to the cutoff, labels from after it. What has no history (the count of failed payments is a state of
    today) is left out; events and mails count by their date on the calendar of the gifts."""
    until = CUTOFF + dt.timedelta(days=EVENT_SHIFT)
    events = tpch.engagement_events(spark, sf_dir).where(F.col("event_date") <= until)
    events = events.groupBy("constituent_id").agg(F.date_sub(F.max("event_date"), EVENT_SHIFT).alias("last_engagement_date"))
    mails = tpch.email_engagement(spark, sf_dir).where(F.col("send_date") <= until)
    mails = G.email_rates(mails, until).select("constituent_id", "email_open_rate_30d", "email_click_rate_30d")
    seen = (
        tpch.constituents(spark, sf_dir).select("constituent_id")
        .join(events, "constituent_id", "left").join(mails, "constituent_id", "left")
    )
    past = tpch.donations(spark, sf_dir).where(F.col("donation_date") <= CUTOFF)
    from constituent360.operators.metrics import giving_summary

    starts = past.where("donation_type = 'recurring' AND donation_status = 'completed'").groupBy("constituent_id").agg(F.min("donation_date").alias("sustainer_start_date"))
    later = tpch.donations(spark, sf_dir).where((F.col("donation_date") > CUTOFF) & (F.col("donation_status") == "completed")).groupBy("constituent_id").agg(
        F.max("donation_amount").alias("later_max"), F.max((F.col("donation_type") == "recurring").cast("int")).alias("later_recurring")
    )
    rows = giving_summary(past).join(seen, "constituent_id").join(starts, "constituent_id", "left").join(labels(spark, sf_dir).drop("is_sustainer"), "constituent_id").join(later, "constituent_id", "left")
    gave = F.coalesce("later_recurring", F.lit(0))
    grew = F.coalesce(F.col("later_max") > F.col("largest_single_gift"), F.lit(False)).cast("int")
    sustainer = F.col("sustainer_start_date").isNotNull()
    return rows.withColumns({
        "to_sustainer": F.when(~sustainer, gave).otherwise(0), "sustainer_increase": F.when(sustainer, grew).otherwise(0),
        "to_major": F.coalesce(F.col("later_max") >= 400000, F.lit(False)).cast("int"),
    })


_FITTED: dict[tuple, tuple] = {}


def fitted(spark, sf_dir, kind):
    """(model or models, metrics, training rows) of a session and input, fitted once for all queries that read them."""
    key = spark.sparkContext.applicationId, sf_dir, kind
    if key not in _FITTED:
        rows = cut_lineage(training_rows(spark, sf_dir))
        train = (lambda: L.train_churn(rows, "churned", CUTOFF)) if kind == "churn" else (lambda: L.train_upgrade(rows, CUTOFF))
        model, metrics = train()
        _FITTED[key] = model, cut_lineage(metrics), rows
    return _FITTED[key]


@query("churn_model_metrics")
def _(spark, sf_dir):
    return fitted(spark, sf_dir, "churn")[1]


def churn_predictions(spark, sf_dir):
    """Train, save, load and predict."""
    model, _metrics, rows = fitted(spark, sf_dir, "churn")
    path = scratch(spark, "churn-model")
    L.save_model(model, path)
    return L.predict_churn(L.load_model(path), rows, CUTOFF)


@query("churn_model_predictions")
def _(spark, sf_dir):
    return churn_predictions(spark, sf_dir)


@query("churn_model_checks", f"""WITH {LABELS} SELECT constituent_id, true AS in_range, true AS tier_fits, DATE '{CUTOFF}' AS prediction_date FROM labels_of
  WHERE constituent_id IN (SELECT constituent_id FROM constituents)""", ("donations", "status_changes", "constituents"))
def _(spark, sf_dir):
    """Every labelled constituent has one score in [0, 1], and the tier that belongs to it."""
    score = F.col("churn_score")
    tier = F.when(score >= 0.85, "critical").when(score >= 0.6, "high").when(score >= 0.3, "medium").otherwise("low")
    return churn_predictions(spark, sf_dir).select(
        "constituent_id", score.between(0, 1).alias("in_range"), (F.col("churn_tier") == tier).alias("tier_fits"), "prediction_date"
    )


@query("churn_model_importance")
def _(spark, sf_dir):
    return L.feature_importance(fitted(spark, sf_dir, "churn")[0], X.CHURN_FEATURES)


@query("churn_model_importance_checks", "SELECT CAST(count(*) AS BIGINT) AS features, true AS sums_to_one FROM range(10)")
def _(spark, sf_dir):
    found = L.feature_importance(fitted(spark, sf_dir, "churn")[0], X.CHURN_FEATURES)
    return found.agg(F.count("*").alias("features"), (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"))


@query("upgrade_model_metrics")
def _(spark, sf_dir):
    return fitted(spark, sf_dir, "upgrade")[1]


def upgrade_predictions(spark, sf_dir):
    models, _metrics, rows = fitted(spark, sf_dir, "upgrade")
    return L.predict_upgrade(models, rows, CUTOFF)


@query("upgrade_model_predictions")
def _(spark, sf_dir):
    return upgrade_predictions(spark, sf_dir)


@query("upgrade_model_checks", f"""WITH {LABELS} SELECT constituent_id, true AS in_range FROM labels_of
  WHERE constituent_id IN (SELECT constituent_id FROM constituents)""", ("donations", "status_changes", "constituents"))
def _(spark, sf_dir):
    """Every labelled constituent has a score in [0, 1] for every target."""
    scores = [F.col(f"{t}_score").between(0, 1) for t in L.UPGRADE_TARGETS]
    return upgrade_predictions(spark, sf_dir).select("constituent_id", (scores[0] & scores[1] & scores[2]).alias("in_range"))


def model_features(spark, sf_dir):
    rows = training_rows(spark, sf_dir)
    return X.churn_features(rows, CUTOFF).join(rows.select("constituent_id", F.col("churned").cast("double").alias("label")), "constituent_id")


@query("model_comparison")
def _(spark, sf_dir):
    """Fifteen fits, with the settings of the other models."""
    return L.compare_models(model_features(spark, sf_dir), X.CHURN_FEATURES, "label", "constituent_id", L.classifiers("label"))


@query("model_calibration", f"""WITH {SCORED}, pts AS (SELECT score, sum(label) AS y, count(*) AS w, row_number() OVER (ORDER BY score) AS i FROM scored GROUP BY 1),
run AS (SELECT *, sum(y) OVER (ORDER BY i) AS sy, sum(w) OVER (ORDER BY i) AS sw FROM pts),
least AS (SELECT a.i AS a, b.i AS b, min(CAST(b.sy - a.sy + a.y AS DOUBLE) / (b.sw - a.sw + a.w)) OVER (PARTITION BY a.i ORDER BY b.i DESC) AS m FROM run a JOIN run b ON a.i <= b.i),
fit AS (SELECT b AS i, max(m) AS v FROM least GROUP BY 1)
SELECT prediction_id, s.score, round(v, 9) AS calibrated FROM scored s JOIN pts USING (score) JOIN fit USING (i)""", ("predictions",))
def _(spark, sf_dir):
    """The fit is the greatest, over starts up to a score, of the least mean over ends from it on."""
    return L.calibrate(scored(spark, sf_dir), "score", "label")[1].select("prediction_id", "score", F.round("calibrated", 9).alias("calibrated"))


@query("donor_segment_sizes", """SELECT true AS five_or_fewer, CAST(count(DISTINCT constituent_id) AS BIGINT) AS donors FROM donations
  WHERE donation_status = 'completed' AND donation_date <= """ + AS_OF, ("donations",))
def _(spark, sf_dir):
    """The segments of all donors add up to the donors."""
    s = X.rfm_summary(tpch.donations(spark, sf_dir), tpch.AS_OF)
    found = L.segment_kmeans(s.withColumn("age", F.col("T")), ["frequency", "recency", "age", "monetary_value"])
    return found.groupBy("segment").agg(F.count("*").alias("n")).agg((F.count("*") <= 5).alias("five_or_fewer"), F.sum("n").alias("donors"))


@query("survival_model_rows", """SELECT DISTINCT constituent_id, true AS positive FROM donations WHERE donation_status = 'completed' AND donation_date <= """ + AS_OF, ("donations",))
def _(spark, sf_dir):
    """Every donor has a positive expected time."""
    return survival(spark, sf_dir).select("constituent_id", (F.col("expected_duration") > 0).alias("positive"))


@query("donor_segments")
def _(spark, sf_dir):
    s = X.rfm_summary(tpch.donations(spark, sf_dir), tpch.AS_OF)
    return L.segment_kmeans(s.withColumn("age", F.col("T")), ["frequency", "recency", "age", "monetary_value"]).groupBy("segment").agg(F.count("*").alias("n"))


def survival(spark, sf_dir):
    """Who has been silent for thirteen months was lost with the last gift; all others are observed until today."""
    s = X.rfm_summary(tpch.donations(spark, sf_dir), tpch.AS_OF).withColumn("churned", (F.col("T") - F.col("recency") > 395).cast("int"))
    s = s.withColumn("observed", F.when(F.col("churned") == 1, F.col("recency")).otherwise(F.col("T")))
    return L.survival_fit(s, ["frequency", "monetary_value"], "observed", "churned")[1].select("constituent_id", "expected_duration")


@query("survival_model")
def _(spark, sf_dir):
    return survival(spark, sf_dir)


@query("uplift_scores")
def _(spark, sf_dir):
    rows = model_features(spark, sf_dir).withColumn("contacted", F.pmod(F.xxhash64("constituent_id"), F.lit(2)))
    return L.uplift_scores(rows, "constituent_id", X.CHURN_FEATURES, "contacted", "label").select("constituent_id", "uplift")


@query("class_weights", f"""WITH {LABELS}, p AS (SELECT avg(churned) AS p FROM labels_of) SELECT churned, count(*) AS n, round(CASE WHEN churned = 1 THEN (1 - max(p)) / max(p) ELSE 1 END, 9) AS weight FROM labels_of, p GROUP BY 1""", ("donations", "status_changes"))
def _(spark, sf_dir):
    w = L.with_class_weight(labels(spark, sf_dir), "churned")
    return w.groupBy("churned").agg(F.count("*").alias("n"), F.round(F.max("weight"), 9).alias("weight"))


@query("time_split", """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS n FROM orders), c AS (SELECT quantile_cont(n, 0.8) AS cut FROM o)
SELECT n <= cut AS earlier, count(*) AS rows, min(d) AS first, max(d) AS last FROM o, c GROUP BY 1""")
def _(spark, sf_dir):
    o = tpch.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    early, late = L.time_split(o, "d")
    both = early.withColumn("earlier", F.lit(True)).unionByName(late.withColumn("earlier", F.lit(False)))
    return both.groupBy("earlier").agg(F.count("*").alias("rows"), F.min("d").alias("first"), F.max("d").alias("last"))


@query("stratified_split", """SELECT o_orderstatus, count(*) AS n, CAST(floor((count(*) - 1) * CAST(0.8 AS DOUBLE)) AS BIGINT) + 1 AS train FROM orders GROUP BY 1""")
def _(spark, sf_dir):
    o = tpch.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    train, valid = L.split(o, "o_orderkey", 0.8, "o_orderstatus")
    both = train.withColumn("t", F.lit(1)).unionByName(valid.withColumn("t", F.lit(0)))
    return both.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("t").alias("train"))


@query("cross_validation_in_time", """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders), known AS (SELECT d, datediff('day', DATE '1970-01-01', d) AS n FROM o WHERE d + 90 <= (SELECT max(d) FROM o)),
q AS (SELECT list_sort(list(c)) AS c FROM (SELECT DATE '1970-01-01' + CAST(floor(unnest(quantile_cont(n, [1/6, 2/6, 3/6, 4/6, 5/6, 1]))) AS INTEGER) AS c FROM known)),
f AS (SELECT k AS fold, c[k] AS a, c[k + 1] AS b FROM q, (VALUES (1), (2), (3), (4), (5)) v(k))
SELECT fold, count(*) FILTER (d <= a - 90) AS train_rows, max(d) FILTER (d <= a - 90) AS train_to, count(*) FILTER (d > a AND d <= b) AS test_rows, min(d) FILTER (d > a AND d <= b) AS test_from,
  max(d) FILTER (d > a AND d <= b) AS test_to, true AS auc_fits, true AS gap_kept FROM f, known GROUP BY fold""")
def _(spark, sf_dir):
    """Does a giver give again within 90 days? Features of a gift look back from its day, labels 90 days ahead."""
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    gifts = tpch.table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("gift_date"), F.col("o_totalprice").cast("double").alias("amount"),
        day.alias("day"), F.struct(day.alias("d"), "o_orderkey").alias("at"), F.struct((-day).alias("d"), (-F.col("o_orderkey")).alias("k")).alias("back"),
    )
    seen = totals.previous_values(totals.previous_values(gifts, ["o_custkey"], "at", "day", ["before"]), ["o_custkey"], "back", "day", ["next"])
    last = gifts.agg(F.max("gift_date")).first()[0]
    rows = seen.where(F.date_add("gift_date", 90) <= F.lit(last)).select(
        "gift_date", "amount", F.coalesce(F.col("day") - F.col("before"), F.lit(999)).cast("double").alias("days_since"),
        F.coalesce(F.col("next") - F.col("day") <= 90, F.lit(False)).cast("int").alias("again"),
    )
    classifier = LogisticRegression(featuresCol="_features", labelCol="_y", probabilityCol="_probability", rawPredictionCol="_margin", predictionCol="_prediction")
    out = L.cross_validate_in_time(rows, ["amount", "days_since"], "again", "gift_date", classifier)
    fits = F.col("auc").isNull() | F.col("auc").between(0, 1)
    return out.withColumns({"auc_fits": fits, "gap_kept": F.coalesce(F.datediff("test_from", "train_to") > 90, F.lit(True))}).drop("auc")
