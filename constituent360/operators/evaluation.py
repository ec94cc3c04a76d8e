"""Model evaluation, drift and monitoring, as aggregations over scored rows.

Curves work on one row per distinct score (see ``totals``), so ties are handled together and no window
sorts all rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from constituent360.functions.numbers import count_if, safe_div
from constituent360.operators.totals import collapse, previous_values, quantiles, running_totals
from constituent360.session import cut_lineage


def curve(scored: DataFrame, score: str, label: str, group: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, from the highest down: positives and negatives at it and at or above it."""
    y = F.col(label).cast("int")
    counts = collapse(
        scored.where(F.col(score).isNotNull()), score, group, pos=F.sum(y), neg=F.sum(1 - y)
    )
    return running_totals(counts, score, ["pos", "neg"], group, descending=True)


def best_f1(scored: DataFrame, score: str, label: str) -> DataFrame:
    """The threshold with the greatest F1; the higher threshold wins a tie. One row."""
    return _best_f1(curve(scored, score, label), score)


def _best_f1(points: DataFrame, score: str) -> DataFrame:
    positives = points.agg(F.sum("pos").alias("p")).first()["p"] or 0
    tp = F.col("cum_pos").cast("double")
    precision = tp / (F.col("cum_pos") + F.col("cum_neg"))
    recall = safe_div(tp, F.lit(float(positives)))
    f1 = safe_div(2 * precision * recall, precision + recall)
    row = F.struct(F.col(score).alias("threshold"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))
    return points.agg(F.max_by(row, F.struct(f1, F.col(score))).alias("r")).select("r.*")


def auc(scored: DataFrame, score: str, label: str, group: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve and average precision, ties counted by halves."""
    return _auc(curve(scored, score, label, group), group)


def _auc(points: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    tp, fp = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    totals = points.groupBy(*group).agg(
        F.sum(pos).alias("positives"), F.sum(neg).alias("negatives"),
        F.sum(neg * (tp - pos / 2)).alias("_area"),
        F.sum(pos * tp / (tp + fp)).alias("_precision"),
    )
    return totals.select(
        *group,
        safe_div(F.col("_area"), F.col("positives") * F.col("negatives")).alias("auc_roc"),
        safe_div(F.col("_precision"), F.col("positives")).alias("auc_pr"),
        "positives", "negatives",
    )


def point_metrics(scored: DataFrame, score: str, label: str, threshold: float = 0.5, group: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 at a threshold (0 where undefined), log loss and Brier score."""
    p, y = F.col(score), F.col(label).cast("int")
    guess = p >= threshold
    safe = F.greatest(F.least(p, F.lit(1 - 1e-15)), F.lit(1e-15))
    sums = scored.groupBy(*group).agg(
        count_if(guess & (y == 1)).cast("double").alias("tp"), count_if(guess).cast("double").alias("called"),
        count_if(y == 1).cast("double").alias("actual"),
        F.avg(-(y * F.log(safe) + (1 - y) * F.log(1 - safe))).alias("log_loss"),
        F.avg((p - y) * (p - y)).alias("brier_score"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    precision = zero(safe_div(F.col("tp"), F.col("called")))
    recall = zero(safe_div(F.col("tp"), F.col("actual")))
    return sums.select(
        *group, precision.alias("precision"), recall.alias("recall"),
        zero(safe_div(2 * F.col("tp"), F.col("called") + F.col("actual"))).alias("f1"), "log_loss", "brier_score",
    )


def lift_at_k(scored: DataFrame, score: str, label: str, k: float) -> DataFrame:
    """Positive rate of the top share over the overall rate. Rows tied at the boundary count in
    proportion, which is their expected number whichever of them are taken."""
    return _lift(curve(scored, score, label), k)


def _lift(points: DataFrame, k: float) -> DataFrame:
    size = points.agg(F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("p")).first()
    n, positives = size["n"] or 0, size["p"] or 0
    top = int(n * k)
    if top == 0 or positives == 0:
        return points.agg(F.lit(k).alias("k"), F.lit(0.0).alias("lift"))
    here = F.col("pos") + F.col("neg")
    above = F.col("cum_pos") + F.col("cum_neg") - here
    taken = F.greatest(F.least(F.lit(top) - above, here), F.lit(0)) / here
    return points.agg((F.sum(F.col("pos") * taken) / F.lit(float(top)) / F.lit(positives / n)).alias("lift")).select(
        F.lit(k).alias("k"), "lift"
    )


def decile_analysis(scored: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Count, positive rate and mean score per quantile bin; equal edges merge, bins are right-closed."""
    edges = quantiles(scored, score, [i / bins for i in range(bins + 1)]).first()
    cuts = sorted(set(edges))[1:-1]
    decile = F.lit(1)
    for cut in cuts:
        decile = decile + (F.col(score) > F.lit(cut)).cast("int")
    return scored.groupBy(decile.alias("decile")).agg(
        F.count("*").alias("count"), F.avg(F.col(label).cast("double")).alias("positive_rate"), F.avg(score).alias("avg_score")
    ).orderBy(F.col("decile").desc())


def evaluate(scored: DataFrame, score: str, label: str) -> DataFrame:
    """(measure, value) rows: discrimination, calibration, best F1 and lift, from one curve."""
    points = cut_lineage(curve(scored, score, label))
    wide = [
        _auc(points).select("auc_roc", "auc_pr"),
        point_metrics(scored, score, label).select("log_loss", "brier_score"),
        _best_f1(points, score).select(
            F.col("threshold").alias("optimal_threshold"), F.col("precision").alias("precision_at_optimal"),
            F.col("recall").alias("recall_at_optimal"), F.col("f1").alias("f1_at_optimal"),
        ),
        _lift(points, 0.1).select(F.col("lift").alias("lift_at_10pct")),
        _lift(points, 0.2).select(F.col("lift").alias("lift_at_20pct")),
    ]
    out = None
    for df in wide:
        part = df.select(*[F.col(c).cast("double").alias(c) for c in df.columns]).unpivot([], df.columns, "measure", "value")
        out = part if out is None else out.unionByName(part)
    return out


def psi(baseline: DataFrame, current: DataFrame, feature: str, bins: int = 10) -> DataFrame:
    """Population stability index over equal-width bins of the baseline range; current values outside
    the range fall in no bin, and every share gets 1e-6 added."""
    span = baseline.agg(F.min(feature).cast("double").alias("lo"), F.max(feature).cast("double").alias("hi")).first()
    low, high = span["lo"], span["hi"]
    if low == high:
        low, high = low - 0.5, high + 0.5
    x = F.col(feature).cast("double")
    bin_no = F.least(F.floor((x - low) * bins / (high - low)).cast("int"), F.lit(bins - 1))
    inside = F.when((x >= low) & (x <= high), bin_no)
    both = baseline.select(inside.alias("bin"), F.lit(1).alias("b"), F.lit(0).alias("c")).unionByName(
        current.select(inside.alias("bin"), F.lit(0).alias("b"), F.lit(1).alias("c"))
    )
    sides = both.groupBy("bin").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    # at most bins + 1 rows: gather them in one array and add the bins nobody fell into
    row = sides.agg(
        F.sum("b").alias("nb"), F.sum("c").alias("nc"),
        F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", F.struct("b", "c"))))).alias("m"),
    )
    share = lambda i, side, total: F.coalesce(F.col("m")[F.lit(i)][side], F.lit(0)) / F.col(total) + 1e-6
    total = F.lit(0.0)
    for i in range(bins):
        b, c = share(i, "b", "nb"), share(i, "c", "nc")
        total = total + (c - b) * F.log(c / b)
    return row.select(F.lit(feature).alias("feature"), total.alias("psi")).withColumn("drift", psi_label(F.col("psi")))


def psi_label(value: Column) -> Column:
    return F.when(value < 0.10, "none").when(value <= 0.25, "moderate").otherwise("significant")


def prediction_monitor(predictions: DataFrame) -> DataFrame:
    """Volume, mean, deviation and tier shares per model, version and date. A score of exactly 0.6
    counts as medium and as high, as the monitoring report defines them."""
    s, n = F.col("prediction_score"), F.count("*")
    share = lambda c: (count_if(c) * F.lit(1.0) / n).cast("double")
    return predictions.groupBy("model_name", "model_version", "prediction_date").agg(
        n.alias("predictions_made"), F.avg(s).alias("avg_score"), F.stddev_samp(s).alias("score_stddev"),
        count_if(F.col("prediction_tier") == "critical").alias("critical_count"),
        share(s < 0.3).alias("pct_low"), share(s.between(0.3, 0.6)).alias("pct_medium"), share(s >= 0.6).alias("pct_high"),
    )


def model_drift(log: DataFrame, value: str = "auc_roc") -> DataFrame:
    """Each evaluation of a model with the one before it and the change."""
    out = previous_values(log, ["model_name"], "evaluation_date", value, ["prev_auc"])
    return out.withColumn("auc_change", F.col(value) - F.col("prev_auc"))


def retrain_flag(log: DataFrame, drift: DataFrame, min_auc: float = 0.75, max_psi: float = 0.2) -> DataFrame:
    """Models whose latest AUC is too low or whose largest feature drift is too great."""
    latest = log.groupBy("model_name").agg(F.max_by("auc_roc", "evaluation_date").alias("auc_roc"))
    worst = drift.groupBy("model_name").agg(F.max("psi").alias("max_psi"))
    joined = latest.join(worst, "model_name", "left")
    bad = (F.col("auc_roc") < min_auc) | F.coalesce(F.col("max_psi") > max_psi, F.lit(False))
    return joined.withColumn("retrain", bad)


def group_metrics(scored: DataFrame, group: str, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Size, selection rate, precision and recall per group, for comparing groups."""
    y, guess = F.col(label).cast("int") == 1, F.col(score) >= threshold
    rate = lambda a, b: safe_div(count_if(a).cast("double"), count_if(b))
    return scored.groupBy(group).agg(
        F.count("*").alias("n"), (count_if(guess) / F.count("*")).alias("selection_rate"),
        (count_if(y) / F.count("*")).alias("positive_rate"),
        rate(y & guess, guess).alias("precision"), rate(y & guess, y).alias("recall"),
    )


