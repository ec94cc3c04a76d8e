"""Risk tiers, recommended actions and dashboard figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from constituent360.functions.numbers import clip, count_if

# Action per churn tier.
TIER_ACTIONS = {
    "low": "Standard communications",
    "medium": "Engagement campaign; survey",
    "high": "Personal outreach; retention offer",
    "critical": "Urgent intervention; executive contact",
}
# Yearly value of each upgrade path.
PATH_VALUES = {"to_sustainer": 300.0, "sustainer_increase": 180.0, "to_major": 1000.0}
DEFAULT_CHURN = 0.3


def churn_tier(score: Column) -> Column:
    return (
        F.when(score >= 0.85, "critical").when(score >= 0.6, "high").when(score >= 0.3, "medium").otherwise("low")
    )


def dashboard_tier(score: Column) -> Column:
    """Right-closed bins of the dashboard, which differ from the model's tiers; 0 falls outside."""
    return (
        F.when((score > 0) & (score <= 0.3), "Low")
        .when((score > 0.3) & (score <= 0.6), "Medium")
        .when((score > 0.6) & (score <= 0.8), "High")
        .when((score > 0.8) & (score <= 1), "Critical")
    )


def tier_action(tier: Column) -> Column:
    return F.create_map(*[F.lit(v) for pair in TIER_ACTIONS.items() for v in pair])[tier]


def best_path(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """The greatest target score and its target; the first target wins a tie."""
    scores = [F.col(f"{t}_score") for t in targets]
    top = scores[0] if len(scores) == 1 else F.greatest(*scores)
    path = F.lit(None).cast("string")
    for target, score in reversed(list(zip(targets, scores))):
        path = F.when(score == top, target).otherwise(path)
    return df.withColumns({"upgrade_propensity": top, "best_path": path})


def recommendations(upgrade: DataFrame, churn: DataFrame | None = None, ordered: bool = True) -> DataFrame:
    """Four actions from two scores at 0.5, with a priority from 0 to 100."""
    recs = upgrade.select("constituent_id", "upgrade_propensity", "best_path")
    if churn is not None:
        recs = recs.join(churn.select("constituent_id", "churn_score"), "constituent_id", "left")
    else:
        recs = recs.withColumn("churn_score", F.lit(None).cast("double"))
    recs = recs.withColumn("churn_score", F.coalesce("churn_score", F.lit(DEFAULT_CHURN)))
    wants, leaves = F.col("upgrade_propensity") >= 0.5, F.col("churn_score") >= 0.5
    recs = recs.withColumns(
        {
            "action": F.when(wants & ~leaves, "prime_target").when(wants, "careful_ask")
            .when(~leaves, "nurture").otherwise("save_first"),
            "priority": clip(F.col("upgrade_propensity") * 100 - F.col("churn_score") * 50, 0.0, 100.0),
        }
    )
    return recs.orderBy(F.col("priority").desc(), "constituent_id") if ordered else recs


def dashboard_action(df: DataFrame) -> DataFrame:
    """Five ordered rules over churn risk, lifetime value and upgrade propensity."""
    churn, ltv, up = F.col("churn_risk"), F.col("lifetime_value"), F.col("upgrade_propensity")
    rules = [
        ((churn > 0.7) & (ltv > 100), "Save First", "CRITICAL"),
        ((churn > 0.6) & (ltv > 50), "Careful Ask", "HIGH"),
        (up > 0.7, "Prime Target", "HIGH"),
        (up > 0.5, "Consider Ask", "MEDIUM"),
    ]
    action, priority = F.lit("Nurture"), F.lit("LOW")
    for condition, name, rank in reversed(rules):
        action, priority = F.when(condition, name).otherwise(action), F.when(condition, rank).otherwise(priority)
    return df.withColumns({"action": action, "priority": priority})


def tier_distribution(df: DataFrame, tier: Column) -> DataFrame:
    counts = df.groupBy(tier.alias("tier")).agg(F.count("*").alias("n"))
    # a handful of tiers
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("pct", share.cast("double"))


def at_risk_value(df: DataFrame) -> DataFrame:
    """How many valuable constituents are at risk, and the value at risk."""
    risky = F.col("churn_risk") > 0.6
    return df.agg(
        count_if(risky & (F.col("lifetime_value") > 100)).alias("high_value_at_risk"),
        F.sum(F.when(risky, F.col("lifetime_value"))).alias("at_risk_value"),
    )


def expected_value(df: DataFrame, values: dict[str, float] | None = None) -> DataFrame:
    """Probability times yearly value per upgrade path, and their sum."""
    values = PATH_VALUES if values is None else values
    terms = {f"{path}_value": F.col(f"{path}_score") * worth for path, worth in values.items()}
    out = df.withColumns(terms)
    total = None
    for name in terms:
        total = F.col(name) if total is None else total + F.col(name)
    return out.withColumn("expected_value", total)
