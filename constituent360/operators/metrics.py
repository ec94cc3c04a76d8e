"""Governed metric catalogue. A metric is a function of the golden tables and a measurement date.

Every metric can be cut by one of its declared dimensions; the label comes back as a column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from constituent360.functions.dates import (
    day, days_ago, fiscal_year_start, month_boundaries, months_ago, year_boundaries,
)
from constituent360.functions.numbers import band, count_if, percent, safe_div

# Band labels.
MONTHLY_AMOUNT = ((10, 25, 50, 100), ("Under $10", "$10-24", "$25-49", "$50-99", "$100+"))
TENURE = ((6, 12, 24), ("New (0-6 mo)", "6-12 mo", "1-2 years", "2+ years"))
LAPSE = ((18, 24, 36), ("12-18 months", "18-24 months", "2-3 years", "3+ years"))


@dataclass(frozen=True)
class Rule:
    """A check on a metric value; ``test`` is a SQL condition over value and previous_value."""

    name: str
    test: str
    severity: str


@dataclass(frozen=True)
class Metric:
    name: str
    title: str
    category: str
    owner: str
    value: str
    compute: Callable
    definition: str = ""
    version: str = "1.0.0"
    dimensions: dict[str, Callable[[dt.date], Column]] = field(default_factory=dict)
    rules: tuple[Rule, ...] = ()
    caveats: tuple[str, ...] = ()


def _by(df: DataFrame, label, as_of, *aggregates) -> DataFrame:
    """Aggregate whole, by one label, or (given a dict of labels) whole and by each label in one scan."""
    if label is None:
        return df.agg(*aggregates)
    if isinstance(label, dict):
        cuts = [F.struct(F.lit(None).cast("string").alias("k"), F.lit(None).cast("string").alias("v"))]
        cuts += [F.struct(F.lit(k).alias("k"), f(as_of).cast("string").alias("v")) for k, f in label.items()]
        cut = df.withColumn("_cut", F.explode(F.array(*cuts)))
        return cut.groupBy(F.col("_cut.k").alias("dimension"), F.col("_cut.v").alias("dimension_value")).agg(*aggregates)
    return df.groupBy(label(as_of).alias("dimension_value")).agg(*aggregates)


def completed(donations: DataFrame) -> DataFrame:
    return donations.where(F.col("donation_status") == "completed")


def donors_since(donations: DataFrame, since: Column) -> DataFrame:
    """Distinct givers: the partial aggregation collapses a hot giver before the shuffle."""
    return (
        completed(donations).where(F.col("donation_date") >= since).select("constituent_id").distinct()
    )


def active_members(constituents: DataFrame, donations: DataFrame, as_of, months: int = 12) -> DataFrame:
    """Constituents with a completed gift in the trailing window."""
    return constituents.join(donors_since(donations, months_ago(as_of, months)), "constituent_id", "left_semi")


def _distinct(name: str) -> Column:
    return F.countDistinct("constituent_id").alias(name)


def _active(months: int, name: str):
    def compute(t, as_of, label):
        return _by(active_members(t["constituents"], t["donations"], as_of, months), label, as_of, _distinct(name))

    return compute


def _active_fiscal(t, as_of, label):
    donors = donors_since(t["donations"], day(fiscal_year_start(as_of)))
    members = t["constituents"].join(donors, "constituent_id", "left_semi")
    return _by(members, label, as_of, _distinct("active_member_fiscal_count"))


def _sustaining(t, as_of, label):
    rows = t["constituents"].where(
        F.col("is_sustainer")
        & (F.col("recurring_status") == "active")
        & (F.col("last_successful_payment_date") >= days_ago(as_of, 90))
    )
    return _by(rows, label, as_of, _distinct("sustaining_member_count"))


def _lapsed(t, as_of, label):
    rows = t["constituents"].where(
        (F.col("total_lifetime_giving") > 0) & (F.col("last_donation_date") < months_ago(as_of, 12))
    )
    return _by(rows, label, as_of, _distinct("lapsed_member_count"))


def _recent_gifts(t, as_of):
    return completed(t["donations"]).where(F.col("donation_date") >= months_ago(as_of, 12))


def _money(c: Column) -> Column:
    return F.sum(c).cast("decimal(18,2)")


def _revenue(t, as_of, label):
    return _by(_recent_gifts(t, as_of), label, as_of, _money(F.col("donation_amount")).alias("total_revenue_t12m"))


def _average_gift(t, as_of, label):
    amount = F.col("donation_amount")
    return _by(
        _recent_gifts(t, as_of), label, as_of,
        (F.sum(amount).cast("double") / F.count("*")).alias("average_gift_amount"),
        _money(amount).alias("total_revenue"),
        F.count("*").alias("gift_count"),
    )


def _retention(t, as_of, label):
    """A gift exactly twelve months back counts in both periods, so one pass flags each giver twice."""
    date = F.col("donation_date")
    givers = (
        completed(t["donations"])
        .where(date >= months_ago(as_of, 24))
        .groupBy("constituent_id")
        .agg(
            F.bool_or(date <= months_ago(as_of, 12)).alias("prior"),
            F.bool_or(date >= months_ago(as_of, 12)).alias("again"),
        )
    )
    prior, both = count_if(F.col("prior")), count_if(F.col("prior") & F.col("again"))
    return givers.agg(
        percent(both, prior).alias("retention_rate"),
        prior.alias("prior_year_count"),
        both.alias("retained_count"),
    )


def _churn_rate(t, as_of, label):
    """Two counts over different tables: stacked and summed, so no join is needed."""
    month = F.trunc(day(as_of), "month")
    churned = (
        t["status_changes"]
        .where(F.col("change_type").isin("cancelled", "payment_failed_final") & (F.col("change_date") >= month))
        .agg(_distinct("churn_count"), F.lit(0).cast("bigint").alias("start_count"))
    )
    at_start = (
        t["constituents"]
        .where(F.col("is_sustainer") & (F.col("recurring_status") == "active"))
        .agg(F.lit(0).cast("bigint").alias("churn_count"), _distinct("start_count"))
    )
    return churned.unionByName(at_start).agg(
        percent(F.sum("churn_count"), F.sum("start_count")).alias("churn_rate"),
        F.sum("churn_count").alias("churn_count"),
        F.sum("start_count").alias("start_count"),
    )


def _open_rate(t, as_of, label):
    sent = t["emails"].where(
        (F.col("send_date") >= days_ago(as_of, 30)) & (F.col("delivery_status") == "delivered")
    )
    opened = count_if(F.col("opened"))
    return _by(
        sent, label, as_of,
        percent(opened, F.count("*")).alias("open_rate"),
        F.count("*").alias("emails_sent"),
        opened.alias("emails_opened"),
    )


def _subscribers(t, as_of, label):
    live = t["subscriptions"].where(
        (F.col("subscription_status") == "active")
        & (F.col("end_date").isNull() | (F.col("end_date") > day(as_of)))
    )
    return _by(live, label, as_of, _distinct("active_subscriber_count"))


def _lifetime_value(t, as_of, label):
    """One row per constituent, not an aggregate."""
    years = year_boundaries(F.col("first_donation_date"), as_of)
    return t["constituents"].where(F.col("total_lifetime_giving") > 0).select(
        "constituent_id",
        "total_lifetime_giving",
        years.alias("tenure_years"),
        safe_div(F.col("total_lifetime_giving").cast("double"), years).alias("avg_annual_giving"),
        F.col("lifetime_value_estimate").alias("estimated_ltv"),
    )


def _column(name: str):
    return lambda as_of: F.col(name)


# Names, titles, owners, rules and thresholds of the metric definitions.
_POSITIVE = Rule("positive_count", "value >= 0", "error")

CATALOG: dict[str, Metric] = {
    m.name: m
    for m in (
        Metric(
            "active_member", "Active Member", "membership", "VP, Membership", "active_member_count",
            _active(12, "active_member_count"),
            "Constituents with at least one completed gift in the trailing twelve months.",
            dimensions={
                "by_source": _column("primary_source"),
                "by_gift_type": lambda as_of: F.when(F.col("is_sustainer"), "Recurring").otherwise("One-time"),
                "by_acquisition_year": lambda as_of: F.year("first_donation_date"),
            },
            rules=(
                _POSITIVE,
                Rule("reasonable_range", "value BETWEEN 50000 AND 150000", "warning"),
                Rule("day_over_day_change", "abs(value - previous_value) / nullif(previous_value, 0) < 0.05", "warning"),
            ),
            caveats=("No grace month; see active_member_with_grace.", "Ticket-only buyers do not count."),
        ),
        Metric(
            "active_member_with_grace", "Active Member (with Grace)", "membership", "VP, Membership",
            "active_member_grace_count", _active(13, "active_member_grace_count"),
            "As active_member, with one month of grace to renew.",
            caveats=("For retention analysis, not for official counts.",),
        ),
        Metric(
            "active_member_fiscal", "Active Member (fiscal year)", "membership", "CFO", "active_member_fiscal_count",
            _active_fiscal, "Constituents with a completed gift since the start of the fiscal year (1 July).",
        ),
        Metric(
            "sustaining_member", "Sustaining Member", "membership", "Director, Membership",
            "sustaining_member_count", _sustaining,
            "Active recurring givers with a successful payment in the last 90 days.",
            dimensions={
                "by_monthly_amount": lambda as_of: band(F.col("recurring_monthly_amount"), *MONTHLY_AMOUNT),
                "by_tenure": lambda as_of: band(month_boundaries(F.col("sustainer_start_date"), as_of), *TENURE),
            },
        ),
        Metric(
            "lapsed_member", "Lapsed Member", "membership", "Director, Membership", "lapsed_member_count", _lapsed,
            "Past givers without a gift in the trailing twelve months.",
            dimensions={
                "by_lapse_duration": lambda as_of: band(month_boundaries(F.col("last_donation_date"), as_of), *LAPSE)
            },
        ),
        Metric(
            "total_revenue_t12m", "Total Revenue (T12M)", "revenue", "CFO", "total_revenue_t12m", _revenue,
            "Completed gifts of the trailing twelve months.",
            dimensions={
                "by_gift_type": _column("donation_type"),
                "by_campaign": _column("campaign_code"),
                "by_channel": _column("source_channel"),
            },
            rules=(Rule("revenue_positive", "value >= 0", "error"), Rule("month_over_month_variance", "abs(value - previous_value) / nullif(previous_value, 0) < 0.20", "warning")),
        ),
        Metric(
            "average_gift_amount", "Average Gift Amount", "revenue", "VP, Development", "average_gift_amount",
            _average_gift, "Mean completed gift of the trailing twelve months.",
        ),
        Metric(
            "donor_retention_rate", "Donor Retention Rate", "retention", "VP, Development", "retention_rate",
            _retention, "Share of last year's givers who gave again.",
            rules=(
                Rule("valid_percentage", "value BETWEEN 0 AND 100", "error"),
                Rule("reasonable_retention", "value BETWEEN 30 AND 80", "warning"),
            ),
        ),
        Metric(
            "sustainer_churn_rate", "Sustainer Churn Rate", "retention", "Director, Membership", "churn_rate",
            _churn_rate, "Sustainers lost this month as a share of active sustainers.",
        ),
        Metric(
            "email_open_rate", "Email Open Rate", "engagement", "Director, Marketing", "open_rate", _open_rate,
            "Opened share of delivered e-mails, trailing 30 days.",
            dimensions={"by_email_type": _column("email_type"), "by_audience_segment": _column("audience_segment")},
        ),
        Metric(
            "active_subscriber", "Active Subscriber", "subscription", "Director, Circulation",
            "active_subscriber_count", _subscribers, "Constituents with a running subscription.",
            dimensions={"by_subscription_type": _column("subscription_type")},
        ),
        Metric(
            "lifetime_value", "Lifetime Value (LTV)", "value", "VP, Development", "estimated_ltv", _lifetime_value,
            "Giving per year of tenure and the estimated lifetime value, per constituent.",
        ),
    )
}


def list_metrics(category: str | None = None) -> list[str]:
    return [m.name for m in CATALOG.values() if category is None or m.category == category]


def metric(tables: dict[str, DataFrame], name: str, as_of: dt.date, dimension: str | None = None) -> DataFrame:
    """Compute one metric. A dimension the metric does not declare is ignored; an unknown metric is an error."""
    if name not in CATALOG:
        raise ValueError(f"Unknown metric: {name}")
    m = CATALOG[name]
    return m.compute(tables, as_of, m.dimensions.get(dimension) if dimension else None)


def catalog_df(spark: SparkSession, category: str | None = None) -> DataFrame:
    rows = [
        (m.name, m.title, m.category, m.owner, m.definition, m.version, sorted(m.dimensions), list(m.caveats))
        for m in CATALOG.values()
        if category is None or m.category == category
    ]
    return spark.createDataFrame(
        rows,
        "name string, title string, category string, owner string, definition string, version string, "
        "dimensions array<string>, caveats array<string>",
    )


def compute_metrics(tables: dict[str, DataFrame], names, as_of: dt.date) -> DataFrame:
    """Long table of metric values, with one row per metric and per value of each dimension.

    Each metric scans its tables once, whatever the number of dimensions.
    """
    parts = []
    for name in names:
        m = CATALOG[name]
        df = m.compute(tables, as_of, m.dimensions or None)
        if not m.dimensions:
            blank = F.lit(None).cast("string")
            df = df.withColumns({"dimension": blank, "dimension_value": blank})
        parts.append(
            df.select(
                F.lit(name).alias("metric"),
                F.col(m.value).cast("double").alias("value"),
                F.lit(as_of).alias("as_of"),
                F.lit(m.version).alias("version"),
                "dimension",
                "dimension_value",
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def with_previous(results: DataFrame) -> DataFrame:
    """Metric values with the value at the measurement before."""
    from constituent360.operators.totals import previous_values

    return previous_values(results, ["metric"], "as_of", "value", ["previous_value"])


def check_metrics(results: DataFrame) -> DataFrame:
    """Apply each metric's rules. A rule that needs a previous value passes when there is none, or zero."""
    checks = F.array(
        *[
            F.struct(
                F.lit(m.name).alias("metric"), F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                F.coalesce(F.expr(r.test), F.lit(True)).alias("passed"),
            )
            for m in CATALOG.values()
            for r in m.rules
        ]
    )
    mine = F.filter(checks, lambda c: c["metric"] == F.col("metric"))
    return (
        with_previous(results)
        .withColumn("c", F.explode(mine))
        .select("metric", "as_of", "value", "previous_value", F.col("c.rule").alias("rule"),
                F.col("c.severity").alias("severity"), F.col("c.passed").alias("passed"))
    )


def check_subset(results: DataFrame, part: str = "sustaining_member", whole: str = "active_member") -> DataFrame:
    """A part may not exceed its whole at any measurement."""
    return (
        results.where(F.col("metric").isin(part, whole))
        .groupBy("as_of")
        .agg(
            F.max(F.when(F.col("metric") == part, F.col("value"))).alias("part_value"),
            F.max(F.when(F.col("metric") == whole, F.col("value"))).alias("whole_value"),
        )
        .withColumn("passed", F.col("part_value") <= F.col("whole_value"))
    )


def metric_anomalies(results: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Values that moved by more than the threshold since the measurement before."""
    change = F.abs(F.col("value") - F.col("previous_value")) / F.nullif(F.col("previous_value"), F.lit(0.0))
    return with_previous(results).withColumn("change", change).where(F.col("change") > threshold)


def active_member_summary(donations: DataFrame, as_of, months: int = 12) -> DataFrame:
    """Gift count and total per constituent over the trailing window."""
    return (
        donations.where(F.col("donation_date") >= months_ago(as_of, months))
        .groupBy("constituent_id")
        .agg(F.count("*").alias("gift_count"), _money(F.col("donation_amount")).alias("total"))
    )


def giving_summary(donations: DataFrame) -> DataFrame:
    """Lifetime giving per constituent over completed gifts."""
    amount, date = F.col("donation_amount"), F.col("donation_date")
    return (
        completed(donations)
        .groupBy("constituent_id")
        .agg(
            _money(amount).alias("total_lifetime_giving"),
            F.count("*").alias("total_gift_count"),
            F.max(amount).alias("largest_single_gift"),
            (F.sum(amount).cast("double") / F.count("*")).alias("average_gift_amount"),
            F.min(date).alias("first_donation_date"),
            F.max(date).alias("last_donation_date"),
        )
    )


def acquisition_cost(new_donors: DataFrame, spend: DataFrame, on: str) -> DataFrame:
    """Spend per new donor, by the shared label."""
    donors = new_donors.groupBy(on).agg(F.count("*").alias("new_donors"))
    cost = spend.groupBy(on).agg(F.sum("spend").alias("spend"))
    return cost.join(donors, on, "left").withColumn(
        "acquisition_cost", safe_div(F.col("spend").cast("double"), F.col("new_donors"))
    )


def email_engagement_score(emails: DataFrame, as_of, open_weight: float = 1.0, click_weight: float = 2.0) -> DataFrame:
    """Weighted opens and clicks per constituent over 30 days; the weights are the caller's."""
    return (
        emails.where(F.col("send_date") >= days_ago(as_of, 30))
        .groupBy("constituent_id")
        .agg((count_if(F.col("opened")) * open_weight + count_if(F.col("clicked")) * click_weight).alias("email_engagement_score"))
    )
