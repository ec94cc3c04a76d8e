"""Model features and the daily feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from constituent360.functions.dates import day, days_ago, days_since, month_boundaries, months_ago
from constituent360.functions.numbers import clip, count_if, safe_div
from constituent360.operators.golden import email_rates

DAYS_PER_MONTH = 30.44

CHURN_FEATURES = (
    "days_since_last_engagement", "days_since_last_donation", "email_open_rate_30d", "email_click_rate_30d",
    "tenure_months", "total_gifts", "avg_gift_amount", "consecutive_failed_payments", "sustainer_months",
    "engagement_score",
)
UPGRADE_FEATURES = (
    "tenure_months", "total_gifts", "avg_gift", "max_gift", "gift_frequency", "days_since_gift", "email_open_rate",
    "events_attended", "engagement_score", "capacity_score",
)


def _known(df: DataFrame, name: str, expr, when_null: float, when_absent: float | None = None) -> Column:
    """The expression over a column, with one default for a missing value and one for a missing column."""
    if name not in df.columns:
        return F.lit(float(when_null if when_absent is None else when_absent))
    return F.coalesce(expr(F.col(name)).cast("double"), F.lit(float(when_null)))


def churn_features(df: DataFrame, as_of) -> DataFrame:
    days = lambda c: days_since(c, as_of)
    months = lambda c: days_since(c, as_of) / F.lit(DAYS_PER_MONTH)
    same = lambda c: c
    raw = df.select(
        "constituent_id",
        _known(df, "last_engagement_date", days, 999).alias("days_since_last_engagement"),
        _known(df, "last_donation_date", days, 999).alias("days_since_last_donation"),
        _known(df, "email_open_rate_30d", same, 0).alias("email_open_rate_30d"),
        _known(df, "email_click_rate_30d", same, 0).alias("email_click_rate_30d"),
        _known(df, "first_donation_date", months, 0).alias("tenure_months"),
        _known(df, "total_gift_count", same, 0).alias("total_gifts"),
        _known(df, "average_gift_amount", same, 0).alias("avg_gift_amount"),
        _known(df, "consecutive_failed_payments", same, 0).alias("consecutive_failed_payments"),
        _known(df, "sustainer_start_date", months, 0).alias("sustainer_months"),
    )
    idle = clip(F.col("days_since_last_engagement"), 0.0, 365.0) / 365
    return raw.withColumn(
        "engagement_score", clip((1 - idle) * 50 + F.col("email_open_rate_30d") * 50, 0.0, 100.0)
    )


def upgrade_features(df: DataFrame, as_of) -> DataFrame:
    same = lambda c: c
    raw = df.select(
        "constituent_id",
        clip(
            _known(df, "first_donation_date", lambda c: days_since(c, as_of) / F.lit(DAYS_PER_MONTH), 12), 0.0, 120.0
        ).alias("tenure_months"),
        _known(df, "total_gift_count", same, 1).alias("total_gifts"),
        _known(df, "average_gift_amount", same, 50).alias("avg_gift"),
        _known(df, "largest_single_gift", same, 50).alias("max_gift"),
        # a missing date counts as 60 days, a missing column as 30
        clip(_known(df, "last_donation_date", lambda c: days_since(c, as_of), 60, 30), 0.0, 365.0).alias("days_since_gift"),
        _known(df, "email_open_rate_30d", same, 0.3).alias("email_open_rate"),
        _known(df, "events_attended_12m", same, 0).alias("events_attended"),
    )
    years = F.greatest(F.col("tenure_months") / 12, F.lit(1.0))
    with_rate = raw.withColumn("gift_frequency", clip(F.col("total_gifts") / years, 0.0, 24.0))
    engagement = (
        (1 - F.col("days_since_gift") / 365) * 40
        + F.col("email_open_rate") * 30
        + clip(F.col("gift_frequency"), 0.0, 4.0) / 4 * 30
    )
    capacity = F.log1p("max_gift") * 10 + F.log1p(F.col("total_gifts") * F.col("avg_gift")) * 5
    scored = with_rate.withColumns(
        {"engagement_score": clip(engagement, 0.0, 100.0), "capacity_score": clip(capacity, 0.0, 100.0)}
    )
    return scored.select("constituent_id", *UPGRADE_FEATURES)


# Cut points of the recency, frequency and monetary scores (1 worst, 5 best). Fixed cuts keep a score
# comparable from day to day and need no global sort.
RECENCY_CUTS = (30, 90, 180, 365)
FREQUENCY_CUTS = (1.0, 2.0, 4.0, 8.0)
MONETARY_CUTS = (25.0, 50.0, 100.0, 250.0)


def score5(c: Column, cuts, ascending: bool = True) -> Column:
    """How many cut points the value reaches, from 1 to 5; descending scores reward small values."""
    reached = F.lit(1)
    for cut in cuts:
        reached = reached + ((c >= cut) if ascending else (c <= cut)).cast("int")
    return reached


def rfm_score(recency_days: Column, frequency: Column, monetary: Column,
              recency=RECENCY_CUTS, freq=FREQUENCY_CUTS, money=MONETARY_CUTS) -> Column:
    """Product of the three scores, 1 to 125."""
    return score5(recency_days, recency, False) * score5(frequency, freq) * score5(monetary, money)


def gift_trend(recent: Column, prior: Column, tolerance: float = 0.1) -> Column:
    """Giving of the last twelve months against the twelve before, within a tolerance."""
    return (
        F.when(recent > prior * (1 + tolerance), "increasing")
        .when(recent < prior * (1 - tolerance), "decreasing")
        .otherwise("stable")
    )


def giving_features(donations: DataFrame, as_of) -> DataFrame:
    """Giving history per constituent in one aggregation over completed gifts up to the date."""
    date, amount = F.col("donation_date"), F.col("donation_amount").cast("double")
    last = date >= months_ago(as_of, 12)
    prior = (date >= months_ago(as_of, 24)) & (date < months_ago(as_of, 12))
    done = donations.where((F.col("donation_status") == "completed") & (date <= day(as_of)))
    base = done.groupBy("constituent_id").agg(
        F.min(date).alias("first_gift"), F.max(date).alias("last_gift"), F.count("*").alias("total_gifts"),
        F.sum("donation_amount").cast("decimal(18,2)").alias("total_giving"),
        F.avg(amount).alias("avg_gift_amount"), F.max(amount).alias("max_gift_amount"),
        F.min(amount).alias("min_gift_amount"), F.stddev_samp(amount).alias("stddev_gift_amount"),
        count_if(last).alias("gifts_last_12m"), count_if(prior).alias("gifts_prior_12m"),
        F.coalesce(F.sum(F.when(last, F.col("donation_amount"))), F.lit(0)).cast("decimal(18,2)").alias("giving_last_12m"),
        F.coalesce(F.sum(F.when(prior, F.col("donation_amount"))), F.lit(0)).cast("decimal(18,2)").alias("giving_prior_12m"),
    )
    years = F.greatest(days_since(F.col("first_gift"), as_of) / F.lit(365.25), F.lit(1.0))
    return base.select(
        "constituent_id",
        days_since(F.col("last_gift"), as_of).alias("recency_days"),
        month_boundaries(F.col("first_gift"), as_of).alias("tenure_months"),
        *[c for c in base.columns if c not in ("constituent_id", "first_gift", "last_gift")],
        (F.col("total_gifts") / years).alias("frequency_annual"),
        gift_trend(F.col("giving_last_12m"), F.col("giving_prior_12m")).alias("gift_amount_trend"),
    ).withColumn("rfm_score", rfm_score(F.col("recency_days"), F.col("frequency_annual"), F.col("avg_gift_amount")))


def payment_features(donations: DataFrame, as_of) -> DataFrame:
    """Failed payments of the last twelve months, and how often a recurring gift was above or below the one before."""
    from constituent360.operators.totals import previous_values

    date = F.col("donation_date")
    seen = donations.where(date <= day(as_of))
    failed = (F.col("donation_status") != "completed") & (date >= months_ago(as_of, 12))
    failures = seen.groupBy("constituent_id").agg(count_if(failed).alias("payment_failures_12m"))
    regular = seen.where((F.col("donation_status") == "completed") & (F.col("donation_type") == "recurring"))
    rows = regular.select("constituent_id", F.struct("donation_date", "donation_id").alias("_at"), "donation_amount")
    steps = previous_values(rows, ["constituent_id"], "_at", "donation_amount").groupBy("constituent_id").agg(
        count_if(F.col("donation_amount") > F.col("previous")).alias("upgrade_count"),
        count_if(F.col("donation_amount") < F.col("previous")).alias("downgrade_count"),
    )
    return failures.join(steps, "constituent_id", "left")


def constituent_features(constituents, donations, subscriptions, emails, events, as_of) -> DataFrame:
    """The feature table for one date: per-constituent aggregates joined one to one."""
    activity = events.groupBy("constituent_id").agg(
        F.max("event_date").alias("last_event"),
        count_if((F.col("event_type") == "purchase") & (F.col("event_date") >= months_ago(as_of, 12))).alias("events_attended_12m"),
        count_if(F.col("event_type") == "purchase").alias("events_attended_all"),
    )
    subscribed = subscriptions.select("constituent_id").distinct().withColumn("has_subscription", F.lit(True))
    e = email_rates(emails, as_of)
    wide = (
        constituents.select("constituent_id", "is_sustainer", "sustainer_start_date")
        .join(giving_features(donations, as_of), "constituent_id", "left")
        .join(payment_features(donations, as_of), "constituent_id", "left")
        .join(e, "constituent_id", "left")
        .join(activity, "constituent_id", "left")
        .join(subscribed, "constituent_id", "left")
    )
    gave = F.col("total_gifts").isNotNull()
    came = F.coalesce(F.col("events_attended_all") > 0, F.lit(False))
    sub = F.coalesce("has_subscription", F.lit(False))
    zero = lambda n: F.coalesce(n, F.lit(0)).alias(n)
    out = wide.select(
        "constituent_id", day(as_of).alias("feature_date"),
        days_since(F.col("last_event"), as_of).alias("days_since_last_engagement"),
        F.col("recency_days").alias("days_since_last_donation"),
        days_since(F.col("last_email_open_date"), as_of).alias("days_since_last_email_open"),
        "email_open_rate_30d", "email_open_rate_90d", "email_click_rate_30d",
        zero("emails_received_30d"), zero("emails_opened_30d"), "tenure_months", zero("total_gifts"), "total_giving",
        "avg_gift_amount", "max_gift_amount", "min_gift_amount", "stddev_gift_amount", zero("gifts_last_12m"),
        "giving_last_12m", zero("gifts_prior_12m"), "giving_prior_12m", "gift_amount_trend", "is_sustainer",
        month_boundaries(F.col("sustainer_start_date"), as_of).alias("sustainer_months"),
        zero("payment_failures_12m"), zero("upgrade_count"), zero("downgrade_count"), "recency_days",
        "frequency_annual", F.col("avg_gift_amount").alias("monetary_avg"), "rfm_score", zero("events_attended_12m"),
        zero("events_attended_all"),
        (gave.cast("int") + sub.cast("int") + came.cast("int")).alias("num_source_systems"),
        gave.alias("has_donation"), sub.alias("has_subscription"), came.alias("has_event_attendance"),
    )
    return out


def with_vector(features: DataFrame, names) -> DataFrame:
    """The named features as one array, with their names, for model input."""
    return features.withColumns(
        {
            "feature_vector": F.array(*[F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in names]),
            "feature_names": F.array(*[F.lit(n) for n in names]),
        }
    )


def refresh_rows(constituents: DataFrame, as_of) -> DataFrame:
    """The daily refresh: nine values for each constituent who has given."""
    engaged = F.col("last_engagement_date") if "last_engagement_date" in constituents.columns else F.lit(None).cast("date")
    return constituents.where(F.col("total_gift_count") > 0).select(
        "constituent_id", day(as_of).alias("feature_date"),
        days_since(engaged, as_of).alias("days_since_last_engagement"),
        days_since(F.col("last_donation_date"), as_of).alias("days_since_last_donation"),
        month_boundaries(F.col("first_donation_date"), as_of).alias("tenure_months"),
        F.col("total_gift_count").alias("total_gifts"),
        F.col("total_lifetime_giving").alias("total_giving"),
        F.col("average_gift_amount").alias("avg_gift_amount"),
        "is_sustainer",
    )


def rfm_summary(donations: DataFrame, as_of) -> DataFrame:
    """Frequency (repeat gift days), recency, age and mean repeat value per giver: input of LTV models."""
    done = donations.where((F.col("donation_status") == "completed") & (F.col("donation_date") <= day(as_of)))
    days = done.groupBy("constituent_id", "donation_date").agg(F.sum("donation_amount").alias("amount"))
    per = days.groupBy("constituent_id").agg(
        F.count("*").alias("gift_days"), F.min("donation_date").alias("first"), F.max("donation_date").alias("last"),
        F.sum("amount").alias("total"), F.min_by("amount", "donation_date").alias("first_amount"),
    )
    repeats = F.col("gift_days") - 1
    return per.select(
        "constituent_id", repeats.alias("frequency"), F.datediff("last", "first").alias("recency"),
        days_since(F.col("first"), as_of).alias("T"),
        F.when(repeats > 0, (F.col("total") - F.col("first_amount")).cast("double") / repeats).otherwise(0.0).alias("monetary_value"),
    )


def gift_timing(donations: DataFrame, as_of) -> DataFrame:
    """Timing signals per giver: last gift against the mean, upgrades (a gift above the one before),
    days since the last upgrade, and the calendar quarter with most gifts."""
    from constituent360.operators.totals import previous_values

    done = donations.where((F.col("donation_status") == "completed") & (F.col("donation_date") <= day(as_of)))
    days = done.groupBy("constituent_id", "donation_date").agg(F.max("donation_amount").alias("amount"))
    seq = previous_values(days, ["constituent_id"], "donation_date", "amount")
    up, q = F.col("amount") > F.col("previous"), F.quarter("donation_date")
    counts = [count_if(q == i) for i in (1, 2, 3, 4)]
    most = F.greatest(*counts)
    return seq.groupBy("constituent_id").agg(
        (F.max_by("amount", "donation_date").cast("double") / F.avg(F.col("amount").cast("double"))).alias("recent_to_mean_ratio"),
        count_if(up).alias("upgrade_count"),
        days_since(F.max(F.when(up, F.col("donation_date"))), as_of).alias("days_since_last_upgrade"),
        F.when(counts[0] == most, 1).when(counts[1] == most, 2).when(counts[2] == most, 3).otherwise(4).alias("peak_quarter"),
    )


def extra_features(events: DataFrame, people: DataFrame, incomes: DataFrame, as_of, area: str) -> DataFrame:
    """Visits of the last 30 days, kinds of content used, and the median income of the area."""
    recent = F.col("event_date") >= days_ago(as_of, 30)
    used = events.groupBy("constituent_id").agg(
        count_if(recent & (F.col("event_type") == "view")).alias("website_visits_30d"),
        F.array_sort(F.collect_set("event_type")).alias("content_types"),
    )
    return people.select("constituent_id", area).join(used, "constituent_id", "left").join(incomes, area, "left").withColumn(
        "website_visits_30d", F.coalesce("website_visits_30d", F.lit(0))
    )
