"""Golden layer: source links, the wide constituent, its views, the 360-degree profile and the calendar.

Facts are always aggregated per constituent before they are joined, so each join meets one row per
key on both sides and a constituent with very many facts costs one partial aggregate per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from constituent360.functions.dates import (
    day, days_ago, days_since, fiscal_month, fiscal_quarter, fiscal_year, months_ago, tenure_months,
)
from constituent360.functions.numbers import count_if, safe_div
from constituent360.functions.text import full_name
from constituent360.operators.metrics import giving_summary


def attach_constituents(facts: DataFrame, links: DataFrame, keep_unmatched: bool = True) -> DataFrame:
    """Give facts their constituent through (source_system, source_record_id). Links are unique per
    source record, so a hot source record only widens the fact side, which AQE splits."""
    keys = ["source_system", "source_record_id"]
    return facts.join(
        links.select(*keys, F.col("constituent_id")), keys, "left" if keep_unmatched else "inner"
    )


def email_rates(emails: DataFrame, as_of) -> DataFrame:
    """Trailing 30- and 90-day e-mail behaviour per constituent."""
    m = F.col("send_date") >= days_ago(as_of, 30)
    sent, opened = count_if(m), count_if(m & F.col("opened"))
    return (
        emails.where(F.col("send_date") <= day(as_of))
        .groupBy("constituent_id")
        .agg(
            sent.alias("emails_received_30d"),
            opened.alias("emails_opened_30d"),
            safe_div(opened.cast("double"), sent).alias("email_open_rate_30d"),
            safe_div(count_if(m & F.col("clicked")).cast("double"), sent).alias("email_click_rate_30d"),
            safe_div(
                count_if((F.col("send_date") >= days_ago(as_of, 90)) & F.col("opened")).cast("double"),
                count_if(F.col("send_date") >= days_ago(as_of, 90)),
            ).alias("email_open_rate_90d"),
            F.max(F.when(F.col("opened"), F.col("send_date"))).alias("last_email_open_date"),
        )
    )


def latest_subscription(subscriptions: DataFrame) -> DataFrame:
    """The subscription that started last, per constituent; the greater id wins a tie."""
    latest = F.max_by(
        F.struct("subscription_type", "subscription_status", "start_date"),
        F.struct("start_date", "subscription_id"),
    )
    return subscriptions.groupBy("constituent_id").agg(latest.alias("s")).select(
        "constituent_id",
        F.lit(True).alias("is_subscriber"),
        F.col("s.subscription_type").alias("subscription_type"),
        F.col("s.subscription_status").alias("subscription_status"),
        F.col("s.start_date").alias("subscription_start_date"),
    )


def lifecycle_stage(as_of, major_gift: float = 1000.0, legacy: F.Column | None = None) -> F.Column:
    """Stage from giving behaviour: legacy prospects where flagged, then prospect (no gift), lapsed (no
    gift in twelve months), major donor (largest gift reaches the threshold), sustainer, one-time donor."""
    never = F.coalesce(F.col("total_gift_count"), F.lit(0)) == 0
    stage = (
        F.when(never, "prospect")
        .when(F.col("last_donation_date") < months_ago(as_of, 12), "lapsed")
        .when(F.col("largest_single_gift") >= major_gift, "major_donor")
        .when(F.col("is_sustainer") & (F.col("recurring_status") == "active"), "sustainer")
        .otherwise("one_time_donor")
    )
    return stage if legacy is None else F.when(legacy, "legacy_prospect").otherwise(stage)


def build_golden(
    constituents: DataFrame, donations: DataFrame, subscriptions: DataFrame, emails: DataFrame, as_of,
    major_gift: float = 1000.0,
) -> DataFrame:
    """The wide golden record: canonical fields, giving, subscription and e-mail behaviour and stage."""
    own = [c for c in constituents.columns if c not in giving_summary(donations).columns or c == "constituent_id"]
    wide = (
        constituents.select(*own)
        .join(giving_summary(donations), "constituent_id", "left")
        .join(latest_subscription(subscriptions), "constituent_id", "left")
        .join(
            email_rates(emails, as_of).select(
                "constituent_id", "email_open_rate_30d", "email_click_rate_30d", "last_email_open_date"
            ),
            "constituent_id",
            "left",
        )
    )
    return wide.withColumns(
        {
            "canonical_full_name": full_name(F.col("canonical_first_name"), F.col("canonical_last_name")),
            "total_lifetime_giving": F.coalesce("total_lifetime_giving", F.lit(0).cast("decimal(18,2)")),
            "total_gift_count": F.coalesce("total_gift_count", F.lit(0)),
            "is_subscriber": F.coalesce("is_subscriber", F.lit(False)),
        }
    ).withColumn("lifecycle_stage", lifecycle_stage(as_of, major_gift))


def v_active_members(constituents: DataFrame, as_of) -> DataFrame:
    return constituents.where(F.col("last_donation_date") >= months_ago(as_of, 12)).withColumn(
        "days_since_last_gift", days_since(F.col("last_donation_date"), as_of)
    )


def v_sustainers(constituents: DataFrame, as_of, tenure: str = "months_between") -> DataFrame:
    wanted = (
        "constituent_id", "canonical_email", "canonical_first_name", "canonical_last_name", "recurring_monthly_amount",
        "sustainer_start_date", "last_successful_payment_date", "consecutive_failed_payments", "churn_risk_score",
        "churn_risk_tier",
    )
    rows = constituents.where(F.col("is_sustainer") & (F.col("recurring_status") == "active"))
    return rows.select(
        *[c for c in wanted if c in constituents.columns],
        tenure_months(F.col("sustainer_start_date"), as_of, tenure).alias("sustainer_months"),
    )


def v_churn_risk(constituents: DataFrame, predictions: DataFrame, model: str = "churn_prediction", floor: float = 0.6) -> DataFrame:
    """High-risk constituents with the explanation from the model's latest run. The latest date is one
    value per model; it is found by an aggregate and met by an equi-join on the date."""
    mine = predictions.where(F.col("model_name") == model)
    latest = mine.agg(F.max("prediction_date").alias("prediction_date"))
    current = mine.join(latest, "prediction_date", "left_semi").select(
        "constituent_id", F.col("top_features").alias("churn_factors")
    )
    wanted = (
        "constituent_id", "canonical_email", "canonical_full_name", "lifecycle_stage", "is_sustainer",
        "recurring_monthly_amount", "churn_risk_score", "churn_risk_tier", "email_open_rate_30d",
    )
    return (
        constituents.where(F.col("churn_risk_score") >= floor)
        .select(*[c for c in wanted if c in constituents.columns])
        .join(current, "constituent_id", "left")
        .orderBy(F.col("churn_risk_score").desc(), "constituent_id")
    )


def profile_360(golden: DataFrame, source_systems: DataFrame | None = None) -> DataFrame:
    """One nested record per constituent, as JSON text."""
    rows = golden
    if source_systems is not None:
        rows = rows.join(source_systems, "constituent_id", "left")
    has = lambda *names: [F.col(n) for n in names if n in rows.columns]
    body = F.struct(
        *has("constituent_id", "canonical_email"),
        F.col("canonical_first_name").alias("first_name"),
        F.col("canonical_last_name").alias("last_name"),
        *has("lifecycle_stage", "source_systems"),
        F.struct(
            F.col("total_lifetime_giving").cast("double").alias("total_lifetime"),
            *has("is_sustainer"),
            F.col("recurring_monthly_amount").cast("double").alias("monthly_amount"),
        ).alias("giving_summary"),
        F.struct(*has("email_open_rate_30d", "email_click_rate_30d"), *has("subscription_status")).alias("engagement"),
        F.struct(*has("churn_risk_score")).alias("predictions"),
    )
    return rows.select("constituent_id", F.to_json(body, {"ignoreNullFields": "true"}).alias("profile"))


def churn_summary(golden: DataFrame, tier: F.Column) -> DataFrame:
    """Sustainers per risk tier, their share, and the monthly amount carried by the two upper tiers."""
    tiers = (
        golden.where(F.col("is_sustainer"))
        .groupBy(tier.alias("churn_tier"))
        .agg(F.count("*").alias("sustainers"), F.sum("recurring_monthly_amount").cast("decimal(18,2)").alias("monthly_amount"))
    )
    # four rows at most from here on
    from pyspark.sql import Window

    every = Window.partitionBy(F.lit(1))
    at_risk = F.col("churn_tier").isin("high", "critical")
    return tiers.select(
        "churn_tier", "sustainers",
        (F.col("sustainers") * 100.0 / F.sum("sustainers").over(every)).cast("double").alias("share_pct"),
        F.when(at_risk, F.col("monthly_amount")).otherwise(F.lit(0).cast("decimal(18,2)")).alias("monthly_at_risk"),
    )


def department_marts(golden: DataFrame) -> dict[str, DataFrame]:
    """Column subsets for the membership, development and marketing teams."""
    views = {
        "membership": ("constituent_id", "lifecycle_stage", "is_sustainer", "recurring_status", "recurring_monthly_amount",
                       "sustainer_start_date", "last_donation_date"),
        "development": ("constituent_id", "total_lifetime_giving", "total_gift_count", "largest_single_gift",
                        "average_gift_amount", "first_donation_date", "last_donation_date", "lifecycle_stage"),
        "marketing": ("constituent_id", "email_open_rate_30d", "email_click_rate_30d", "subscription_type",
                      "subscription_status", "acquisition_channel", "primary_source"),
    }
    return {name: golden.select(*[c for c in cols if c in golden.columns]) for name, cols in views.items()}


def dim_date(spark: SparkSession, start: dt.date, end: dt.date, fiscal_first_month: int = 7, **named) -> DataFrame:
    """One row for every calendar day of a range, without holes; see ``calendar``."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("full_date"))
    return calendar(days, fiscal_first_month, **named)


def _first_that_holds(cases) -> F.Column:
    """The name of the first (condition, name) that holds."""
    return F.coalesce(*[F.when(c, F.lit(name)) for c, name in cases], F.lit(None).cast("string"))


def calendar(
    days: DataFrame, fiscal_first_month: int = 7, drives: tuple[tuple[dt.date, dt.date, str], ...] = (),
    holidays: tuple[tuple[int, int, str], ...] = (),
) -> DataFrame:
    """Week, month, quarter, year and fiscal attributes of each day, the pledge drive (first day, last day, name) that it
    lies in and the holiday (month, day, name) that it is."""
    d = F.col("full_date")
    drive = _first_that_holds([(d.between(a, b), name) for a, b, name in drives])
    holiday = _first_that_holds([((F.month(d) == m) & (F.dayofmonth(d) == n), name) for m, n, name in holidays])
    week_start = F.date_sub(d, F.dayofweek(d) - 1)
    weekend = F.dayofweek(d).isin(1, 7)
    quarter_start = F.trunc(d, "quarter")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d,
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_weekday"),
        F.weekofyear(d).alias("week_of_year"),
        week_start.alias("week_start_date"),
        F.date_add(week_start, 6).alias("week_end_date"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.dayofmonth(F.last_day(d)).alias("days_in_month"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        quarter_start.alias("quarter_start_date"),
        F.date_sub(F.add_months(quarter_start, 3), 1).alias("quarter_end_date"),
        F.year(d).alias("year"),
        F.trunc(d, "year").alias("year_start_date"),
        F.date_sub(F.add_months(F.trunc(d, "year"), 12), 1).alias("year_end_date"),
        fiscal_year(d, fiscal_first_month).alias("fiscal_year"),
        fiscal_quarter(d, fiscal_first_month).alias("fiscal_quarter"),
        fiscal_month(d, fiscal_first_month).alias("fiscal_month"),
        drive.isNotNull().alias("is_pledge_drive"), drive.alias("pledge_drive_name"),
        holiday.isNotNull().alias("is_holiday"), holiday.alias("holiday_name"),
    )


def dim_campaign(donations: DataFrame, campaigns: DataFrame, as_of) -> DataFrame:
    """Campaigns with what they have raised so far and from how many givers."""
    actual = (
        donations.where(F.col("donation_status") == "completed")
        .groupBy("campaign_code")
        .agg(
            F.sum("donation_amount").cast("decimal(18,2)").alias("actual_amount"),
            F.countDistinct("constituent_id").alias("actual_donors"),
        )
    )
    return campaigns.join(actual, "campaign_code", "left").withColumn(
        "is_active", day(as_of).between(F.col("start_date"), F.col("end_date"))
    )


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows per stage and their total."""
    out = None
    for name, df in stages.items():
        row = df.agg(F.count("*").alias("records")).select(F.lit(name).alias("stage"), "records")
        out = row if out is None else out.unionByName(row)
    return out.unionByName(out.agg(F.lit("total").alias("stage"), F.sum("records").alias("records")))


def golden_of_records(
    people: DataFrame, gifts: DataFrame, subscriptions: DataFrame, as_of, major_gift: float = 1000.0, active_days: int = 90
) -> DataFrame:
    """The wide golden record of unified people: contact fields and their quality, giving, recurring gifts, subscription,
    first and last engagement, and stage. Facts come with the constituent that their source record is linked to; facts
    without one belong to nobody and are left to the caller. Each fact table is aggregated once."""
    from constituent360.operators.quality import quality_flags

    done = F.col("donation_status") == "completed"
    regular = done & (F.col("donation_type") == "recurring")
    date, amount = F.col("donation_date"), F.col("donation_amount")
    n = count_if(done)
    giving = gifts.where(F.col("constituent_id").isNotNull()).groupBy("constituent_id").agg(
        F.sum(F.when(done, amount)).cast("decimal(18,2)").alias("total_lifetime_giving"), n.alias("total_gift_count"),
        F.max(F.when(done, amount)).alias("largest_single_gift"),
        safe_div(F.sum(F.when(done, amount)).cast("double"), n).alias("average_gift_amount"),
        F.min(F.when(done, date)).alias("first_donation_date"), F.max(F.when(done, date)).alias("last_donation_date"),
        F.coalesce(F.bool_or(regular), F.lit(False)).alias("is_sustainer"),
        F.min(F.when(regular, date)).alias("sustainer_start_date"),
        F.max(F.when(regular, date)).alias("last_successful_payment_date"),
        F.min_by("campaign_code", F.when(done, F.struct(date, F.col("donation_id")))).alias("acquisition_campaign"),
    )
    subscribed = latest_subscription(subscriptions.where(F.col("constituent_id").isNotNull()))
    wide = people.join(giving, "constituent_id", "left").join(subscribed, "constituent_id", "left")
    wide = quality_flags(wide, "canonical_email", "canonical_phone", "canonical_address_line1")
    paid = F.col("last_successful_payment_date") >= days_ago(as_of, active_days)
    first = F.least("first_donation_date", "subscription_start_date")
    wide = wide.withColumns(
        {
            "canonical_full_name": full_name(F.col("canonical_first_name"), F.col("canonical_last_name")),
            "total_lifetime_giving": F.coalesce("total_lifetime_giving", F.lit(0).cast("decimal(18,2)")),
            "total_gift_count": F.coalesce("total_gift_count", F.lit(0)),
            "is_sustainer": F.coalesce("is_sustainer", F.lit(False)),
            "is_subscriber": F.coalesce("is_subscriber", F.lit(False)),
            "recurring_status": F.when(F.col("is_sustainer"), F.when(paid, "active").otherwise("failed")),
            "acquisition_date": first,
        }
    )
    return wide.withColumn("lifecycle_stage", lifecycle_stage(as_of, major_gift))
