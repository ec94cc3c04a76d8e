"""Direct-mail campaign: eligibility, bucket assignment, mailing list and its checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from constituent360.functions.numbers import count_if
from constituent360.operators.totals import collapse, quantiles_of

# Bucket labels.
FIRST_YEAR = "Additional gift target - first year of giving"
LEADERSHIP = "Current leadership circle member"

# Output columns, in order.
MAILING_COLUMNS = (
    "crm_household_id", "crm_person_id", "household_address_line", "first_name", "street", "address_altline1", "city",
    "state_code", "country_name", "postal_code", "membership_sub_level_code", "member_journey_type_name",
    "most_recent_one_time_amount", "most_recent_one_time_date", "DirectMailSubType",
)
CRITICAL_COLUMNS = ("crm_household_id", "crm_person_id", "street", "city", "postal_code", "DirectMailSubType")


@dataclass(frozen=True)
class CampaignParams:
    """Everything a campaign changes; the lists are fixed values of the standard campaign."""

    recent_start: dt.date = dt.date(2025, 7, 1)
    recent_end: dt.date = dt.date(2026, 1, 26)
    first_year_cutoff: dt.date = dt.date(2025, 2, 1)
    leadership_threshold: int = 1200
    summary_type: str = "MEMBERSHIP_OVERALL - HOUSEHOLD"
    excluded_flags: tuple[str, ...] = ("Major Donor Prospect", "Major Donor", "Deceased", "No Mail", "No Renewals")
    segments: tuple[str, ...] = ("Active", "Dormant", "Lapsed", "Late", "New", "Renewal")


def excluded_households(flags: DataFrame, names: Sequence[str]) -> DataFrame:
    return flags.where(F.col("flag_name").isin(*names)).select("crm_household_id").distinct()


def eligible_constituents(t: dict[str, DataFrame], p: CampaignParams) -> DataFrame:
    """Household heads who may be mailed. Each filter is applied to its table before the joins."""
    family = t["account_family"].where(
        (F.col("family_role_code") == "HEAD_OF_HOUSEHOLD")
        & (F.col("record_status") == "A")
        & (F.col("do_not_contact") == "N")
    )
    address = t["primary_address"].where(
        (F.col("address_status_code") == "MAILABLE") & (F.col("address_contact_status") == "Y")
    )
    journey = t["member_journey"].where(F.col("member_journey_segment_name").isin(*p.segments))
    summary = t["gift_summary"].where(F.col("summary_type") == p.summary_type).select("crm_household_id", "first_gift_date")
    level = F.col("membership_sub_level_code")
    return (
        family.join(excluded_households(t["account_flag"], p.excluded_flags), "crm_household_id", "left_anti")
        .join(t["account"], "crm_household_id")
        .join(journey, "crm_household_id")
        .join(t["membership"], "crm_household_id", "left")
        .where(level.isNull() | (level != "MAJOR_DONOR"))
        .join(summary, "crm_household_id", "left")
        .join(address, "crm_person_id")
        .select(
            "crm_household_id", "crm_person_id", "household_address_line", "first_name", "street", "address_altline1",
            "city", "state_code", "country_name", "postal_code", "membership_sub_level_code",
            "member_journey_type_name", "most_recent_one_time_amount", "most_recent_one_time_date", "first_gift_date",
        )
    )


def standard_rules(p: CampaignParams) -> list[tuple[str, Column]]:
    """(label, condition) in priority order."""
    recent = (F.col("member_journey_type_name") == "One-Time") & F.col("most_recent_one_time_date").between(
        F.lit(p.recent_start), F.lit(p.recent_end)
    )
    amount = F.col("most_recent_one_time_amount")
    return [
        (FIRST_YEAR, recent & (F.col("first_gift_date") >= F.lit(p.first_year_cutoff)) & (amount < p.leadership_threshold)),
        (LEADERSHIP, recent & (amount >= p.leadership_threshold)),
    ]


def assign_buckets(df: DataFrame, rules: Sequence[tuple[str, Column]], name: str = "DirectMailSubType") -> DataFrame:
    """The label of the first rule that holds; none leaves the bucket empty."""
    bucket = F.lit(None).cast("string")
    for label, condition in reversed(list(rules)):
        bucket = F.when(condition, label).otherwise(bucket)
    return df.withColumn(name, bucket)


def mailing_list(t: dict[str, DataFrame], p: CampaignParams = CampaignParams()) -> DataFrame:
    rows = assign_buckets(eligible_constituents(t, p), standard_rules(p))
    return (
        rows.where(F.col("DirectMailSubType").isNotNull())
        .select(*MAILING_COLUMNS)
        .orderBy("DirectMailSubType", "postal_code", "crm_household_id")
    )


def dedupe_household(listing: DataFrame) -> DataFrame:
    """One row per household: the latest gift wins, then the largest, then the greater person id."""
    others = [c for c in listing.columns if c != "crm_household_id"]
    best = F.max_by(
        F.struct(*others), F.struct("most_recent_one_time_date", "most_recent_one_time_amount", "crm_person_id")
    )
    return listing.groupBy("crm_household_id").agg(best.alias("r")).select("crm_household_id", "r.*").select(*listing.columns)


def bucket_stats(listing: DataFrame) -> DataFrame:
    """Count, share, mean, exact median, total and range of the recent gift per bucket. Everything follows
    from the number of households per bucket and amount, so the list is read once."""
    counted = collapse(listing, "most_recent_one_time_amount", ["DirectMailSubType"], n=F.count("*"))
    amount, n = F.col("most_recent_one_time_amount"), F.col("n")
    total = F.sum(amount * n)
    stats = counted.groupBy("DirectMailSubType").agg(
        F.sum(n).alias("households"),
        (total.cast("double") / F.sum(F.when(amount.isNotNull(), n))).alias("mean_gift"),
        total.cast("decimal(18,2)").alias("total_gifts"),
        F.min(amount).alias("least_gift"),
        F.max(amount).alias("largest_gift"),
    )
    # one row per bucket: a window over it is a window over a handful of rows
    share = F.col("households") * 100.0 / F.sum("households").over(Window.partitionBy(F.lit(1)))
    medians = quantiles_of(counted.where(amount.isNotNull()), "most_recent_one_time_amount", [0.5], ["DirectMailSubType"])
    return stats.withColumn("share_pct", share.cast("double")).join(
        medians.withColumnRenamed("q0", "median_gift"), "DirectMailSubType", "left"
    )


def top_cities(listing: DataFrame, n: int = 5) -> DataFrame:
    return listing.groupBy("city").count().orderBy(F.col("count").desc(), "city").limit(n)


def campaign_funnel(t: dict[str, DataFrame], p: CampaignParams = CampaignParams()) -> DataFrame:
    """Rows left at each step. The first four steps look at one table each, not at each other."""
    bucketed = assign_buckets(eligible_constituents(t, p), standard_rules(p))
    flagged = excluded_households(t["account_flag"], p.excluded_flags).agg(F.count("*").alias("n"))
    households = t["account_family"].select("crm_household_id").agg(F.count_distinct("crm_household_id").alias("n"))
    unflagged = (
        households.unionByName(flagged.select((-F.col("n")).alias("n"))).agg(F.sum("n").alias("n"))
    )
    whole = bucketed.agg(F.count("*").alias("a"), F.count("DirectMailSubType").alias("b"))
    steps = [
        t["account_family"].agg(
            F.count("*").alias("a"), count_if(F.col("do_not_contact") == "N").alias("b")
        ).select(F.inline(F.array(_step(0, "all_households", "a"), _step(1, "not_do_not_contact", "b")))),
        t["primary_address"].agg(count_if(F.col("address_status_code") == "MAILABLE").alias("a"))
        .select(F.inline(F.array(_step(2, "mailable_address", "a")))),
        t["member_journey"].agg(count_if(F.col("member_journey_segment_name").isin(*p.segments)).alias("a"))
        .select(F.inline(F.array(_step(3, "eligible_segment", "a")))),
        unflagged.select(F.inline(F.array(_step(4, "no_exclusion_flag", "n")))),
        whole.select(F.inline(F.array(_step(5, "eligible", "a"), _step(6, "in_bucket", "b")))),
    ]
    out = steps[0]
    for step in steps[1:]:
        out = out.unionByName(step)
    return out


def _step(number: int, name: str, column: str) -> Column:
    return F.struct(F.lit(number).alias("step"), F.lit(name).alias("name"), F.col(column).cast("bigint").alias("rows"))


def validate_mailing_list(listing: DataFrame, p: CampaignParams = CampaignParams()) -> DataFrame:
    """Six content checks; the order of the written list is checked by ``is_sorted``."""
    critical = F.lit(False)
    for name in CRITICAL_COLUMNS:
        critical = critical | F.col(name).isNull()
    one_time = F.col("member_journey_type_name") == "One-Time"
    amount = F.col("most_recent_one_time_amount")
    bucket = F.col("DirectMailSubType")
    repeated = listing.groupBy("crm_household_id").count().agg(
        F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count") - 1)), F.lit(0)).alias("n")
    )
    missing = sum(c not in listing.columns for c in MAILING_COLUMNS)
    checks = listing.agg(
        count_if(critical).alias("a"),
        count_if(~F.coalesce(bucket.isin(FIRST_YEAR, LEADERSHIP), F.lit(False))).alias("b"),
        count_if((bucket == FIRST_YEAR) & ~F.coalesce(one_time & (amount < p.leadership_threshold), F.lit(False))).alias("c"),
        count_if((bucket == LEADERSHIP) & ~F.coalesce(one_time & (amount >= p.leadership_threshold), F.lit(False))).alias("d"),
        F.lit(missing).alias("e"),
    )
    name = lambda label, column: F.struct(F.lit(label).alias("check_name"), F.col(column).cast("bigint").alias("violations"))
    out = checks.select(F.inline(F.array(
        name("required_columns", "e"), name("critical_not_null", "a"), name("valid_bucket", "b"),
        name("first_year_logic", "c"), name("leadership_logic", "d"),
    ))).unionByName(repeated.select(F.inline(F.array(name("unique_household", "n")))))
    return out.withColumn("passed", F.col("violations") == 0)


def sort_violations(written: DataFrame, position: str) -> DataFrame:
    """Rows of a numbered list that sort before their predecessor. Each position meets the one before
    it in an equi-join, so no task reads the list in sequence."""
    key = F.struct("DirectMailSubType", "postal_code", "crm_household_id")
    here = written.select(F.col(position).alias("position"), key.alias("key"))
    before = written.select((F.col(position) + 1).alias("position"), key.alias("key_before"))
    met = here.join(before, "position", "left")
    return met.agg(F.count("*").alias("rows"), count_if(F.col("key") < F.col("key_before")).alias("violations"))


def campaign_report(listing: DataFrame, p: CampaignParams = CampaignParams()) -> DataFrame:
    """One row: the parameters, rows per bucket, total and mean gift."""
    amount = F.col("most_recent_one_time_amount")
    return listing.agg(
        F.lit(p.recent_start).alias("recent_start"),
        F.lit(p.recent_end).alias("recent_end"),
        F.lit(p.first_year_cutoff).alias("first_year_cutoff"),
        F.lit(p.leadership_threshold).alias("leadership_threshold"),
        F.count("*").alias("total_mailable"),
        count_if(F.col("DirectMailSubType") == FIRST_YEAR).alias("first_year_rows"),
        count_if(F.col("DirectMailSubType") == LEADERSHIP).alias("leadership_rows"),
        F.sum(amount).cast("decimal(18,2)").alias("total_value"),
        (F.sum(amount).cast("double") / F.count(amount)).alias("average_value"),
    )
