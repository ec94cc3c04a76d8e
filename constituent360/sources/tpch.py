"""Domain tables derived from TPC-H-like warehouse tables.

The warehouse holds orders, customers, line items and web events but no people, e-mail addresses or
phone numbers; those are derived from keys by integer arithmetic, so the same rows come out of any
SQL engine. Each function reads only the columns it needs.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2001, 8, 1)
EVENTS_AS_OF = dt.date(2024, 1, 31)

FIRST_NAMES = (
    "Ana", "Benjamin", "Carla", "Dmitri", "Elena", "Farid", "Grace", "Hugo", "Ines", "Jonathan",
    "Katherine", "Catherine", "Liam", "Mary", "Marie", "Noah", "Olivia", "Pablo", "Quentin", "Rosa",
)
LAST_NAMES = (
    "Adler", "Brooks", "Castillo", "Dubois", "Eriksen", "Fischer", "Garcia", "Hoffmann", "Ibsen",
    "Johnson", "Johnston", "Keller", "Lindqvist", "Moreau", "Novak", "Okafor", "Petrov", "Quinn",
    "Rossi", "Schmidt", "Schmitt", "Tanaka", "Ueda",
)
STREETS = (
    "Main Street", "Oak Avenue", "North Lake Road", "Cedar Lane", "Grand Boulevard", "West Park Drive", "Mill Court",
)
STREETS_SHORT = ("main st", "Oak Ave.", "N Lake Rd", "Cedar Ln", "Grand Blvd", "W. Park Dr", "Mill Ct")
CITIES = ("Chicago", "Evanston", "Oak Park", "Hyde Park")
EMAIL_TYPES = ("newsletter", "appeal", "event", "update")
CHANNELS = ("web", "mail", "phone", "radio")


def pick(values, index) -> F.Column:
    """The entry of a fixed list at a zero-based position."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def donations(spark, sf_dir) -> DataFrame:
    """Gifts: one per order."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        key.cast("string").alias("donation_id"),
        F.col("o_custkey").cast("string").alias("constituent_id"),
        F.col("o_orderdate").cast("date").alias("donation_date"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("donation_amount"),
        F.when(F.col("o_orderpriority").eqNullSafe("1-URGENT"), "recurring").otherwise("one_time").alias("donation_type"),
        # nested and null-safe, so that a test for "completed" folds to the stored column and reaches the scan
        F.when(F.col("o_orderstatus").eqNullSafe("F"), "completed")
        .otherwise(F.when(F.col("o_orderstatus").eqNullSafe("O"), "pending").otherwise("refunded"))
        .alias("donation_status"),
        F.col("o_orderpriority").alias("campaign_code"),
        pick(CHANNELS, key % 4).alias("source_channel"),
        F.lit("donations").alias("source_system"),
        key.cast("string").alias("source_record_id"),
    )


def constituents(spark, sf_dir) -> DataFrame:
    """Constituents with their giving summary: gifts are aggregated before the join."""
    gifts = (
        donations(spark, sf_dir)
        .where(F.col("donation_status") == "completed")
        .groupBy("constituent_id")
        .agg(
            F.min("donation_date").alias("first_donation_date"),
            F.max("donation_date").alias("last_donation_date"),
            F.sum("donation_amount").cast("decimal(18,2)").alias("total_lifetime_giving"),
            F.count("*").alias("total_gift_count"),
            F.max("donation_amount").alias("largest_single_gift"),
            (F.sum("donation_amount").cast("double") / F.count("*")).alias("average_gift_amount"),
            F.min(F.when(F.col("donation_type") == "recurring", F.col("donation_date"))).alias("sustainer_start_date"),
            F.max(F.when(F.col("donation_type") == "recurring", F.col("donation_date"))).alias(
                "last_successful_payment_date"
            ),
        )
    )
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    people = table(spark, sf_dir, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    key = F.col("c_custkey")
    base = people.select(
        key.cast("string").alias("constituent_id"),
        key.alias("_key"),
        pick(FIRST_NAMES, key % 20).alias("canonical_first_name"),
        pick(LAST_NAMES, key % 23).alias("canonical_last_name"),
        F.when(key % 41 == 0, F.concat(F.lit("user"), key.cast("string")))
        .when(key % 43 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")))
        .alias("canonical_email"),
        F.col("r_name").alias("primary_source"),
        F.col("n_name").alias("canonical_state"),
        F.col("c_mktsegment").alias("acquisition_channel"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("lifetime_value_estimate"),
    )
    joined = base.join(gifts, "constituent_id", "left")
    sustainer = F.col("sustainer_start_date").isNotNull()
    return joined.select(
        "constituent_id", "canonical_first_name", "canonical_last_name", "canonical_email", "primary_source",
        "canonical_state", "acquisition_channel", "lifetime_value_estimate", "first_donation_date",
        "last_donation_date",
        F.coalesce("total_lifetime_giving", F.lit(0).cast("decimal(18,2)")).alias("total_lifetime_giving"),
        F.coalesce("total_gift_count", F.lit(0)).alias("total_gift_count"),
        "largest_single_gift", "average_gift_amount",
        sustainer.alias("is_sustainer"),
        F.when(
            sustainer,
            F.when(F.col("_key") % 7 == 0, "cancelled").when(F.col("_key") % 7 == 1, "paused").otherwise("active"),
        ).alias("recurring_status"),
        F.when(sustainer, (F.col("_key") % 140 + 5).cast("decimal(10,2)")).alias("recurring_monthly_amount"),
        "sustainer_start_date", "last_successful_payment_date",
        F.when(F.col("_key") % 5 == 0, F.col("_key") % 4).otherwise(0).cast("int").alias("consecutive_failed_payments"),
        (F.col("_key") * 7919 % 10001 / F.lit(10000.0)).alias("churn_risk_score"),
    )


def subscriptions(spark, sf_dir) -> DataFrame:
    """Subscriptions: one per order line. Order and line number repeat in the source, so the id also names part,
    supplier and day."""
    lines = table(spark, sf_dir, "lineitem").withColumn("start_date", F.col("l_shipdate").cast("date"))
    owners = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("start_date", "yyyyMMdd")
        ).alias("subscription_id"),
        F.col("o_custkey").cast("string").alias("constituent_id"),
        F.when(F.col("l_returnflag") == "A", "DIGITAL")
        .when(F.col("l_returnflag") == "N", "WEEKEND")
        .otherwise("DAILY")
        .alias("subscription_type"),
        F.col("l_quantity").cast("decimal(10,2)").alias("monthly_rate"),
        F.when(F.col("l_linestatus") == "F", "active").otherwise("cancelled").alias("subscription_status"),
        "start_date",
        F.when(F.col("l_linenumber") % 3 == 0, F.date_add("start_date", 365)).alias("end_date"),
    )


def email_engagement(spark, sf_dir) -> DataFrame:
    """E-mail sends and reactions: one per web event."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("engagement_id"),
        F.col("user_id").cast("string").alias("constituent_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email_address"),
        pick(EMAIL_TYPES, F.col("event_id") % 4).alias("email_type"),
        pick(("new", "core", "lapsed"), F.col("user_id") % 3).alias("audience_segment"),
        F.col("ts").cast("date").alias("send_date"),
        F.when(F.col("event_type") == "error", "bounced").otherwise("delivered").alias("delivery_status"),
        F.col("event_type").isin("view", "click").alias("opened"),
        (F.col("event_type") == "click").alias("clicked"),
    )


def engagement_events(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("constituent_id"),
        "event_type",
        F.col("ts").cast("date").alias("event_date"),
        F.col("ts").alias("event_timestamp"),
        F.col("props").alias("event_attributes"),
        F.col("value").cast("decimal(12,2)").alias("donation_amount"),
    )


def predictions(spark, sf_dir) -> DataFrame:
    """Model scores: one per web event."""
    e = table(spark, sf_dir, "events")
    score = F.col("event_id") * 7919 % 10001 / F.lit(10000.0)
    return e.select(
        F.col("event_id").cast("string").alias("prediction_id"),
        F.col("user_id").cast("string").alias("constituent_id"),
        F.when(F.col("event_id") % 2 == 0, "churn_prediction").otherwise("upgrade_propensity").alias("model_name"),
        F.concat(F.lit("v"), (F.col("user_id") % 2 + 1).cast("string")).alias("model_version"),
        F.col("ts").cast("date").alias("prediction_date"),
        score.alias("prediction_score"),
        F.when(score >= 0.85, "critical").when(score >= 0.6, "high").when(score >= 0.3, "medium").otherwise("low").alias(
            "prediction_tier"
        ),
        F.col("props").alias("top_features"),
    )


def status_changes(spark, sf_dir) -> DataFrame:
    """Sustainer status changes: one per refunded order."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    return o.select(
        F.col("o_custkey").cast("string").alias("constituent_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "cancelled")
        .when(F.col("o_orderpriority") == "2-HIGH", "payment_failed_final")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "payment_failed")
        .otherwise("resumed")
        .alias("change_type"),
        F.col("o_orderdate").cast("date").alias("change_date"),
    )


def source_records(spark, sf_dir) -> DataFrame:
    """Raw contact rows of three source systems, with the usual disagreements between them.

    Customers appear in the donation system; those with orders appear again in the subscription
    system with abbreviated addresses and, for every third one, another e-mail; suppliers appear in
    the ticket system with a full name only. Some phones differ in the area code, some rows lack a
    phone, an e-mail or an address, and some use a role mailbox.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    number = (k * 37 % 900 + 100).cast("string")
    local = F.lpad((k * 104729 % 10000000).cast("string"), 7, "0")
    domain = F.concat(F.lit("mail"), (k % 61).cast("string"), F.lit(".org"))
    first, last = pick(FIRST_NAMES, k % 20), pick(LAST_NAMES, (k / 20).cast("bigint") % 23)
    zip_code = F.lpad(((k * 13) % 880 + 60000).cast("string"), 5, "0")
    ts = F.expr("timestamp_ntz'2023-01-01 00:00:00'")

    donors = c.select(
        F.lit("donations").alias("source_system"),
        F.concat(F.lit("D"), k.cast("string")).alias("source_id"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(k % 13 == 0, F.concat(F.lit("Info@"), domain))
        .otherwise(F.concat(F.lit(" User"), k.cast("string"), F.lit("@"), domain))
        .alias("email"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("(312) "), F.substring(local, 1, 3), F.lit("-"), F.substring(local, 4, 4)))
        .alias("phone"),
        first.alias("first_name"), last.alias("last_name"), F.lit(None).cast("string").alias("full_name"),
        F.concat(number, F.lit(" "), pick(STREETS, k % 7)).alias("address_line1"),
        pick(CITIES, k % 4).alias("city"), F.lit("IL").alias("state"),
        F.when(k % 5 == 0, F.concat(zip_code, F.lit("-1234"))).otherwise(zip_code).alias("zip_code"),
        (ts + F.make_dt_interval(days=(k % 365).cast("int"))).alias("updated_at"),
    )

    active = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    subscribers = active.select(
        F.lit("subscriptions").alias("source_system"),
        F.concat(F.lit("S"), k.cast("string")).alias("source_id"),
        F.when(k % 17 == 0, F.concat(F.lit("info@"), domain))
        .when(k % 3 == 0, F.concat(F.lit("alt"), k.cast("string"), F.lit("@"), domain))
        .otherwise(F.concat(F.lit("user"), k.cast("string"), F.lit("@"), domain))
        .alias("email"),
        F.when(k % 19 == 0, F.lit(""))
        .when(k % 6 == 0, F.concat(F.lit("773"), local))
        .otherwise(F.concat(F.lit("1-312-"), F.substring(local, 1, 3), F.lit("-"), F.substring(local, 4, 4)))
        .alias("phone"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(first).alias("first_name"),
        F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(last).alias("last_name"),
        F.when(k % 4 == 0, F.concat(first, F.lit(" M "), last)).alias("full_name"),
        F.concat(number, F.lit(" "), pick(STREETS_SHORT, k % 7)).alias("address_line1"),
        pick(CITIES, k % 4).alias("city"), F.lit("IL").alias("state"),
        zip_code.alias("zip_code"),
        F.when(k % 2 == 0, ts + F.make_dt_interval(days=((k * 7) % 365).cast("int"))).alias("updated_at"),
    )

    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"))
    tickets = s.select(
        F.lit("tickets").alias("source_system"),
        F.concat(F.lit("T"), k.cast("string")).alias("source_id"),
        F.concat(F.lit("user"), (k * 3).cast("string"), F.lit("@mail"), (k * 3 % 61).cast("string"), F.lit(".org")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("first_name"), F.lit(None).cast("string").alias("last_name"),
        F.concat(F.substring(pick(FIRST_NAMES, k * 3 % 20), 1, 1), F.lit(". "), pick(LAST_NAMES, (k * 3 / 20).cast("bigint") % 23)).alias("full_name"),
        F.lit(None).cast("string").alias("address_line1"),
        F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("state"),
        F.lit(None).cast("string").alias("zip_code"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    return donors.unionByName(subscribers).unionByName(tickets)


def crm_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The seven CRM tables of the direct-mail campaign."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    hh = F.concat(F.lit("HH-"), F.lpad(k.cast("string"), 8, "0")).alias("crm_household_id")
    person = F.concat(F.lit("PER-"), F.lpad(k.cast("string"), 8, "0")).alias("crm_person_id")
    gifts = (
        donations(spark, sf_dir)
        .where((F.col("donation_type") == "one_time") & (F.col("donation_status") != "refunded"))
        .groupBy(F.col("constituent_id").cast("bigint").alias("c_custkey"))
        .agg(
            F.max(F.struct("donation_date", F.col("donation_id").cast("bigint").alias("i"), "donation_amount")).alias("last"),
            F.min("donation_date").alias("first"),
        )
    )
    return {
        "account_family": c.select(
            hh, pick(FIRST_NAMES, k % 20).alias("first_name"),
            F.when(k % 29 == 0, "SPOUSE").otherwise("HEAD_OF_HOUSEHOLD").alias("family_role_code"),
            F.when(k % 31 == 0, "I").otherwise("A").alias("record_status"),
            F.when(k % 20 == 0, "Y").when(k % 37 == 0, F.lit(None)).otherwise("N").alias("do_not_contact"),
        ),
        "account": c.select(hh, person, F.concat((k % 400 + 1).cast("string"), F.lit(" Main St")).alias("household_address_line")),
        "primary_address": c.select(
            person, F.concat((k % 400 + 1).cast("string"), F.lit(" Main Street")).alias("street"),
            F.when(k % 4 == 1, "Suite 100").when(k % 4 == 2, "Apt 200").alias("address_altline1"),
            pick(CITIES, k % 4).alias("city"), F.lit("IL").alias("state_code"), F.lit("USA").alias("country_name"),
            (k % 100 + 60601).cast("string").alias("postal_code"),
            F.when(k % 10 == 3, "UNDELIVERABLE").otherwise("MAILABLE").alias("address_status_code"),
            F.when(k % 12 == 5, "N").otherwise("Y").alias("address_contact_status"),
        ),
        "account_flag": table(spark, sf_dir, "orders").select(
            F.concat(F.lit("HH-"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("crm_household_id"),
            F.when(
                F.col("o_orderkey") % 400 < 6,
                pick(
                    ("Major Donor Prospect", "Major Donor", "Deceased", "No Mail", "No Renewals", "Volunteer"),
                    F.col("o_orderkey") % 400,
                ),
            ).otherwise("Newsletter").alias("flag_name"),
        ),
        "member_journey": c.join(gifts, "c_custkey", "left").select(
            hh,
            pick(("One-Time", "Sustaining", "One-Time", "Monthly"), k % 4).alias("member_journey_type_name"),
            pick(("Active", "Dormant", "Lapsed", "Late", "New", "Renewal", "Suppressed"), k % 7).alias("member_journey_segment_name"),
            (F.col("last.donation_amount") * F.lit(Decimal("0.01"))).cast("decimal(12,2)").alias("most_recent_one_time_amount"),
            F.col("last.donation_date").alias("most_recent_one_time_date"),
        ),
        "membership": c.select(
            hh,
            F.when(k % 5 < 3, pick(("BASIC", "SUSTAINER", "LEADERSHIP", "BASIC", "MAJOR_DONOR"), k % 25 / F.lit(5))).alias("membership_sub_level_code"),
        ),
        "gift_summary": c.join(gifts, "c_custkey").select(
            hh, F.when(k % 9 == 0, "OTHER").otherwise("MEMBERSHIP_OVERALL - HOUSEHOLD").alias("summary_type"),
            F.when(k % 2 == 0, F.add_months(F.col("first"), 60)).otherwise(F.col("first")).alias("first_gift_date"),
        ),
    }
