import datetime as dt

import pytest
from pyspark.sql import functions as F

from constituent360.operators import campaign as C
from constituent360.operators.totals import number_rows

P = C.CampaignParams()


@pytest.fixture(scope="module")
def tables(spark):
    # household, amount, gift date, first gift, journey, level, flag, summary type, segment, contact
    s, e, cut = P.recent_start, P.recent_end, P.first_year_cutoff
    day = dt.timedelta(days=1)
    base = dict(amount=100, date=s, first=cut, journey="One-Time", level=None, flag=None, summary=P.summary_type, segment="Active", contact="N")
    cases = {
        "first_year": {}, "at_threshold": dict(amount=1200), "under": dict(amount=1199), "end_edge": dict(date=e), "too_early": dict(date=s - day),
        "too_late": dict(date=e + day), "no_first": dict(first=None), "old_first": dict(first=cut - day), "leader_no_first": dict(first=None, amount=5000),
        "sustaining": dict(journey="Sustaining"), "major": dict(level="MAJOR_DONOR"), "basic": dict(level="BASIC"), "volunteer": dict(flag="Volunteer"),
        "other_summary": dict(summary="OTHER"), "suppressed": dict(segment="Suppressed"), "no_contact": dict(contact="Y"), "null_contact": dict(contact=None),
        **{f"flag_{i}": dict(flag=f) for i, f in enumerate(P.excluded_flags)},
    }
    rows = [{**base, **v, "hh": k} for k, v in cases.items()]
    df = spark.createDataFrame(
        [(r["hh"], r["amount"], r["date"], r["first"], r["journey"], r["level"], r["flag"], r["summary"], r["segment"], r["contact"]) for r in rows],
        "hh string, amount int, date date, first date, journey string, level string, flag string, summary string, segment string, contact string",
    )
    hh, lit = F.col("hh").alias("crm_household_id"), F.lit
    return {
        "account_family": df.select(hh, lit("F").alias("first_name"), lit("HEAD_OF_HOUSEHOLD").alias("family_role_code"), lit("A").alias("record_status"), F.col("contact").alias("do_not_contact")),
        "account": df.select(hh, F.col("hh").alias("crm_person_id"), lit("x").alias("household_address_line")),
        "primary_address": df.select(
            F.col("hh").alias("crm_person_id"), lit("s").alias("street"), lit(None).cast("string").alias("address_altline1"), lit("c").alias("city"), lit("IL").alias("state_code"),
            lit("USA").alias("country_name"), F.substring(F.reverse("hh"), 1, 2).alias("postal_code"), lit("MAILABLE").alias("address_status_code"), lit("Y").alias("address_contact_status"),
        ),
        "account_flag": df.where("flag is not null").select(hh, F.col("flag").alias("flag_name")),
        "member_journey": df.select(hh, F.col("journey").alias("member_journey_type_name"), F.col("segment").alias("member_journey_segment_name"),
                                    F.col("amount").cast("decimal(12,2)").alias("most_recent_one_time_amount"), F.col("date").alias("most_recent_one_time_date")),
        "membership": df.where("level is not null").select(hh, F.col("level").alias("membership_sub_level_code")),
        "gift_summary": df.select(hh, F.col("summary").alias("summary_type"), F.col("first").alias("first_gift_date")),
    }


def test_buckets(tables):
    got = {r["crm_household_id"]: r["DirectMailSubType"] for r in C.mailing_list(tables).collect()}
    first = {"first_year", "under", "end_edge", "basic", "volunteer"}
    assert got == {**{k: C.FIRST_YEAR for k in first}, "at_threshold": C.LEADERSHIP, "leader_no_first": C.LEADERSHIP}


def test_checks_and_report(tables):
    listing = C.mailing_list(tables)
    assert listing.columns == list(C.MAILING_COLUMNS)
    assert all(r["passed"] for r in C.validate_mailing_list(listing).collect())
    broken = listing.unionByName(listing.limit(1)).withColumn("DirectMailSubType", F.lit(C.LEADERSHIP))
    failed = {r["check_name"] for r in C.validate_mailing_list(broken).collect() if not r["passed"]}
    assert failed == {"unique_household", "leadership_logic"}
    report = C.campaign_report(listing).first()
    assert (report["total_mailable"], report["leadership_rows"]) == (7, 2)
    assert C.dedupe_household(listing.unionByName(listing)).count() == 7


def test_sorted(tables):
    numbered = number_rows(C.mailing_list(tables))
    assert C.sort_violations(numbered, "position").first()["violations"] == 0
    swapped = numbered.withColumn("position", -F.col("position"))
    assert C.sort_violations(swapped, "position").first()["violations"] == 6


def test_parameters_change_the_result(tables):
    low = C.CampaignParams(leadership_threshold=50)
    assert {r["DirectMailSubType"] for r in C.mailing_list(tables, low).collect()} == {C.LEADERSHIP}
