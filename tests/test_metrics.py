import datetime as dt

import pytest
from pyspark.sql import functions as F

from constituent360.operators import metrics

AS_OF = dt.date(2024, 8, 1)


def d(months=0, days=0):
    month = AS_OF.month - 1 - months
    return dt.date(AS_OF.year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=days)


@pytest.fixture(scope="module")
def tables(spark):
    gifts = [
        ("edge12", d(12), "completed"), ("past12", d(12, 1), "completed"), ("edge13", d(13), "completed"),
        ("edge24", d(24), "completed"), ("past24", d(24, 1), "completed"), ("refund", d(1), "refunded"),
        ("both", d(20), "completed"), ("both", d(2), "completed"),
    ]
    donations = spark.createDataFrame(gifts, "constituent_id string, donation_date date, donation_status string").withColumns(
        {"donation_amount": F.lit(10).cast("decimal(12,2)"), "donation_type": F.lit("one_time"), "campaign_code": F.lit("c"), "source_channel": F.lit("web")}
    )
    people = [(c, c != "refund") for c in sorted({g[0] for g in gifts})]
    constituents = spark.createDataFrame(people, "constituent_id string, is_sustainer boolean").withColumns(
        {
            "primary_source": F.lit("s"), "recurring_status": F.lit("active"), "last_successful_payment_date": F.lit(AS_OF - dt.timedelta(days=90)),
            "recurring_monthly_amount": F.lit(25), "sustainer_start_date": F.lit(d(6)), "total_lifetime_giving": F.lit(1),
            "first_donation_date": F.lit(d(24)), "last_donation_date": F.lit(d(12, 1)), "lifetime_value_estimate": F.lit(5),
        }
    )
    subscriptions = spark.createDataFrame(
        [("a", "active", None), ("b", "active", AS_OF), ("c", "active", AS_OF + dt.timedelta(days=1)), ("d", "cancelled", None)],
        "constituent_id string, subscription_status string, end_date date",
    ).withColumn("subscription_type", F.lit("DAILY"))
    changes = spark.createDataFrame([("a", "cancelled", AS_OF), ("b", "payment_failed_final", d(0, 1)), ("c", "paused", AS_OF)], "constituent_id string, change_type string, change_date date")
    emails = spark.createDataFrame([(True, "delivered", 30), (False, "delivered", 31), (True, "bounced", 0), (False, "delivered", 0)], "opened boolean, delivery_status string, ago int").withColumns(
        {"send_date": F.date_sub(F.lit(AS_OF), F.col("ago")), "email_type": F.lit("e"), "audience_segment": F.lit("s")}
    )
    return {"donations": donations, "constituents": constituents, "subscriptions": subscriptions, "status_changes": changes, "emails": emails}


def value(tables, name, dimension=None):
    return metrics.metric(tables, name, AS_OF, dimension).collect()


def test_active_windows(tables):
    assert value(tables, "active_member")[0][0] == 2  # the edge counts, refunds do not
    assert value(tables, "active_member_with_grace")[0][0] == 4
    assert value(tables, "active_member_fiscal")[0][0] == 0


def test_retention_counts_the_edge_twice(tables):
    r = value(tables, "donor_retention_rate")[0]
    assert (r["prior_year_count"], r["retained_count"]) == (5, 2)
    assert r["retention_rate"] == 40.0


def test_sustaining_bands(tables):
    assert value(tables, "sustaining_member")[0][0] == 6
    assert [tuple(r) for r in value(tables, "sustaining_member", "by_monthly_amount")] == [("$25-49", 6)]
    assert [tuple(r) for r in value(tables, "sustaining_member", "by_tenure")] == [("6-12 mo", 6)]


def test_lapsed(tables):
    assert [tuple(r) for r in value(tables, "lapsed_member", "by_lapse_duration")] == [("12-18 months", 7)]


def test_subscriber_end_date(tables):
    assert value(tables, "active_subscriber")[0][0] == 2


def test_churn_rate(tables):
    r = value(tables, "sustainer_churn_rate")[0]
    assert (r["churn_count"], r["start_count"]) == (1, 6)


def test_open_rate(tables):
    r = value(tables, "email_open_rate")[0]
    assert (r["open_rate"], r["emails_sent"], r["emails_opened"]) == (50.0, 2, 1)


def test_empty_denominators(tables):
    none = {**tables, "donations": tables["donations"].limit(0), "emails": tables["emails"].limit(0)}
    assert metrics.metric(none, "donor_retention_rate", AS_OF).first()["retention_rate"] is None
    assert metrics.metric(none, "email_open_rate", AS_OF).first()["open_rate"] is None


def test_catalog(spark, tables):
    assert metrics.list_metrics("revenue") == ["total_revenue_t12m", "average_gift_amount"]
    assert metrics.catalog_df(spark).count() == len(metrics.CATALOG) == 12
    with pytest.raises(ValueError, match="Unknown metric"):
        metrics.metric(tables, "nothing", AS_OF)
    # an undeclared dimension is ignored
    assert value(tables, "active_member", "by_nothing") == value(tables, "active_member")


def test_long_table_agrees_with_single_metrics(tables):
    rows = metrics.compute_metrics(tables, ["active_member", "total_revenue_t12m"], AS_OF).collect()
    whole = {r["metric"]: r["value"] for r in rows if r["dimension"] is None}
    assert whole == {"active_member": 2.0, "total_revenue_t12m": 20.0}
    assert {r["dimension"] for r in rows if r["metric"] == "active_member"} == {None, "by_source", "by_gift_type", "by_acquisition_year"}
