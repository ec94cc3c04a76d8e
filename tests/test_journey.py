"""From linked facts to recommendations, on a few people."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from constituent360.operators import journey as J
from constituent360.operators.models import TreeParams

DAY = dt.date
PEOPLE = "constituent_id string, canonical_email string, canonical_first_name string, canonical_last_name string, canonical_phone string, canonical_address_line1 string"
GIFTS = "constituent_id string, donation_id string, donation_date date, donation_amount decimal(12,2), donation_type string, donation_status string, campaign_code string"
SUBSCRIPTIONS = "constituent_id string, subscription_id string, subscription_type string, subscription_status string, start_date date"
MAILS = "constituent_id string, send_date date, opened boolean, clicked boolean"
EVENTS = "constituent_id string, event_date date"
CHANGES = "constituent_id string, change_type string, change_date date"


def gift(who, number, day, amount, kind="one_time", status="completed"):
    return (who, str(number), day, Decimal(amount), kind, status, None)


@pytest.fixture(scope="module")
def few(spark):
    names = ["grower", "leaver", "silent", "big", "new"]
    people = spark.createDataFrame([(n, f"{n}@x.org", n, "Lee", None, None) for n in names], PEOPLE)
    gifts = [
        gift("grower", 1, DAY(2020, 1, 5), 10, "recurring"), gift("grower", 2, DAY(2020, 7, 5), 30, "recurring"),
        gift("leaver", 3, DAY(2020, 2, 5), 20, "recurring"),
        gift("silent", 4, DAY(2019, 6, 20), 50), gift("silent", 5, DAY(2020, 6, 30), 60, status="refunded"),
        gift("big", 6, DAY(2020, 5, 1), 2000), gift("big", 7, DAY(2020, 8, 1), 3000, "recurring"),
        gift("new", 8, DAY(2020, 9, 1), 5), gift(None, 9, DAY(2020, 1, 1), 9999),
    ]
    facts = J.Facts(
        spark.createDataFrame(gifts, GIFTS), spark.createDataFrame([("leaver", "1", "print", "active", DAY(2021, 1, 1))], SUBSCRIPTIONS),
        spark.createDataFrame(
            [("grower", DAY(2020, 6, 30), True, True), ("grower", DAY(2020, 7, 2), False, False), ("grower", DAY(2020, 7, 20), True, False),
             (None, DAY(2020, 6, 30), True, True)], MAILS),
        spark.createDataFrame([("grower", DAY(2020, 6, 1)), ("grower", DAY(2020, 7, 9)), (None, DAY(2020, 6, 1))], EVENTS),
        spark.createDataFrame([("leaver", "cancelled", DAY(2020, 7, 15)), ("grower", "cancelled", DAY(2020, 12, 15))], CHANGES),
        lag=10,
    )
    return people, facts


def test_inputs_know_nothing_of_later_days(few):
    """On 30 June, with mails and events ten days ahead; nobody is left out and nobody's facts are not given to anyone."""
    rows = {r["constituent_id"]: r for r in J.inputs(*few, DAY(2020, 6, 30), 1000).collect()}
    assert set(rows) == {"grower", "leaver", "silent", "big", "new"}
    g = rows["grower"]
    assert (g["total_gift_count"], g["largest_single_gift"], g["email_open_rate_30d"], g["email_click_rate_30d"]) == (1, 10, 0.5, 0.5)
    assert g["last_engagement_date"] == DAY(2020, 6, 29) and rows["new"]["last_engagement_date"] is None
    assert not rows["leaver"]["is_subscriber"] and rows["new"]["lifecycle_stage"] == "prospect"
    later = {r["constituent_id"]: r["total_gift_count"] for r in J.inputs(*few, DAY(2021, 1, 1), 1000).collect()}
    assert later == {"grower": 2, "leaver": 1, "silent": 1, "big": 2, "new": 1}


def test_examples_are_labelled_by_what_followed(few):
    rows = {r["constituent_id"]: r for r in J.examples(*few, DAY(2020, 6, 30), 1000).collect()}
    targets = ("churned", "to_sustainer", "sustainer_increase", "to_major")
    assert {k: tuple(r[t] for t in targets) for k, r in rows.items()} == {
        "grower": (0, 0, 1, 0), "leaver": (1, 0, 0, 0), "silent": (1, 0, 0, 0), "big": (0, 1, 0, 0),  # big has been major before
    }


def test_scores_and_recommendations_for_everybody(spark):
    names = [f"p{i:03d}" for i in range(120)]
    people = spark.createDataFrame([(n, None, None, None, None, None) for n in names], PEOPLE)
    gifts = []
    for i, n in enumerate(names[:100]):
        kind = "recurring" if i % 4 == 0 else "one_time"
        gifts += [gift(n, 3 * i, DAY(2019, 1 + i % 12, 3), 10 + i, kind)]
        if i % 3:
            gifts += [gift(n, 3 * i + 1, DAY(2020, 9, 1), 2000 if i % 5 == 0 else 20 + 2 * i, "recurring" if i % 2 else kind)]
    changes = [(n, "cancelled", DAY(2020, 8, 1)) for n in names[:100:8]]
    empty = lambda schema: spark.createDataFrame([], schema)
    facts = J.Facts(spark.createDataFrame(gifts, GIFTS), empty(SUBSCRIPTIONS), empty(MAILS), empty(EVENTS), spark.createDataFrame(changes, CHANGES))
    small = TreeParams(trees=2, depth=2)
    scored = J.scores(people, facts, DAY(2021, 1, 1), DAY(2020, 6, 30), 1000, small, small)
    rows = {r["constituent_id"]: r for r in scored.collect()}
    assert set(rows) == set(names) and all(0 <= r["churn_score"] <= 1 for r in rows.values())
    found = J.recommended(people, scored).collect()
    assert len(found) == 120 and {r["action"] for r in found} <= {"prime_target", "careful_ask", "nurture", "save_first"}
    assert all(0 <= r["priority"] <= 100 for r in found)


def test_facts_are_written_with_the_columns_that_are_read(spark, few):
    people, facts = few
    given = [getattr(facts, f) for f in ("gifts", "subscriptions", "mails", "events", "changes")]
    written = J.Facts.written(*[df.withColumn("unread", F.lit("x" * 50)) for df in given], lag=facts.lag)
    for df, name in zip(given, ("gifts", "subscriptions", "mails", "events", "changes")):
        kept = getattr(written, name)
        assert sorted(kept.columns) == sorted(df.columns) and kept.count() == df.count()
    rows = lambda f: sorted(J.features(people, f, DAY(2020, 7, 1)).collect())
    assert rows(written) == rows(facts)
