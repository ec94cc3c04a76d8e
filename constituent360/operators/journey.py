"""From unified people and the facts linked to them to features, scores and recommendations.

``inputs`` states what is known of everybody on a day. Models are trained on an earlier day, with what happened afterwards as
their labels, and applied to a later one: both come from the same function, so a feature means the same in either.
Facts without a constituent belong to nobody and are left out; each fact table is aggregated before it is joined.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constituent360.functions.dates import day
from constituent360.operators import golden as G
from constituent360.operators import models as L
from constituent360.operators import recommend as R
from constituent360.operators.features import churn_features
from constituent360.session import cut_lineage


#: The columns that are read of each table of ``Facts``, in the order of its fields.
READ = (
    ("constituent_id", "donation_id", "donation_date", "donation_amount", "donation_type", "donation_status", "campaign_code"),
    ("constituent_id", "subscription_id", "subscription_type", "subscription_status", "start_date"),
    ("constituent_id", "send_date", "opened", "clicked"),
    ("constituent_id", "event_date"),
    ("constituent_id", "change_type", "change_date"),
)


@dataclass(frozen=True)
class Facts:
    """Facts with the constituent that their source record is linked to. ``lag`` is by how many days the calendar of mails and
    web events runs ahead of that of the gifts."""

    gifts: DataFrame
    subscriptions: DataFrame
    mails: DataFrame
    events: DataFrame
    changes: DataFrame
    lag: int = 0

    @classmethod
    def written(cls, *facts: DataFrame, lag: int = 0) -> Facts:
        """Facts, in the order of the fields, written with the columns that are read here: several inputs follow from each."""
        return cls(*(cut_lineage(df.select(*columns)) for df, columns in zip(facts, READ, strict=True)), lag=lag)

    def until(self, as_of: dt.date) -> Facts:
        """What was known on a day."""
        there = as_of + dt.timedelta(days=self.lag)
        return Facts(
            self.gifts.where(F.col("donation_date") <= day(as_of)), self.subscriptions.where(F.col("start_date") <= day(as_of)),
            self.mails.where(F.col("send_date") <= day(there)), self.events.where(F.col("event_date") <= day(there)),
            self.changes.where(F.col("change_date") <= day(as_of)), self.lag,
        )


def owned(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("constituent_id").isNotNull())


def inputs(people: DataFrame, facts: Facts, as_of: dt.date, major_gift: float = 1000.0) -> DataFrame:
    """The golden record of everybody with e-mail behaviour and last engagement, as known on ``as_of``."""
    known = facts.until(as_of)
    wide = G.golden_of_records(people, known.gifts, known.subscriptions, as_of, major_gift)
    rates = G.email_rates(owned(known.mails), as_of + dt.timedelta(days=facts.lag)).select(
        "constituent_id", "email_open_rate_30d", "email_click_rate_30d", "last_email_open_date"
    )
    seen = owned(known.events).groupBy("constituent_id").agg(F.date_sub(F.max("event_date"), facts.lag).alias("last_engagement_date"))
    return wide.join(rates, "constituent_id", "left").join(seen, "constituent_id", "left")


def examples(people: DataFrame, facts: Facts, cutoff: dt.date, major_gift: float = 1000.0, horizon: int = 90) -> DataFrame:
    """Inputs of everybody who had given by ``cutoff``, with what followed: ``churned`` within ``horizon`` days, and the targets of
    the upgrade model. A target that somebody has reached already is 0."""
    gifts = owned(facts.gifts)
    payments = gifts.select(
        "constituent_id", F.col("donation_date").alias("payment_date"), F.col("donation_id").cast("bigint").alias("payment_id"),
        (F.col("donation_status") != "completed").alias("failed"),
    )
    labels = L.churn_labels(gifts, owned(facts.changes), payments, cutoff, horizon).select("constituent_id", "churned")
    later = gifts.where((F.col("donation_date") > day(cutoff)) & (F.col("donation_status") == "completed")).groupBy("constituent_id").agg(
        F.max("donation_amount").alias("_most"), F.max((F.col("donation_type") == "recurring").cast("int")).alias("_recurring")
    )
    rows = inputs(people, facts, cutoff, major_gift).join(labels, "constituent_id").join(later, "constituent_id", "left")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return rows.withColumns(
        {
            "to_sustainer": flag(~F.col("is_sustainer") & (F.col("_recurring") == 1)),
            "sustainer_increase": flag(F.col("is_sustainer") & (F.col("_most") > F.col("largest_single_gift"))),
            "to_major": flag((F.col("_most") >= major_gift) & (F.coalesce("largest_single_gift", F.lit(0)) < major_gift)),
        }
    ).drop("_most", "_recurring")


def features(people: DataFrame, facts: Facts, as_of: dt.date, major_gift: float = 1000.0) -> DataFrame:
    return churn_features(inputs(people, facts, as_of, major_gift), as_of)


def scores(
    people: DataFrame, facts: Facts, as_of: dt.date, cutoff: dt.date, major_gift: float = 1000.0,
    churn: L.TreeParams = L.TreeParams(), upgrade: L.TreeParams = L.UPGRADE_PARAMS,
) -> DataFrame:
    """Churn score and tier, upgrade scores and best path of everybody on ``as_of``, by models of ``cutoff``."""
    past = cut_lineage(examples(people, facts, cutoff, major_gift))
    now = cut_lineage(inputs(people, facts, as_of, major_gift))
    (leaving, _), (growing, _) = L.concurrently(
        [lambda: L.train_churn(past, "churned", cutoff, churn), lambda: L.train_upgrade(past, cutoff, params=upgrade)]
    )
    return cut_lineage(L.predict_churn(leaving, now, as_of).join(L.predict_upgrade(growing, now, as_of), "constituent_id"))


def recommended(people: DataFrame, scored: DataFrame) -> DataFrame:
    """What to do about everybody, with the contact fields that doing it needs."""
    found = R.recommendations(scored, scored, ordered=False)
    contact = people.select("constituent_id", "canonical_email", "canonical_phone")
    return contact.join(found.join(scored.select("constituent_id", "churn_tier"), "constituent_id"), "constituent_id")
