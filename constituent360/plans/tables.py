"""The domain tables themselves: scans, projections and the source union."""

from __future__ import annotations

from constituent360.plans.registry import query
from constituent360.sources import tpch


@query("donation_facts", "SELECT * FROM donations", ("donations",))
def _(spark, sf_dir):
    return tpch.donations(spark, sf_dir)


@query("constituents", "SELECT * FROM constituents", ("constituents",))
def _(spark, sf_dir):
    return tpch.constituents(spark, sf_dir)


@query("subscription_facts", "SELECT * FROM subscriptions", ("subscriptions",))
def _(spark, sf_dir):
    return tpch.subscriptions(spark, sf_dir)


@query("email_engagement", "SELECT * FROM emails", ("emails",))
def _(spark, sf_dir):
    return tpch.email_engagement(spark, sf_dir)


@query("model_predictions", "SELECT * FROM predictions", ("predictions",))
def _(spark, sf_dir):
    return tpch.predictions(spark, sf_dir)


@query("sustainer_status_changes", "SELECT * FROM status_changes", ("status_changes",))
def _(spark, sf_dir):
    return tpch.status_changes(spark, sf_dir)


@query("source_records_union", "SELECT * FROM source_records", ("source_records",))
def _(spark, sf_dir):
    return tpch.source_records(spark, sf_dir)


def _crm(name):
    @query(f"crm_{name}", f"SELECT * FROM {name}", (name,))
    def run(spark, sf_dir):
        return tpch.crm_tables(spark, sf_dir)[name]


for _name in ("account_family", "account", "primary_address", "account_flag", "member_journey", "membership", "gift_summary"):
    _crm(_name)
