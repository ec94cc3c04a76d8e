"""Registered queries against their SQL. By default a sample of every area; ALL_QUERIES=1 runs them all."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SAMPLE = (
    "donation_facts", "constituents", "subscription_facts", "source_api_pages", "sink_partitioned_facts", "stream_metric_refresh",
    "metric_active_member_by_source", "metric_results", "metric_rule_checks", "golden_constituents", "giving_features", "date_dimension",
    "campaign_mailing_list", "campaign_bucket_stats", "quality_all_check_kinds", "golden_records", "identity_scored_matches",
    "evaluation_suite", "recommendations", "churn_labels", "scd2_history", "incremental_upsert", "lineage_references",
    "pipeline_links", "pipeline_golden", "stream_upsert", "source_extract_audit", "source_first_per_person", "quality_profile",
    "retention_events", "retention_logs", "constituent_features", "identity_fuzzy_join", "metric_anomalies", "model_drift",
    "stratified_split", "time_split", "gift_timing", "extra_features", "gifts_as_of", "gift_status_as_of", "model_calibration",
    "event_attribute_paths", "cross_validation_in_time", "quality_merged_profile", "source_write_audit",
    "identity_stored_batches", "pipeline_features", "source_json_array",
)
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("ALL_QUERIES") else SAMPLE)
def test_query_equals_sql(spark, duck, sf, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    mine = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted(repr([plain(r[i]) for i in order]) for r in cursor.fetchall())
    assert mine == theirs


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
