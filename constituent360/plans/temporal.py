"""History, incremental load, audit, retention and restricted-view queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from constituent360.operators import temporal as H
from constituent360.operators.asof import as_of_join
from constituent360.plans.registry import query
from constituent360.session import scratch
from constituent360.sources import tpch
from constituent360.sources.writers import KeyedTable

DAY1, DAY2 = dt.date(2001, 1, 1), dt.date(2001, 6, 1)
KEYS, ATTRS = ["constituent_id"], ["segment", "balance"]


def snapshots(spark, sf_dir):
    """Customers on two dates: by the second, some changed segment, some left and some are new."""
    k = F.col("c_custkey")
    base = tpch.table(spark, sf_dir, "customer")
    one = base.select(k.cast("string").alias("constituent_id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").cast("decimal(12,2)").alias("balance"), k)
    two = one.where(k % 17 != 0).withColumn("segment", F.when(k % 5 == 0, "MOVED").otherwise(F.col("segment"))).unionByName(
        one.where(k % 50 == 0).withColumn("constituent_id", F.concat(F.lit("N"), "constituent_id"))
    )
    return one.drop("c_custkey"), two.drop("c_custkey")


SNAP = """one AS (SELECT CAST(c_custkey AS VARCHAR) AS constituent_id, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(12,2)) AS balance, c_custkey AS k FROM customer),
two AS (SELECT constituent_id, CASE WHEN k % 5 = 0 THEN 'MOVED' ELSE segment END AS segment, balance FROM one WHERE k % 17 <> 0
  UNION ALL SELECT 'N' || constituent_id, segment, balance FROM one WHERE k % 50 = 0),
cmp AS (SELECT coalesce(one.constituent_id, two.constituent_id) AS constituent_id, one.segment AS s1, one.balance AS b1, two.segment AS s2, two.balance AS b2,
  one.constituent_id IS NOT NULL AS was, two.constituent_id IS NOT NULL AS now, one.segment IS NOT DISTINCT FROM two.segment AND one.balance IS NOT DISTINCT FROM two.balance AS same FROM one FULL JOIN two USING (constituent_id)),
history AS (SELECT constituent_id, s1 AS segment, b1 AS balance, DATE '2001-01-01' AS effective_date, CASE WHEN was AND now AND same THEN DATE '9999-12-31' ELSE DATE '2001-06-01' END AS end_date, was AND now AND same AS is_current, 'initial' AS change_reason FROM cmp WHERE was
  UNION ALL SELECT constituent_id, s2, b2, DATE '2001-06-01', DATE '9999-12-31', true, CASE WHEN was THEN 'changed' ELSE 'new' END FROM cmp WHERE now AND NOT (was AND same))"""


def history(spark, sf_dir):
    one, two = snapshots(spark, sf_dir)
    return H.scd2_merge(H.scd2_start(one, DAY1), two, KEYS, ATTRS, DAY2)


@query("scd2_history", f"WITH {SNAP} SELECT * FROM history")
def _(spark, sf_dir):
    return history(spark, sf_dir)


@query("scd2_as_of", f"WITH {SNAP} SELECT constituent_id, segment, balance FROM history WHERE effective_date <= DATE '2001-03-01' AND end_date > DATE '2001-03-01'")
def _(spark, sf_dir):
    return H.as_of(history(spark, sf_dir), dt.date(2001, 3, 1)).select("constituent_id", "segment", "balance")


@query("gifts_as_of", f"""WITH {SNAP} SELECT o_orderkey AS gift_no, CAST(o_custkey AS VARCHAR) AS constituent_id, CAST(o_orderdate AS DATE) AS gift_date, segment, balance, effective_date, change_reason
  FROM orders LEFT JOIN history ON constituent_id = CAST(o_custkey AS VARCHAR) AND effective_date <= CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) < end_date""")
def _(spark, sf_dir):
    """Every gift with the segment and balance that its giver had on that day."""
    gifts = tpch.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("gift_no"), F.col("o_custkey").cast("string").alias("constituent_id"), F.col("o_orderdate").cast("date").alias("gift_date")
    )
    found = as_of_join(gifts, history(spark, sf_dir), KEYS, "gift_date", "effective_date", "end_date")
    return found.select(*gifts.columns, *[F.col(f"version.{c}") for c in (*ATTRS, "effective_date", "change_reason")])


LAST_STATUS = """st AS (SELECT CAST(o_custkey AS VARCHAR) AS constituent_id, CAST(o_orderdate AS DATE) AS change_date, CASE o_orderpriority WHEN '1-URGENT' THEN 'cancelled'
  WHEN '2-HIGH' THEN 'payment_failed_final' WHEN '3-MEDIUM' THEN 'payment_failed' ELSE 'resumed' END AS change_type FROM orders WHERE o_orderstatus = 'P'),
one_a_day AS (SELECT constituent_id, change_date, max(change_type) AS change_type FROM st GROUP BY 1, 2)"""


@query("gift_status_as_of", f"""WITH {LAST_STATUS} SELECT o_orderkey AS gift_no, change_type, change_date FROM orders o
  ASOF LEFT JOIN one_a_day s ON s.constituent_id = CAST(o.o_custkey AS VARCHAR) AND CAST(o.o_orderdate AS DATE) >= s.change_date""")
def _(spark, sf_dir):
    """Every gift with the last change of status up to its day: a history without ends."""
    gifts = tpch.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("gift_no"), F.col("o_custkey").cast("string").alias("constituent_id"), F.col("o_orderdate").cast("date").alias("gift_date")
    )
    changes = tpch.status_changes(spark, sf_dir).select("constituent_id", "change_type", "change_date")
    found = as_of_join(gifts, changes, KEYS, "gift_date", "change_date")
    return found.select("gift_no", "version.change_type", "version.change_date")


@query("change_log", f"""WITH {SNAP}, f AS (SELECT constituent_id, unnest([{{'f': 'segment', 'o': s1, 'n': s2}}, {{'f': 'balance', 'o': CAST(b1 AS VARCHAR), 'n': CAST(b2 AS VARCHAR)}}]) AS c FROM cmp)
SELECT constituent_id, c.f AS field, c.o AS old_value, c.n AS new_value, 'loader' AS changed_by, DATE '2001-06-01' AS changed_at, 'refresh' AS reason, 'crm' AS process FROM f WHERE c.o IS DISTINCT FROM c.n""")
def _(spark, sf_dir):
    one, two = snapshots(spark, sf_dir)
    return H.change_log(one, two, KEYS, ATTRS, who="loader", why="refresh", where="crm", when=DAY2)


UPSERT = """src AS (SELECT CAST(o_custkey AS VARCHAR) AS constituent_id, CAST(o_orderdate AS DATE) AS modified_at, o_orderkey AS change_no, o_orderpriority AS status FROM orders),
before AS (SELECT constituent_id, modified_at, change_no, status FROM (SELECT *, row_number() OVER (PARTITION BY constituent_id ORDER BY modified_at DESC, change_no DESC) AS rn FROM src WHERE modified_at <= DATE '2000-12-31') WHERE rn = 1),
fresh AS (SELECT constituent_id, modified_at, change_no, status FROM (SELECT *, row_number() OVER (PARTITION BY constituent_id ORDER BY modified_at DESC, change_no DESC) AS rn FROM src WHERE modified_at > DATE '2000-12-31' AND modified_at <= DATE '2001-06-30') WHERE rn = 1)"""


@query("incremental_upsert", f"WITH {UPSERT} SELECT * FROM before WHERE constituent_id NOT IN (SELECT constituent_id FROM fresh) UNION ALL SELECT * FROM fresh")
def _(spark, sf_dir):
    source = tpch.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("constituent_id"), F.col("o_orderdate").cast("date").alias("modified_at"),
        F.col("o_orderkey").alias("change_no"), F.col("o_orderpriority").alias("status"),
    )
    end, later = dt.date(2000, 12, 31), dt.date(2001, 6, 30)
    table = KeyedTable(spark, f"{scratch(spark, 'upsert')}/table", KEYS, 8)
    H.upsert_into(table, source, "modified_at", None, end, ["change_no"])
    H.upsert_into(table, source, "modified_at", end, later, ["change_no"])
    return table.read()


WHEN = dt.date(2006, 8, 1)


@query("retention_donations", "SELECT donation_id, donation_date FROM donations WHERE donation_date >= DATE '1999-08-01'", ("donations",))
def _(spark, sf_dir):
    return H.apply_retention(tpch.donations(spark, sf_dir), "donation_date", H.SCHEDULE["donations"], WHEN).select("donation_id", "donation_date")


@query("retention_events", "SELECT event_id, event_date FROM engagement WHERE event_date >= DATE '2024-01-20'", ("engagement",))
def _(spark, sf_dir):
    return H.apply_retention(tpch.engagement_events(spark, sf_dir), "event_date", H.SCHEDULE["events"], dt.date(2029, 1, 20)).select("event_id", "event_date")


@query("retention_logs", "SELECT event_id, event_date FROM engagement WHERE event_date >= DATE '2024-01-10'", ("engagement",))
def _(spark, sf_dir):
    """Web events taken as access logs, which are kept for a year."""
    return H.apply_retention(tpch.engagement_events(spark, sf_dir), "event_date", H.SCHEDULE["logs"], dt.date(2025, 1, 10)).select("event_id", "event_date")


@query("retention_contacts", """SELECT constituent_id, last_donation_date, CASE WHEN last_donation_date < DATE '2000-08-01' THEN NULL ELSE canonical_email END AS canonical_email,
  CASE WHEN last_donation_date < DATE '2000-08-01' THEN NULL ELSE canonical_last_name END AS canonical_last_name FROM constituents""", ("constituents",))
def _(spark, sf_dir):
    c = H.apply_retention(tpch.constituents(spark, sf_dir), "last_donation_date", H.SCHEDULE["contacts"], dt.date(2003, 8, 1))
    return c.select("constituent_id", "last_donation_date", "canonical_email", "canonical_last_name")


@query("retention_email_totals", """SELECT CAST(date_trunc('month', send_date) AS DATE) AS month, email_type, count(*) AS rows FROM emails WHERE send_date < DATE '2024-01-15' GROUP BY 1, 2""", ("emails",))
def _(spark, sf_dir):
    return H.expired_totals(tpch.email_engagement(spark, sf_dir), "send_date", H.SCHEDULE["email_engagement"], dt.date(2027, 1, 15))


@query("restricted_view", """SELECT constituent_id, canonical_last_name, sha256(canonical_email) AS canonical_email, primary_source, total_gift_count FROM constituents WHERE primary_source = 'ASIA'""", ("constituents",))
def _(spark, sf_dir):
    c = tpch.constituents(spark, sf_dir).select("constituent_id", "canonical_last_name", "canonical_email", "primary_source", "total_gift_count", "total_lifetime_giving")
    return H.restrict_view(c, H.Access(hidden=("total_lifetime_giving",), hashed=("canonical_email",), rows="primary_source = 'ASIA'"))
