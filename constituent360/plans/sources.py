"""Source, sink and streaming queries. Each writes to a new folder in the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from constituent360.operators import campaign as C
from constituent360.operators import features as X
from constituent360.plans import campaign as campaign_plans
from constituent360.plans.registry import query
from constituent360.plans.sql_domain import AS_OF
from constituent360.session import scratch
from constituent360.sources import readers as IN
from constituent360.sources import tpch
from constituent360.sources import writers as OUT
from constituent360.streaming import jobs as S

GIFT_SCHEMA = "donation_id string, constituent_id string, donation_date date, donation_amount decimal(12,2), donation_type string, donation_status string, campaign_code string, source_channel string, source_system string, source_record_id string"


@query("source_csv", "SELECT * FROM donations", ("donations",))
def _(spark, sf_dir):
    base = scratch(spark, "csv")
    OUT.write_dataset(tpch.donations(spark, sf_dir), f"{base}/gifts.csv", "csv")
    return IN.read_table(spark, base, "gifts", GIFT_SCHEMA)


@query("source_json", "SELECT * FROM donations", ("donations",))
def _(spark, sf_dir):
    base = scratch(spark, "json")
    OUT.write_dataset(tpch.donations(spark, sf_dir), f"{base}/gifts.json", "json")
    return spark.read.schema(GIFT_SCHEMA).json(f"{base}/gifts.json")


@query("source_json_array", "SELECT * FROM donations", ("donations",))
def _(spark, sf_dir):
    """Files of one array each; a file is read by one task, so the writer bounds what it holds."""
    base = scratch(spark, "arrays")
    OUT.write_json_arrays(tpch.donations(spark, sf_dir), f"{base}/gifts.json")
    return IN.read_table(spark, base, "gifts", GIFT_SCHEMA)


@query("source_text_csv", "SELECT doc_id, text, lang FROM documents")
def _(spark, sf_dir):
    """Whole texts with quotes and line breaks survive the CSV round trip."""
    base = scratch(spark, "text")
    OUT.write_dataset(tpch.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), f"{base}/documents.csv", "csv")
    return IN.read_table(spark, base, "documents", "doc_id bigint, text string, lang string", multi_line=True)


@query("source_api_pages", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf_dir):
    """Events packed into landed API pages (list, data and results shapes) and unpacked again."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    e = tpch.table(spark, sf_dir, "events")
    record = F.struct("event_id", "user_id", "event_type")
    pages = e.groupBy(F.floor(F.col("event_id") / 50).alias("page")).agg(F.to_json(F.collect_list(record)).alias("items"))
    kind = F.col("page") % 3
    body = F.when(kind == 0, F.col("items")).when(kind == 1, F.concat(F.lit('{"data": '), "items", F.lit("}"))).otherwise(
        F.concat(F.lit('{"results": '), "items", F.lit(', "next": null}'))
    )
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()), StructField("event_type", StringType())])
    return IN.explode_api_pages(pages.select(body.alias("body")), "body", schema)


@query("source_field_mapping", "SELECT 'crm' AS source_system, CAST(c_custkey AS VARCHAR) AS source_id, c_name AS full_name, c_mktsegment AS segment FROM customer")
def _(spark, sf_dir):
    c = tpch.table(spark, sf_dir, "customer")
    mapped = IN.load_source_records(c, "crm", {"source_id": "c_custkey", "full_name": "c_name", "email": "c_email"})
    return mapped.select("source_system", F.col("source_id").cast("string").alias("source_id"), "full_name", F.col("raw_data")["c_mktsegment"].alias("segment"))


@query("source_first_per_person", "SELECT CAST(min(o_orderkey) AS VARCHAR) AS source_id, 'gifts' AS source_system, o_custkey AS person FROM orders GROUP BY o_custkey")
def _(spark, sf_dir):
    """The first gift of each person."""
    o = tpch.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("person"), "o_orderkey")
    return IN.to_source_records(o, "gifts", "o_orderkey", "o_orderkey", "person").select("source_id", "source_system", "person")


_AUDIT = """SELECT 'warehouse' AS source, 'lineitem' AS "table", count(*) >= {least} AS success, count(*) AS records_extracted, TIMESTAMP '2001-08-01 02:00:00' AS extracted_at,
  CAST(90 AS DOUBLE) AS duration_seconds, CASE WHEN count(*) < {least} THEN 'expected {least} records or more, got ' || count(*) END AS error_message FROM lineitem"""


@query("source_extract_audit", f"{_AUDIT.format(least=1)} UNION ALL {_AUDIT.format(least=10**12)}")
def _(spark, sf_dir):
    """An extract that is large enough, and the same one held to a number that it can't reach."""
    import datetime as dt

    lines, started = tpch.table(spark, sf_dir, "lineitem"), dt.datetime(2001, 8, 1, 2)
    audit = lambda least: IN.extract_audit(lines, "warehouse", "lineitem", started, started + dt.timedelta(seconds=90), least)
    return audit(1).unionByName(audit(10**12))


_WRITTEN = "TIMESTAMP '2001-08-01 02:00:00' AS extracted_at, CAST(60 AS DOUBLE) AS duration_seconds"


@query("source_write_audit", f"""SELECT 'gifts' AS "table", count(*) > 0 AS success, count(*) AS records_extracted, {_WRITTEN}, false AS failed FROM donations
UNION ALL SELECT 'none', false, 0, {_WRITTEN}, true UNION ALL SELECT 'broken', false, 0, {_WRITTEN}, true""", ("donations",))
def _(spark, sf_dir):
    """Extracts audited by their own writes: a whole one, one without rows and one that ends in an error."""
    import datetime as dt

    path, out = scratch(spark, "extract"), None
    went = F.when(F.col("donation_type").isNotNull(), F.raise_error("source went away")).cast("string")
    extracts = {
        "gifts": lambda session: tpch.donations(session, sf_dir),
        "none": lambda session: tpch.donations(session, sf_dir).where("donation_amount < -1e9"),
        "broken": lambda session: tpch.donations(session, sf_dir).withColumn("donation_type", went),
    }
    for name, extract in extracts.items():
        start = dt.datetime(2001, 8, 1, 2)
        times = iter([start, start + dt.timedelta(minutes=1)])
        row = OUT.write_audited(spark, extract, f"{path}/{name}", "parquet", "crm", name, lambda: next(times))
        out = row if out is None else out.unionByName(row)
    return out.select("table", "success", "records_extracted", "extracted_at", "duration_seconds", F.col("error_message").isNotNull().alias("failed"))


@query("sink_partitioned_facts", "SELECT *, strftime(donation_date, '%Y-%m') AS donation_year_month FROM donations WHERE donation_date BETWEEN DATE '1998-02-10' AND DATE '1998-05-05'", ("donations",))
def _(spark, sf_dir):
    import datetime as dt

    path = scratch(spark, "facts")
    OUT.write_partitioned(tpch.donations(spark, sf_dir), path, "donation_date", "donation_year_month")
    stored = spark.read.schema(f"{GIFT_SCHEMA}, donation_year_month string").parquet(path)
    return IN.between_months(stored, "donation_date", "donation_year_month", dt.date(1998, 2, 10), dt.date(1998, 5, 5))


@query("sink_feature_refresh", f"""SELECT constituent_id, {AS_OF} AS feature_date, total_gift_count AS total_gifts FROM constituents WHERE total_gift_count > 0
UNION ALL SELECT constituent_id, {AS_OF} - 1, total_gift_count FROM constituents WHERE total_gift_count > 0""", ("constituents",))
def _(spark, sf_dir):
    """Two days are refreshed, the second one twice; a rerun replaces its own day only."""
    import datetime as dt

    path = scratch(spark, "features")
    c = tpch.constituents(spark, sf_dir)
    for day in (tpch.AS_OF - dt.timedelta(days=1), tpch.AS_OF, tpch.AS_OF):
        OUT.replace_partitions(X.refresh_rows(c, day), path, ["feature_date"])
    return spark.read.parquet(path).select("constituent_id", "feature_date", "total_gifts")


@query("sink_mailing_list", f"""WITH {campaign_plans.CTES} SELECT * REPLACE (CAST(most_recent_one_time_date AS VARCHAR) AS most_recent_one_time_date, CAST(most_recent_one_time_amount AS VARCHAR) AS most_recent_one_time_amount) FROM listing""", campaign_plans.TABLES)
def _(spark, sf_dir):
    path = scratch(spark, "mailing")
    OUT.write_mailing_list(campaign_plans.listing(spark, sf_dir), path)
    return spark.read.schema(IN.text_schema(C.MAILING_COLUMNS)).option("header", True).csv(path)


@query("sink_versioned_table", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 2 = 0")
def _(spark, sf_dir):
    """A data set that is written twice holds the second version only."""
    path = f"{scratch(spark, 'versions')}/table"
    c = tpch.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    OUT.write_dataset(c, path, "parquet")
    OUT.write_dataset(c.where("c_custkey % 2 = 0"), path, "parquet")
    return spark.read.schema(c.schema).parquet(path)


def event_stream(spark, sf_dir):
    schema = tpch.table(spark, sf_dir, "events").schema
    return S.read_stream(spark, sf_dir, schema, "events.parquet")


def shuffled_event_stream(spark, sf_dir, files: int = 20):
    """The events as that many files in no order of time, five to a batch."""
    events = tpch.table(spark, sf_dir, "events")
    path = scratch(spark, "event-files")
    events.repartition(files, F.xxhash64("event_id")).write.parquet(path)
    return S.read_stream(spark, path, events.schema, files_per_batch=5)


@query("stream_staging", "SELECT event_id, CAST(value AS DECIMAL(12,2)) AS donation_amount, true AS stamped FROM events WHERE CAST(value AS DECIMAL(12,2)) > 0")
def _(spark, sf_dir):
    base = scratch(spark, "staging")
    gifts = event_stream(spark, sf_dir).withColumn("donation_amount", F.col("value").cast("decimal(12,2)"))
    S.write_stream(S.staging_donations(gifts), f"{base}/rows", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/rows").select("event_id", "donation_amount", F.col("processed_at").isNotNull().alias("stamped"))


@query("stream_upsert", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def _(spark, sf_dir):
    base = scratch(spark, "upsert")
    table = OUT.KeyedTable(spark, f"{base}/table", ["user_id"], 8)
    rows = shuffled_event_stream(spark, sf_dir).select("user_id", "event_id", "event_type", "ts")
    S.upsert_stream(rows, table, ["ts", "event_id"], f"{base}/checkpoint").awaitTermination()
    return table.read().select("user_id", "event_id", "event_type")


@query("stream_metric_refresh", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total FROM events GROUP BY 1, 2")
def _(spark, sf_dir):
    base = scratch(spark, "metric")
    table = OUT.KeyedTable(spark, f"{base}/table", ["window_start", "window_end", "event_type"], 8)
    rows = shuffled_event_stream(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("value").cast("decimal(12,2)").alias("value"))
    S.refresh_table(S.metric_refresh(rows, "ts", "value", ["event_type"]), table, f"{base}/checkpoint").awaitTermination()
    return table.read().select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")


ARRIVALS, JITTER_HOURS = 4, 6


def arrivals(spark, sf_dir):
    """The events in the order in which they arrive, up to six hours late: a folder's worth of rows for each arrival."""
    rows = tpch.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.pmod(F.xxhash64("event_id"), F.lit(JITTER_HOURS * 3600))
    rows = rows.withColumn("at", F.unix_timestamp("ts") + late)
    ends = rows.agg(F.min("at").alias("low"), F.max("at").alias("high")).first()
    width = (ends["high"] - ends["low"]) // ARRIVALS + 1
    return [rows.where(F.floor((F.col("at") - ends["low"]) / width) == i).drop("at") for i in range(ARRIVALS)]


@query("stream_event_time", f"""WITH w AS (SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total
  FROM events GROUP BY 1, 2)
SELECT * FROM w WHERE window_start + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL {JITTER_HOURS} HOURS""")
def _(spark, sf_dir):
    """Every arrival restarts the job from its checkpoint; only windows that can't change any more are out."""
    base = scratch(spark, "event-time")
    for rows in arrivals(spark, sf_dir):
        rows.write.mode("append").parquet(f"{base}/in")
        stream = S.read_stream(spark, f"{base}/in", rows.schema).select("ts", "event_type", F.col("value").cast("decimal(12,2)").alias("value"))
        metric = S.metric_refresh(stream, "ts", "value", ["event_type"], late=f"{JITTER_HOURS} hours")
        S.append_closed(metric, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")


@query("stream_changes", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def _(spark, sf_dir):
    """The latest event of every user, from changes that arrive late and are folded on the way."""
    base = scratch(spark, "changes")
    table = OUT.Changes(spark, f"{base}/table", ["user_id"], ["ts", "event_id"], "ts", 8)
    for number, rows in enumerate(arrivals(spark, sf_dir)):
        rows.write.mode("append").parquet(f"{base}/in")
        stream = S.read_stream(spark, f"{base}/in", rows.schema).select("user_id", "event_id", "event_type", "ts")
        S.change_stream(stream, table, f"{base}/checkpoint").awaitTermination()
        if number == 1:
            table.fold(str(rows.agg(F.to_date(F.max("ts"))).first()[0]))
    return table.read().select("user_id", "event_id", "event_type")
