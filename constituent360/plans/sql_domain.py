"""The domain tables of ``sources.tpch`` written as SQL common table expressions."""

from __future__ import annotations

from constituent360.sources import tpch

AS_OF = f"DATE '{tpch.AS_OF}'"
EVENTS_AS_OF = f"DATE '{tpch.EVENTS_AS_OF}'"


def listed(values, index: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[CAST(({index}) + 1 AS INTEGER)]"


def hh(key: str) -> str:
    return f"'HH-' || lpad(CAST({key} AS VARCHAR), 8, '0')"


TABLES: dict[str, tuple[tuple[str, ...], str]] = {}

TABLES["donations"] = ((), f"""
SELECT CAST(o_orderkey AS VARCHAR) AS donation_id, CAST(o_custkey AS VARCHAR) AS constituent_id,
  CAST(o_orderdate AS DATE) AS donation_date, CAST(o_totalprice AS DECIMAL(12,2)) AS donation_amount,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'recurring' ELSE 'one_time' END AS donation_type,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'refunded' END AS donation_status,
  o_orderpriority AS campaign_code, {listed(tpch.CHANNELS, 'o_orderkey % 4')} AS source_channel,
  'donations' AS source_system, CAST(o_orderkey AS VARCHAR) AS source_record_id
FROM orders""")

TABLES["constituents"] = (("donations",), f"""
SELECT CAST(c_custkey AS VARCHAR) AS constituent_id,
  {listed(tpch.FIRST_NAMES, 'c_custkey % 20')} AS canonical_first_name,
  {listed(tpch.LAST_NAMES, 'c_custkey % 23')} AS canonical_last_name,
  CASE WHEN c_custkey % 41 = 0 THEN 'user' || c_custkey WHEN c_custkey % 43 = 0 THEN NULL
    ELSE 'user' || c_custkey || '@example.com' END AS canonical_email,
  r_name AS primary_source, n_name AS canonical_state, c_mktsegment AS acquisition_channel,
  CAST(c_acctbal AS DECIMAL(12,2)) AS lifetime_value_estimate,
  first_donation_date, last_donation_date,
  coalesce(total_lifetime_giving, CAST(0 AS DECIMAL(18,2))) AS total_lifetime_giving,
  coalesce(total_gift_count, 0) AS total_gift_count, largest_single_gift, average_gift_amount,
  sustainer_start_date IS NOT NULL AS is_sustainer,
  CASE WHEN sustainer_start_date IS NULL THEN NULL WHEN c_custkey % 7 = 0 THEN 'cancelled'
    WHEN c_custkey % 7 = 1 THEN 'paused' ELSE 'active' END AS recurring_status,
  CASE WHEN sustainer_start_date IS NOT NULL THEN CAST(c_custkey % 140 + 5 AS DECIMAL(10,2)) END AS recurring_monthly_amount,
  sustainer_start_date, last_successful_payment_date,
  CAST(CASE WHEN c_custkey % 5 = 0 THEN c_custkey % 4 ELSE 0 END AS INTEGER) AS consecutive_failed_payments,
  (c_custkey * 7919 % 10001) / CAST(10000.0 AS DOUBLE) AS churn_risk_score
FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (
  SELECT constituent_id, min(donation_date) AS first_donation_date, max(donation_date) AS last_donation_date,
    CAST(sum(donation_amount) AS DECIMAL(18,2)) AS total_lifetime_giving, count(*) AS total_gift_count,
    max(donation_amount) AS largest_single_gift,
    CAST(sum(donation_amount) AS DOUBLE) / count(*) AS average_gift_amount,
    min(donation_date) FILTER (donation_type = 'recurring') AS sustainer_start_date,
    max(donation_date) FILTER (donation_type = 'recurring') AS last_successful_payment_date
  FROM donations WHERE donation_status = 'completed' GROUP BY 1) g
  ON g.constituent_id = CAST(c_custkey AS VARCHAR)""")

TABLES["subscriptions"] = ((), """
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS subscription_id, CAST(o_custkey AS VARCHAR) AS constituent_id,
  CASE l_returnflag WHEN 'A' THEN 'DIGITAL' WHEN 'N' THEN 'WEEKEND' ELSE 'DAILY' END AS subscription_type,
  CAST(l_quantity AS DECIMAL(10,2)) AS monthly_rate,
  CASE WHEN l_linestatus = 'F' THEN 'active' ELSE 'cancelled' END AS subscription_status,
  CAST(l_shipdate AS DATE) AS start_date,
  CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_shipdate AS DATE) + 365 END AS end_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")

TABLES["emails"] = ((), f"""
SELECT CAST(event_id AS VARCHAR) AS engagement_id, CAST(user_id AS VARCHAR) AS constituent_id,
  'user' || user_id || '@example.com' AS email_address,
  {listed(tpch.EMAIL_TYPES, 'event_id % 4')} AS email_type,
  {listed(('new', 'core', 'lapsed'), 'user_id % 3')} AS audience_segment, CAST(ts AS DATE) AS send_date,
  CASE WHEN event_type = 'error' THEN 'bounced' ELSE 'delivered' END AS delivery_status,
  event_type IN ('view', 'click') AS opened, event_type = 'click' AS clicked
FROM events""")

TABLES["engagement"] = ((), """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS constituent_id, event_type,
  CAST(ts AS DATE) AS event_date, ts AS event_timestamp, props AS event_attributes,
  CAST(value AS DECIMAL(12,2)) AS donation_amount
FROM events""")

TABLES["predictions"] = ((), """
SELECT *, CASE WHEN prediction_score >= 0.85 THEN 'critical' WHEN prediction_score >= 0.6 THEN 'high'
    WHEN prediction_score >= 0.3 THEN 'medium' ELSE 'low' END AS prediction_tier
FROM (SELECT CAST(event_id AS VARCHAR) AS prediction_id, CAST(user_id AS VARCHAR) AS constituent_id,
  CASE WHEN event_id % 2 = 0 THEN 'churn_prediction' ELSE 'upgrade_propensity' END AS model_name,
  'v' || (user_id % 2 + 1) AS model_version, CAST(ts AS DATE) AS prediction_date,
  (event_id * 7919 % 10001) / CAST(10000.0 AS DOUBLE) AS prediction_score, props AS top_features
  FROM events)""")

TABLES["status_changes"] = ((), """
SELECT CAST(o_custkey AS VARCHAR) AS constituent_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'cancelled' WHEN '2-HIGH' THEN 'payment_failed_final'
    WHEN '3-MEDIUM' THEN 'payment_failed' ELSE 'resumed' END AS change_type, CAST(o_orderdate AS DATE) AS change_date
FROM orders WHERE o_orderstatus = 'P'""")

_NUMBER = "CAST(k * 37 % 900 + 100 AS VARCHAR)"
_LOCAL = "lpad(CAST(k * 104729 % 10000000 AS VARCHAR), 7, '0')"
_DOMAIN = "'mail' || (k % 61) || '.org'"
_ZIP = "lpad(CAST((k * 13) % 880 + 60000 AS VARCHAR), 5, '0')"
_FIRST = listed(tpch.FIRST_NAMES, "k % 20")
_LAST = listed(tpch.LAST_NAMES, "(k // 20) % 23")

TABLES["source_records"] = ((), f"""
SELECT 'donations' AS source_system, 'D' || k AS source_id,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 'Info@' || {_DOMAIN} ELSE ' User' || k || '@' || {_DOMAIN} END AS email,
  CASE WHEN k % 7 = 0 THEN NULL ELSE '(312) ' || {_LOCAL}[1:3] || '-' || {_LOCAL}[4:7] END AS phone,
  {_FIRST} AS first_name, {_LAST} AS last_name, CAST(NULL AS VARCHAR) AS full_name,
  {_NUMBER} || ' ' || {listed(tpch.STREETS, 'k % 7')} AS address_line1,
  {listed(tpch.CITIES, 'k % 4')} AS city, 'IL' AS state,
  CASE WHEN k % 5 = 0 THEN {_ZIP} || '-1234' ELSE {_ZIP} END AS zip_code,
  TIMESTAMP '2023-01-01' + to_days(CAST(k % 365 AS INTEGER)) AS updated_at
FROM (SELECT c_custkey AS k FROM customer)
UNION ALL
SELECT 'subscriptions', 'S' || k,
  CASE WHEN k % 17 = 0 THEN 'info@' || {_DOMAIN} WHEN k % 3 = 0 THEN 'alt' || k || '@' || {_DOMAIN}
    ELSE 'user' || k || '@' || {_DOMAIN} END,
  CASE WHEN k % 19 = 0 THEN '' WHEN k % 6 = 0 THEN '773' || {_LOCAL} ELSE '1-312-' || {_LOCAL}[1:3] || '-' || {_LOCAL}[4:7] END,
  CASE WHEN k % 4 = 0 THEN NULL ELSE {_FIRST} END, CASE WHEN k % 4 = 0 THEN NULL ELSE {_LAST} END,
  CASE WHEN k % 4 = 0 THEN {_FIRST} || ' M ' || {_LAST} END,
  {_NUMBER} || ' ' || {listed(tpch.STREETS_SHORT, 'k % 7')}, {listed(tpch.CITIES, 'k % 4')}, 'IL', {_ZIP},
  CASE WHEN k % 2 = 0 THEN TIMESTAMP '2023-01-01' + to_days(CAST((k * 7) % 365 AS INTEGER)) END
FROM (SELECT DISTINCT o_custkey AS k FROM orders)
UNION ALL
SELECT 'tickets', 'T' || s, 'user' || k || '@' || {_DOMAIN}, NULL, NULL, NULL,
  ({_FIRST})[1] || '. ' || {_LAST}, NULL, NULL, NULL, NULL, NULL
FROM (SELECT s_suppkey AS s, s_suppkey * 3 AS k FROM supplier)""")

_TRIM = "trim({0}, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"
_PHONE = """CASE WHEN length(CASE WHEN length(d) = 11 AND d LIKE '1%' THEN d[2:] ELSE d END) = 10
    THEN CASE WHEN length(d) = 11 AND d LIKE '1%' THEN d[2:] ELSE d END ELSE phone END"""

ADDRESS_SQL = "trim(lower(coalesce(address_line1, '')))"
for _word, _short in (
    ("street", "st"), ("str", "st"), ("avenue", "ave"), ("av", "ave"), ("road", "rd"), ("drive", "dr"),
    ("boulevard", "blvd"), ("lane", "ln"), ("court", "ct"), ("apartment", "apt"), ("unit", "apt"),
    ("suite", "ste"), ("north", "n"), ("south", "s"), ("east", "e"), ("west", "w"),
):
    ADDRESS_SQL = f"regexp_replace({ADDRESS_SQL}, '\\b{_word}\\b', '{_short}', 'g')"
ADDRESS_SQL = f"trim(regexp_replace(regexp_replace({ADDRESS_SQL}, '[,.]', '', 'g'), '\\s+', ' ', 'g'))"

# normalised contact rows with the values the matcher compares
TABLES["records"] = (("source_records",), f"""
SELECT *, 
  CASE WHEN coalesce(first_name, '') <> '' AND coalesce(last_name, '') <> '' THEN lower(first_name)
    WHEN coalesce(full_name, '') <> '' THEN lower(string_split(full_name, ' ')[1]) ELSE '' END AS first_part,
  CASE WHEN coalesce(first_name, '') <> '' AND coalesce(last_name, '') <> '' THEN lower(last_name)
    WHEN len(string_split(full_name, ' ')) >= 2 THEN lower(string_split(full_name, ' ')[-1]) ELSE '' END AS last_part,
  {ADDRESS_SQL} AS address,
  CASE WHEN email LIKE '%@%' THEN string_split(email, '@')[-1] ELSE '' END AS domain,
  coalesce(email IS NULL OR regexp_matches(email, '^(info|admin|support|contact|hello|noreply|no-reply|webmaster|postmaster)@'), true) AS generic_email
FROM (
  SELECT source_system || ':' || source_id AS record_key, source_system, source_id,
    nullif({_TRIM.format('lower(email)')}, '') AS email, nullif({_PHONE}, '') AS phone,
    nullif({_TRIM.format('first_name')}, '') AS first_name, nullif({_TRIM.format('last_name')}, '') AS last_name,
    nullif({_TRIM.format('full_name')}, '') AS full_name,
    address_line1, city, state, nullif(zip_code[1:5], '') AS zip_code, updated_at
  FROM (SELECT *, regexp_replace(phone, '[^0-9]', '', 'g') AS d FROM source_records))""")

# every pair of records, compared without any blocking
TABLES["all_pairs"] = (("records",), """
SELECT *, CASE WHEN match_type0 IS NOT NULL THEN match_type0
    WHEN score >= 0.85 THEN 'probabilistic' WHEN score >= 0.70 THEN 'manual_review' ELSE 'no_match' END AS match_type
FROM (
  SELECT *, CASE WHEN email_a = email_b AND NOT generic_a THEN 'deterministic_email'
      WHEN phone_a = phone_b AND length(phone_a) >= 10 THEN 'deterministic_phone' END AS match_type0,
    CAST(name_score * CAST(0.35 AS DOUBLE) + address_score * CAST(0.30 AS DOUBLE) + phone_score * CAST(0.15 AS DOUBLE)
      + domain_score * CAST(0.10 AS DOUBLE) + zip_score * CAST(0.10 AS DOUBLE) AS DOUBLE) AS score
  FROM (
    SELECT a.record_key AS key_a, b.record_key AS key_b, a.email AS email_a, b.email AS email_b,
      a.phone AS phone_a, b.phone AS phone_b, a.generic_email AS generic_a,
      CASE WHEN a.first_part <> '' AND b.first_part <> '' THEN jaro_winkler_similarity(a.first_part, b.first_part) ELSE CAST(0 AS DOUBLE) END * CAST(0.4 AS DOUBLE)
      + CASE WHEN a.last_part <> '' AND b.last_part <> '' THEN jaro_winkler_similarity(a.last_part, b.last_part) ELSE CAST(0 AS DOUBLE) END * CAST(0.6 AS DOUBLE) AS name_score,
      CASE WHEN a.address <> '' AND b.address <> '' THEN jaro_winkler_similarity(a.address, b.address) ELSE CAST(0 AS DOUBLE) END AS address_score,
      CAST(CASE WHEN a.phone = b.phone THEN 1 WHEN length(a.phone) >= 7 AND length(b.phone) >= 7 AND right(a.phone, 7) = right(b.phone, 7)
        THEN 0.8 ELSE 0 END AS DOUBLE) AS phone_score,
      CAST(CASE WHEN a.domain <> '' AND a.domain = b.domain THEN 1 ELSE 0 END AS DOUBLE) AS domain_score,
      CAST(CASE WHEN a.zip_code = b.zip_code THEN 1 WHEN a.zip_code[1:3] = b.zip_code[1:3] THEN 0.5 ELSE 0 END AS DOUBLE) AS zip_score
    FROM records a JOIN records b ON a.record_key < b.record_key))""")

TABLES["account_family"] = ((), f"""
SELECT {hh('c_custkey')} AS crm_household_id, {listed(tpch.FIRST_NAMES, 'c_custkey % 20')} AS first_name,
  CASE WHEN c_custkey % 29 = 0 THEN 'SPOUSE' ELSE 'HEAD_OF_HOUSEHOLD' END AS family_role_code,
  CASE WHEN c_custkey % 31 = 0 THEN 'I' ELSE 'A' END AS record_status,
  CASE WHEN c_custkey % 20 = 0 THEN 'Y' WHEN c_custkey % 37 = 0 THEN NULL ELSE 'N' END AS do_not_contact
FROM customer""")
TABLES["account"] = ((), f"""
SELECT {hh('c_custkey')} AS crm_household_id, 'PER-' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS crm_person_id,
  (c_custkey % 400 + 1) || ' Main St' AS household_address_line FROM customer""")
TABLES["primary_address"] = ((), f"""
SELECT 'PER-' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS crm_person_id, (c_custkey % 400 + 1) || ' Main Street' AS street,
  CASE c_custkey % 4 WHEN 1 THEN 'Suite 100' WHEN 2 THEN 'Apt 200' END AS address_altline1,
  {listed(tpch.CITIES, 'c_custkey % 4')} AS city, 'IL' AS state_code, 'USA' AS country_name,
  CAST(c_custkey % 100 + 60601 AS VARCHAR) AS postal_code,
  CASE WHEN c_custkey % 10 = 3 THEN 'UNDELIVERABLE' ELSE 'MAILABLE' END AS address_status_code,
  CASE WHEN c_custkey % 12 = 5 THEN 'N' ELSE 'Y' END AS address_contact_status
FROM customer""")
TABLES["account_flag"] = ((), f"""
SELECT {hh('o_custkey')} AS crm_household_id,
  coalesce({listed(('Major Donor Prospect', 'Major Donor', 'Deceased', 'No Mail', 'No Renewals', 'Volunteer'), 'o_orderkey % 400')}, 'Newsletter') AS flag_name
FROM orders""")
TABLES["crm_gifts"] = (("donations",), """
SELECT CAST(constituent_id AS BIGINT) AS c_custkey, min(donation_date) AS first_date,
  max({'d': donation_date, 'i': CAST(donation_id AS BIGINT), 'a': donation_amount}) AS last_gift
FROM donations WHERE donation_type = 'one_time' AND donation_status <> 'refunded' GROUP BY 1""")
TABLES["member_journey"] = (("crm_gifts",), f"""
SELECT {hh('customer.c_custkey')} AS crm_household_id,
  {listed(('One-Time', 'Sustaining', 'One-Time', 'Monthly'), 'customer.c_custkey % 4')} AS member_journey_type_name,
  {listed(('Active', 'Dormant', 'Lapsed', 'Late', 'New', 'Renewal', 'Suppressed'), 'customer.c_custkey % 7')} AS member_journey_segment_name,
  CAST(last_gift.a * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(12,2)) AS most_recent_one_time_amount, last_gift.d AS most_recent_one_time_date
FROM customer LEFT JOIN crm_gifts ON customer.c_custkey = crm_gifts.c_custkey""")
TABLES["membership"] = ((), f"""
SELECT {hh('c_custkey')} AS crm_household_id,
  CASE WHEN c_custkey % 5 < 3 THEN {listed(('BASIC', 'SUSTAINER', 'LEADERSHIP', 'BASIC', 'MAJOR_DONOR'), '(c_custkey % 25) // 5')} END AS membership_sub_level_code
FROM customer""")
TABLES["gift_summary"] = (("crm_gifts",), f"""
SELECT {hh('c_custkey')} AS crm_household_id,
  CASE WHEN c_custkey % 9 = 0 THEN 'OTHER' ELSE 'MEMBERSHIP_OVERALL - HOUSEHOLD' END AS summary_type,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(first_date + INTERVAL 60 MONTH AS DATE) ELSE first_date END AS first_gift_date
FROM crm_gifts""")


def with_tables(names, body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix the body with the named tables and everything they read."""
    ordered: list[str] = []

    def add(name):
        if name in ordered:
            return
        for needed in TABLES[name][0]:
            add(needed)
        ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body.strip()
    recursive = "RECURSIVE " if "WITH RECURSIVE" in body else ""
    body = body.replace("WITH RECURSIVE", "WITH", 1).strip()
    parts = [f"{name} AS ({TABLES[name][1]})" for name in ordered]
    if body.upper().startswith("WITH "):
        return f"WITH {recursive}" + ",\n".join(parts) + ",\n" + body[5:]
    return f"WITH {recursive}" + ",\n".join(parts) + "\n" + body
