"""Direct-mail campaign queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from constituent360.operators import campaign as C
from constituent360.operators.totals import number_rows
from constituent360.plans.registry import query
from constituent360.session import cut_lineage
from constituent360.sources import tpch

PARAMS = C.CampaignParams(dt.date(2000, 7, 1), dt.date(2001, 7, 31), dt.date(2000, 2, 1))
TABLES = ("account_family", "account", "primary_address", "account_flag", "member_journey", "membership", "gift_summary")

CTES = f"""excluded AS (SELECT DISTINCT crm_household_id FROM account_flag
  WHERE flag_name IN ('Major Donor Prospect', 'Major Donor', 'Deceased', 'No Mail', 'No Renewals')),
heads AS (SELECT crm_household_id, first_name FROM account_family WHERE family_role_code = 'HEAD_OF_HOUSEHOLD' AND record_status = 'A' AND do_not_contact = 'N'
  AND crm_household_id NOT IN (SELECT crm_household_id FROM excluded)),
places AS (SELECT * EXCLUDE (address_status_code, address_contact_status) FROM primary_address WHERE address_status_code = 'MAILABLE' AND address_contact_status = 'Y'),
journeys AS (SELECT * EXCLUDE (member_journey_segment_name) FROM member_journey WHERE member_journey_segment_name IN ('Active', 'Dormant', 'Lapsed', 'Late', 'New', 'Renewal')),
firsts AS (SELECT crm_household_id, first_gift_date FROM gift_summary WHERE summary_type = 'MEMBERSHIP_OVERALL - HOUSEHOLD'),
eligible AS (SELECT crm_household_id, crm_person_id, household_address_line, first_name, street, address_altline1, city, state_code, country_name, postal_code,
    membership_sub_level_code, member_journey_type_name, most_recent_one_time_amount, most_recent_one_time_date, first_gift_date
  FROM heads JOIN account USING (crm_household_id) JOIN journeys USING (crm_household_id) JOIN places USING (crm_person_id)
  LEFT JOIN membership USING (crm_household_id) LEFT JOIN firsts USING (crm_household_id)
  WHERE coalesce(membership_sub_level_code, '') <> 'MAJOR_DONOR'),
one_time AS (SELECT crm_household_id, crm_person_id, most_recent_one_time_amount AS gift, first_gift_date AS since FROM eligible
  WHERE member_journey_type_name = 'One-Time' AND most_recent_one_time_date >= DATE '{PARAMS.recent_start}' AND most_recent_one_time_date <= DATE '{PARAMS.recent_end}'),
chosen AS (SELECT crm_household_id, crm_person_id, '{C.LEADERSHIP}' AS bucket FROM one_time WHERE gift >= 1200
  UNION SELECT crm_household_id, crm_person_id, '{C.FIRST_YEAR}' FROM one_time WHERE gift < 1200 AND since >= DATE '{PARAMS.first_year_cutoff}'),
bucketed AS (SELECT eligible.*, bucket AS "DirectMailSubType" FROM eligible LEFT JOIN chosen USING (crm_household_id, crm_person_id)),
listing AS (SELECT * EXCLUDE (first_gift_date) FROM bucketed WHERE "DirectMailSubType" IS NOT NULL)"""


def listing(spark, sf_dir):
    return C.mailing_list(tpch.crm_tables(spark, sf_dir), PARAMS)


@query("campaign_excluded_households", f"WITH {CTES} SELECT * FROM excluded", TABLES)
def _(spark, sf_dir):
    return C.excluded_households(tpch.crm_tables(spark, sf_dir)["account_flag"], PARAMS.excluded_flags)


@query("campaign_eligible", f"WITH {CTES} SELECT * FROM eligible", TABLES)
def _(spark, sf_dir):
    return C.eligible_constituents(tpch.crm_tables(spark, sf_dir), PARAMS)


@query("campaign_buckets", f"""WITH {CTES} SELECT "DirectMailSubType", count(*) AS n FROM bucketed GROUP BY 1""", TABLES)
def _(spark, sf_dir):
    rows = C.eligible_constituents(tpch.crm_tables(spark, sf_dir), PARAMS)
    return C.assign_buckets(rows, C.standard_rules(PARAMS)).groupBy("DirectMailSubType").agg(F.count("*").alias("n"))


@query("campaign_mailing_list", f"""WITH {CTES} SELECT * FROM listing ORDER BY "DirectMailSubType", postal_code, crm_household_id""", TABLES)
def _(spark, sf_dir):
    return listing(spark, sf_dir)


@query("campaign_household_dedupe", f"""WITH {CTES} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY crm_household_id
  ORDER BY most_recent_one_time_date DESC, most_recent_one_time_amount DESC, crm_person_id DESC) AS rn FROM listing) WHERE rn = 1""", TABLES)
def _(spark, sf_dir):
    return C.dedupe_household(listing(spark, sf_dir))


@query("campaign_bucket_stats", f"""WITH {CTES} SELECT "DirectMailSubType", count(*) AS households, CAST(sum(most_recent_one_time_amount) AS DOUBLE) / count(*) AS mean_gift,
  CAST(sum(most_recent_one_time_amount) AS DECIMAL(18,2)) AS total_gifts, min(most_recent_one_time_amount) AS least_gift, max(most_recent_one_time_amount) AS largest_gift,
  CAST(count(*) * 100.0 / sum(count(*)) OVER () AS DOUBLE) AS share_pct, quantile_cont(CAST(most_recent_one_time_amount AS DOUBLE), 0.5) AS median_gift FROM listing GROUP BY 1""", TABLES)
def _(spark, sf_dir):
    return C.bucket_stats(listing(spark, sf_dir))


@query("campaign_top_cities", f"WITH {CTES} SELECT city, count(*) AS count FROM listing GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5", TABLES)
def _(spark, sf_dir):
    return C.top_cities(listing(spark, sf_dir))


@query("campaign_funnel", f"""WITH {CTES} SELECT 0 AS step, 'all_households' AS name, (SELECT count(*) FROM account_family) AS rows
UNION ALL SELECT 1, 'not_do_not_contact', (SELECT count(*) FROM account_family WHERE do_not_contact = 'N')
UNION ALL SELECT 2, 'mailable_address', (SELECT count(*) FROM primary_address WHERE address_status_code = 'MAILABLE')
UNION ALL SELECT 3, 'eligible_segment', (SELECT count(*) FROM member_journey WHERE member_journey_segment_name IN ('Active', 'Dormant', 'Lapsed', 'Late', 'New', 'Renewal'))
UNION ALL SELECT 4, 'no_exclusion_flag', (SELECT count(DISTINCT crm_household_id) FROM account_family) - (SELECT count(*) FROM excluded)
UNION ALL SELECT 5, 'eligible', (SELECT count(*) FROM eligible) UNION ALL SELECT 6, 'in_bucket', (SELECT count(*) FROM listing)""", TABLES)
def _(spark, sf_dir):
    return C.campaign_funnel(tpch.crm_tables(spark, sf_dir), PARAMS)


@query("campaign_checks", f"""WITH {CTES}, v AS (SELECT 'required_columns' AS check_name, 0 AS violations
UNION ALL SELECT 'critical_not_null', count(*) FROM listing WHERE crm_household_id IS NULL OR crm_person_id IS NULL OR street IS NULL OR city IS NULL OR postal_code IS NULL OR "DirectMailSubType" IS NULL
UNION ALL SELECT 'valid_bucket', count(*) FROM listing WHERE "DirectMailSubType" NOT IN ('{C.FIRST_YEAR}', '{C.LEADERSHIP}')
UNION ALL SELECT 'first_year_logic', count(*) FROM listing WHERE "DirectMailSubType" = '{C.FIRST_YEAR}' AND NOT (member_journey_type_name = 'One-Time' AND most_recent_one_time_amount < 1200)
UNION ALL SELECT 'leadership_logic', count(*) FROM listing WHERE "DirectMailSubType" = '{C.LEADERSHIP}' AND NOT (member_journey_type_name = 'One-Time' AND most_recent_one_time_amount >= 1200)
UNION ALL SELECT 'unique_household', coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM listing GROUP BY crm_household_id))
SELECT *, violations = 0 AS passed FROM v""", TABLES)
def _(spark, sf_dir):
    return C.validate_mailing_list(listing(spark, sf_dir), PARAMS)


@query("campaign_report", f"""WITH {CTES} SELECT DATE '{PARAMS.recent_start}' AS recent_start, DATE '{PARAMS.recent_end}' AS recent_end, DATE '{PARAMS.first_year_cutoff}' AS first_year_cutoff,
  1200 AS leadership_threshold, count(*) AS total_mailable, count(*) FILTER ("DirectMailSubType" = '{C.FIRST_YEAR}') AS first_year_rows,
  count(*) FILTER ("DirectMailSubType" = '{C.LEADERSHIP}') AS leadership_rows, CAST(sum(most_recent_one_time_amount) AS DECIMAL(18,2)) AS total_value,
  CAST(sum(most_recent_one_time_amount) AS DOUBLE) / count(*) AS average_value FROM listing""", TABLES)
def _(spark, sf_dir):
    return C.campaign_report(listing(spark, sf_dir), PARAMS)


@query("campaign_sort_check", f"WITH {CTES} SELECT count(*) AS rows, 0 AS violations FROM listing", TABLES)
def _(spark, sf_dir):
    numbered = cut_lineage(number_rows(listing(spark, sf_dir)))
    return C.sort_violations(numbered, "position").select(F.col("rows"), "violations")
