"""Identity-resolution queries. Their SQL compares every pair of records without any blocking."""

from __future__ import annotations

from pyspark.sql import functions as F

from constituent360.functions import text as T
from constituent360.operators import golden as G
from constituent360.operators import identity as I
from constituent360.operators import journey as J
from constituent360.operators import matching as M
from constituent360.operators import models as L
from constituent360.operators.match_store import MatchStore
from constituent360.plans.golden import EVENT_SHIFT
from constituent360.plans.models import CUTOFF
from constituent360.plans.registry import query
from constituent360.plans.sql_domain import AS_OF
from constituent360.session import cut_lineage, scratch
from constituent360.sources import tpch

CFG = M.MatchConfig()

# record pairs grouped by the compared values of both sides
PROFILES = """profiles AS (SELECT first_part, last_part, address, phone, email, zip_code, min(record_key) AS profile, count(*) AS copies FROM records GROUP BY ALL),
named AS (SELECT record_key, p.profile, p.copies FROM records r JOIN profiles p ON r.first_part = p.first_part AND r.last_part = p.last_part AND r.address = p.address
  AND r.phone IS NOT DISTINCT FROM p.phone AND r.email IS NOT DISTINCT FROM p.email AND r.zip_code IS NOT DISTINCT FROM p.zip_code),
scored AS (SELECT a.profile AS profile_a, b.profile AS profile_b, a.copies AS copies_a, b.copies AS copies_b, match_type, score AS confidence,
    name_score, address_score, phone_score, domain_score, zip_score
  FROM all_pairs JOIN profiles a ON key_a = a.profile JOIN profiles b ON key_b = b.profile WHERE match_type IN ('probabilistic', 'manual_review'))"""
CLUSTERS = """edges AS (SELECT key_a AS a, key_b AS b FROM all_pairs WHERE match_type IN ('deterministic_email', 'deterministic_phone', 'probabilistic')),
both_ways AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
reach(k, m) AS (SELECT record_key, record_key FROM records UNION SELECT r.k, e.b FROM reach r JOIN both_ways e ON r.m = e.a),
clusters AS (SELECT k AS record_key, min(m) AS cluster FROM reach GROUP BY 1)"""


def records(spark, sf_dir):
    return M.prepare(tpch.source_records(spark, sf_dir), CFG)


@query("identity_records", """SELECT record_key, email, phone, first_name, last_name, full_name, zip_code, first_part, last_part, address,
  CASE WHEN NOT generic_email THEN email END AS personal_email, domain FROM records""", ("records",))
def _(spark, sf_dir):
    return records(spark, sf_dir).select(
        "record_key", "email", "phone", "first_name", "last_name", "full_name", "zip_code", "first_part", "last_part",
        "address", "personal_email", F.coalesce(T.email_domain(F.col("email")), F.lit("")).alias("domain"),
    )


@query("identity_email_groups", """SELECT email AS personal_email, min(record_key) AS representative, count(*) AS records, count(*) * (count(*) - 1) // 2 AS pairs
FROM records WHERE NOT generic_email GROUP BY 1 HAVING count(*) > 1""", ("records",))
def _(spark, sf_dir):
    return M.email_groups(records(spark, sf_dir))


@query("identity_phone_groups", """SELECT r.phone AS full_phone, min(record_key) AS representative, count(*) AS records,
  (SELECT count(*) FROM all_pairs p WHERE p.phone_a = r.phone AND match_type = 'deterministic_phone') AS pairs
FROM records r WHERE length(r.phone) >= 10 GROUP BY 1 HAVING count(*) > 1""", ("records", "all_pairs"))
def _(spark, sf_dir):
    return M.phone_groups(records(spark, sf_dir))


@query("identity_scored_matches", f"""WITH {PROFILES} SELECT profile_a, profile_b, copies_a, copies_b, match_type, round(confidence, 9) AS confidence, round(name_score, 9) AS name_score,
  round(address_score, 9) AS address_score, phone_score, domain_score, zip_score FROM scored""", ("all_pairs",))
def _(spark, sf_dir):
    m = M.scored_matches(records(spark, sf_dir), CFG)
    return m.withColumns({c: F.round(c, 9) for c in ("confidence", "name_score", "address_score")})


@query("identity_match_reasons", f"""WITH {PROFILES}, r AS (SELECT profile_a, profile_b, unnest([
    CASE WHEN name_score > 0.8 THEN 'Strong name match (' || printf('%.2f', name_score) || ')' WHEN name_score > 0.6 THEN 'Moderate name match (' || printf('%.2f', name_score) || ')' END,
    CASE WHEN address_score > 0.8 THEN 'Strong address match (' || printf('%.2f', address_score) || ')' WHEN address_score > 0.6 THEN 'Moderate address match (' || printf('%.2f', address_score) || ')' END,
    CASE WHEN phone_score > 0 THEN 'Phone match (' || printf('%.2f', phone_score) || ')' END,
    CASE WHEN zip_score = 1 THEN 'Same zip code' END]) AS reason FROM scored)
SELECT * FROM r WHERE reason IS NOT NULL""", ("all_pairs",))
def _(spark, sf_dir):
    m = M.explain_pairs(M.scored_matches(records(spark, sf_dir), CFG))
    return m.select("profile_a", "profile_b", F.explode("match_reasons").alias("reason"))


@query("identity_matches_per_record", f"""WITH {PROFILES} SELECT profile_a AS record, profile_b AS other, match_type, round(confidence, 9) AS confidence FROM scored
UNION ALL SELECT profile_b, profile_a, match_type, round(confidence, 9) FROM scored""", ("all_pairs",))
def _(spark, sf_dir):
    return I.matches_per_record(M.scored_matches(records(spark, sf_dir), CFG)).withColumn("confidence", F.round("confidence", 9))


@query("identity_match_type_counts", "SELECT match_type, count(*) AS pairs FROM all_pairs WHERE match_type <> 'no_match' GROUP BY 1", ("all_pairs",))
def _(spark, sf_dir):
    r = cut_lineage(records(spark, sf_dir))
    p = cut_lineage(M.profiles(r))
    return I.match_type_counts(r, p, M.scored_profiles(p, CFG, CFG.review_threshold), CFG)


@query("identity_clusters", f"WITH RECURSIVE {CLUSTERS} SELECT * FROM clusters", ("all_pairs",))
def _(spark, sf_dir):
    return unified(spark, sf_dir).clusters


@query("identity_clusters_deterministic", f"WITH RECURSIVE {CLUSTERS.replace(', ' + chr(39) + 'probabilistic' + chr(39), '')} SELECT * FROM clusters", ("all_pairs",))
def _(spark, sf_dir):
    return I.unify(tpch.source_records(spark, sf_dir), CFG, probabilistic=False).clusters


GOLDEN = f"""WITH RECURSIVE {CLUSTERS}, m AS (SELECT r.*, c.cluster, coalesce(first_name, CASE WHEN len(string_split(full_name, ' ')) >= 2 THEN string_split(full_name, ' ')[1] END) AS any_first,
    CASE WHEN first_name IS NULL AND len(string_split(full_name, ' ')) >= 2 THEN string_split(full_name, ' ')[-1] END AS split_last
  FROM records r JOIN clusters c USING (record_key)),
lasts AS (SELECT cluster, record_key, 0 AS o, last_name AS v FROM m WHERE last_name IS NOT NULL UNION ALL SELECT cluster, record_key, 1, split_last FROM m WHERE split_last IS NOT NULL),
golden AS (SELECT 'UC-' || sha256(cluster)[1:16] AS constituent_id, cluster,
  coalesce((SELECT email FROM m x WHERE x.cluster = c.cluster AND email IS NOT NULL AND updated_at IS NOT NULL ORDER BY updated_at DESC, record_key LIMIT 1),
    (SELECT email FROM m x WHERE x.cluster = c.cluster AND email IS NOT NULL AND NOT regexp_matches(email, '^(info|admin|support)@') ORDER BY record_key LIMIT 1),
    (SELECT email FROM m x WHERE x.cluster = c.cluster AND email IS NOT NULL ORDER BY record_key LIMIT 1)) AS canonical_email,
  (SELECT any_first FROM m x WHERE x.cluster = c.cluster AND any_first IS NOT NULL ORDER BY length(any_first) DESC, record_key LIMIT 1) AS canonical_first_name,
  (SELECT v FROM lasts x WHERE x.cluster = c.cluster ORDER BY length(v) DESC, record_key, o LIMIT 1) AS canonical_last_name,
  CASE WHEN (SELECT count(*) FROM m x WHERE x.cluster = c.cluster AND length(phone) >= 10) > 0 THEN
    coalesce((SELECT phone FROM m x WHERE x.cluster = c.cluster AND phone IS NOT NULL AND updated_at IS NOT NULL ORDER BY updated_at DESC, record_key LIMIT 1),
      (SELECT phone FROM m x WHERE x.cluster = c.cluster AND length(phone) >= 10 ORDER BY record_key LIMIT 1)) END AS canonical_phone,
  coalesce((SELECT {{'a': address_line1, 'c': city, 's': state, 'z': zip_code}} FROM m x WHERE x.cluster = c.cluster AND address_line1 <> '' AND updated_at IS NOT NULL ORDER BY updated_at DESC, record_key LIMIT 1),
    (SELECT {{'a': address_line1, 'c': city, 's': state, 'z': zip_code}} FROM m x WHERE x.cluster = c.cluster AND address_line1 <> '' ORDER BY record_key LIMIT 1)) AS place,
  (SELECT count(*) FROM m x WHERE x.cluster = c.cluster) AS record_count,
  (SELECT string_agg(DISTINCT source_system, '+' ORDER BY source_system) FROM m x WHERE x.cluster = c.cluster) AS sources
FROM (SELECT DISTINCT cluster FROM clusters) c)"""


def unified(spark, sf_dir):
    return I.unify(tpch.source_records(spark, sf_dir), CFG)


@query("golden_records", f"""{GOLDEN} SELECT constituent_id, cluster, canonical_email, canonical_first_name, canonical_last_name, canonical_phone, place.a AS canonical_address_line1,
  place.c AS canonical_city, place.s AS canonical_state, place.z AS canonical_zip, record_count, sources AS source_systems FROM golden""", ("all_pairs",))
def _(spark, sf_dir):
    return unified(spark, sf_dir).constituents.withColumn("source_systems", F.array_join("source_systems", "+"))


@query("identity_source_links", f"""WITH RECURSIVE {CLUSTERS}, ends AS (SELECT key_a AS k, match_type, score FROM all_pairs UNION ALL SELECT key_b, match_type, score FROM all_pairs),
b AS (SELECT k, max(CASE match_type WHEN 'deterministic_email' THEN 3 WHEN 'deterministic_phone' THEN 2 WHEN 'probabilistic' THEN 1 END) AS t,
  max(score) FILTER (match_type = 'probabilistic') AS s FROM ends GROUP BY 1)
SELECT sha256(record_key) AS link_id, 'UC-' || sha256(cluster)[1:16] AS constituent_id, source_system, source_id AS source_record_id,
  CASE t WHEN 3 THEN 'deterministic_email' WHEN 2 THEN 'deterministic_phone' WHEN 1 THEN 'probabilistic' ELSE 'no_match' END AS match_type,
  round(CASE t WHEN 3 THEN CAST(1 AS DOUBLE) WHEN 2 THEN CAST(0.95 AS DOUBLE) WHEN 1 THEN s END, 9) AS match_confidence
FROM records JOIN clusters USING (record_key) LEFT JOIN b ON k = record_key""", ("all_pairs",))
def _(spark, sf_dir):
    return unified(spark, sf_dir).links.withColumn("match_confidence", F.round("match_confidence", 9))


@query("identity_match_audit", f"""WITH RECURSIVE {CLUSTERS}, p AS (SELECT key_a, key_b, match_type, CASE match_type WHEN 'deterministic_email' THEN 1 WHEN 'deterministic_phone' THEN CAST(0.95 AS DOUBLE) ELSE score END AS confidence
  FROM all_pairs WHERE match_type <> 'no_match'),
e AS (SELECT a.cluster, match_type, confidence FROM p JOIN clusters a ON key_a = a.record_key
  UNION ALL SELECT b.cluster, match_type, confidence FROM p JOIN clusters a ON key_a = a.record_key JOIN clusters b ON key_b = b.record_key WHERE a.cluster <> b.cluster)
SELECT cluster, match_type, count(*) AS pairs, round(max(confidence), 9) AS best_confidence, round(min(confidence), 9) AS least_confidence FROM e GROUP BY 1, 2""", ("all_pairs",))
def _(spark, sf_dir):
    audit = unified(spark, sf_dir).audit
    return audit.withColumns({c: F.round(c, 9) for c in ("best_confidence", "least_confidence")})


@query("identity_match_statistics", f"""{GOLDEN}, t AS (SELECT count(*) AS c, sum(record_count) AS r, count(*) FILTER (contains(sources, '+')) AS x FROM golden)
SELECT 'total_constituents' AS statistic, CAST(NULL AS VARCHAR) AS key, CAST(c AS DOUBLE) AS value FROM t UNION ALL SELECT 'total_source_records', NULL, r FROM t
UNION ALL SELECT 'avg_records_per_constituent', NULL, r / c FROM t UNION ALL SELECT 'cross_source_constituents', NULL, x FROM t UNION ALL SELECT 'consolidation_rate', NULL, (r - c) * 100.0 / r FROM t
UNION ALL SELECT 'record_count', CAST(record_count AS VARCHAR), count(*) FROM golden GROUP BY 2 UNION ALL SELECT 'source_systems', sources, count(*) FROM golden GROUP BY 2""", ("all_pairs",))
def _(spark, sf_dir):
    return I.match_statistics(unified(spark, sf_dir).constituents)


@query("identity_incremental", f"WITH RECURSIVE {CLUSTERS} SELECT * FROM clusters", ("all_pairs",))
def _(spark, sf_dir):
    """Tickets arrive after the other two systems were clustered; the result equals one full run."""
    raw = tpch.source_records(spark, sf_dir)
    old, new = raw.where("source_system <> 'tickets'"), raw.where("source_system = 'tickets'")
    return I.unify_incremental(new, old, I.unify(old, CFG).clusters, CFG)


@query("identity_stored_batches", f"WITH RECURSIVE {CLUSTERS} SELECT * FROM clusters", ("all_pairs",))
def _(spark, sf_dir):
    """Each source system arrives as a batch of its own; a batch reads only the stored blocks that it touches."""
    raw = cut_lineage(tpch.source_records(spark, sf_dir))
    store = MatchStore(spark, scratch(spark, "matches"), CFG, 8)
    for system in ("donations", "subscriptions", "tickets"):
        store.add(raw.where(F.col("source_system") == system))
    return store.clusters()


@query("identity_fuzzy_join", """SELECT a.record_key AS record_key, b.record_key AS right_record_key, round(jaro_winkler_similarity(a.last_part, b.last_part), 9) AS similarity
FROM records a JOIN records b ON a.zip_code = b.zip_code WHERE a.source_system = 'donations' AND b.source_system = 'subscriptions' AND a.last_part <> '' AND b.last_part <> ''
  AND jaro_winkler_similarity(a.last_part, b.last_part) > 0.8""", ("records",))
def _(spark, sf_dir):
    r = records(spark, sf_dir).select("record_key", "source_system", "zip_code", "last_part")
    side = lambda s: r.where(F.col("source_system") == s).drop("source_system")
    out = M.fuzzy_join(side("donations"), side("subscriptions"), ["zip_code"], "last_part", "last_part", 0.8)
    return out.select("record_key", "right_record_key", F.round("similarity", 9).alias("similarity"))


@query("identity_block_sizes", """SELECT CASE WHEN last_part <> '' THEN last_part[1:3] ELSE 'NONAME' END || '_' || coalesce(zip_code, '')[1:3] AS block, count(*) AS records FROM records GROUP BY 1""", ("records",))
def _(spark, sf_dir):
    block = M.block_key(F.col("last_part"), F.col("zip_code"))
    return records(spark, sf_dir).groupBy(block.alias("block")).agg(F.count("*").alias("records"))


# Soundex in SQL: code the letters, drop H and W, merge runs, drop vowels, pad
_CODE = "translate(upper(n)[1] || regexp_replace(upper(n)[2:], '[HW]', '', 'g'), 'AEIOUYBFPVCGJKQSXZDTLMNR', '000000111122222222334556')"
for _d in "0123456":
    _CODE = f"regexp_replace({_CODE}, '{_d}+', '{_d}', 'g')"


@query("identity_phonetic_groups", f"""SELECT rpad(upper(n)[1] || replace(({_CODE})[2:], '0', ''), 4, '0')[1:4] AS code, string_agg(DISTINCT n, '+' ORDER BY n) AS spellings, count(*) AS constituents
FROM (SELECT canonical_last_name AS n FROM constituents) GROUP BY 1""", ("constituents",))
def _(spark, sf_dir):
    c = tpch.constituents(spark, sf_dir)
    per = c.groupBy(F.soundex("canonical_last_name").alias("code"), "canonical_last_name").agg(F.count("*").alias("n"))
    return per.groupBy("code").agg(
        F.array_join(F.array_sort(F.collect_set("canonical_last_name")), "+").alias("spellings"), F.sum("n").alias("constituents")
    )


@query("identity_threshold_tuning", f"""WITH {PROFILES}, l AS (SELECT confidence, (profile_a LIKE '%:D%' OR profile_a LIKE '%:S%') AND (profile_b LIKE '%:D%' OR profile_b LIKE '%:S%')
  AND regexp_extract(profile_a, '[0-9]+$') = regexp_extract(profile_b, '[0-9]+$') AS y FROM scored),
t AS (SELECT confidence AS threshold, count(*) FILTER (y) AS p, count(*) FILTER (NOT y) AS n FROM l GROUP BY 1),
c AS (SELECT threshold, sum(p) OVER (ORDER BY threshold DESC) AS tp, sum(n) OVER (ORDER BY threshold DESC) AS fp, sum(p) OVER () AS pos FROM t),
f AS (SELECT threshold, tp / CAST(tp + fp AS DOUBLE) AS precision, tp / CAST(pos AS DOUBLE) AS recall FROM c)
SELECT round(threshold, 9) AS threshold, round(precision, 9) AS precision, round(recall, 9) AS recall, round(2 * precision * recall / (precision + recall), 9) AS f1 FROM f
ORDER BY 2 * precision * recall / (precision + recall) DESC NULLS LAST, threshold DESC LIMIT 1""", ("all_pairs",))
def _(spark, sf_dir):
    """Best review threshold when the customer number is taken as the truth."""
    number = lambda c: F.regexp_extract(c, "[0-9]+$", 0)
    person = lambda c: F.col(c).rlike(":[DS]")
    same = person("profile_a") & person("profile_b") & (number("profile_a") == number("profile_b"))
    scored = M.scored_matches(records(spark, sf_dir), CFG).withColumn("label", same.cast("int"))
    best = M.tune_threshold(scored)
    return best.select(*[F.round(c, 9).alias(c) for c in ("threshold", "precision", "recall", "f1")])


OVERRIDES = """o AS (SELECT 'donations:D' || c_custkey AS key_a, 'subscriptions:S' || c_custkey AS key_b, 'unmatch' AS action FROM customer WHERE c_custkey % 10 = 1
  UNION ALL SELECT 'donations:D' || c_custkey, 'donations:D' || (c_custkey - 1), 'match' FROM customer WHERE c_custkey % 10 = 2)"""


@query("identity_overrides", f"""WITH {OVERRIDES}, g AS (SELECT email, min(record_key) AS rep FROM records WHERE NOT generic_email GROUP BY 1 HAVING count(*) > 1),
e AS (SELECT least(record_key, rep) AS a, greatest(record_key, rep) AS b FROM records JOIN g USING (email) WHERE record_key <> rep
  UNION SELECT least(key_a, key_b), greatest(key_a, key_b) FROM o WHERE action = 'match')
SELECT a, b FROM e WHERE (a, b) NOT IN (SELECT (least(key_a, key_b), greatest(key_a, key_b)) FROM o WHERE action = 'unmatch')""", ("records",))
def _(spark, sf_dir):
    k = F.col("c_custkey")
    c = tpch.table(spark, sf_dir, "customer").select("c_custkey")
    name = lambda prefix, n: F.concat(F.lit(prefix), n.cast("string"))
    overrides = c.where(k % 10 == 1).select(
        name("donations:D", k).alias("key_a"), name("subscriptions:S", k).alias("key_b"), F.lit("unmatch").alias("action")
    ).unionByName(c.where(k % 10 == 2).select(name("donations:D", k).alias("key_a"), name("donations:D", k - 1).alias("key_b"), F.lit("match").alias("action")))
    r = records(spark, sf_dir)
    return I.apply_overrides(M.star_edges(r, M.email_groups(r), "personal_email"), overrides)


@query("identity_unify_overrides", f"""WITH RECURSIVE {CLUSTERS}
SELECT cluster AS key_a, max(record_key) AS key_b, 2 AS clusters, count(*) AS records, false AS together FROM clusters GROUP BY cluster HAVING count(*) > 1""", ("all_pairs",))
def _(spark, sf_dir):
    # a steward rejects the least and the greatest record of every cluster: each falls into two parts
    before = unified(spark, sf_dir).clusters
    pairs = before.groupBy("cluster").agg(F.max("record_key").alias("key_b"), F.count("*").alias("records")).where("records > 1")
    pairs = cut_lineage(pairs.select(F.col("cluster").alias("key_a"), "key_b"))
    after = I.unify(tpch.source_records(spark, sf_dir), CFG, overrides=pairs.withColumn("action", F.lit("unmatch"))).clusters
    both = before.withColumnRenamed("cluster", "key_a").join(after, "record_key").join(pairs, "key_a")
    one = lambda key: F.max(F.when(F.col("record_key") == F.col(key), F.col("cluster")))
    return both.groupBy("key_a", "key_b").agg(
        F.count_distinct("cluster").cast("int").alias("clusters"), F.count("*").alias("records"), (one("key_a") == one("key_b")).alias("together")
    )


# ---- source records -> constituents -> facts -> golden record, as one job

LINKED = """linked AS (SELECT source_system, source_id, 'UC-' || sha256(cluster)[1:16] AS cid FROM records JOIN clusters USING (record_key)),
gifts AS (SELECT l.cid, d.* FROM donations d LEFT JOIN linked l ON l.source_system = 'donations' AND l.source_id = 'D' || d.constituent_id),
subs AS (SELECT l.cid, s.* FROM subscriptions s LEFT JOIN linked l ON l.source_system = 'subscriptions' AND l.source_id = 'S' || s.constituent_id)"""

MAILS = """mails AS (SELECT l.cid, e.* FROM emails e LEFT JOIN linked l ON l.source_system = 'donations' AND l.source_id = 'D' || e.constituent_id)"""


def facts_of(facts, system: str, letter: str, links):
    """Facts whose owner is a record of a source system, with the constituent of that record (null if there is none)."""
    keyed = facts.withColumn("source_system", F.lit(system)).withColumn("source_record_id", F.concat(F.lit(letter), "constituent_id"))
    return G.attach_constituents(keyed.drop("constituent_id"), links)


def linked_facts(spark, sf_dir):
    u = unified(spark, sf_dir)
    links = cut_lineage(u.links.select("source_system", "source_record_id", "constituent_id"))
    gifts = facts_of(tpch.donations(spark, sf_dir), "donations", "D", links)
    subscribed = facts_of(tpch.subscriptions(spark, sf_dir), "subscriptions", "S", links)
    mails = facts_of(tpch.email_engagement(spark, sf_dir), "donations", "D", links)  # sent by the system that takes the gifts
    return u, gifts, subscribed, mails, links


@query("pipeline_links", f"""WITH RECURSIVE {CLUSTERS}, {LINKED}, {MAILS}
SELECT 'gift' AS fact, cid AS constituent_id, count(*) AS n FROM gifts GROUP BY 2
UNION ALL SELECT 'subscription', cid, count(*) FROM subs GROUP BY 2 UNION ALL SELECT 'mail', cid, count(*) FROM mails GROUP BY 2""",
       ("all_pairs", "donations", "subscriptions", "emails"))
def _(spark, sf_dir):
    """Every fact is kept, with the constituent that the identity job found for its source record, or none."""
    _u, *facts, _links = linked_facts(spark, sf_dir)
    out = None
    for name, rows in zip(("gift", "subscription", "mail"), facts):
        part = rows.groupBy("constituent_id").agg(F.count("*").alias("n")).withColumn("fact", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query("pipeline_golden", f"""{GOLDEN}, {LINKED},
g AS (SELECT cid, CAST(sum(donation_amount) FILTER (donation_status = 'completed') AS DECIMAL(18,2)) AS total, count(*) FILTER (donation_status = 'completed') AS n,
  max(donation_amount) FILTER (donation_status = 'completed') AS largest, min(donation_date) FILTER (donation_status = 'completed') AS first, max(donation_date) FILTER (donation_status = 'completed') AS last,
  count(*) FILTER (donation_status = 'completed' AND donation_type = 'recurring') > 0 AS regular, min(donation_date) FILTER (donation_status = 'completed' AND donation_type = 'recurring') AS since,
  max(donation_date) FILTER (donation_status = 'completed' AND donation_type = 'recurring') AS paid,
  arg_min(campaign_code, {{'d': donation_date, 'i': donation_id}}) FILTER (donation_status = 'completed') AS campaign FROM gifts GROUP BY 1),
s AS (SELECT cid, subscription_type, subscription_status, start_date FROM subs QUALIFY row_number() OVER (PARTITION BY cid ORDER BY start_date DESC, subscription_id DESC) = 1),
w AS (SELECT o.*, g.*, s.cid AS sub, subscription_type, subscription_status, start_date FROM golden o LEFT JOIN g ON g.cid = o.constituent_id LEFT JOIN s ON s.cid = o.constituent_id)
SELECT constituent_id, canonical_email, canonical_phone, canonical_first_name, canonical_last_name, place.a AS canonical_address_line1, record_count, sources AS source_systems,
  coalesce(total, 0) AS total_lifetime_giving, coalesce(n, 0) AS total_gift_count, largest AS largest_single_gift, CAST(total AS DOUBLE) / nullif(n, 0) AS average_gift_amount,
  first AS first_donation_date, last AS last_donation_date, coalesce(regular, false) AS is_sustainer, since AS sustainer_start_date, paid AS last_successful_payment_date,
  CASE WHEN regular THEN CASE WHEN paid >= {AS_OF} - 90 THEN 'active' ELSE 'failed' END END AS recurring_status,
  sub IS NOT NULL AS is_subscriber, subscription_type, subscription_status, start_date AS subscription_start_date, campaign AS acquisition_campaign,
  least(first, start_date) AS acquisition_date,
  CASE WHEN coalesce(n, 0) = 0 THEN 'prospect' WHEN last < CAST({AS_OF} - INTERVAL 12 MONTH AS DATE) THEN 'lapsed' WHEN largest >= 400000 THEN 'major_donor'
    WHEN regular AND paid >= {AS_OF} - 90 THEN 'sustainer' ELSE 'one_time_donor' END AS lifecycle_stage FROM w""",
       ("all_pairs", "donations", "subscriptions"))
def _(spark, sf_dir):
    """Golden records whose ids and facts come from the identity job."""
    u, gifts, subscribed, _mails, _links = linked_facts(spark, sf_dir)
    wide = G.golden_of_records(u.constituents, gifts, subscribed, tpch.AS_OF, 400000)
    return wide.withColumn("source_systems", F.array_join("source_systems", "+")).select(
        "constituent_id", "canonical_email", "canonical_phone", "canonical_first_name", "canonical_last_name", "canonical_address_line1",
        "record_count", "source_systems", "total_lifetime_giving", "total_gift_count", "largest_single_gift", "average_gift_amount",
        "first_donation_date", "last_donation_date", "is_sustainer", "sustainer_start_date", "last_successful_payment_date",
        "recurring_status", "is_subscriber", "subscription_type", "subscription_status", "subscription_start_date",
        "acquisition_campaign", "acquisition_date", "lifecycle_stage",
    )


# ---- and on to features, scores and recommendations of the people found

MAJOR, LAST, SEEN = 400000, AS_OF, f"({AS_OF} + {EVENT_SHIFT})"
PEOPLE = "people AS (SELECT DISTINCT 'UC-' || sha256(cluster)[1:16] AS constituent_id FROM clusters)"


def journey(spark, sf_dir):
    """Written people and their facts."""
    u, gifts, subscribed, mails, links = linked_facts(spark, sf_dir)
    events = facts_of(tpch.engagement_events(spark, sf_dir), "donations", "D", links)
    changes = facts_of(tpch.status_changes(spark, sf_dir), "donations", "D", links)
    facts = J.Facts.written(gifts, subscribed, mails, events, changes, lag=EVENT_SHIFT)
    return cut_lineage(u.constituents), facts


@query("pipeline_features", f"""WITH RECURSIVE {CLUSTERS}, {LINKED}, {MAILS}, {PEOPLE},
g AS (SELECT cid, count(*) AS n, CAST(sum(donation_amount) AS DOUBLE) / count(*) AS average, min(donation_date) AS first, max(donation_date) AS last,
  min(donation_date) FILTER (donation_type = 'recurring') AS since FROM gifts WHERE donation_status = 'completed' AND donation_date <= {LAST} GROUP BY 1),
r AS (SELECT cid, count(*) FILTER (send_date >= {SEEN} - 30) AS sent, count(*) FILTER (opened AND send_date >= {SEEN} - 30) AS opens, count(*) FILTER (clicked AND send_date >= {SEEN} - 30) AS clicks
  FROM mails WHERE send_date <= {SEEN} GROUP BY 1),
e AS (SELECT cid, max(event_date) - {EVENT_SHIFT} AS met FROM engagement JOIN linked ON source_system = 'donations' AND source_id = 'D' || constituent_id WHERE event_date <= {SEEN} GROUP BY 1),
f AS (SELECT constituent_id, CAST(coalesce(datediff('day', met, {LAST}), 999) AS DOUBLE) AS days_since_last_engagement, CAST(coalesce(datediff('day', last, {LAST}), 999) AS DOUBLE) AS days_since_last_donation,
  coalesce(CAST(opens AS DOUBLE) / nullif(sent, 0), 0) AS email_open_rate_30d, coalesce(CAST(clicks AS DOUBLE) / nullif(sent, 0), 0) AS email_click_rate_30d,
  coalesce(datediff('day', first, {LAST}) / CAST(30.44 AS DOUBLE), 0) AS tenure_months, CAST(coalesce(n, 0) AS DOUBLE) AS total_gifts, coalesce(average, 0) AS avg_gift_amount,
  CAST(0 AS DOUBLE) AS consecutive_failed_payments, coalesce(datediff('day', since, {LAST}) / CAST(30.44 AS DOUBLE), 0) AS sustainer_months
  FROM people LEFT JOIN g ON g.cid = constituent_id LEFT JOIN r ON r.cid = constituent_id LEFT JOIN e ON e.cid = constituent_id)
SELECT *, least(greatest((1 - least(greatest(days_since_last_engagement, 0), 365) / CAST(365 AS DOUBLE)) * 50 + email_open_rate_30d * 50, 0), 100) AS engagement_score FROM f""",
       ("all_pairs", "donations", "subscriptions", "emails", "engagement"))
def _(spark, sf_dir):
    """Features of the people that the identity job found, from the facts of all their records."""
    return J.features(*journey(spark, sf_dir), tpch.AS_OF, MAJOR)


def journey_scores(spark, sf_dir):
    people, facts = journey(spark, sf_dir)
    return people, J.scores(people, facts, tpch.AS_OF, CUTOFF, MAJOR)


@query("pipeline_scores", f"""WITH RECURSIVE {CLUSTERS}, {PEOPLE}
SELECT constituent_id, true AS in_range, true AS tier_fits, true AS best_fits, {AS_OF} AS prediction_date FROM people""", ("all_pairs",))
def _(spark, sf_dir):
    """Everybody has one churn score in [0, 1] with its tier, and the greatest upgrade score belongs to the path that is named."""
    _people, scored = journey_scores(spark, sf_dir)
    churn, up = F.col("churn_score"), [F.col(f"{t}_score") for t in L.UPGRADE_TARGETS]
    tier = F.when(churn >= 0.85, "critical").when(churn >= 0.6, "high").when(churn >= 0.3, "medium").otherwise("low")
    named = F.coalesce(*[F.when(F.col("best_path") == t, c) for t, c in zip(L.UPGRADE_TARGETS, up)])
    in_range = churn.between(0, 1)
    for c in up:
        in_range = in_range & c.between(0, 1)
    return scored.select(
        "constituent_id", in_range.alias("in_range"), (F.col("churn_tier") == tier).alias("tier_fits"),
        ((named == F.greatest(*up)) & (named == F.col("upgrade_propensity"))).alias("best_fits"), "prediction_date",
    )


@query("pipeline_recommendations", f"""{GOLDEN}
SELECT constituent_id, canonical_email, canonical_phone, true AS action_fits, true AS priority_fits FROM golden""", ("all_pairs",))
def _(spark, sf_dir):
    """Everybody gets one action, that follows from both scores, a priority from 0 to 100 and the contact fields."""
    people, scored = journey_scores(spark, sf_dir)
    asked, leaving = F.col("upgrade_propensity") >= 0.5, F.col("churn_score") >= 0.5
    fits = {"prime_target": asked & ~leaving, "careful_ask": asked & leaving, "nurture": ~asked & ~leaving, "save_first": ~asked & leaving}
    action = F.coalesce(*[F.when(F.col("action") == a, c) for a, c in fits.items()])
    worth = F.col("upgrade_propensity") * 100 - F.col("churn_score") * 50
    return J.recommended(people, scored).select(
        "constituent_id", "canonical_email", "canonical_phone", action.alias("action_fits"),
        (F.abs(F.col("priority") - F.greatest(F.lit(0.0), F.least(F.lit(100.0), worth))) < 1e-9).alias("priority_fits"),
    )
