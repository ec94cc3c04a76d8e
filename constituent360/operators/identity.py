"""From source records to golden constituents: clustering, survivorship, links, audit and statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from constituent360.functions import text as T
from constituent360.operators import matching as M
from constituent360.operators.components import connected_components
from constituent360.operators.constrained import constrained_components
from constituent360.session import cut_lineage


@dataclass
class Unified:
    """Results of one identity run. Records, profiles, automatic matches and clusters are written
    tables; the rest is planned on them and runs when read."""

    cfg: M.MatchConfig
    records: DataFrame
    profiles: DataFrame
    auto: DataFrame | None
    clusters: DataFrame

    @property
    def constituents(self) -> DataFrame:
        return survivors(self.records, self.clusters)

    @property
    def links(self) -> DataFrame:
        return source_links(self.records, self.profiles, self.clusters, self.auto, self.cfg)

    @property
    def matches(self) -> DataFrame:
        """Profile pairs matched by score, those for review included."""
        return M.scored_profiles(self.profiles, self.cfg, self.cfg.review_threshold)

    @property
    def audit(self) -> DataFrame:
        return match_audit(self.records, self.profiles, self.clusters, self.matches, self.cfg)


def _same_values() -> Column:
    """Join condition between records ``r`` and profiles ``p``."""
    on = F.lit(True)
    for c in M.COMPARED:
        on = on & F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}"))
    return on


def group_edges(records: DataFrame, flag: str | None = None) -> DataFrame:
    """(a, b) edges of e-mail and phone groups. With a ``flag`` column, only groups that hold a
    flagged (new) record."""
    emails, phones = M.email_groups(records), M.phone_groups(records)
    if flag:
        touched = lambda key: records.where(F.col(flag) & F.col(key).isNotNull()).select(key).distinct()
        emails = emails.join(touched("personal_email"), "personal_email", "left_semi")
        phones = phones.join(touched("full_phone"), "full_phone", "left_semi")
    return M.star_edges(records, emails, "personal_email").unionByName(M.star_edges(records, phones, "full_phone"))


def score_edges(records: DataFrame, p: DataFrame, auto: DataFrame, cfg: M.MatchConfig) -> DataFrame:
    """(a, b) edges of automatic matches. A match between profiles, or between the copies of one,
    draws in every copy."""
    pairs = auto.select(F.col("profile_a").alias("a"), F.col("profile_b").alias("b"))
    same = M.copy_matches(p, cfg).where(F.col("match_type") == M.AUTO).select("profile")
    several = p.where("copies > 1").select("profile")
    drawn = same.unionByName(
        pairs.select(F.explode(F.array("a", "b")).alias("profile")).join(several, "profile", "left_semi")
    ).distinct()
    expanded = p.join(drawn, "profile", "left_semi").select("profile", *M.COMPARED)
    copies = records.alias("r").join(expanded.alias("p"), _same_values()).select(
        F.col("r.record_key").alias("a"), F.col("p.profile").alias("b")
    )
    return pairs.unionByName(copies.where(F.col("a") != F.col("b")))


def cluster(records: DataFrame, edges: DataFrame) -> DataFrame:
    """(record_key, cluster): the cluster is named by its least record."""
    nodes = records.select(F.col("record_key").alias("node"))
    return connected_components(nodes, edges).select(
        F.col("node").alias("record_key"), F.col("component").alias("cluster")
    )


def constituent_id(cluster_key: Column) -> Column:
    """Stable across runs: derived from the cluster's least record key."""
    return F.concat(F.lit("UC-"), F.substring(F.sha2(cluster_key, 256), 1, 16))


def _newest_first(present: Column) -> Column:
    """Sort key that puts the latest update first and, among equals, the least record key."""
    age = -F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01'"), F.col("updated_at"))
    return F.when(present & F.col("updated_at").isNotNull(), F.struct(age, "record_key"))


def survivors(records: DataFrame, clusters: DataFrame) -> DataFrame:
    """One canonical row per cluster. All choices are min/max aggregates, so they combine on the map
    side and a cluster of any size is never gathered in one place."""
    key = F.col("record_key")
    email, phone = F.col("email"), F.col("phone")
    some_email, some_phone = email.isNotNull(), phone.isNotNull()
    long_phone = F.coalesce(F.length(phone) >= 10, F.lit(False))
    line = T.blank_to_null(F.col("address_line1"))
    place = F.struct("address_line1", "city", "state", "zip_code")

    tokens = T.name_tokens(F.col("full_name"))
    split = F.col("first_name").isNull() & (F.size(tokens) >= 2) & F.col("full_name").isNotNull()
    longest = lambda value, rank: F.min(
        F.when(value.isNotNull(), F.struct((-F.length(value)).alias("l"), key.alias("k"), F.lit(rank).alias("r"), value.alias("v")))
    )
    first_name = F.coalesce(F.col("first_name"), F.when(split, tokens[0]))
    merged = (
        records.join(clusters, "record_key")
        .groupBy("cluster")
        .agg(
            F.coalesce(
                F.min_by(email, _newest_first(some_email)),
                F.min_by(email, F.when(some_email & ~T.starts_with_any(email, T.SURVIVOR_GENERIC_PREFIXES), key)),
                F.min_by(email, F.when(some_email, key)),
            ).alias("canonical_email"),
            longest(first_name, 0)["v"].alias("canonical_first_name"),
            F.least(longest(F.col("last_name"), 0), longest(F.when(split, F.element_at(tokens, -1)), 1))["v"].alias("canonical_last_name"),
            F.when(
                F.bool_or(long_phone),
                F.coalesce(
                    F.min_by(phone, _newest_first(some_phone)), F.min_by(phone, F.when(long_phone, key))
                ),
            ).alias("canonical_phone"),
            F.coalesce(
                F.min_by(place, _newest_first(line.isNotNull())), F.min_by(place, F.when(line.isNotNull(), key))
            ).alias("_place"),
            F.count("*").alias("record_count"),
            F.array_sort(F.collect_set("source_system")).alias("source_systems"),
        )
    )
    return merged.select(
        constituent_id(F.col("cluster")).alias("constituent_id"), "cluster",
        "canonical_email", "canonical_first_name", "canonical_last_name", "canonical_phone",
        F.col("_place.address_line1").alias("canonical_address_line1"), F.col("_place.city").alias("canonical_city"),
        F.col("_place.state").alias("canonical_state"), F.col("_place.zip_code").alias("canonical_zip"),
        "record_count", "source_systems",
    )


def best_evidence(records: DataFrame, p: DataFrame, auto: DataFrame | None, cfg: M.MatchConfig) -> DataFrame:
    """The strongest automatic match type of each record, with its confidence."""
    e = M.email_groups(records).select("personal_email", F.lit(True).alias("_e"))
    t = M.phone_groups(records).select("full_phone", F.lit(True).alias("_t"))
    out = records.join(e, "personal_email", "left").join(t, "full_phone", "left")
    best = F.lit(None).cast("double")
    if auto is not None:
        own = M.copy_matches(p, cfg).where(F.col("match_type") == M.AUTO).select("profile", "confidence")
        ends = (
            auto.select(F.explode(F.array("profile_a", "profile_b")).alias("profile"), "confidence")
            .unionByName(own)
            .groupBy("profile")
            .agg(F.max("confidence").alias("_c"))
        )
        keyed = p.select("profile", *M.COMPARED).join(ends, "profile")
        out = out.alias("r").join(keyed.alias("p"), _same_values(), "left").select("r.*", "p._c")
        best = F.col("_c")
    by_email, by_phone = F.coalesce("_e", F.lit(False)), F.coalesce("_t", F.lit(False))
    return out.select(
        "record_key", "source_system", "source_id",
        F.when(by_email, M.EMAIL).when(by_phone, M.PHONE).when(best.isNotNull(), M.AUTO).otherwise(M.NONE).alias("match_type"),
        F.when(by_email, cfg.email_confidence).when(by_phone, cfg.phone_confidence).otherwise(best).alias("match_confidence"),
    )


def source_links(records, p, clusters, auto, cfg: M.MatchConfig) -> DataFrame:
    """One row per source record: its constituent and the evidence that put it there."""
    return best_evidence(records, p, auto, cfg).join(clusters, "record_key").select(
        F.sha2("record_key", 256).alias("link_id"),
        constituent_id(F.col("cluster")).alias("constituent_id"),
        "source_system", F.col("source_id").alias("source_record_id"), "match_type", "match_confidence",
    )


def confident_edges(records: DataFrame, p: DataFrame | None, auto: DataFrame | None, cfg: M.MatchConfig, overrides: DataFrame) -> DataFrame:
    """(a, b, confidence) of all matches, those that a steward confirmed above all others. Copies of one profile hold the same
    values throughout, as a shared mailbox does."""
    sure = lambda df, confidence: df.select("a", "b", F.lit(float(confidence)).alias("confidence"))
    edges = sure(M.star_edges(records, M.email_groups(records), "personal_email"), cfg.email_confidence)
    edges = edges.unionByName(sure(M.star_edges(records, M.phone_groups(records), "full_phone"), cfg.phone_confidence))
    confirmed = overrides.where(F.col("action") == "match").select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
    keys = records.select(F.col("record_key").alias("a"))
    known = confirmed.join(keys, "a", "left_semi").join(keys.withColumnRenamed("a", "b"), "b", "left_semi")
    edges = edges.unionByName(sure(known, 2.0))
    if auto is not None:
        scored = auto.select(F.least("profile_a", "profile_b").alias("a"), F.greatest("profile_a", "profile_b").alias("b"), "confidence")
        drawn = score_edges(records, p, auto, cfg).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = edges.unionByName(drawn.join(scored, ["a", "b"], "left").select("a", "b", F.coalesce("confidence", F.lit(cfg.email_confidence)).alias("confidence")))
    return edges


def unify(
    raw: DataFrame, cfg: M.MatchConfig = M.MatchConfig(), probabilistic: bool = True, overrides: DataFrame | None = None
) -> Unified:
    """Match, cluster and merge. Automatic matches need one block family under the default weights;
    review pairs never merge anything and are scored only when ``matches`` or ``audit`` is read.

    ``overrides`` (key_a, key_b, action) are a steward's decisions: "match" joins a pair, and an "unmatch" pair is kept in
    different clusters, whatever other records stand between the two; of a pair with both, the rejection holds."""
    records = cut_lineage(M.prepare(M.spread(raw), cfg))
    edges = group_edges(records)
    p, auto = M.profiles(records), None
    if probabilistic:
        p = cut_lineage(p)
        auto = cut_lineage(M.scored_profiles(p, cfg, cfg.auto_threshold))
        edges = edges.unionByName(score_edges(records, p, auto, cfg))
    if overrides is None:
        return Unified(cfg, records, p, auto, cut_lineage(cluster(records, edges)))
    rejected = overrides.where(F.col("action") == "unmatch").select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
    nodes = records.select(F.col("record_key").alias("node"))
    parted = constrained_components(nodes, confident_edges(records, p, auto, cfg, overrides), rejected)
    return Unified(cfg, records, p, auto, cut_lineage(parted.select(F.col("node").alias("record_key"), F.col("component").alias("cluster"))))


def unify_incremental(
    new: DataFrame, existing: DataFrame, existing_clusters: DataFrame, cfg: M.MatchConfig = M.MatchConfig(), probabilistic: bool = True
) -> DataFrame:
    """(record_key, cluster) after new records arrive. Only pairs with a new record are compared; what
    is known about the existing records enters as one edge per record."""
    both = cut_lineage(
        M.prepare(M.spread(existing), cfg).withColumn("is_new", F.lit(False)).unionByName(
            M.prepare(M.spread(new), cfg).withColumn("is_new", F.lit(True))
        )
    )
    edges = group_edges(both, "is_new")
    if probabilistic:
        p = cut_lineage(M.profiles(both, "is_new"))
        auto = cut_lineage(M.scored_profiles(p, cfg, cfg.auto_threshold, new_only=True))
        edges = edges.unionByName(score_edges(both, p, auto, cfg))
    known = existing_clusters.select(F.col("record_key").alias("a"), F.col("cluster").alias("b")).where("a <> b")
    return cluster(both, edges.unionByName(known))


def apply_overrides(edges: DataFrame, overrides: DataFrame) -> DataFrame:
    """Add edges a steward confirmed and drop those a steward rejected: (key_a, key_b, action)."""
    pair = lambda df, a, b: df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    current = pair(edges, "a", "b")
    added = pair(overrides.where(F.col("action") == "match"), "key_a", "key_b")
    removed = pair(overrides.where(F.col("action") == "unmatch"), "key_a", "key_b")
    return current.unionByName(added).distinct().join(removed, ["a", "b"], "left_anti")


def match_audit(records: DataFrame, p: DataFrame, clusters: DataFrame, matches: DataFrame, cfg: M.MatchConfig) -> DataFrame:
    """Matches per cluster in counted form: (cluster, match_type, pairs, best and least confidence).

    E-mail and phone groups and copies of one profile enter with their pair counts, so no group is
    written out pair by pair. A review pair between two clusters appears in both. The matches are written once, since both
    of their ends are looked up.
    """
    matches = cut_lineage(matches.select("profile_a", "profile_b", "copies_a", "copies_b", "match_type", "confidence")).hint("merge")
    clusters = clusters.hint("merge")
    by_rep = lambda groups: groups.join(clusters.withColumnRenamed("record_key", "representative"), "representative")
    emails = by_rep(M.email_groups(records)).select(
        "cluster", F.lit(M.EMAIL).alias("match_type"), "pairs", F.lit(cfg.email_confidence).alias("confidence")
    )
    phones = by_rep(M.phone_groups(records)).where("pairs > 0").select(
        "cluster", F.lit(M.PHONE).alias("match_type"), "pairs", F.lit(cfg.phone_confidence).alias("confidence")
    )
    # how many records of a profile lie in which cluster: copies left for review stay apart
    held = (
        records.join(clusters, "record_key").groupBy(*M.COMPARED, "cluster").agg(F.count("*").alias("held"))
    )
    held = held.alias("r").join(p.select("profile", *M.COMPARED).alias("p").hint("merge"), _same_values()).select(
        "p.profile", "r.cluster", "r.held"
    )
    # a pair inside one cluster is met from both ends but counted once
    side = lambda x, y: matches.withColumnRenamed(f"profile_{x}", "profile").join(held, "profile").select(
        "cluster", "match_type", "confidence", F.col(f"profile_{y}").alias("other"), "profile",
        (F.col("held") * F.col(f"copies_{y}")).alias("pairs"), F.col("held").alias("mine"),
    )
    ends = side("a", "b").select("cluster", "match_type", "confidence", "pairs", F.col("profile").alias("pa"), F.col("other").alias("pb"),
                                 F.col("mine").alias("in_a"), F.lit(0).cast("bigint").alias("in_b"))
    ends = ends.unionByName(
        side("b", "a").select("cluster", "match_type", "confidence", "pairs", F.col("other").alias("pa"), F.col("profile").alias("pb"),
                              F.lit(0).cast("bigint").alias("in_a"), F.col("mine").alias("in_b"))
    )
    across = ends.groupBy("cluster", "match_type", "confidence", "pa", "pb").agg(
        (F.sum("pairs") - F.sum("in_a") * F.sum("in_b")).alias("pairs")
    ).select("cluster", "match_type", "pairs", "confidence")
    copies = M.copy_matches(p, cfg).where(F.col("match_type").isin(M.AUTO, M.REVIEW)).hint("merge")
    merged = copies.join(held, "profile").select(
        "cluster", "match_type",
        (F.col("held") * F.col("copies") - F.col("held") * (F.col("held") + 1) / 2).cast("bigint").alias("pairs"), "confidence",
    )
    rows = emails.unionByName(phones).unionByName(across).unionByName(merged)
    return rows.groupBy("cluster", "match_type").agg(
        F.sum("pairs").alias("pairs"), F.max("confidence").alias("best_confidence"), F.min("confidence").alias("least_confidence")
    )


def match_type_counts(records: DataFrame, p: DataFrame, matches: DataFrame, cfg: M.MatchConfig = M.MatchConfig()) -> DataFrame:
    """Record pairs per match type, computed from group sizes."""
    count = lambda df, kind: df.select(kind.alias("match_type"), "pairs")
    rows = (
        count(M.email_groups(records), F.lit(M.EMAIL))
        .unionByName(count(M.phone_groups(records).where("pairs > 0"), F.lit(M.PHONE)))
        .unionByName(matches.select("match_type", (F.col("copies_a") * F.col("copies_b")).alias("pairs")))
        .unionByName(count(M.copy_matches(p, cfg).where(F.col("match_type").isin(M.AUTO, M.REVIEW)), F.col("match_type")))
    )
    return rows.groupBy("match_type").agg(F.sum("pairs").alias("pairs"))


def match_statistics(constituents: DataFrame) -> DataFrame:
    """(statistic, key, value): totals, mean size, and the distributions of sizes and source combinations."""
    n = F.col("record_count")
    totals = constituents.agg(
        F.count("*").cast("double").alias("total_constituents"),
        F.sum(n).cast("double").alias("total_source_records"),
        (F.sum(n) / F.count("*")).alias("avg_records_per_constituent"),
        F.count(F.when(F.size("source_systems") > 1, 1)).cast("double").alias("cross_source_constituents"),
        ((F.sum(n) - F.count("*")) * 100.0 / F.sum(n)).cast("double").alias("consolidation_rate"),
    )
    names = totals.columns
    blank = F.lit(None).cast("string").alias("key")
    single = totals.where("total_constituents > 0").unpivot([], names, "statistic", "value").select("statistic", blank, "value")
    sizes = constituents.groupBy(n.cast("string").alias("key")).agg(F.count("*").cast("double").alias("value")).select(
        F.lit("record_count").alias("statistic"), "key", "value"
    )
    combos = constituents.groupBy(F.array_join("source_systems", "+").alias("key")).agg(
        F.count("*").cast("double").alias("value")
    ).select(F.lit("source_systems").alias("statistic"), "key", "value")
    return single.unionByName(sizes).unionByName(combos)


def matches_per_record(scored: DataFrame) -> DataFrame:
    """Scored matches seen from either side, best first. They are written once: both sides and the sort's bounds read them."""
    scored = cut_lineage(scored.select("profile_a", "profile_b", "match_type", "confidence"))
    one = scored.select(F.col("profile_a").alias("record"), F.col("profile_b").alias("other"), "match_type", "confidence")
    two = scored.select(F.col("profile_b").alias("record"), F.col("profile_a").alias("other"), "match_type", "confidence")
    return one.unionByName(two).orderBy("record", F.col("confidence").desc(), "other")
