"""Record matching without comparing all pairs.

Equal e-mails and equal phones are groups, not pairs: a group is kept as its size and its least record,
so a shared mailbox with millions of records costs one row, and pair counts are computed from sizes.

For the weighted score, a pair can reach a threshold only if it agrees on something besides name and
address. ``reachable`` works out from the weights which agreements are enough; each such case is one
equi-join on all the columns it needs (for an automatic match: phone block and zip, or phone block and
domain). The cases exclude each other, so no pair is produced twice and nothing needs a
de-duplicating shuffle. An upper bound inside the join drops pairs whose names and addresses cannot
make up the rest. Records with the same compared values form one profile and are scored once.
Large blocks are cut into tiles, so that no task holds more than two tiles of a block.

Written rows are joined with a merge hint where they grow with the records: the size of their files, by which the planner
would send them to every task, is a small part of their size in memory when few values repeat.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from constituent360.functions import text as T
from constituent360.functions.similarity import char_mask, common_start, inverse_length, jaro_winkler, jaro_winkler_once, score_ceiling
from constituent360.operators.similar import similar_pairs
from constituent360.operators.tiles import tiled
from constituent360.session import cut_lineage

EMAIL, PHONE, AUTO, REVIEW, NONE = (
    "deterministic_email", "deterministic_phone", "probabilistic", "manual_review", "no_match",
)
FIELDS = (
    "source_system", "source_id", "email", "phone", "first_name", "last_name", "full_name", "address_line1", "city",
    "state", "zip_code", "updated_at",
)
COMPARED = ("first_part", "last_part", "address", "phone", "email", "zip_code")


@dataclass(frozen=True)
class MatchConfig:
    """Weights, thresholds and the role-mailbox list; the defaults are fixed values."""

    auto_threshold: float = 0.85
    review_threshold: float = 0.70
    name_weight: float = 0.35
    address_weight: float = 0.30
    phone_weight: float = 0.15
    domain_weight: float = 0.10
    zip_weight: float = 0.10
    email_confidence: float = 1.0
    phone_confidence: float = 0.95
    generic_prefixes: tuple[str, ...] = T.GENERIC_EMAIL_PREFIXES
    tile_rows: int = 4096

    def score(self, name, address, phone, domain, zip_code):
        """Weighted sum, always added in this order: the last digit decides at the thresholds."""
        return (
            name * self.name_weight
            + address * self.address_weight
            + phone * self.phone_weight
            + domain * self.domain_weight
            + zip_code * self.zip_weight
        )


def spread(df: DataFrame) -> DataFrame:
    """The same rows dealt evenly over the cores: normalising costs far more than reading, and a few files of contact rows
    would be read by as few tasks."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def prepare(df: DataFrame, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """Normalised contact rows plus the values that matching compares."""
    have = [c for c in FIELDS if c in df.columns]
    missing = {c: F.lit(None).cast("timestamp_ntz" if c == "updated_at" else "string") for c in FIELDS if c not in have}
    rows = df.withColumns(missing) if missing else df
    extra = [c for c in df.columns if c not in FIELDS]
    clean = rows.select(
        T.record_key(F.col("source_system"), F.col("source_id")).alias("record_key"),
        "source_system", "source_id",
        T.norm_email(F.col("email")).alias("email"),
        T.norm_phone(F.col("phone")).alias("phone"),
        T.norm_name(F.col("first_name")).alias("first_name"),
        T.norm_name(F.col("last_name")).alias("last_name"),
        T.norm_name(F.col("full_name")).alias("full_name"),
        "address_line1", "city", "state",
        T.norm_zip(F.col("zip_code")).alias("zip_code"),
        "updated_at", *extra,
    )
    parts = T.name_parts(F.col("first_name"), F.col("last_name"), F.col("full_name"))
    return clean.withColumns(
        {
            "first_part": parts["first"],
            "last_part": parts["last"],
            "address": T.norm_address(F.col("address_line1")),
            "personal_email": F.when(~T.is_generic_email(F.col("email"), cfg.generic_prefixes), F.col("email")),
            "full_phone": F.when(F.length("phone") >= 10, F.col("phone")),
        }
    )


def equal_groups(records: DataFrame, key: str) -> DataFrame:
    """Groups of records that share a key: (key, representative, records, pairs)."""
    n = F.col("records")
    return (
        records.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min("record_key").alias("representative"), F.count("*").alias("records"))
        .where(n > 1)
        .withColumn("pairs", (n * (n - 1) / 2).cast("bigint"))
    )


def email_groups(records: DataFrame) -> DataFrame:
    return equal_groups(records, "personal_email")


def phone_groups(records: DataFrame) -> DataFrame:
    """Phone groups; pairs that already agree on the e-mail are not counted again."""
    per = (
        records.where(F.col("full_phone").isNotNull())
        .groupBy("full_phone", "personal_email")
        .agg(F.count("*").alias("c"), F.min("record_key").alias("k"))
    )
    n, c = F.col("records"), F.col("c")
    by_email = F.when(F.col("personal_email").isNotNull(), c * (c - 1) / 2).otherwise(0)
    groups = per.groupBy("full_phone").agg(
        F.min("k").alias("representative"), F.sum("c").alias("records"), F.sum(by_email).alias("_same")
    )
    return groups.where(n > 1).select(
        "full_phone", "representative", "records", (n * (n - 1) / 2 - F.col("_same")).cast("bigint").alias("pairs")
    )


def star_edges(records: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """(a, b): every record of a group with the group's representative."""
    return (
        records.where(F.col(key).isNotNull())
        .select(F.col("record_key").alias("a"), key)
        .join(groups.select(key, F.col("representative").alias("b")), key)
        .where(F.col("a") != F.col("b"))
        .select("a", "b")
    )


def profiles(records: DataFrame, flag: str | None = None) -> DataFrame:
    """One row per distinct combination of compared values, named by its least record."""
    extra = [F.bool_or(flag).alias("is_new")] if flag else []
    # both follow from the compared values
    follow = [F.first(c).alias(c) for c in ("personal_email", "full_phone")]
    p = records.groupBy(*COMPARED).agg(
        F.min("record_key").alias("profile"), F.count("*").alias("copies"), *follow, *extra
    )
    domain = T.email_domain(F.col("email"))
    return p.withColumns(
        {
            "domain": T.blank_to_null(domain),
            "phone_block": T.phone_block(F.col("phone")),
            "zip3": F.substring("zip_code", 1, 3),
            **{f"len_{c}": F.length(c) for c in ("first_part", "last_part", "address")},
            **{f"inv_{c}": inverse_length(F.col(c)) for c in ("first_part", "last_part", "address")},
            **{f"mask_{c}": char_mask(F.col(c)) for c in ("first_part", "last_part", "address")},
        }
    )


def _agree(a: Column, b: Column) -> Column:
    return F.coalesce(a == b, F.lit(False))


def phone_similarity(a: Column, b: Column, block_a: Column, block_b: Column) -> Column:
    """1 when equal, 0.8 when the last seven digits are (a shorter number is its own block)."""
    return F.when(a == b, 1.0).when(block_a == block_b, 0.8).otherwise(0.0)


def zip_similarity(a: Column, b: Column, area_a: Column, area_b: Column) -> Column:
    return F.when(a == b, 1.0).when(area_a == area_b, 0.5).otherwise(0.0)


def domain_similarity(a: Column, b: Column) -> Column:
    return F.when(a == b, 1.0).otherwise(0.0)


def text_similarity(a: Column, b: Column) -> Column:
    """Jaro-Winkler, 0 when either side is empty."""
    return F.when((a != "") & (b != ""), jaro_winkler_once(a, b)).otherwise(0.0)


def name_similarity(first: Column, last: Column) -> Column:
    return first * 0.4 + last * 0.6


@dataclass(frozen=True)
class Family:
    """One way for a pair to reach the threshold: the columns it must share, and the column sets it must
    not share as a whole because an earlier family covers those pairs."""

    equal: tuple[str, ...]
    unless: tuple[tuple[str, ...], ...]


# agreement levels and the column that must be equal to reach them
PHONE_LEVELS = ((0.0, None), (0.8, "phone_block"), (1.0, "phone"))
DOMAIN_LEVELS = ((0.0, None), (1.0, "domain"))
ZIP_LEVELS = ((0.0, None), (0.5, "zip3"), (1.0, "zip_code"))
NAMED = ("first_part", "last_part", "address")
# from this similarity on, an index of similar last names meets fewer of them than a block holds
INDEXED = 0.7


def reachable(cfg: MatchConfig, threshold: float) -> list[Family]:
    """The equi-joins that together find every pair able to reach the threshold, each pair once.

    Of all combinations of agreements that can reach it with a perfect name and address, the smallest
    are kept; larger ones share their columns too. Where nothing is left to spare, name and address must
    be identical and join the key.
    """
    combos = [
        ((p, d, z), tuple(c for c in (pc, dc, zc) if c))
        for p, pc in PHONE_LEVELS for d, dc in DOMAIN_LEVELS for z, zc in ZIP_LEVELS
    ]
    spare = {levels: cfg.score(1.0, 1.0, *levels) - threshold for levels, _ in combos}
    below = lambda x, y: x != y and all(i <= j for i, j in zip(x, y))
    loose = [(lv, cols) for lv, cols in combos if spare[lv] > 1e-9]
    tight = [(lv, cols) for lv, cols in combos if 0 <= spare[lv] <= 1e-9 and not any(below(o, lv) for o, _ in loose)]
    least = [cols for lv, cols in loose if not any(below(o, lv) for o, _ in loose)]
    least += [cols + NAMED for lv, cols in tight if not any(below(o, lv) for o, _ in tight)]
    if () in least or NAMED in least:
        raise ValueError(
            "name and address alone reach the threshold, so no agreement can be required; raise the threshold or "
            "restrict the comparison with fuzzy_join and an explicit block"
        )
    # narrow blocks first: what is left for the wide ones shares little else, so that its names have to be alike
    width = {"phone": 0, "phone_block": 0, "domain": 1, "zip_code": 2, "zip3": 2}
    least.sort(key=lambda cols: 3 if set(NAMED) <= set(cols) else min(width[c] for c in cols))
    if ("domain",) in least:
        least.insert(least.index(("domain",)), ("domain", "zip3"))
    return [Family(cols, tuple(least[:i])) for i, cols in enumerate(least)]


def block_pairs(
    p: DataFrame, equal: Sequence[str], keep, tile_rows: int, key: str = "profile", apart: str | None = None, new_only: bool = False
) -> DataFrame:
    """Pairs (a, b) of rows that share the ``equal`` columns and pass ``keep``, each pair once.

    A block of n rows is dealt into about n / tile_rows tiles and each pair of tiles meets under its own
    join key, so the work of a hot block spreads over many tasks of bounded size. Rows that agree on
    ``apart`` need no comparison: a block of such rows alone is left out, and in others
    such a group, once larger than a tile, gets tiles of its own and those are never paired with each other.
    Where ``keep`` wants a new row in every pair (``new_only``), blocks without one are left out too.
    """
    equal = list(equal)
    present = p
    for c in equal:
        present = present.where(F.col(c).isNotNull())
    group = F.col(apart) if apart else F.lit(None).cast("string")
    present = present.withColumn("_apart", group)

    fresh = F.bool_or("is_new") if new_only else F.lit(True)
    counts = present.groupBy(*equal, "_apart").agg(F.count("*").alias("_n"), fresh.alias("_fresh"))
    big = F.col("_apart").isNotNull() & (F.col("_n") > tile_rows)
    tiles = lambda n: F.ceil(n / tile_rows).cast("int")
    blocks = (
        counts.groupBy(*equal)
        .agg(
            F.sum("_n").alias("_all"),
            F.coalesce(F.sum(F.when(~big, F.col("_n"))), F.lit(0)).alias("_rest"),
            F.coalesce(F.sum(F.when(big, tiles(F.col("_n")))), F.lit(0)).cast("int").alias("_own_tiles"),
            ((F.count(F.lit(1)) > 1) | (F.max(F.when(F.col("_apart").isNull(), F.col("_n"))) > 1)).alias("_differ"),
            F.bool_or("_fresh").alias("_wanted"),
        )
        .where("_all > 1 AND _differ AND _wanted")
        .drop("_differ", "_wanted")
    )
    # groups above the tile size: at most one per tile_rows rows
    before = Window.partitionBy(*equal).orderBy("_apart").rowsBetween(Window.unboundedPreceding, -1)
    large = counts.where(big).withColumn("_width", tiles(F.col("_n"))).select(
        *equal, "_apart", "_width", F.coalesce(F.sum("_width").over(before), F.lit(0)).cast("int").alias("_start")
    )
    # one narrow row per group of the blocks that have something to compare; the wide rows meet it once
    groups = cut_lineage(counts.drop("_n", "_fresh").join(blocks, equal).join(large, [*equal, "_apart"], "left")).hint("merge")
    own = F.col("p._apart").eqNullSafe(F.col("g._apart"))
    for c in equal:
        own = own & (F.col(f"p.{c}") == F.col(f"g.{c}"))
    sizes = [F.col(f"g.{c}") for c in ("_rest", "_own_tiles", "_width", "_start")]
    met = cut_lineage(present.alias("p").join(groups.alias("g"), own).select("p.*", *sizes).drop("_apart"))
    shared = tiles(F.col("_rest"))
    spread_over = lambda n: F.pmod(F.xxhash64(key), n).cast("int")
    alone = F.col("_width").isNotNull()
    dealt = met.withColumn(
        "_tile",
        F.when(alone, F.col("_start") + spread_over(F.col("_width")))
        .otherwise(F.col("_own_tiles") + spread_over(F.greatest(shared, F.lit(1)))),
    ).withColumns(
        {
            "_from": F.when(alone, F.col("_start") + F.col("_width")).otherwise(F.col("_tile")),
            "_to": F.when(alone, F.col("_start") - 1).otherwise(F.col("_tile")),
            "_last": F.col("_own_tiles") + shared - 1,
        }
    )
    span = lambda low, high: F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    upward = F.explode(span(F.col("_from"), F.col("_last")))
    downward = F.explode(span(F.lit(0), F.col("_to")))
    a = dealt.withColumns({"_low": F.col("_tile"), "_high": upward}).alias("a")
    b = dealt.withColumns({"_low": downward, "_high": F.col("_tile")}).alias("b")
    on = (F.col("a._low") == F.col("b._low")) & (F.col("a._high") == F.col("b._high"))
    for c in equal:
        on = on & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    once = (F.col("a._low") < F.col("a._high")) | (F.col(f"a.{key}") < F.col(f"b.{key}"))
    return a.join(b.hint("merge"), on & once & keep)


# equality on the left implies equality on the right
IMPLIED = {"phone": "phone_block", "zip_code": "zip3"}


def spare_score(family: Family, cfg: MatchConfig, threshold: float) -> float:
    """What name and address of a family's pairs can lose together and still reach the threshold."""
    best = -1.0
    for p, pc in PHONE_LEVELS:
        for d, dc in DOMAIN_LEVELS:
            for z, zc in ZIP_LEVELS:
                shared = {c for c in (pc, dc, zc) if c}
                shared |= {IMPLIED[c] for c in shared if c in IMPLIED}
                if set(family.equal) <= shared | set(NAMED) and not any(set(u) <= shared for u in family.unless):
                    best = max(best, cfg.score(1.0, 1.0, p, d, z) - threshold)
    return best


def similar_names(p: DataFrame, least: float, tile_rows: int) -> DataFrame:
    """(last_part, near, similarity): pairs of different last names, in order, with at least that similarity, and every name
    with itself. Names meet through the characters that they must share (``similar.similar_pairs``)."""
    names = cut_lineage(p.where(F.col("last_part") != "").select("last_part").distinct())
    pairs = similar_pairs(names, "last_part", least, tile_rows)
    similar = pairs.select(F.col("a").alias("last_part"), F.col("b").alias("near"), "similarity")
    return cut_lineage(similar.unionByName(names.select("last_part", F.col("last_part").alias("near"), F.lit(1.0).alias("similarity"))))


def refined(families: Sequence[Family]) -> list[Family]:
    """The same pairs, with those of a family that share the zip area told apart by the zip code: without it they have less to spare."""
    out = []
    for f in families:
        if "zip3" in f.equal and not set(NAMED) <= set(f.equal):
            closer = tuple("zip_code" if c == "zip3" else c for c in f.equal)
            out += [Family(closer, f.unless), Family(f.equal, (*f.unless, closer))]
        else:
            out.append(f)
    return out


def _tiled_join(left: DataFrame, right: DataFrame, on: Sequence[str], key: Sequence[str], condition: Column, tile_rows: int) -> DataFrame:
    a, b = tiled(left, right, on, key, key, tile_rows)
    a, b = a.alias("a"), b.alias("b")
    for c in [*on, "_ta", "_tb"]:
        condition = (F.col(f"a.{c}") == F.col(f"b.{c}")) & condition
    return a.join(b, condition)


def name_pairs(names: DataFrame, equal: Sequence[str], near: DataFrame | None, fits, tile_rows: int) -> DataFrame:
    """Pairs of different names (first_part, last_part; near_first, near) of a block with their similarities ``_first`` and ``_last``, where
    ``fits(first, last)``; last names are in order. ``near`` are the similar last names, where so few are that an index helps."""
    there = names.withColumn("near", F.col("last_part"))
    own, on = (names, list(equal)) if near is None else (names.join(near.hint("merge"), "last_part"), [*equal, "near"])
    limit = lambda c: score_ceiling(*[F.col(f"{s}.{m}_{c}") for m in ("len", "inv", "mask") for s in "ab"])
    last = limit("last_part") if near is None else F.col("a.similarity")
    ordered = F.col("a.last_part") <= F.col("b.last_part")
    met = _tiled_join(own, there, on, ["first_part", "last_part"], ordered & fits(limit("first_part"), last), tile_rows)
    alike = lambda c: text_similarity(F.col(f"a.{c}"), F.col(f"b.{c}"))
    scored = met.select(
        *[F.col(f"a.{c}") for c in (*equal, "first_part", "last_part")], F.col("b.first_part").alias("near_first"), F.col("b.last_part").alias("near"),
        alike("first_part").alias("_first"), (alike("last_part") if near is None else F.col("a.similarity")).alias("_last"),
    )
    return scored.where(fits(F.col("_first"), F.col("_last")))


def near_pairs(
    p: DataFrame, equal: Sequence[str], near: DataFrame | None, fits, keep, tile_rows: int, filled: Sequence[str], new_only: bool = False
) -> list[DataFrame]:
    """Pairs (a, b) of rows that share the ``equal`` columns, have names that fit and pass ``keep``, each pair once. The different names of
    a block are compared once (``name_pairs``), and rows meet under two names that fit. Rows that lack one of ``filled`` can't reach
    the threshold and are left out."""
    present = p
    for c in equal:
        present = present.where(F.col(c).isNotNull())
    for c in filled:
        present = present.where(F.col(c) != "")
    name = [*equal, "first_part", "last_part"]
    traits = [f"{m}_{c}" for m in ("len", "inv", "mask") for c in ("first_part", "last_part")]  # follow from the names
    names = cut_lineage(present.groupBy(*name).agg(*[F.first(c).alias(c) for c in traits]))
    fitting = cut_lineage(name_pairs(names, equal, near, fits, tile_rows))
    own = present.join(fitting.hint("merge"), name)
    there = present.withColumns({"near_first": F.col("first_part"), "near": F.col("last_part")})
    sides = [(own, there)]
    if new_only:  # new rows against all, and old rows against new ones
        sides = [(own.where("is_new"), there), (own.where("not is_new"), there.where("is_new"))]
    once = (F.col("a.last_part") < F.col("b.last_part")) | (F.col("a.profile") < F.col("b.profile"))
    return [_tiled_join(left, right, [*equal, "near_first", "near"], ["profile"], once & keep, tile_rows) for left, right in sides]


def _ab(name: str) -> tuple[Column, Column]:
    return F.col(f"a.{name}"), F.col(f"b.{name}")


def _deterministic() -> Column:
    return _agree(*_ab("personal_email")) | _agree(*_ab("full_phone"))


def candidate_pairs(p: DataFrame, cfg: MatchConfig, threshold: float, new_only: bool = False) -> DataFrame:
    """Profile pairs that may reach the threshold by score and are not already matched by e-mail or phone, with the similarities
    ``_first`` and ``_last`` of their names."""
    phone = phone_similarity(*_ab("phone"), *_ab("phone_block"))
    domain = domain_similarity(*_ab("domain"))
    zip_code = zip_similarity(*_ab("zip_code"), *_ab("zip3"))
    ceilings = {c: score_ceiling(*[x for m in ("len", "inv", "mask") for x in _ab(f"{m}_{c}")]) for c in ("first_part", "last_part")}
    line = score_ceiling(*[x for m in ("len", "inv", "mask") for x in _ab(f"{m}_address")], common_start(*_ab("address")))

    def possible(first: Column, last: Column) -> Column:
        ceiling = cfg.score(name_similarity(first, last), line, phone, domain, zip_code)
        pair = ~_deterministic() & (ceiling >= threshold - 1e-9)
        return pair & (F.col("a.is_new") | F.col("b.is_new")) if new_only else pair

    families = refined(reachable(cfg, threshold))
    # how far name and address have to agree where little else does
    by_name = cfg.score(1.0, 0.0, 0.0, 0.0, 0.0)
    lost = {f: spare_score(f, cfg, threshold) for f in families}
    last = {f: 1 - lost[f] / (by_name * 0.6) for f in families}
    wide = [f for f in families if "phone_block" not in f.equal and "last_part" not in f.equal and last[f] > 0]
    indexed = [f for f in wide if last[f] >= INDEXED]
    near = similar_names(p, min(last[f] for f in indexed), cfg.tile_rows) if indexed else None

    out = None
    for family in families:
        fresh = F.lit(True)
        for columns in family.unless:
            covered = F.lit(True)
            for c in columns:
                covered = covered & _agree(*_ab(c))
            fresh = fresh & ~covered
        # equal e-mails and equal phones are matches already
        apart = "full_phone" if "phone_block" in family.equal else "personal_email"
        if family in wide:
            needed = {"first_part": by_name * 0.4, "address": cfg.score(0.0, 1.0, 0.0, 0.0, 0.0)}
            filled = ["last_part", *(c for c, weight in needed.items() if lost[family] < weight - 1e-9)]
            fits = lambda first, last, spare=lost[family]: by_name * (1 - name_similarity(first, last)) <= spare + 1e-9
            alike = near.where(F.col("similarity") >= last[family] - 1e-9) if family in indexed else None
            names = [F.col("a._first"), F.col("a._last")]  # both are known here
            found = near_pairs(p, family.equal, alike, fits, possible(*names) & fresh, cfg.tile_rows, filled, new_only)
        else:
            names = [text_similarity(*_ab(c)) for c in ("first_part", "last_part")]
            found = [block_pairs(p, family.equal, possible(*ceilings.values()) & fresh, cfg.tile_rows, apart=apart, new_only=new_only)]
        for joined in found:
            pairs = joined.select(
                *[F.col(f"{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in ("profile", "copies", "address")],
                *[c.alias(name) for c, name in zip(names, ("_first", "_last"))],
                phone.alias("phone_score"), domain.alias("domain_score"), zip_code.alias("zip_score"),
            )
            out = pairs if out is None else out.unionByName(pairs)
    return out


def classify(score: Column, cfg: MatchConfig) -> Column:
    return F.when(score >= cfg.auto_threshold, AUTO).when(score >= cfg.review_threshold, REVIEW).otherwise(NONE)


def match_reasons(name: Column, address: Column, phone: Column, zip_code: Column) -> Column:
    def graded(score, label):
        text = lambda word: F.format_string(f"{word} {label} match (%.2f)", score)
        return F.when(score > 0.8, text("Strong")).when(score > 0.6, text("Moderate"))

    reasons = F.array(
        graded(name, "name"),
        graded(address, "address"),
        F.when(phone > 0, F.format_string("Phone match (%.2f)", phone)),
        F.when(zip_code == 1.0, F.lit("Same zip code")),
    )
    return F.filter(reasons, lambda r: r.isNotNull())


def score_pairs(candidates: DataFrame, cfg: MatchConfig, threshold: float) -> DataFrame:
    """Scores, type and reasons of the candidate profile pairs that reach the threshold."""
    name = name_similarity(F.col("_first"), F.col("_last"))
    named = candidates.withColumns({"name_score": name, "address_score": text_similarity(F.col("address_a"), F.col("address_b"))})
    scores = [F.col(c) for c in ("name_score", "address_score", "phone_score", "domain_score", "zip_score")]
    scored = named.withColumn("confidence", cfg.score(*scores)).where(F.col("confidence") >= threshold)
    a, b = F.col("profile_a"), F.col("profile_b")
    first = a < b
    return scored.select(
        F.least(a, b).alias("profile_a"), F.greatest(a, b).alias("profile_b"),
        F.when(first, F.col("copies_a")).otherwise(F.col("copies_b")).alias("copies_a"),
        F.when(first, F.col("copies_b")).otherwise(F.col("copies_a")).alias("copies_b"),
        classify(F.col("confidence"), cfg).alias("match_type"),
        "confidence", "name_score", "address_score", "phone_score", "domain_score", "zip_score",
    )


def explain_pairs(scored: DataFrame) -> DataFrame:
    """Add the feature map and the list of reasons."""
    features = {
        "name_similarity": "name_score", "address_similarity": "address_score", "phone_similarity": "phone_score",
        "email_domain": "domain_score", "zip_match": "zip_score",
    }
    return scored.withColumns(
        {
            "feature_scores": F.create_map(*[x for k, c in features.items() for x in (F.lit(k), F.col(c))]),
            "match_reasons": match_reasons(*[F.col(c) for c in ("name_score", "address_score", "phone_score", "zip_score")]),
        }
    )


def scored_profiles(p: DataFrame, cfg: MatchConfig, threshold: float, new_only: bool = False) -> DataFrame:
    """Every pair of profiles whose score reaches the threshold. ``p`` should be a written table, since
    each block family reads it."""
    return score_pairs(candidate_pairs(p, cfg, threshold, new_only), cfg, threshold)


def scored_matches(records: DataFrame, cfg: MatchConfig = MatchConfig(), threshold: float | None = None) -> DataFrame:
    """Score records directly, down to the review threshold unless another is given."""
    limit = cfg.review_threshold if threshold is None else threshold
    return scored_profiles(cut_lineage(profiles(records)), cfg, limit)


def copy_matches(p: DataFrame, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """Profiles held by several records: how the copies match each other, and in how many pairs."""
    there = lambda c: F.when(c, 1.0).otherwise(0.0)
    name = name_similarity(there(F.col("first_part") != ""), there(F.col("last_part") != ""))
    score = cfg.score(
        name, there(F.col("address") != ""), there(F.col("phone").isNotNull()), there(F.col("domain").isNotNull()),
        there(F.col("zip_code").isNotNull()),
    )
    n = F.col("copies")
    kind = F.when(F.col("personal_email").isNotNull(), EMAIL).when(F.col("full_phone").isNotNull(), PHONE).otherwise(classify(score, cfg))
    value = F.when(kind == EMAIL, cfg.email_confidence).when(kind == PHONE, cfg.phone_confidence).otherwise(score)
    return p.where(n > 1).select(
        "profile", "copies", kind.alias("match_type"), value.alias("confidence"), (n * (n - 1) / 2).cast("bigint").alias("pairs")
    ).where(F.col("match_type") != NONE)


def block_key(last: Column, zip_code: Column) -> Column:
    """Coarse opt-in block: three letters of the last name and the zip area."""
    prefix = F.when(F.coalesce(last, F.lit("")) != "", F.substring(last, 1, 3)).otherwise("NONAME")
    return F.concat(prefix, F.lit("_"), F.substring(F.coalesce(zip_code, F.lit("")), 1, 3))


def fuzzy_join(
    left: DataFrame, right: DataFrame, block: Sequence[str], left_text: str, right_text: str, threshold: float,
    tile_rows: int = 4096,
) -> DataFrame:
    """Rows of two tables that share the block columns and whose texts are similar. The different texts of a block are compared once each,
    and rows meet under two texts that are similar; a hot block or text is dealt into tiles. The JVM-side ceiling inside the join
    drops hopeless pairs; only the rest reaches the similarity function."""
    block = list(block)

    def side(df, column):
        c = F.col(column)
        return df.withColumns({"_len": F.length(c), "_inv": inverse_length(c), "_mask": char_mask(c)})

    def met(a, b, on, key_a, key_b, condition=None):
        a, b = tiled(a, b, on, key_a, key_b, tile_rows)
        a, b = a.alias("l"), b.alias("r")
        condition = F.lit(True) if condition is None else condition
        for c in [*on, "_ta", "_tb"]:
            condition = condition & (F.col(f"l.{c}") == F.col(f"r.{c}"))
        return a.join(b, condition)

    keep = [F.col(f"l.{c}") for c in left.columns] + [
        F.col(f"r.{c}").alias(c if c not in left.columns else f"right_{c}") for c in right.columns if c not in block
    ]
    bound = score_ceiling(*[F.col(f"{s}.{c}") for c in ("_len", "_inv", "_mask") for s in "lr"]) >= threshold - 1e-9
    if threshold < 0:  # all pairs of a block, rows without a text included
        similarity = text_similarity(F.col(f"l.{left_text}"), F.col(f"r.{right_text}"))
        return met(side(left, left_text), side(right, right_text), block, left.columns, right.columns, bound).select(
            *keep, similarity.alias("similarity")
        ).where(F.col("similarity") > threshold)

    def texts(df, column):
        return side(df.where(F.col(column) != "").select(*block, F.col(column).alias("_text")).distinct(), "_text")

    compared = met(texts(left, left_text), texts(right, right_text), block, ["_text"], ["_text"], bound).select(
        *[F.col(f"l.{c}") for c in block], F.col("l._text").alias("_own"), F.col("r._text").alias("_near"),
        text_similarity(F.col("l._text"), F.col("r._text")).alias("_similarity"),
    )
    similar = cut_lineage(compared.where(F.col("_similarity") > threshold))
    own = left.withColumn("_own", F.col(left_text)).join(similar, [*block, "_own"])
    there = right.withColumn("_near", F.col(right_text))
    return met(own, there, [*block, "_near"], left.columns, right.columns).select(*keep, F.col("_similarity").alias("similarity"))


def tune_threshold(scored: DataFrame, score: str = "confidence", label: str = "label") -> DataFrame:
    """The score threshold with the best F1 against labelled pairs, as one row."""
    from constituent360.operators.evaluation import best_f1

    return best_f1(scored, score, label)


