import datetime as dt
import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from constituent360.functions.similarity import jaro_winkler_batch
from constituent360.operators import components, identity, matching
from constituent360.operators.matching import MatchConfig
from constituent360.operators.tiles import tiled
from constituent360.session import cut_lineage

CFG = MatchConfig()
SCHEMA = (
    "source_system string, source_id string, email string, phone string, first_name string, last_name string, "
    "full_name string, address_line1 string, city string, state string, zip_code string, updated_at timestamp_ntz"
)


def row(system, id_, email=None, phone=None, first=None, last=None, full=None, address=None, zip_code=None, at=None):
    return (system, id_, email, phone, first, last, full, address, None, None, zip_code, at)


DEMO = [
    row("donations", "D-001", "john.smith@gmail.com", "312-555-1234", "John", "Smith", None, "123 Main Street", "60601"),
    row("subscriptions", "S-001", "j.smith@work.com", "312-555-1234", None, None, "John M Smith", "123 Main St", "60601"),
    row("events", "E-001", "john.smith@gmail.com", None, None, None, "J. Smith"),
    row("donations", "D-002", "mary.jones@gmail.com", None, "Mary", "Jones", None, "456 Oak Avenue", "60201"),
]


def test_demo_records(spark):
    u = identity.unify(spark.createDataFrame(DEMO, SCHEMA))
    golden = {r["record_count"]: r for r in u.constituents.collect()}
    assert set(golden) == {1, 3}
    big = golden[3]
    assert big["canonical_email"] == "john.smith@gmail.com"
    assert (big["canonical_first_name"], big["canonical_last_name"]) == ("John", "Smith")
    assert big["canonical_phone"] == "3125551234"
    assert big["canonical_address_line1"] == "123 Main Street"
    assert big["source_systems"] == ["donations", "events", "subscriptions"]
    links = {r["source_record_id"]: (r["match_type"], r["match_confidence"]) for r in u.links.collect()}
    assert links["D-001"] == ("deterministic_email", 1.0)
    assert links["S-001"] == ("deterministic_phone", 0.95)
    assert links["D-002"] == ("no_match", None)


def test_knife_edge_is_review(spark):
    """Everything equal but no phone: the weights add up to just under the automatic threshold."""
    rows = [
        row("a", "1", "info@x.org", None, "Ann", "Lee", None, "1 Oak Street", "60601"),
        row("b", "2", "other@x.org", None, "Ann", "Lee", None, "1 Oak St", "60601"),
    ]
    got = matching.scored_matches(matching.prepare(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [(r["match_type"], r["confidence"]) for r in got] == [("manual_review", 0.8499999999999999)]


def test_families_of_the_default_weights():
    columns = lambda t: {f.equal for f in matching.reachable(CFG, t)}
    assert columns(0.85) == {
        ("phone_block", "zip_code"), ("phone_block", "domain"), ("phone", "zip3", "first_part", "last_part", "address"),
    }
    assert columns(0.70) == {
        ("zip_code",), ("domain", "zip3"), ("domain",), ("phone_block",), ("zip3", "first_part", "last_part", "address"),
    }
    spare = {f.equal: matching.spare_score(f, CFG, 0.70) for f in matching.reachable(CFG, 0.70)}
    assert spare["domain",] == pytest.approx(0.05) and spare["zip_code",] == pytest.approx(0.05)
    with pytest.raises(ValueError):
        matching.reachable(CFG, 0.6)


def jw(a, b):
    return float(jaro_winkler_batch(pd.Series([a]), pd.Series([b]))[0])


def compare(a, b, cfg):
    """Plain comparison of two prepared rows."""
    if a["personal_email"] and a["personal_email"] == b["personal_email"]:
        return "deterministic_email", 1.0
    if a["full_phone"] and a["full_phone"] == b["full_phone"]:
        return "deterministic_phone", 0.95
    part = lambda c: jw(a[c], b[c]) if a[c] and b[c] else 0.0
    name = part("first_part") * 0.4 + part("last_part") * 0.6
    phone = zip_code = domain = 0.0
    if a["phone"] and b["phone"]:
        if a["phone"] == b["phone"]:
            phone = 1.0
        elif len(a["phone"]) >= 7 and len(b["phone"]) >= 7 and a["phone"][-7:] == b["phone"][-7:]:
            phone = 0.8
    if a["zip_code"] and b["zip_code"]:
        zip_code = 1.0 if a["zip_code"] == b["zip_code"] else 0.5 if a["zip_code"][:3] == b["zip_code"][:3] else 0.0
    da, db = [(r["email"] or "").rpartition("@")[2] if "@" in (r["email"] or "") else "" for r in (a, b)]
    domain = 1.0 if da and da == db else 0.0
    score = cfg.score(name, part("address"), phone, domain, zip_code)
    kind = "probabilistic" if score >= cfg.auto_threshold else "manual_review" if score >= cfg.review_threshold else "no_match"
    return kind, score


def population(n, seed, hot=None):
    """Random contacts from small vocabularies; with ``hot``, a third of them share one value of a column."""
    rng = random.Random(seed)
    pick = lambda *v: rng.choice(v)
    out = []
    for i in range(n):
        domain = pick("a.org", "b.org", "c.org", "d.org")
        values = dict(
            email=pick(None, f"u{rng.randint(0, n)}@{domain}", f"Info@{domain}", f"u{rng.randint(0, 5)}@{domain}"),
            phone=pick(None, f"312555{rng.randint(1000, 1000 + n):04d}", f"773555{rng.randint(1000, 1010):04d}", "555-1234", "12345"),
            first=pick("Ann", "Anna", "Jon", "John", "Mary", None), last=pick("Smith", "Smyth", "Jones", "Lee", None),
            full=pick(None, "Mary Ann Lee", "Cher"), address=pick("1 Oak Street", "1 Oak St.", "12 Oak Ave", "77 Lake Road", None, ""),
            zip_code=pick("60601", "60602", "60601-1234", "70001", None), at=pick(None, dt.datetime(2024, 1, rng.randint(1, 28))),
        )
        if hot and rng.random() < 0.34:
            values.update(hot)
        out.append(row(pick("x", "y", "z"), f"{i}", **values))
    return out


HOT = [None, {"phone": "3125550000"}, {"email": "shared@a.org"}, {"zip_code": "60601"}, {"email": None, "phone": None, "first": "Ann", "last": "Lee", "full": None, "address": "1 Oak St", "zip_code": "60601"}]


@pytest.mark.parametrize("hot", HOT)
def test_blocked_matching_equals_all_pairs(spark, hot):
    cfg = MatchConfig(tile_rows=16)
    raw = spark.createDataFrame(population(140, 11, hot), SCHEMA)
    u = identity.unify(raw, cfg)
    rows = [r.asDict() for r in u.records.collect()]
    pairs = {}
    parent = {r["record_key"]: r["record_key"] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(rows, key=lambda r: r["record_key"]), 2):
        kind, score = compare(a, b, cfg)
        if kind != "no_match":
            pairs[(a["record_key"], b["record_key"])] = (kind, score)
        if kind not in ("no_match", "manual_review"):
            x, y = find(a["record_key"]), find(b["record_key"])
            if x != y:
                parent[max(x, y)] = min(x, y)
    truth = {k: find(k) for k in parent}
    assert {r["record_key"]: r["cluster"] for r in u.clusters.collect()} == truth

    matches = u.matches
    counts = {r["match_type"]: r["pairs"] for r in identity.match_type_counts(u.records, u.profiles, matches, cfg).collect()}
    want = pd.Series([k for k, _ in pairs.values()]).value_counts().to_dict()
    assert counts == want

    audit = {(r["cluster"], r["match_type"]): r["pairs"] for r in u.audit.collect()}
    expected = {}
    for (a, b), (kind, _) in pairs.items():
        for c in {truth[a], truth[b]}:
            expected[(c, kind)] = expected.get((c, kind), 0) + 1
    assert audit == expected


def test_hot_shared_phone_is_not_compared_pairwise(spark):
    """Rows that share a full phone match already; their tiles never meet."""
    rows = [(f"k{i:04d}", "5551234", "3125551234") for i in range(300)] + [("z1", "5551234", "7735551234"), ("z2", "5551234", None)]
    df = spark.createDataFrame(rows, "profile string, phone_block string, full_phone string")
    pairs = matching.block_pairs(df, ["phone_block"], F.lit(True), 32, apart="full_phone")
    assert pairs.count() == 300 * 2 + 1


def test_blocks_without_anything_to_compare_are_left_out(spark):
    """Rows of one full phone match already; a block of them alone meets no join, and one without a new row none that wants new rows."""
    rows = [(f"a{i}", "1111111", "3121111111", True) for i in range(4)]
    rows += [("b1", "2222222", "3122222222", False), ("b2", "2222222", "7732222222", False)]
    rows += [("c1", "3333333", "3123333333", False), ("c2", "3333333", "7733333333", True)]
    rows += [("d1", "4444444", None, False), ("d2", "4444444", None, True), ("e1", "5555555", None, True), ("f1", None, None, True), ("f2", None, None, True)]
    df = spark.createDataFrame(rows, "profile string, phone_block string, full_phone string, is_new boolean")

    def met(new_only):
        pairs = matching.block_pairs(df, ["phone_block"], F.lit(True), 32, apart="full_phone", new_only=new_only)
        return sorted((r[0], r[1]) for r in pairs.select("a.profile", "b.profile").collect())

    assert met(False) == [("b1", "b2"), ("c1", "c2"), ("d1", "d2")]
    assert met(True) == [("c1", "c2"), ("d1", "d2")]


def test_records_of_one_file_are_prepared_by_many_tasks(spark):
    raw = spark.createDataFrame(population(120, 6), SCHEMA)
    one = raw.coalesce(1)
    dealt = matching.spread(one)
    assert dealt.rdd.getNumPartitions() > 4 and sorted(dealt.collect(), key=repr) == sorted(raw.collect(), key=repr)
    u = identity.unify(one, probabilistic=False)
    assert u.records.count() == 120 and u.records.select(F.input_file_name()).distinct().count() > 4


def test_incremental_equals_full(spark):
    raw = spark.createDataFrame(population(120, 4), SCHEMA)
    old, new = raw.where("cast(source_id as int) % 4 <> 0"), raw.where("cast(source_id as int) % 4 = 0")
    full = {r["record_key"]: r["cluster"] for r in identity.unify(raw).clusters.collect()}
    step = identity.unify_incremental(new, old, identity.unify(old).clusters)
    assert {r["record_key"]: r["cluster"] for r in step.collect()} == full


def test_components_of_chain_hub_and_random(spark):
    rng = random.Random(9)
    edges = [(f"c{i:05d}", f"c{i + 1:05d}") for i in range(1000)]
    edges += [("hub", f"h{i:05d}") for i in range(2000)]
    edges += [(f"r{rng.randint(0, 300):05d}", f"r{rng.randint(0, 300):05d}") for _ in range(250)]
    nodes = sorted({x for e in edges for x in e} | {"lonely"})
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = components.connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node string"), spark.createDataFrame(edges, "a string, b string")
    )
    assert {r["node"]: r["component"] for r in got.collect()} == {n: find(n) for n in nodes}


def test_survivor_rules(spark):
    late, early = dt.datetime(2024, 2, 1), dt.datetime(2024, 1, 1)
    rows = [
        row("a", "1", "info@x.org", "3125551234", "Jo", "Li", None, "1 Oak", "60601", early),
        row("a", "2", "jo@x.org", "12345", None, None, "Joanna de Lima", "2 Oak", "60602", late),
        row("a", "3", "jo2@x.org", None, "Joan", "Lima", None, "", None, None),
    ]
    records = matching.prepare(spark.createDataFrame(rows, SCHEMA))
    clusters = records.select("record_key", F.lit("a:1").alias("cluster"))
    r = identity.survivors(records, clusters).first()
    assert r["canonical_email"] == "jo@x.org"  # latest
    assert (r["canonical_first_name"], r["canonical_last_name"]) == ("Joanna", "Lima")  # longest, each on its own
    assert r["canonical_phone"] == "12345"  # latest of any length, because one full number exists
    assert (r["canonical_address_line1"], r["canonical_zip"]) == ("2 Oak", "60602")

    untimed = [x[:-1] + (None,) for x in rows]
    records = matching.prepare(spark.createDataFrame(untimed, SCHEMA))
    r = identity.survivors(records, clusters).first()
    assert r["canonical_email"] == "jo@x.org"  # first that is no role mailbox
    assert r["canonical_phone"] == "3125551234" and r["canonical_address_line1"] == "1 Oak"


def test_reasons(spark):
    df = spark.createDataFrame([(0.95, 0.7, 0.8, 1.0), (0.5, 0.5, 0.0, 0.5)], "n double, a double, p double, z double")
    got = [r[0] for r in df.select(matching.match_reasons(*[F.col(c) for c in "napz"])).collect()]
    assert got == [["Strong name match (0.95)", "Moderate address match (0.70)", "Phone match (0.80)", "Same zip code"], []]


def test_overrides(spark):
    edges = spark.createDataFrame([("a", "b"), ("c", "b")], "a string, b string")
    overrides = spark.createDataFrame([("b", "a", "unmatch"), ("d", "a", "match")], "key_a string, key_b string, action string")
    got = {tuple(r) for r in identity.apply_overrides(edges, overrides).collect()}
    assert got == {("b", "c"), ("a", "d")}


def test_statistics_of_nothing(spark):
    empty = identity.survivors(
        matching.prepare(spark.createDataFrame([], SCHEMA)), spark.createDataFrame([], "record_key string, cluster string")
    )
    assert identity.match_statistics(empty).count() == 0


def test_similar_names_are_the_pairs_of_distinct_names(spark):
    import random

    from constituent360.functions.similarity import jaro_winkler_batch
    from constituent360.operators import matching as M

    rng = random.Random(3)
    names = sorted({"".join(rng.choice("abcdm") for _ in range(rng.randint(3, 7))) for _ in range(60)})
    rows = [("s", str(i), f"a {n}", n) for i, n in enumerate(names + names[:20])]
    raw = spark.createDataFrame(rows, "source_system string, source_id string, full_name string, last_name string")
    p = M.profiles(M.prepare(raw))
    for tile_rows in (7, 4096):
        got = {(r["last_part"], r["near"]) for r in M.similar_names(p, 0.762, tile_rows).collect()}
        last = sorted({r["last_part"] for r in p.select("last_part").collect()})
        pairs = [(a, b) for a in last for b in last if a < b]
        import pandas as pd

        score = jaro_winkler_batch(pd.Series([a for a, _ in pairs]), pd.Series([b for _, b in pairs]))
        assert got == {x for x, s in zip(pairs, score) if s >= 0.762 - 1e-9} | {(n, n) for n in last}


def written(monkeypatch):
    """The sizes of the tables that matching writes."""
    sizes, write = [], matching.cut_lineage
    monkeypatch.setattr(matching, "cut_lineage", lambda df: (out := write(df), sizes.append(out.count()))[0])
    return sizes


def test_names_of_a_block_are_compared_once(spark, monkeypatch):
    """Sixty people with one of two names share a mail domain and a zip code: two names are compared, whoever bears them."""
    rows = [row("a", f"{i}", f"u{i}@a.org", None, "Ann", ("Smith", "Smyth")[i % 2], None, f"{i} Oak Street", "60601") for i in range(60)]
    p = matching.profiles(matching.prepare(spark.createDataFrame(rows, SCHEMA))).cache()
    found = []
    plain = matching.name_pairs
    monkeypatch.setattr(matching, "name_pairs", lambda *a: (out := plain(*a), found.append(out.count()))[0])
    got = matching.scored_profiles(p, CFG, CFG.review_threshold)
    expected = sum(compare(a, b, CFG)[0] == "manual_review" for a, b in itertools.combinations([r.asDict() for r in p.collect()], 2))
    assert got.count() == expected > 0
    assert found and max(found) <= 3


def test_ceiling_with_a_common_start_bounds_the_similarity(spark):
    from constituent360.functions import similarity as S

    words = ["", "a", "12 oak st", "123 oak st", "132 oak st", "456 oak st", "12 oak ave", "1234", "1243", "öl 12", "ol 12"]
    df = spark.createDataFrame([(a, b, jw(a, b) if a and b else 0.0) for a in words for b in words], "a string, b string, exact double")
    own = [f(F.col(c)) for f in (F.length, S.inverse_length, S.char_mask) for c in "ab"]
    bound = S.score_ceiling(*own, S.common_start(F.col("a"), F.col("b")))
    assert df.where(bound < F.col("exact") - 1e-12).count() == 0
    assert df.where((F.col("a") == "123 oak st") & (F.col("b") == "456 oak st")).where(bound < S.score_ceiling(*own) - 0.05).count() == 1


def test_fuzzy_join_compares_different_texts_once(spark, monkeypatch):
    left = spark.createDataFrame([(f"l{i}", "z", ("smith", "lee", "", None)[i % 4]) for i in range(80)], "k string, zip string, name string")
    right = spark.createDataFrame([(f"r{i}", "z", ("smyth", "jones", "")[i % 3]) for i in range(90)], "k string, zip string, name string")
    sizes = written(monkeypatch)
    got = matching.fuzzy_join(left, right, ["zip"], "name", "name", 0.8, tile_rows=16)
    assert got.columns == ["k", "zip", "name", "right_k", "right_name", "similarity"]
    rows = {(r["name"], r["right_name"], round(r["similarity"], 9)) for r in got.collect()}
    assert rows == {("smith", "smyth", round(jw("smith", "smyth"), 9))} and got.count() == 20 * 30
    assert sizes and max(sizes) <= 2
    assert matching.fuzzy_join(left, right, ["zip"], "name", "name", -1.0, tile_rows=16).count() == 80 * 90


@pytest.fixture
def by_file_size(spark):
    """The planner would send a written table of up to 64 KB of files to every task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def sent_whole(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def few_names(n):
    return [row("a", str(i), f"u{i}@x.org", None, "Ann", ("Lee", "Leeds")[i % 2], None, f"{i % 9} Oak Street", f"606{i % 7:02}") for i in range(n)]


def test_tile_sizes_are_merged_not_sent_to_every_task(spark, by_file_size):
    """One row per key: as many as the input has keys, in files that may be far smaller."""
    a, b = (cut_lineage(spark.range(3000).selectExpr("'a long text that compresses well' as k", f"id as {c}")) for c in "xy")
    left, right = tiled(a, b, ["k"], ["x"], ["y"], 1000)
    assert [sent_whole(left), sent_whole(right)] == [0, 0]
    assert left.join(right, ["k", "_ta", "_tb"]).count() == 3000 * 3000


def test_names_that_fit_are_merged_with_the_rows_not_sent_to_every_task(spark, by_file_size):
    """They come again for every block, so millions of them fill a file of a few MB."""
    p = cut_lineage(matching.profiles(matching.prepare(spark.createDataFrame(few_names(120), SCHEMA))))
    pairs = matching.candidate_pairs(p, CFG, CFG.review_threshold)
    assert sent_whole(pairs) == 0
    assert pairs.count() > 0


def test_matches_per_record_are_scored_once(spark):
    """Both sides of a match, and the sort's bounds, come from the written matches: nothing is joined again."""
    scored = matching.scored_matches(matching.prepare(spark.createDataFrame(few_names(40), SCHEMA)))
    pairs = {(r["profile_a"], r["profile_b"]) for r in scored.collect()}
    found = identity.matches_per_record(scored)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    rows = [(r["record"], -r["confidence"], r["other"]) for r in found.collect()]
    assert rows == sorted(rows) and {(a, b) for a, _, b in rows} == pairs | {(b, a) for a, b in pairs} and len(rows) == 2 * len(pairs) > 0


def test_audit_scores_once_and_sends_no_table_to_every_task(spark, by_file_size):
    u = identity.unify(spark.createDataFrame(few_names(40) + DEMO, SCHEMA))
    audit = u.audit
    assert sent_whole(audit) == 0
    assert "ArrowEvalPython" not in audit._jdf.queryExecution().executedPlan().toString()  # the similarity of a pair
    assert {r["match_type"] for r in audit.collect()} >= {"deterministic_email", "deterministic_phone", "manual_review"}
