"""Components with pairs that must not meet, against a plain version."""

import random

import pytest

from constituent360.operators import identity as I
from constituent360.operators.constrained import constrained_components


def by_hand(nodes, edges, forbidden):
    of = {n: {n} for n in nodes}
    best = {}
    for a, b, c in edges:
        k = (min(a, b), max(a, b))
        best[k] = max(best.get(k, c), c)
    for (a, b), _ in sorted(best.items(), key=lambda x: (-x[1], x[0])):
        both = of[a] | of[b]
        if of[a] is not of[b] and not any(x in both and y in both for x, y in forbidden):
            for n in both:
                of[n] = both
    return sorted((n, min(of[n])) for n in nodes)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("kind", ["string", "long"])
def test_components_by_hand(spark, seed, kind):
    r = random.Random(seed)
    name = (lambda i: f"n{i:03d}") if kind == "string" else (lambda i: i)
    nodes = [name(i) for i in range(200)]
    pick = lambda: sorted(r.sample(nodes, 2))
    edges = [(*r.choice([lambda p: p, lambda p: p[::-1]])(pick()), r.choice([0.86, 0.9, 0.95, 1.0])) for _ in range(150 + 40 * seed)]
    edges += [(nodes[0], n, 1.0) for n in nodes[100:140]]  # a hub
    edges = [(a, b, c) for a, b, c in edges]
    forbidden = [tuple(pick()) for _ in range(25)] + [(nodes[101], nodes[120]), (nodes[0], nodes[130]), (nodes[5], nodes[5])]
    a = constrained_components(
        spark.createDataFrame([(n,) for n in nodes], f"node {kind}"), spark.createDataFrame(edges, f"a {kind}, b {kind}, confidence double"),
        spark.createDataFrame([*forbidden, (None, nodes[1]), (name(900), nodes[1])], f"a {kind}, b {kind}"),
    )
    assert sorted(map(tuple, a.collect())) == by_hand(nodes, edges, [f for f in forbidden if f[0] != f[1]])


def test_nothing_forbidden(spark):
    edges = spark.createDataFrame([("a", "b", 1.0)], "a string, b string, confidence double")
    none = spark.createDataFrame([], "a string, b string")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "node string")
    assert sorted(map(tuple, constrained_components(nodes, edges, none).collect())) == [("a", "a"), ("b", "a"), ("c", "c")]


RAW = (
    "source_system string, source_id string, email string, phone string, first_name string, last_name string, full_name string, "
    "address_line1 string, city string, state string, zip_code string, updated_at timestamp"
)


def test_a_third_record_does_not_join_a_rejected_pair(spark):
    person = lambda i, email, phone: ("crm", i, email, phone, "Ann", "Lee", None, None, None, None, None, None)
    raw = spark.createDataFrame(
        [person("1", "a@x.org", None), person("2", "a@x.org", "3125551234"), person("3", "b@x.org", "3125551234"), person("4", "c@x.org", None)], RAW
    )
    key = {r["source_id"]: r["record_key"] for r in I.unify(raw, probabilistic=False).records.collect()}
    overrides = spark.createDataFrame([(key["1"], key["3"], "unmatch"), (key["4"], key["3"], "match")], "key_a string, key_b string, action string")
    of = lambda u: {r["record_key"]: r["cluster"] for r in u.clusters.collect()}
    before, after = of(I.unify(raw, probabilistic=False)), of(I.unify(raw, probabilistic=False, overrides=overrides))
    assert before[key["1"]] == before[key["3"]] == before[key["2"]]
    # the mailbox (1.0) outweighs the phone (0.95), so the second record stays with the first
    assert after[key["1"]] == after[key["2"]] != after[key["3"]] == after[key["4"]]
