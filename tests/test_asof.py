import random

import pytest
from pyspark.sql import functions as F

from constituent360.operators.asof import as_of_join
from constituent360.operators.calibration import calibrated, isotonic_blocks

FACTS, HISTORY = "k string, t int, f int", "k string, since int, until int, v string"


def brute(facts, history, ends):
    out = []
    for k, t, f in facts:
        fit = [h for h in history if k is not None and t is not None and h[0] == k and h[1] is not None and h[1] <= t]
        # of versions that start together the greatest counts; a null is the least
        best = max(fit, key=lambda h: (h[1], h[2] is not None, h[2] or 0, h[3]), default=None)
        if best and ends and best[2] is not None and best[2] <= t:
            best = None
        out.append((k, t, f, best and best[3]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 3, 9])
@pytest.mark.parametrize("ends", [False, True])
def test_as_of_join_against_brute_force(spark, ranges, ends):
    r = random.Random(ranges)
    key = lambda: r.choice(["hot", "hot", "a", "b", None])
    facts = [(key(), r.choice([None, r.randrange(40)]), r.randrange(3)) for _ in range(300)] + [("none", 5, 0), ("hot", 0, 1), ("hot", 0, 1)]
    history = [(key(), r.choice([None, r.randrange(40)]), r.choice([None, r.randrange(60)]), f"v{i:02}") for i in range(40)] + [("late", 99, None, "x")]
    got = as_of_join(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(history, HISTORY), ["k"], "t", "since", "until" if ends else None, ranges=ranges
    )
    assert sorted([tuple(x) for x in got.select("k", "t", "f", "version.v").collect()], key=repr) == brute(facts, history, ends)


def test_as_of_join_without_history_facts_or_keys(spark):
    facts = spark.createDataFrame([("a", 1, 2), (None, None, None)], FACTS)
    none = spark.createDataFrame([], HISTORY)
    assert [x["version"] for x in as_of_join(facts, none, ["k"], "t", "since").collect()] == [None, None]
    assert as_of_join(facts.limit(0), none, ["k"], "t", "since").count() == 0
    one = spark.createDataFrame([(0, "x"), (2, "y")], "since int, v string")
    assert [x["version"]["v"] for x in as_of_join(facts.where("t = 1"), one, [], "t", "since").collect()] == ["x"]
    with pytest.raises(ValueError):
        as_of_join(facts.withColumn("version", F.lit(1)), none, ["k"], "t", "since")


def least_squares(points):
    """max over starts of min over ends of the mean, per score."""
    xs = sorted({x for x, _ in points})
    total = [sum(y for x, y in points if x == v) for v in xs]
    n = [sum(1 for x, _ in points if x == v) for v in xs]
    mean = lambda a, b: sum(total[a : b + 1]) / sum(n[a : b + 1])
    return {v: max(min(mean(a, b) for b in range(i, len(xs))) for a in range(i + 1)) for i, v in enumerate(xs)}


@pytest.mark.parametrize("kind", ["noise", "rising", "falling", "late drop"])
def test_isotonic_fit_over_many_ranges(spark, kind):
    r = random.Random(3)
    points = {
        "noise": [(r.randrange(60) / 7, float(r.random() < 0.5)) for _ in range(150)],
        "rising": [(float(i), i / 40) for i in range(40)],
        "falling": [(float(i), -i / 40) for i in range(40)],
        "late drop": [(float(i), float(i)) for i in range(40)] + [(40.0, -3000.0)],
    }[kind]
    rows = spark.createDataFrame([*points, (None, 1.0), (float("nan"), 1.0), (1.0, None)], "x double, y double")
    blocks = isotonic_blocks(rows, "x", "y", size=8)
    got = {x["x"]: x["calibrated"] for x in calibrated(blocks, rows.where("x IS NOT NULL AND NOT isnan(x)"), "x").collect()}
    want = least_squares(points)
    assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-9 for v in want)


def test_calibrated_between_and_outside_blocks(spark):
    rows = spark.createDataFrame([(1.0, 0), (2.0, 1), (3.0, 0), (5.0, 1)], "x double, y int")
    blocks = isotonic_blocks(rows, "x", "y")
    asked = spark.createDataFrame([(-9.0,), (1.0,), (1.5,), (2.5,), (4.0,), (9.0,), (None,), (float("nan"),)], "x double")
    got = [x["calibrated"] for x in calibrated(blocks, asked, "x").orderBy("x").collect()]
    assert got == [None, 0.0, 0.0, 0.25, 0.5, 0.75, 1.0, None]
    nothing = isotonic_blocks(rows.limit(0), "x", "y")
    assert nothing.count() == 0 and {x["calibrated"] for x in calibrated(nothing, asked, "x").collect()} == {None}
