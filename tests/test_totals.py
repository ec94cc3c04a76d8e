import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from constituent360.operators import totals


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value."""
    rng = random.Random(1)
    values = [5.0 if rng.random() < 0.34 else round(rng.random() * 100, 2) for _ in range(3000)]
    pdf = pd.DataFrame({"v": values, "g": [rng.choice("aaab") for _ in values]})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("ranges", [1, 7, 60])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(skewed, ranges, descending):
    pdf, df = skewed
    counted = totals.collapse(df, "v", ["g"], n=F.count("*"))
    got = totals.running_totals(counted, "v", ["n"], ["g"], descending, ranges).toPandas()
    want = pdf.groupby(["g", "v"]).size().reset_index(name="n").sort_values("v", ascending=not descending)
    want["cum_n"] = want.groupby("g").n.cumsum()
    merged = got.merge(want, on=["g", "v"])
    assert len(got) == len(want) == len(merged)
    assert (merged.cum_n_x == merged.cum_n_y).all()


@pytest.mark.parametrize("ranges", [1, 7, 60])
def test_quantiles(skewed, ranges):
    pdf, df = skewed
    probabilities = [0.0, 0.25, 0.333, 0.5, 0.9, 1.0]
    got = totals.quantiles(df, "v", probabilities, ["g"], ranges).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        assert np.allclose(got.loc[g].to_numpy(), part.v.quantile(probabilities).to_numpy())


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert totals.quantiles(empty, "v", [0.5]).first()["q0"] is None


ODD = [None, float("nan"), float("inf"), -1.0, 0.0, 2.5, 2.5, 7.0]


@pytest.fixture(scope="module")
def odd(spark):
    """Null groups and values, NaN and infinity, in any combination."""
    rows = [(g, v, i) for g in ("a", None, "b") for i, v in enumerate(ODD * (40 if g is None else 3))]
    return rows, spark.createDataFrame(rows, "g string, v double, i int")


def rank_of(v, descending):
    """Nulls first going up and last going down; NaN above all numbers."""
    at = -1 if v is None else 1 if v != v else 0
    number = v if at == 0 else 0.0
    return (-at, -number) if descending else (at, number)


def plain(v):
    return "nan" if v is not None and v != v else v


@pytest.mark.parametrize("ranges", [1, 3, 40])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_keep_nulls_and_nan(odd, ranges, descending):
    rows, df = odd
    got = totals.running_totals(totals.collapse(df, "v", ["g"], n=F.count("*")), "v", ["n"], ["g"], descending, ranges).collect()
    want = set()
    for g in ("a", None, "b"):
        own = [v for h, v, _ in rows if h == g]
        for v in {plain(x): x for x in own}.values():
            want.add((g, plain(v), sum(rank_of(x, descending) <= rank_of(v, descending) for x in own)))
    assert {(r["g"], plain(r["v"]), r["cum_n"]) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_running_totals_over_dates_and_strings(spark, ranges):
    days = [(f"2001-01-{i % 28 + 1:02d}", f"x{i % 28:02d}") for i in range(100)]
    df = spark.createDataFrame(days, "d string, s string").withColumn("d", F.to_date("d"))
    for column in ("d", "s"):
        got = totals.running_totals(totals.collapse(df, column, n=F.count("*")), column, ["n"], ranges=ranges).orderBy(column).collect()
        assert [r["cum_n"] for r in got] == list(np.cumsum([r["n"] for r in got])) and got[-1]["cum_n"] == 100


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_quantiles_of_null_groups(odd, ranges):
    rows, df = odd
    got = {r["g"]: plain(r["q0"]) for r in totals.quantiles(df, "v", [0.5], ["g"], ranges).collect()}
    for g in ("a", None, "b"):
        own = sorted((v for h, v, _ in rows if h == g and v is not None), key=lambda v: rank_of(v, False))
        at = 0.5 * (len(own) - 1)
        assert got[g] == pytest.approx((own[int(np.floor(at))] + own[int(np.ceil(at))]) / 2)


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_previous_values_of_a_hot_key(spark, ranges):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.5 else rng.choice([None, *(f"k{i}" for i in range(9))]), i, rng.choice([None, rng.random()])) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    got = {(r["k"], r["t"]): (r["one"], r["two"], r["three"]) for r in totals.previous_values(df, ["k"], "t", "v", ["one", "two", "three"], ranges).collect()}
    assert len(got) == 2000
    seen = {}
    for k, t, v in rows:
        before = seen.setdefault(k, [])
        assert got[k, t] == tuple([*before[::-1], None, None, None][:3])
        before.append(v)


def test_previous_values_of_null_order(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", 1, 2.0), (None, 1, 3.0), (None, 2, None)], "k string, t int, v double")
    got = {(r["k"], r["t"]): r["previous"] for r in totals.previous_values(df, ["k"], "t", "v").collect()}
    assert got == {("a", None): None, ("a", 1): 1.0, (None, 1): None, (None, 2): 3.0}


def test_number_rows(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).orderBy("x")
    got = totals.number_rows(df).toPandas()
    assert (got.position == got.x + 1).all() and len(got) == 5000
