import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from constituent360.functions import dates, numbers, similarity, text


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(expr(F.col("c"))).collect()]


def test_email(spark):
    assert column(spark, [" A@B.Com\t", "", "   ", None], text.norm_email) == ["a@b.com", None, None, None]


def test_phone(spark):
    given = ["1-312-555-1234", "(312) 555-1234", "555-1234", "23125551234", "", None]
    assert column(spark, given, text.norm_phone) == ["3125551234", "3125551234", "555-1234", "23125551234", None, None]


def test_zip(spark):
    assert column(spark, ["60601-1234", "606", "", None], text.norm_zip) == ["60601", "606", None, None]


def test_generic_email(spark):
    given = ["info@x.org", "INFO@x.org", "no-reply@x.org", "infos@x.org", "", None]
    assert column(spark, given, text.is_generic_email) == [True, True, True, False, True, True]


def test_address(spark):
    given = ["123 North Main Street, Unit 4", "5 Av. of the East", "  9   Oak Boulevard ", None, "Strand 1"]
    want = ["123 n main st apt 4", "5 ave of the e", "9 oak blvd", "", "strand 1"]
    assert column(spark, given, text.norm_address) == want


def test_address_words_are_replaced_in_one_pass(spark):
    """The same as one replacement after the other, at the cost of a few patterns a row."""
    rng = random.Random(3)
    parts = [w for pair in text.ADDRESS_WORDS for w in pair] + ["main", "streets", "12", "o'street", "av_", "caf\u00e9", "\u00e9av", "Stre\u0301et"]
    given = ["".join(rng.choice(parts) + rng.choice([" ", "  ", ".", ", ", "-", "_", "\t", ""]) for _ in range(5)) for _ in range(400)] + ["", " ", None]
    df = spark.createDataFrame([(v,) for v in given], "c string")
    step = text.strip(F.lower(F.coalesce("c", F.lit(""))))
    for word, short in text.ADDRESS_WORDS:
        step = F.regexp_replace(step, rf"\b{word}\b", short)
    step = text.strip(F.regexp_replace(F.regexp_replace(step, r"[,.]", ""), r"\s+", " "))
    rows = df.select("c", step.alias("a"), text.norm_address(F.col("c")).alias("b")).collect()
    assert [r for r in rows if r["a"] != r["b"]] == []
    assert str(text.norm_address(F.col("c"))).count("regexp_replace") <= 2


def test_domain(spark):
    assert column(spark, ["a@b.org", "a@b@c.org", "none"], text.email_domain) == ["b.org", "c.org", ""]


def test_name_parts(spark):
    rows = [("John", "Smith", None), (None, None, "John M Smith"), (None, None, "Cher"), ("John", None, " Ann  Lee "), (None, None, None), ("John", None, None)]
    df = spark.createDataFrame(rows, "f string, l string, n string")
    got = [tuple(r[0]) for r in df.select(text.name_parts(F.col("f"), F.col("l"), F.col("n"))).collect()]
    assert got == [("john", "smith"), ("john", "smith"), ("cher", ""), ("ann", "lee"), ("", ""), ("", "")]


def test_band_and_clip(spark):
    band = lambda c: numbers.band(c, (10, 25), ("low", "mid", "high"))
    assert column(spark, [9.9, 10.0, 25.0], band, "double") == ["low", "mid", "high"]
    assert column(spark, [-1.0, 5.0, 99.0, None], lambda c: numbers.clip(c, 0.0, 10.0), "double") == [0.0, 5.0, 10.0, None]


def test_month_boundaries(spark):
    got = column(spark, [dt.date(2024, 1, 31)], lambda c: dates.month_boundaries(c, dt.date(2024, 2, 1)), "date")
    assert got == [1]


def test_fiscal(spark):
    days = [dt.date(2024, 6, 30), dt.date(2024, 7, 1)]
    assert column(spark, days, dates.fiscal_year, "date") == [2024, 2025]
    assert column(spark, days, dates.fiscal_quarter, "date") == [4, 1]
    assert column(spark, days, dates.fiscal_month, "date") == [12, 1]
    assert dates.fiscal_year_start(dt.date(2024, 6, 30)) == dt.date(2023, 7, 1)


def test_tenure_mode():
    with pytest.raises(ValueError):
        dates.tenure_months(None, dt.date(2024, 1, 1), "weeks")


def random_pairs(n, alphabet="abcde 12", longest=20):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest)))
    left = [word() for _ in range(n)]
    right = [word() if rng.random() < 0.5 else "".join(rng.sample(x, len(x))) for x in left]
    return pd.DataFrame({"a": left, "b": right})


def test_jaro_winkler_equals_duckdb():
    df = random_pairs(20000)
    mine = similarity.jaro_winkler_batch(df.a, df.b)
    theirs = duckdb.sql("SELECT jaro_winkler_similarity(a, b) AS s FROM df").df().s
    assert (mine - theirs).abs().max() < 1e-12


def test_jaro_winkler_long_and_empty():
    a = pd.Series(["x" * 20000, "", "abc", None])
    b = pd.Series(["x" * 19999 + "y", "", "", "abc"])
    got = similarity.jaro_winkler_batch(a, b)
    assert got[0] > 0.99 and got[1] == 1.0 and got[2] == 0.0 and pd.isna(got[3])


def test_ceiling_is_an_upper_bound(spark):
    df = spark.createDataFrame(random_pairs(5000, "abcdefghijklmnopqrstuvwxyz0123456789 ", 15))
    part = lambda f: [f(F.col("a")), f(F.col("b"))]
    ceiling = similarity.score_ceiling(
        *part(F.length), *part(similarity.inverse_length), *part(similarity.char_mask)
    )
    row = df.select(
        F.max(similarity.jaro_winkler("a", "b") - ceiling).alias("worst"), F.avg(ceiling).alias("mean")
    ).first()
    assert row["worst"] <= 1e-9 and row["mean"] < 0.9
