"""The index of shared characters against a comparison of all pairs."""

import itertools
import random

import pandas as pd
import pytest

from constituent360.functions.similarity import jaro_winkler_batch
from constituent360.operators.similar import similar_pairs


def some_names(n, seed=1):
    r = random.Random(seed)
    syllables = [c + v for c in "bcdfghjklmnprstvwz" for v in "aeiou"]
    out = {"".join(r.choice(syllables) for _ in range(r.randint(1, 4))) + r.choice(["", "n", "son", "er"]) for _ in range(n)}
    for x in list(out)[: n // 3]:  # near copies: a letter changed, left out, doubled or swapped
        i = r.randrange(len(x))
        out |= {x[:i] + r.choice("aeinrst") + x[i + 1 :], x[:i] + x[i + 1 :], x[:i] + x[i] + x[i:], x[:i] + x[i : i + 2][::-1] + x[i + 2 :]}
    return sorted(out | {"a", "b", "ab", "ba", "aaaa", "aaaab", "é", "éa", "日本", "日本語", "😀a", "x" * 40, "x" * 39 + "y", "abcdefghijklmnopqrstuvwxyz", "zyxwvutsrqponmlkjihgfedcba"} - {""})


@pytest.fixture(scope="module")
def compared():
    pairs = list(itertools.combinations(some_names(250), 2))
    left, right = (pd.Series(list(x), dtype=object) for x in zip(*pairs))
    return dict(zip(pairs, jaro_winkler_batch(left, right)))


@pytest.mark.parametrize("least, tile_rows", [(0.2, 10_000), (0.7, 10_000), (0.762, 40), (0.9, 10_000)])
def test_every_similar_pair_once(spark, compared, least, tile_rows):
    names = sorted({x for p in compared for x in p})
    table = spark.createDataFrame([(n,) for n in names] * 2 + [(None,), ("",)], "name string")
    found = sorted((r["a"], r["b"]) for r in similar_pairs(table, "name", least, tile_rows).collect())
    assert found == sorted(p for p, s in compared.items() if s >= least - 1e-9)


def test_no_names(spark):
    assert similar_pairs(spark.createDataFrame([], "name string"), "name", 0.8, 100).isEmpty()
    with pytest.raises(ValueError):
        similar_pairs(spark.createDataFrame([], "name string"), "name", 0.0, 100)
