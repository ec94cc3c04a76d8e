"""Pairs of similar strings by Jaro-Winkler, found through an inverted index of the characters that they must share.

Jaro-Winkler of at least ``least`` implies a Jaro similarity J, and J implies m >= (3 J - 1) |a| |b| / (|a| + |b|) matched
characters. A string is the set of its characters with the rank of each occurrence, so two strings that match must share at
least m of these elements. With all elements in one order, the rarest first, the first |a| - m + s elements of one and the first
|b| - m + s of the other share at least s (prefix filter). Every choice of s elements from that prefix is a key, next to
both lengths; a pair meets under several keys and is kept under the one made of its first s shared elements, so nothing
is produced twice. Pairs with the same first character, which alone can profit from the prefix boost, have it in
their key; for all others J has to reach ``least`` itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from constituent360.functions.similarity import jaro_winkler_once
from constituent360.operators.tiles import tiled
from constituent360.session import cut_lineage

#: Elements of a key, for prefixes of up to so many elements beyond it: longer strings take fewer, so that choices stay few.
CHOSEN = ((8, 3), (20, 2))
EDGE = 1e-9


def least_jaro(least: float, same_start: bool) -> float:
    """The Jaro similarity that a Jaro-Winkler similarity of ``least`` implies; there is a boost above 0.7 only."""
    if least <= 0.7 or not same_start:
        return least
    return max(0.7, (least - 0.4) / 0.6)


def shared_elements(shorter: Column, longer: Column, jaro: float) -> Column:
    """The number of elements that strings of these lengths have to share."""
    m = F.ceil((3 * jaro - 1) * shorter * longer / (shorter + longer) - EDGE)
    return F.greatest(m, F.lit(1)).cast("int")


def _chosen(beyond: Column, shared: Column) -> Column:
    size = F.lit(1)
    for most, n in reversed(CHOSEN):
        size = F.when(beyond <= most, n).otherwise(size)
    return F.least(size, shared)


def _choices(items: Column, n: Column) -> Column:
    """All ordered choices of n (1 to 3) of the items, as arrays."""
    size = F.size(items)
    at = lambda i: F.get(items, i)
    one = F.transform(items, lambda x: F.array(x))
    two = F.flatten(F.transform(F.sequence(F.lit(0), size - 2), lambda i: F.transform(F.sequence(i + 1, size - 1), lambda j: F.array(at(i), at(j)))))
    three = F.flatten(F.flatten(F.transform(
        F.sequence(F.lit(0), size - 3),
        lambda i: F.transform(F.sequence(i + 1, size - 2), lambda j: F.transform(F.sequence(j + 1, size - 1), lambda k: F.array(at(i), at(j), at(k)))),
    )))
    return F.when(n == 3, three).when(n == 2, two).otherwise(one)


def with_elements(names: DataFrame, name: str) -> DataFrame:
    """name, start, length, elements: the characters with the rank of their occurrence, the rarest of all names first."""
    c = F.col(name)
    place = F.sequence(F.lit(1), F.char_length(c))
    element = lambda i: F.concat(
        c.substr(i, F.lit(1)),
        F.size(F.filter(F.sequence(F.lit(1), i), lambda j: c.substr(j, F.lit(1)) == c.substr(i, F.lit(1)))).cast("string"),
    )
    each = names.where(F.char_length(c) > 0).select(name, F.explode(F.transform(place, element)).alias("element"))
    counts = each.groupBy("element").agg(F.count(F.lit(1)).alias("n"))
    rare_first = F.array_sort(F.collect_list(F.struct("n", "element")))  # as long as the name
    out = each.join(counts, "element").groupBy(name).agg(rare_first["element"].alias("elements"))
    return out.select(name, c.substr(1, 1).alias("start"), F.size("elements").alias("length"), "elements")


def _keyed(strings: DataFrame, shorter: bool, longest: int, least: float, same_start: bool) -> DataFrame:
    """A row per key of every string in its role as the shorter or the longer one of a pair."""
    jaro = least_jaro(least, same_start)
    # m <= the shorter length bounds the longer one
    reach = 3 * jaro - 2
    own = F.col("length")
    if shorter:
        end = F.least(F.floor(own / reach + EDGE).cast("int"), F.lit(longest)) if reach > 0 else F.lit(longest)
        rows = strings.withColumn("_other", F.explode(F.sequence(own, F.greatest(own, end))))
        low, high = own, F.col("_other")
    else:
        start = F.greatest(F.ceil(own * reach - EDGE).cast("int"), F.lit(1)) if reach > 0 else F.lit(1)
        rows = strings.withColumn("_other", F.explode(F.sequence(F.least(start, own), own)))
        low, high = F.col("_other"), own
    rows = rows.withColumn("_m", shared_elements(low, high, jaro)).where(F.col("_m") <= low)
    rows = rows.withColumn("_s", _chosen(high - F.col("_m"), F.col("_m")))
    rows = rows.withColumn("_prefix", F.slice("elements", 1, own - F.col("_m") + F.col("_s")))
    key = F.explode(_choices(F.col("_prefix"), F.col("_s")))
    return rows.select("name", "start", low.alias("_low"), high.alias("_high"), "_prefix", "_s", key.alias("_key"))


def similar_pairs(names: DataFrame, name: str, least: float, tile_rows: int) -> DataFrame:
    """(a, b, similarity): pairs of different strings of the column with a Jaro-Winkler similarity of at least ``least`` > 0,
    a < b, each once. Null and empty strings are similar to nothing."""
    if least <= 0:
        raise ValueError("an index needs a similarity above zero")
    strings = cut_lineage(with_elements(names.select(name).distinct(), name).withColumnRenamed(name, "name"))
    longest = strings.agg(F.max("length")).first()[0] or 0
    found = []
    for same_start in (True, False):
        on = ["_low", "_high", "_key", *(["start"] if same_start else [])]
        sides = [_keyed(strings, shorter, longest, least, same_start) for shorter in (True, False)]
        a, b = tiled(*sides, on, ["name"], ["name"], tile_rows)
        a, b = a.alias("a"), b.alias("b")
        same = reduce(lambda x, y: x & y, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in [*on, "_ta", "_tb"]])
        once = (F.col("a._low") < F.col("a._high")) | (F.col("a.name") < F.col("b.name"))
        first = F.slice(F.array_intersect("a._prefix", "b._prefix"), F.lit(1), F.col("a._s")) == F.col("a._key")
        apart = F.lit(True) if same_start else F.col("a.start") != F.col("b.start")
        pairs = a.join(b, same & once & apart & first)
        found.append(pairs.select(F.least("a.name", "b.name").alias("a"), F.greatest("a.name", "b.name").alias("b")))
    met = found[0].unionByName(found[1]).where(F.col("a") != F.col("b"))
    return met.withColumn("similarity", jaro_winkler_once(F.col("a"), F.col("b"))).where(F.col("similarity") >= least - EDGE)
