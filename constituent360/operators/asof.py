"""Point-in-time joins: the version of a history that was in force at each row's own moment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from constituent360.operators.totals import _joined, in_ranges


def last_box(df: DataFrame, keys: Sequence[str], order: Column, box: str, name: str, ranges: int | None = None) -> DataFrame:
    """Add ``name``, the last ``box`` that is not null up to and including the row, per key. A key with very many rows spans
    several ranges, and each range hands its last box on."""
    ranged = in_ranges(df, keys, order, ranges)
    within = [*keys, "_range"]
    inside = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    tails = ranged.groupBy(*within).agg(F.max_by(box, F.when(F.col(box).isNotNull(), order)).alias("_tail"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(*within, F.last("_tail", ignorenulls=True).over(earlier).alias("_carried"))
    found = ranged.withColumn("_last", F.last(box, ignorenulls=True).over(inside))
    return _joined(found, carried, within).withColumn(name, F.coalesce("_last", "_carried")).drop("_range", "_last", "_carried")


def as_of_join(
    facts: DataFrame, history: DataFrame, keys: Sequence[str], when: str, since: str, until: str | None = None,
    name: str = "version", ranges: int | None = None,
) -> DataFrame:
    """Every fact with ``name``, a struct of the history's columns other than the keys: the version of its key with the latest
    ``since`` that is not after ``when``, or null where there is none or it is over (``until`` <= ``when``; a null ``until`` never is).

    Different moments of a key are looked up once. Moments and versions are put in one order, dealt into sorted ranges that
    split a hot key, and the last version is carried along and across ranges; the facts themselves meet the answers in one
    equi-join. No pair of a fact with a version that is not its own is formed.

    A fact with a null key or moment keeps its row and finds nothing; a version with a null key or start is in force
    never. Of versions that start together the greatest one (as a struct) counts, so columns must be orderable. ``facts``
    may repeat rows and have any further columns, except one called ``name``. Without keys, all facts read one history.
    """
    keys = list(keys)
    if name in facts.columns:
        raise ValueError(f"the facts already have a column {name}")
    moments = facts.select(*keys, F.col(when).alias("_at")).na.drop().distinct()
    values = [c for c in history.columns if c not in keys]
    versions = (
        history.select(*keys, F.col(since).alias("_at"), F.struct(*values).alias("_box")).na.drop(subset=[*keys, "_at"])
        .groupBy(*keys, "_at").agg(F.max("_box").alias("_box"))
    )
    both = versions.withColumn("_asks", F.lit(False)).unionByName(
        moments.withColumn("_asks", F.lit(True)), allowMissingColumns=True
    )
    found = last_box(both, keys, F.struct("_at", "_asks"), "_box", "_found", ranges).where("_asks")
    if until is not None:
        end = F.col(f"_found.{until}")
        found = found.withColumn("_found", F.when(end.isNull() | (F.col("_at") < end), F.col("_found")))
    found = found.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_at", F.col("_found").alias(name))
    same = reduce(lambda a, b: a & b, [facts[k] == found[f"_key{i}"] for i, k in enumerate(keys)], facts[when] == found["_at"])
    return facts.join(found, same, "left").select(*[facts[c] for c in facts.columns], name)
