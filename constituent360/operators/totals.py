"""Running totals, ranks, exact quantiles and earlier values over data of any size.

A window without a partition, or one partitioned by a hot key, sorts everything in a single task. Here rows are dealt out
in sorted ranges (of group and value, so that a large group or a single hot value spans as many ranges as it needs) and
written; each range is worked on by itself, and one row per group and range carries the rest across. There is one path
for every size. Nulls sort first going up and last going down, NaN is the largest number, and null groups and keys are
groups and keys like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from constituent360.session import cut_lineage


def _joined(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``left`` with the other columns of ``right``, which has one row per value of ``columns``."""
    names = {c: f"_right_{c}" for c in columns}
    right = right.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[n]) for c, n in names.items()])
    return left.join(right, same, "left").drop(*names.values())


def in_ranges(df: DataFrame, group: Sequence[str], order: Column, ranges: int | None = None) -> DataFrame:
    """The rows with ``_range``, a number that grows with (group, order); written, since a second run might cut elsewhere."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *[F.col(g) for g in group], order).withColumn("_range", F.spark_partition_id()))


def collapse(df: DataFrame, value: str, group: Sequence[str] = (), **sums) -> DataFrame:
    """One row per (group, value) with the given sums, written once: the steps below read it several times
    and must not rescan the source each time."""
    return cut_lineage(df.groupBy(*group, value).agg(*[expr.alias(name) for name, expr in sums.items()]))


def running_totals(
    collapsed: DataFrame, value: str, sums: Sequence[str], group: Sequence[str] = (), descending: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``cum_<name>`` for each summed column: the total up to and including the row's value."""
    order = F.col(value).desc() if descending else F.col(value).asc()
    ranged = in_ranges(collapsed, group, order, ranges)
    keys = [*group, "_range"]
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*keys).agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
        .select(*keys, *[F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0)).alias(f"_before_{s}") for s in sums])
    )
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    totals = ranged.select("*", *[F.sum(s).over(inside).alias(f"_in_{s}") for s in sums])
    return _joined(totals, offsets, keys).select(
        *collapsed.columns, *[(F.col(f"_in_{s}") + F.col(f"_before_{s}")).alias(f"cum_{s}") for s in sums]
    )


def quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], group: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation: columns q0, q1, ... per group, missing values left out."""
    counted = collapse(df.where(F.col(value).isNotNull()), value, group, n=F.count("*"))
    return quantiles_of(counted, value, probabilities, group, ranges)


def quantiles_of(
    counted: DataFrame, value: str, probabilities: Sequence[float], group: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Quantiles from one row per (group, value) with its count ``n``."""
    ranked = running_totals(counted, value, ["n"], group, ranges=ranges)
    sizes = counted.groupBy(*group).agg(F.sum("n").alias("_size"))
    if group:
        sized = _joined(ranked, sizes, list(group))
    else:
        first = sizes.first()
        sized = ranked.withColumn("_size", F.lit(first["_size"] if first else None).cast("bigint"))

    aggregates = []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("_size") - 1)
        v = F.col(value).cast("double")
        aggregates += [
            F.min(F.when(F.col("cum_n") > F.floor(position), v)).alias(f"_lo{i}"),
            F.min(F.when(F.col("cum_n") > F.ceil(position), v)).alias(f"_hi{i}"),
            F.max(position - F.floor(position)).alias(f"_part{i}"),
        ]
    found = sized.groupBy(*group).agg(*aggregates)
    # where both neighbours are the same there is nothing to interpolate (their difference is no number if they are infinite)
    between = lambda i: (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")
    return found.select(
        *group,
        *[
            F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}")).otherwise(F.col(f"_lo{i}") + between(i)).alias(f"q{i}")
            for i in range(len(probabilities))
        ],
    )


def previous_values(
    df: DataFrame, keys: Sequence[str], order: str, value: str, names: Sequence[str] = ("previous",), ranges: int | None = None
) -> DataFrame:
    """The values of the rows before, per key, in the order of ``order`` (a null first): the last one under the first name, the
    one before it under the second, and so on. A key with very many rows spans several ranges; each range hands
    its last values on."""
    k = len(names)
    ranged = in_ranges(df, keys, F.col(order).asc(), ranges)
    within = [*keys, "_range"]
    inside = Window.partitionBy(*within).orderBy(order)
    boxed = F.struct(F.col(value).alias("v"))  # a box tells a null value from no row
    placed = ranged.withColumns({f"_lag{i}": F.lag(boxed, i + 1).over(inside) for i in range(k)})
    placed = placed.withColumn("_nth", F.row_number().over(inside))
    from_end = Window.partitionBy(*within).orderBy(F.col(order).desc(), F.col("_nth").desc())
    tail = (
        placed.select(*within, order, "_nth", boxed.alias("_box")).withColumn("_back", F.row_number().over(from_end))
        .where(F.col("_back") <= k)
        .groupBy(*within).agg(F.array_sort(F.collect_list(F.struct("_back", "_box"))).alias("_tail"))
    )
    earlier = Window.partitionBy(*keys).orderBy(F.col("_range").desc()).rowsBetween(1, k)
    carried = tail.select(*within, F.flatten(F.collect_list("_tail").over(earlier)).alias("_carried"))
    both = _joined(placed, carried, within)
    # the first rows of a range look into what was handed on
    found = {
        name: F.coalesce(F.col(f"_lag{i}"), F.get("_carried", F.lit(i + 1) - F.col("_nth"))["_box"])["v"] for i, name in enumerate(names)
    }
    return both.withColumns(found).drop("_range", "_nth", "_carried", *[f"_lag{i}" for i in range(k)])


def number_rows(ordered: DataFrame, name: str = "position") -> DataFrame:
    """Consecutive row numbers, from 1, in the order of a sorted DataFrame. The sorted rows are written
    first, so that partition sizes and numbers come from the same partitions."""
    placed = cut_lineage(ordered.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    # one row per partition
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        placed.join(starts, "_part")
        .withColumn(name, F.col("_row") - F.col("_first") + F.col("_before") + 1)
        .drop("_part", "_row", "_first", "_before")
    )
