"""Isotonic calibration of any number of scores: the non-decreasing function of the score with the least squared error."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from constituent360.operators.asof import as_of_join
from constituent360.operators.totals import number_rows, previous_values
from constituent360.session import cut_lineage

_BLOCK = "lo double, hi double, total double, n long"


def _pooled(group: pd.DataFrame) -> pd.DataFrame:
    """The blocks of one range after pooling neighbours that are out of order; columns lo, hi, total, n."""
    kept: list[list] = []
    for lo, hi, total, n in group.sort_values("lo")[["lo", "hi", "total", "n"]].itertuples(index=False):
        block = [lo, hi, total, n]
        # compared without a division, so that counts are compared exactly
        while kept and kept[-1][2] * block[3] >= block[2] * kept[-1][3]:
            before = kept.pop()
            block = [before[0], block[1], before[2] + block[2], before[3] + block[3]]
        kept.append(block)
    return pd.DataFrame(kept, columns=["lo", "hi", "total", "n"])


def _out_of_order(blocks: DataFrame) -> bool:
    """Whether the last block of some range lies above the first of the next; one row per range is compared."""
    mean = F.col("total") / F.col("n")
    ends = blocks.groupBy("_range").agg(F.min_by(mean, "lo").alias("first"), F.max_by(mean, "lo").alias("last"))
    before = F.lag("last").over(Window.partitionBy(F.lit(1)).orderBy("_range"))
    return not ends.select((before > F.col("first")).alias("wrong")).where("wrong").isEmpty()


def isotonic_blocks(scored: DataFrame, score: str, label: str, size: int = 50_000) -> DataFrame:
    """(lo, hi, value, n, next_lo, next_value): the blocks of the fit in rising order, with the block that follows.

    One row per score goes in; ranges of ``size`` neighbouring blocks are pooled, each in its own task. Ranges whose ends are
    out of order are cut anew, every other time half a range further on, so that an old cut lies inside a new range; pooling in any
    order ends at the same fit. Rounds follow how far a single block reaches, counted in ranges. Rows without a score
    or label, and scores that are no number, are left out; no rows give no blocks.
    """
    x, y = F.col(score).cast("double"), F.col(label).cast("double")
    points = scored.select(x.alias("lo"), y.alias("_y")).where("lo IS NOT NULL AND NOT isnan(lo) AND _y IS NOT NULL")
    blocks = points.groupBy("lo").agg(F.sum("_y").alias("total"), F.count("*").alias("n")).withColumn("hi", F.col("lo"))
    turn, again = 0, True
    while again:
        placed = number_rows(blocks.orderBy("lo"))
        step = F.floor((F.col("position") + (size // 2 if turn % 2 else 0)) / size)
        pool = lambda key, group: _pooled(group).assign(_range=key[0])
        blocks = cut_lineage(placed.withColumn("_range", step).groupBy("_range").applyInPandas(pool, f"{_BLOCK}, _range long"))
        turn, again = turn + 1, _out_of_order(blocks)
    # blocks of one value that ranges left apart stay apart: the function is the same
    valued = blocks.select("lo", "hi", (F.col("total") / F.col("n")).alias("value"), "n", (-F.col("lo")).alias("_back"))
    following = previous_values(valued.withColumn("_next", F.struct("lo", "value")), [], "_back", "_next", ["_after"])
    return cut_lineage(following.select("lo", "hi", "value", "n", F.col("_after.lo").alias("next_lo"), F.col("_after.value").alias("next_value")))


def calibrated(blocks: DataFrame, rows: DataFrame, score: str, name: str = "calibrated") -> DataFrame:
    """The rows with the value of the block that holds the score; between two blocks the value is interpolated, and outside
    of all it is that of the nearest. A missing score, or one that is no number, has none."""
    first = blocks.agg(F.min("lo").alias("lo"), F.min_by("value", "lo").alias("value")).where("lo IS NOT NULL")
    # what lies below the first block takes its value
    below = first.select(
        F.lit(float("-inf")).alias("lo"), "lo", "value", F.lit(None).cast("double").alias("next_lo"), F.lit(None).cast("double").alias("next_value")
    ).toDF("lo", "hi", "value", "next_lo", "next_value").where("lo < hi")
    known = blocks.select("lo", "hi", "value", "next_lo", "next_value").unionByName(below)
    x = F.col(score).cast("double")
    asked = rows.withColumn("_x", F.when(~F.isnan(x), x))
    found = as_of_join(asked, known, [], "_x", "lo", name="_block")
    b, at = F.col("_block"), F.col("_x")
    share = (at - b["hi"]) / (b["next_lo"] - b["hi"])
    between = b["value"] + share * (b["next_value"] - b["value"])
    value = F.when((at <= b["hi"]) | b["next_lo"].isNull(), b["value"]).otherwise(between)
    return found.withColumn(name, value).drop("_x", "_block")
