"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size in words. A level is raised until the shares ``weight * level`` use up
the wanted total; a source stops at ``most`` times its own size, and what it leaves over raises the others'
level. A source's target is met by whole repetitions of all its documents and one more repetition of
the documents that come first in a seeded order, up to the document at whose middle the target is passed. The order goes by a hash
of the id, then by a hash of the text; of rows that are equal in both, as many as needed are taken.

Defined cases: a null source is a source of its own; a null or empty text has size 0 and takes 0 words; without
any word all targets are 0; repeated rows, ids and null ids are documents of their own; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from constituent360.llm.common import WORD, stored, tasks

#: Rows of a source that are aimed at for one slice of its seeded order.
SLICE_ROWS = 8192


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """source, source_size, docs, place (from 0, by code point, null last): ranks within sorted ranges plus
    the counts of the ranges before, so that no task sees all sources."""
    spark = sizes.sparkSession
    order = [F.col("source").isNull(), F.col("source")]
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ranges = stored(
        totals.repartitionByRange(tasks(spark), *order).withColumn("range", F.spark_partition_id()), "sources"
    )
    before = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = before.select(
        "range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before")
    )  # one row per range
    inside = ranges.withColumn("inside", F.row_number().over(Window.partitionBy("range").orderBy(*order)))
    return inside.join(before, "range").select(
        "source", "source_size", "docs", (F.col("before") + F.col("inside") - 1).alias("place")
    )


def water_level(sources: DataFrame, total: float, most: float) -> float:
    """The level at which the shares min(weight * level, most * source_size) add up to ``total``.

    Each round clamps the sources above their limit and solves for the rest; a round only adds clamped
    sources, and one row per round comes to the driver.
    """
    level, clamped = 0.0, -1
    cap = F.col("source_size") * F.lit(most)
    while True:
        over = F.col("weight") * F.lit(level) >= cap
        row = sources.agg(
            F.sum(F.when(over, cap).otherwise(0.0)).alias("full"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weights"),
            F.sum(over.cast("long")).alias("n"),
        ).first()
        if not row["weights"] or row["n"] == clamped:
            return level
        clamped = row["n"]
        level = (total - row["full"]) / row["weights"]


def _ticket(seed: str) -> Column:
    """32 digits that the id gives and 16 that the text gives."""
    by_id = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return F.concat(by_id, F.lpad(F.hex(F.xxhash64(F.coalesce("text", F.lit("")))), 16, "0"))


def _cuts(sizes: DataFrame, plan: DataFrame, digits: int) -> DataFrame:
    """_cut_of, cut, part, tied: the last ticket of every source that gets the partial repetition, how many of its rows do, and
    of how many.

    Tickets fall into slices by their first digits, and a slice into smaller ones by the first digits that the text
    gives (one id may stand in very many rows). Sums of slices find the one in which the owed words end, and only its
    tickets are put in order.
    """
    rows = sizes.select("source", "ticket", "size")
    at = plan.select(F.col("source").alias("_of"), "owed", F.lit(0).cast("long").alias("before"))
    same = F.col("source").eqNullSafe(F.col("_of"))
    for length in (digits, 32 + digits):
        sliced = rows.withColumn("slice", F.substring("ticket", 1, length))
        in_order = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
        found = (
            sliced.groupBy("source", "slice").agg(F.sum("size").alias("words"))
            .withColumn("passed", F.coalesce(F.sum("words").over(in_order), F.lit(0)))
            .join(at, same).withColumn("before", F.col("before") + F.col("passed"))
            .where(F.col("before") <= F.col("owed"))
            .groupBy("_of", "owed").agg(F.max(F.struct("slice", "before")).alias("at"))
        )
        at = stored(found.select("_of", "owed", F.col("at.slice").alias("_slice"), F.col("at.before").alias("before")), "cut-slices")
        rows = sliced.join(at.select("_of", "_slice"), same & (F.col("slice") == F.col("_slice"))).select("source", "ticket", "size")
    cut = rows.groupBy("source", "ticket").agg(F.sum("size").alias("words"), F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy("source").orderBy("ticket").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("passed", F.coalesce(F.sum("words").over(inside), F.lit(0))).join(at.drop("_slice"), same)
    start = F.col("before") + F.col("passed")
    # rows of a ticket have one size: the i-th is taken if its middle, start + (i - 1/2) * size, is not beyond what is owed
    fitting = F.floor((F.col("owed") - start) / F.col("size") + 0.5).cast("long")
    taken = F.when(F.col("size") > 0, F.least("n", fitting)).when(start <= F.col("owed"), F.col("n")).otherwise(0)
    last = F.max(F.when(taken > 0, F.struct("ticket", taken.alias("part"), "n")))
    ends = cut.groupBy(F.col("source").alias("_cut_of")).agg(last.alias("last"), F.min("ticket").alias("least"))
    nothing = F.lit(0).cast("long")
    return ends.select(
        "_cut_of", F.coalesce("last.ticket", "least").alias("cut"), F.coalesce("last.part", nothing).alias("part"),
        F.coalesce("last.n", nothing).alias("tied"),
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with ``nth``, from 1 within their source: numbers within partitions, and the counts of those before."""
    source = F.col("_planned")
    placed = stored(rows.withColumns({"_at": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "tied-rows")
    before = Window.partitionBy("_from").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(source.alias("_from"), F.col("_at").alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("_from", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_planned", "_at").orderBy("_row"))
    both = placed.withColumn("_inside", inside).join(sizes, source.eqNullSafe(F.col("_from")) & (F.col("_at") == F.col("_part")))
    return both.withColumn("nth", F.col("_inside") + F.col("_before")).drop("_at", "_row", "_from", "_part", "_before", "_inside")


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0, seed: str = "mix"
) -> DataFrame:
    """row (all columns of ``docs``), size, source_size, target, copies and taken.

    ``weights`` repeat over the sources in code point order, ``share`` is the wanted total as a part of all
    words and ``most`` the number of times that a source may be repeated.
    """
    sizes = stored(
        docs.select("source", n_words(F.col("text")).alias("size"), _ticket(seed).alias("ticket")), "sizes"
    )
    place = (F.col("place") % len(weights)).cast("int")
    sources = ranked_sources(sizes).withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), place))
    sources = stored(sources, "source-weights")
    row = sources.agg(F.sum("source_size").alias("words"), F.max("docs").alias("docs")).first()
    level = water_level(sources, share * (row["words"] or 0), most)
    # copies that every document of a source gets, and the words that one more, partial repetition owes
    plan = sources.select(
        "source", "source_size",
        F.least(F.col("source_size") * F.lit(float(most)), F.col("weight") * F.lit(level)).alias("target"),
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("whole", whole).withColumn("owed", F.col("target") - whole * F.col("source_size"))
    digits = max(0, math.ceil(math.log(max(1, (row["docs"] or 0) / SLICE_ROWS), 16)))
    cuts = _cuts(sizes, plan, digits)
    plan = stored(
        plan.join(cuts, F.col("source").eqNullSafe(F.col("_cut_of"))).select(
            F.col("source").alias("_planned"), "source_size", "target", "whole", "cut", "part", "tied"
        ),
        "source-plan",
    )
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col("source").alias("_source"), n_words(F.col("text")).alias("size"), _ticket(seed).alias("_ticket"))
    own = own.join(plan, F.col("_source").eqNullSafe(F.col("_planned")))
    # of equal rows that share the last ticket, some may be taken and some not; a single one is taken or not
    parted = (F.col("_ticket") == F.col("cut")) & (F.col("part") > 0) & (F.col("part") < F.col("tied"))
    once = (F.col("_ticket") < F.col("cut")) | ((F.col("_ticket") == F.col("cut")) & (F.col("part") > 0))
    out = own.withColumn("copies", F.col("whole") + once.cast("long"))
    if not plan.where((F.col("part") > 0) & (F.col("part") < F.col("tied"))).isEmpty():
        some = _numbered(own.where(parted)).withColumn("copies", F.col("whole") + (F.col("nth") <= F.col("part")).cast("long"))
        out = out.where(~parted).unionByName(some.drop("nth"))
    out = out.withColumn("taken", F.col("size") * F.col("copies"))
    return out.select("row", "size", "source_size", "target", "copies", "taken")


def repeated(docs: DataFrame, **settings) -> DataFrame:
    """The rows of the mix itself: every document as often as it was taken."""
    nth = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mix(docs, **settings).select("row", nth).select("row.*")
