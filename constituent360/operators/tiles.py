"""Hot join keys dealt into tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constituent360.session import cut_lineage


def tiled(a: DataFrame, b: DataFrame, on: Sequence[str], key_a: Sequence[str], key_b: Sequence[str], tile_rows: int):
    """Both sides of a join on ``on`` with tile numbers _ta and _tb to join on as well: a hot key's rows are dealt into tiles on
    either side, and every pair of tiles is a key of its own. The sizes, a row per key, are merged and never sent to every task."""
    on = list(on)
    count = lambda df, name: df.groupBy(*on).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias(name))
    sizes = cut_lineage(count(a, "_na").join(count(b, "_nb"), on)).hint("merge")
    tile = lambda key, n: F.pmod(F.xxhash64(*key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = a.join(sizes, on).withColumn("_ta", tile(key_a, "_na")).withColumn("_tb", every("_nb")).drop("_na", "_nb")
    right = b.join(sizes, on).withColumn("_tb", tile(key_b, "_nb")).withColumn("_ta", every("_na")).drop("_na", "_nb")
    return left, right
