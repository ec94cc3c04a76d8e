"""Hard negatives by inner product, found in a sort-tile-recursive (STR) packed R-tree.

The vectors are rows of whole numbers. Spark's range partitioning by the coordinate with the widest spread cuts them into strips, the
first step of the packing; a task cuts its strip into slabs, every slab by the next coordinate into pages and every page by the one
after that into leaves. A box's lowest and highest value per coordinate give an interval for each product with a query's
coordinate; their sums bound the scores of all rows in it. A query walks a slab's tree best bound first and leaves out
a box whose interval misses all its score windows, or whose upper bound lies strictly below the k-th score found (an equal score with a
smaller id may still come in).

Groups of queries meet strips as keyed rows: a task holds one group, and the strips' pages stream past it, so its k-th scores
tighten on the way. Strips are searched in rounds, each of seven times the strips of all before, that start from the
scores known by then: what a round returns is bounded by the queries, not by queries times strips.

Defined cases: rows without id or label, with a null vector or a null or non-finite component take no part; rows that repeat an
id are one, the least; shorter vectors count as if filled up with zeros; ties go to the smaller id; scores beyond 64 bits are cut to
the range of a long, and where sums may be inexact (2**53 or more) no box is left out; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from constituent360.llm import topk
from constituent360.llm.common import stored, tasks

LEAF, SLAB_ROWS, STRIP_ROWS, LEAST_STRIP, GROUP = 64, 8192, 65536, 1024, 4096
#: Strips of a round, as a multiple of those before it.
GROWTH = 7
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1

_PAGES = "strip int, slab int, page int, ids binary, labels binary, rows binary, leaves binary, low binary, high binary"
_FOUND = "query_id long, w int, vec_id long, score long"


def labelled_vectors(table: DataFrame, label: Column, scale: int = 256, vector: str = "embedding") -> DataFrame:
    """vec_id, label, v (floor(scale * x) of every component, as doubles) of the rows that take part."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform(v, lambda x: topk._floor(x.cast("double") * scale))
    rows = table.select("vec_id", label.cast("long").alias("label"), v.alias(vector))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & sound)
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", scaled.alias("v"))).alias("r")).select("vec_id", "r.label", "r.v")


# ---- the tree


def _widest(vectors: DataFrame) -> list[int]:
    """The three coordinates with the widest spread."""
    spread = vectors.select(F.posexplode("v")).groupBy("pos").agg(F.var_pop("col").alias("spread"))
    first = [r["pos"] for r in spread.orderBy(F.col("spread").desc(), "pos").limit(3).collect()]
    return (first * 3)[:3] or [0, 0, 0]


def _tiles(values: np.ndarray, n: int) -> list[np.ndarray]:
    """The places of the values in order, in ``n`` equal runs."""
    return np.array_split(np.argsort(values, kind="stable"), n)


def packed(vectors: DataFrame, width: int, strips: int) -> DataFrame:
    """The tree's pages: a row per page with its rows and the boxes of its leaves."""
    a, b, c = _widest(vectors)
    lead = F.coalesce(F.get("v", F.lit(a)), F.lit(0.0))
    dealt = vectors.withColumn("lead", lead).repartitionByRange(strips, "lead", "vec_id")
    dealt = dealt.withColumn("strip", F.spark_partition_id()).sortWithinPartitions("lead", "vec_id")

    def pages(strip, slab, ids, labels, values):
        grid = np.zeros((len(ids), width))
        for i, v in enumerate(values):
            grid[i, : len(v)] = v
        ids, labels = np.array(ids, np.int64), np.array(labels, np.int64)
        tiles = math.ceil(math.sqrt(len(ids) / LEAF))
        out = []
        for number, tile in enumerate(_tiles(grid[:, b], tiles) if width else [np.arange(len(ids))]):
            leaves = _tiles(grid[tile, c], math.ceil(len(tile) / LEAF)) if width else [np.arange(len(tile))]
            order = tile[np.concatenate(leaves)]
            ends = np.cumsum([len(x) for x in leaves]).astype(np.int64)
            parts = np.split(grid[order], ends[:-1])
            low, high = np.array([p.min(axis=0) for p in parts]), np.array([p.max(axis=0) for p in parts])
            packed = [x.tobytes() for x in (ids[order], labels[order], grid[order], ends, low, high)]
            out.append((strip, slab, number, *packed))
        kinds = [pa.int32()] * 3 + [pa.binary()] * 6
        names = [f.split()[0] for f in _PAGES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)

    def run(batches):
        held, strip, slab = ([], [], []), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            strip = batch.column("strip")[0].as_py()
            for mine, name in zip(held, ("vec_id", "label", "v")):
                mine += batch.column(name).to_pylist()
            while len(held[0]) >= SLAB_ROWS:
                yield pages(strip, slab, *[x[:SLAB_ROWS] for x in held])
                held, slab = tuple(x[SLAB_ROWS:] for x in held), slab + 1
        if held[0]:
            yield pages(strip, slab, *held)

    return dealt.select("strip", "vec_id", "label", "v").mapInArrow(run, _PAGES)


class Tree:
    """One slab: a root over pages over leaves."""

    def __init__(self, pages: list[dict], width: int):
        grid = lambda data: np.frombuffer(data, np.float64).reshape(-1, width) if width else np.zeros((0, 0))
        self.pages = []
        for p in pages:
            ids = np.frombuffer(p["ids"], np.int64)
            rows = grid(p["rows"]) if width else np.zeros((len(ids), 0))
            ends = np.frombuffer(p["leaves"], np.int64).tolist()
            boxes = (grid(p["low"]), grid(p["high"])) if width else (np.zeros((len(ends), 0)),) * 2
            self.pages.append((ids, np.frombuffer(p["labels"], np.int64), rows, [0, *ends], *boxes))
        self.low = np.array([p[4].min(axis=0) for p in self.pages])
        self.high = np.array([p[5].max(axis=0) for p in self.pages])
        self.largest = max(np.abs(self.low).max(initial=0), np.abs(self.high).max(initial=0))


def interval(query: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of the query with any point of each box."""
    plus, minus = np.maximum(query, 0), np.minimum(query, 0)
    return low @ plus + high @ minus, high @ plus + low @ minus


class Search:
    """A query's windows [low, high] of scores, each with its best k so far."""

    def __init__(self, query_id, label, vector, lows, highs, same: bool, k: int):
        self.id, self.label, self.vector, self.same, self.k = query_id, label, vector, same, k
        self.lows, self.highs = np.array(lows, np.int64), np.array(highs, np.int64)
        self.best: list[list] = [[] for _ in lows]

    def wanted(self, least, most):
        """Whether scores in [least, most] (arrays) can matter to any window."""
        return ((most >= self.lows[:, None]) & (least <= self.highs[:, None])).any(axis=0)

    def walk(self, tree: Tree) -> None:
        exact = tree.largest * np.abs(self.vector).max(initial=0) * len(self.vector) < topk.EXACT
        queue: list[tuple] = []

        def offer(at, low, high):
            least, most = interval(self.vector, low, high) if exact else (np.full(len(low), -np.inf), np.full(len(low), np.inf))
            for i in np.flatnonzero(self.wanted(least, most)).tolist():
                heapq.heappush(queue, (-most[i], (*at, i), least[i]))

        offer((), tree.low, tree.high)
        while queue:
            most, at, least = heapq.heappop(queue)
            if not self.wanted(np.array([least]), np.array([-most]))[0]:  # the windows may have tightened meanwhile
                continue
            ids, labels, rows, ends, low, high = tree.pages[at[0]]
            if len(at) == 1:
                offer(at, low, high)
                continue
            cut = slice(ends[at[1]], ends[at[1] + 1])
            own = labels[cut] == self.label if self.same else labels[cut] != self.label
            own &= ids[cut] != self.id
            if own.any():
                score = rows[cut] @ self.vector if exact else topk._products(self.vector[None, :], rows[cut])[0]
                self.take(ids[cut][own], score[own].astype(np.int64))

    def take(self, ids, score) -> None:
        inside = (score >= self.lows[:, None]) & (score <= self.highs[:, None])
        for w in np.flatnonzero(inside.any(axis=1)).tolist():
            best = self.best[w]
            for pair in zip(score[inside[w]].tolist(), (-ids[inside[w]]).tolist()):
                if len(best) < self.k:
                    heapq.heappush(best, pair)
                elif pair > best[0]:
                    heapq.heapreplace(best, pair)
            if len(best) == self.k:
                self.lows[w] = max(self.lows[w], best[0][0])


# ---- groups of queries against strips


def _met(queries: DataFrame, pages: DataFrame, strips: range, groups: int, width: int, same: bool, k: int) -> DataFrame:
    """Best k per query and window in the given strips. ``queries``: query_id, label, v, lows, highs."""
    cell = ["group", "strip"]
    asked = queries.withColumn("group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")).withColumn(
        "strip", F.explode(F.sequence(F.lit(strips[0]), F.lit(strips[-1])))
    )
    asked = asked.withColumn("slab", F.lit(-1))  # in front of all pages
    own = pages.where(F.col("strip").between(strips[0], strips[-1]))
    own = own.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    both = asked.unionByName(own, allowMissingColumns=True)
    both = both.repartition(tasks(both.sparkSession), *cell).sortWithinPartitions(*cell, "slab", "page")

    def result(searches):
        rows = [(s.id, w, -negated, score) for s in searches for w, best in enumerate(s.best) for score, negated in best]
        columns = list(zip(*rows)) or [()] * 4
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "w", "vec_id", "score"])

    def run(batches):
        at, slab, searches, held = None, None, [], []

        def search():
            if held:
                tree = Tree(held, width)
                for s in searches:
                    s.walk(tree)
                held.clear()

        for batch in batches:
            for row in batch.to_pylist():
                here = row["group"], row["strip"]
                if (here, row["slab"]) != (at, slab):
                    search()
                if here != at:
                    yield result(searches)
                    at, searches = here, []
                slab = row["slab"]
                if slab < 0:
                    vector = np.zeros(width)
                    vector[: len(row["v"])] = row["v"]
                    searches.append(Search(row["query_id"], row["label"], vector, row["lows"], row["highs"], same, k))
                else:
                    held.append(row)
        search()
        yield result(searches)

    columns = ["group", "strip", "slab", "query_id", "label", "v", "lows", "highs", "ids", "labels", "rows", "leaves", "low", "high"]
    return both.select(*columns).mapInArrow(run, _FOUND)


def _rounds(strips: int) -> list[range]:
    out, done = [], 0
    while done < strips:
        end = min(strips, max(1, done * (GROWTH + 1)))
        out.append(range(done, end))
        done = end
    return out


def best_in_windows(queries: DataFrame, windows: DataFrame, pages: DataFrame, strips: int, groups: int, width: int, same: bool, k: int) -> DataFrame:
    """query_id, w, rank, vec_id, score: the best k of each query's windows. ``queries``: query_id, label, v; ``windows``:
    query_id, w (0, 1, ...), low, high. ``same``: only rows of the query's label, else only of other labels."""
    order = Window.partitionBy("query_id", "w").orderBy(F.col("score").desc(), "vec_id")
    best = None
    for strip_numbers in _rounds(strips):
        tight = windows
        if best is not None:
            kth = best.where(F.col("rank") == k).select("query_id", "w", F.col("score").alias("kth"))
            tight = windows.join(kth, ["query_id", "w"], "left").withColumn("low", F.greatest("low", "kth")).drop("kth")
        lists = tight.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("w", "low", "high"))).alias("each"))  # a few windows a query
        asked = queries.join(lists, "query_id").select(
            "query_id", "label", "v", F.col("each.low").alias("lows"), F.col("each.high").alias("highs")
        )
        found = _met(asked, pages, strip_numbers, groups, width, same, k)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
    return best


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least_percent: int = 30, most_percent: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for the best ``positives`` rows of an anchor's own
    label, the best rows of other labels with a score between the two percentages of the positive's."""
    vectors = stored(vectors, "labelled-vectors")
    size = vectors.agg(F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n"), F.sum(is_anchor.cast("long")).alias("q")).first()
    width, groups = size["width"] or 0, max(1, math.ceil((size["q"] or 0) / GROUP))
    # large strips, so that queries are copied seldom, but as many cells as tasks where there are rows for them
    cells = min(math.ceil(tasks(vectors.sparkSession) / groups), size["n"] // LEAST_STRIP)
    strips = max(1, math.ceil(size["n"] / STRIP_ROWS), cells)
    pages = stored(packed(vectors, width, strips), "pages")
    queries = stored(vectors.where(is_anchor).withColumnRenamed("vec_id", "query_id"), "anchors")
    everything = queries.select("query_id", F.lit(0).alias("w"), F.lit(LOWEST).cast("long").alias("low"), F.lit(HIGHEST).cast("long").alias("high"))
    near = best_in_windows(queries, everything, pages, strips, groups, width, True, positives)
    near = stored(near.select("query_id", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # percentages of a score without a product that could leave 64 bits
    rest, hundreds = F.pmod("positive_score", F.lit(100)), F.expr("(positive_score - pmod(positive_score, 100)) div 100")
    low = hundreds * least_percent + F.ceil(rest * least_percent / 100)
    high = hundreds * most_percent + F.floor(rest * most_percent / 100)
    windows = near.where(F.col("positive_score") >= 0).select("query_id", "w", low.cast("long").alias("low"), high.cast("long").alias("high"))
    # window numbers must be 0, 1, ...: scores descend with w, so those below zero are the last
    found = best_in_windows(queries, windows, pages, strips, groups, width, False, negatives)
    return found.join(near, ["query_id", "w"]).select(
        F.col("query_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
