"""Exact top-k search by inner product, block at a time.

Vectors are rows of whole numbers. They are cut into blocks of neighbouring ids; a block has a forward index (its rows as a
matrix) and, per term, the largest and the smallest value. A term's part of a query's bound is the query's weight times the
one of the two that makes it larger. A query visits the blocks of a shard in the order of the summed bounds,
scores a block's rows through its forward index, and stops when the next bound lies below its k-th score.

Query blocks meet shards of the index as keyed rows, and every task handles one pair. So that no shard starts from nothing, each
query block first searches the shard with the highest bounds for it; the k-th scores found there are the lower bounds for
all other shards, and a pair of which no query can gain is not dealt out at all.

Defined cases: vectors that are null or hold a null or a non-finite component, and rows without id, take no part; rows that
repeat an id are one vector, the least; shorter vectors count as if filled up with zeros; ties go to the smaller
id; scores beyond 64 bits are cut to the range of a long; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from constituent360.llm.common import stored

BLOCK, BLOCKS_PER_SHARD, QUERY_BLOCK = 512, 16, 512
FLOOR = np.iinfo(np.int64).min
EXACT = 2.0**53

_BLOCKS = "part int, block int, ids binary, rows binary, high binary, low binary"
_FOUND = "query_id long, vec_id long, score long"


def whole_vectors(table: DataFrame, scale: int = 256, vector: str = "embedding") -> DataFrame:
    """vec_id, v: floor(scale * x) of every component, as doubles, of the rows that take part."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform(v, lambda x: _floor(x.cast("double") * scale))
    rows = table.where(F.col("vec_id").isNotNull() & v.isNotNull() & sound).select("vec_id", scaled.alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _floor(x):
    """floor as a double: F.floor gives a long, which large values do not fit."""
    return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)


def _blocks(vectors: DataFrame, width: int, rows: int, parts: int) -> DataFrame:
    """The vectors in ranges of ids: a row per block with its packed ids, rows and term maxima and minima."""
    dealt = vectors.repartitionByRange(parts, "vec_id").withColumn("part", F.spark_partition_id()).sortWithinPartitions("vec_id")

    def pack(part, number, ids, values):
        grid = np.zeros((len(ids), width))
        for i, v in enumerate(values):
            grid[i, : len(v)] = v
        ends = (grid.max(axis=0), grid.min(axis=0)) if width else (np.zeros(0), np.zeros(0))
        packed = [np.array(ids, np.int64).tobytes(), grid.tobytes(), *[e.tobytes() for e in ends]]
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([number], pa.int32()), *[pa.array([x], pa.binary()) for x in packed]],
            names=["part", "block", "ids", "rows", "high", "low"],
        )

    def run(batches):
        ids, values, number, part = [], [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            ids += batch.column("vec_id").to_pylist()
            values += batch.column("v").to_pylist()
            while len(ids) >= rows:
                yield pack(part, number, ids[:rows], values[:rows])
                ids, values, number = ids[rows:], values[rows:], number + 1
        if ids:
            yield pack(part, number, ids, values)

    return dealt.select("part", "vec_id", "v").mapInArrow(run, _BLOCKS)


def _shard(part: Column, block: Column) -> Column:
    """The key of a block's shard, a long: with int, the 2,148th range of ids would overflow."""
    return part.cast("long") * 1_000_000 + F.floor(block / BLOCKS_PER_SHARD)


def _grid(data: bytes, width: int) -> np.ndarray:
    """Rows of doubles; without any component the number of rows does not matter."""
    return np.frombuffer(data, np.float64).reshape(-1, width) if width else np.zeros((0, 0))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as 64-bit numbers."""
    if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] >= EXACT:
        big = np.array([[int(x) for x in r] for r in a], object) @ np.array([[int(x) for x in r] for r in b], object).T
        return np.clip(big, FLOOR + 1, -FLOOR - 1).astype(np.int64)
    return (a @ b.T).astype(np.int64)


def _bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of every query (row) in every block (column)."""
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    bound = plus @ high.T + minus @ low.T
    return bound + np.abs(bound) * 1e-9 + (np.abs(bound) >= EXACT)  # rounding only matters where sums are inexact


def search_shard(queries, query_ids, least, blocks, k: int):
    """(query rows, ids, scores) of the best k per query among the blocks that can pass ``least`` (k-th scores so far)."""
    high, low = np.array([b[2] for b in blocks]), np.array([b[3] for b in blocks])
    bounds = _bounds(queries, high, low)
    order = np.argsort(-bounds, axis=1, kind="stable")
    n = len(queries)
    top_score, top_id = np.full((n, k), FLOOR), np.full((n, k), np.iinfo(np.int64).max)
    live = np.arange(n)
    for turn in range(len(blocks)):
        block_of = order[live, turn]
        kth = np.maximum(top_score[live, -1], least[live])
        go_on = (bounds[live, block_of] >= kth) | (kth == FLOOR)
        live, block_of = live[go_on], block_of[go_on]
        if not len(live):
            break
        for b in np.unique(block_of).tolist():
            own = live[block_of == b]
            ids, rows = blocks[b][0], blocks[b][1]
            score = _products(queries[own], rows)
            score[ids[None, :] == query_ids[own][:, None]] = FLOOR
            # ids of a block ascend, so a stable sort leaves the smaller id first among equal scores
            best = np.argsort(-score, axis=1, kind="stable")[:, :k] if score.min(initial=0) > FLOOR else _stable_best(score, k)
            both = np.hstack([top_score[own], np.take_along_axis(score, best, 1)])
            names = np.hstack([top_id[own], ids[best]])
            place = np.lexsort((names, -np.maximum(both, FLOOR + 1)), axis=1)[:, :k]
            top_score[own], top_id[own] = np.take_along_axis(both, place, 1), np.take_along_axis(names, place, 1)
    found = (top_score > FLOOR) & (top_score >= least[:, None])
    row, _ = np.nonzero(found)
    return row, top_id[found], top_score[found]


def _stable_best(score: np.ndarray, k: int) -> np.ndarray:
    return np.argsort(-np.maximum(score, FLOOR + 1), axis=1, kind="stable")[:, :k]


def _pairs_searched(pairs: DataFrame, index: DataFrame, width: int, k: int) -> DataFrame:
    """Best k per query of each pair (qpart, qblock, part) with the query block's columns and its k-th scores."""
    blocks = index.select("part", F.struct("ids", "rows", "high", "low").alias("b"))
    shards = blocks.groupBy("part").agg(F.collect_list("b").alias("blocks"))  # BLOCKS_PER_SHARD at most

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                queries, ids = _grid(row["qrows"], width), np.frombuffer(row["qids"], np.int64)
                if not width:
                    queries = np.zeros((len(ids), 0))
                least = np.frombuffer(row["least"], np.int64) if row["least"] else np.full(len(ids), FLOOR)
                own = []
                for b in row["blocks"]:
                    names = np.frombuffer(b["ids"], np.int64)
                    grid = _grid(b["rows"], width) if width else np.zeros((len(names), 0))
                    own.append((names, grid, np.frombuffer(b["high"]), np.frombuffer(b["low"])))
                at, found, score = search_shard(queries, ids, least, own, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"]
                )

    return pairs.join(shards, "part").select("qids", "qrows", "least", "blocks").mapInArrow(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the best k of all other vectors for each vector for which ``is_query`` holds."""
    vectors = stored(vectors, "whole-vectors")
    row = vectors.agg(F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("long")).alias("q")).first()
    width, shards = row["width"] or 0, max(1, math.ceil(row["n"] / (BLOCK * BLOCKS_PER_SHARD)))
    index = stored(_blocks(vectors, width, BLOCK, shards), "blocks")
    q_parts = max(1, math.ceil((row["q"] or 0) / QUERY_BLOCK))
    queries = _blocks(vectors.where(is_query), width, QUERY_BLOCK, q_parts).select(
        F.col("part").alias("qpart"), F.col("block").alias("qblock"), F.col("ids").alias("qids"), F.col("rows").alias("qrows")
    )
    queries = stored(queries, "query-blocks")
    # range partitions are only about equal, so a shard is a run of blocks of its partition
    index = index.withColumn("range", F.col("part")).withColumn("part", _shard(F.col("part"), F.col("block")))
    ends = stored(
        index.groupBy("range", "part").agg(F.collect_list("high").alias("highs"), F.collect_list("low").alias("lows")),
        "shard-bounds",
    )

    def bound(batches):
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                high = np.array([np.frombuffer(x) for x in r["highs"]]).max(axis=0)
                low = np.array([np.frombuffer(x) for x in r["lows"]]).min(axis=0)
                grid = _grid(r["qrows"], width) if width else np.zeros((len(r["qids"]) // 8, 0))
                out.append(_bounds(grid, high[None, :], low[None, :])[:, 0])
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("qpart", "qblock", "part")],
                    pa.array([float(x.sum()) for x in out], pa.float64()), pa.array([x.tobytes() for x in out], pa.binary()),
                ],
                names=["qpart", "qblock", "part", "total", "bounds"],
            )

    # the stated queries against all rows, in blocks: every query block gets a row per range of ids
    keyed = queries.withColumn("range", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(ends, "range")
    bounds = keyed.select("qpart", "qblock", "qids", "qrows", "part", "highs", "lows").mapInArrow(
        bound, "qpart int, qblock int, part long, total double, bounds binary"
    )
    bounds = stored(bounds, "pair-bounds")
    first = bounds.groupBy("qpart", "qblock").agg(F.max_by("part", F.struct("total", "part")).alias("part"))
    first = stored(first, "first-shards")
    empty = F.lit(None).cast("binary").alias("least")
    seeds = stored(_pairs_searched(first.join(queries, ["qpart", "qblock"]).withColumn("least", empty), index, width, k), "seeds")
    kth = _best(seeds, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
    rest = bounds.join(first, ["qpart", "qblock", "part"], "left_anti").join(queries, ["qpart", "qblock"])
    scores = _kth_by_block(queries, kth)
    rest = rest.join(scores, ["qpart", "qblock"])

    def useful(batches):
        for batch in batches:
            keep = [
                bool((np.frombuffer(b) >= np.frombuffer(least, np.int64)).any())
                for b, least in zip(batch.column("bounds").to_pylist(), batch.column("least").to_pylist())
            ]
            yield batch.select(["qpart", "qblock", "part"]).filter(pa.array(keep, pa.bool_()))

    pairs = rest.select("qpart", "qblock", "part", "bounds", "least").mapInArrow(useful, "qpart int, qblock int, part long")
    pairs = pairs.join(queries, ["qpart", "qblock"]).join(scores, ["qpart", "qblock"])
    others = _pairs_searched(pairs, index, width, k)
    return _best(seeds.unionByName(others), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _kth_by_block(queries: DataFrame, kth: DataFrame) -> DataFrame:
    """qpart, qblock, least: the k-th scores of a block's queries in the block's order (the lowest number where fewer are known)."""

    def ids(batches):
        for batch in batches:
            for row in batch.to_pylist():
                names = np.frombuffer(row["qids"], np.int64)
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["qpart"]] * n, pa.int32()), pa.array([row["qblock"]] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(names)],
                    names=["qpart", "qblock", "nth", "query_id"],
                )

    each = queries.select("qpart", "qblock", "qids").mapInArrow(ids, "qpart int, qblock int, nth int, query_id long")
    lists = each.join(kth, "query_id", "left").groupBy("qpart", "qblock").agg(
        F.array_sort(F.collect_list(F.struct("nth", F.coalesce("kth", F.lit(FLOOR)).alias("kth")))).alias("k")
    )

    def pack(batches):
        for batch in batches:
            rows = batch.column("k").to_pylist()
            packed = [np.array([x["kth"] for x in r], np.int64).tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("qpart"), batch.column("qblock"), pa.array(packed, pa.binary())], names=["qpart", "qblock", "least"]
            )

    return stored(lists.mapInArrow(pack, "qpart int, qblock int, least binary"), "kth-scores")
