"""Prefix trie of conversations with subtree totals by time-forward processing.

Turns are numbered within their conversation over sorted ranges, so a conversation of any length spans as many tasks as it
needs. A node is a distinct sequence of first turns; its key is the depth and 128 bits, the exclusive or of one hash per place and
turn, which can be carried across ranges and gives the parent's key as well.

Subtree totals: the nodes are cut into connected shards. ``rows`` below a node (one per member and later turn) never grow on the way
down, so the nodes whose rows have the same magnitude (in powers of ``shard_rows``) form runs on every path; a shard is a
maximal connected run, cut at every ``band`` levels if it holds more than the lowest magnitude. A shard therefore
has at most ``shard_rows * band`` nodes however large the trie is. Within a shard the nodes come in reverse level order, and
each sends its totals forward to its parent through a priority queue that spills. Then the roots of the shards above the lowest
magnitude (fewer than one per ``shard_rows`` rows and level run) pass theirs on in the same way, and these shards run once more with what
their child shards hold.

Defined cases: rows without conv_id take no part; a null role or text is empty; turns go by ``turn`` (null first), equal ones by
role, then by the digest of the turn; repeated rows are turns of their own; without any conversation there is no node;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from constituent360.llm.common import stored, tasks

SHARD_ROWS, BAND, IN_MEMORY, FAN_IN = 4096, 64, 100_000, 64
KEY = ("depth", "a", "b")
PARENT = ("pdepth", "pa", "pb")
TOTALS = ("n_children", "n_leaves", "saved_tokens")


class SpillingQueue:
    """A priority queue of tuples: beyond ``most`` of them, what it holds goes to a sorted file, which is read back in blocks.
    The files have no name and vanish with the task."""

    def __init__(self, most: int = IN_MEMORY, block: int = 1024):
        self.most, self.block, self.heap, self.runs, self.made = most, block, [], [], 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            if len(self.runs) >= FAN_IN:  # so that files and read buffers stay few
                runs, self.runs = self.runs, []
                self._spill(heapq.merge(*[self._chained(head, run) for head, _, run in runs]))
            self.heap.sort()
            heap, self.heap = self.heap, []
            self._spill(iter(heap))

    @staticmethod
    def _chained(head, run):
        yield head
        yield from run

    def _spill(self, items: Iterator[tuple]) -> None:
        file = tempfile.TemporaryFile()
        while block := [x for _, x in zip(range(self.block), items)]:
            pickle.dump(block, file)
        file.seek(0)
        run = self._read(file)
        self.made += 1
        heapq.heappush(self.runs, (next(run), self.made, run))

    @staticmethod
    def _read(file):
        with file:
            while True:
                try:
                    block = pickle.load(file)
                except EOFError:
                    return
                yield from block

    def _from_run(self) -> bool:
        return bool(self.runs) and (not self.heap or self.runs[0][0] < self.heap[0])

    def peek(self) -> tuple | None:
        return self.runs[0][0] if self._from_run() else self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self._from_run():
            head, number, run = self.runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, run))
            return head
        return heapq.heappop(self.heap)


def hash_of_id(conv_id: Column, modulus: int) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % modulus


def _ranged(rows: DataFrame, *order: str) -> DataFrame:
    """The rows dealt out in sorted ranges of (conv_id, order), written, since a second run might cut elsewhere."""
    dealt = rows.repartitionByRange(tasks(rows.sparkSession), "conv_id", *order)
    return stored(dealt.withColumn("range", F.spark_partition_id()), "ranges")


def _carried(ranged: DataFrame, **totals: Column) -> DataFrame:
    """(conv_id, range, totals of its earlier ranges): only for conversations that began in an earlier range, so at most one
    row per range, which is the bound that lets it be broadcast."""
    sums = ranged.groupBy("conv_id", "range").agg(*[total.alias(name) for name, total in totals.items()])
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    merged = {n: (F.bit_xor(n) if n in ("a", "b") else F.sum(n)).over(before).alias(f"_before_{n}") for n in totals}
    first = next(iter(totals))
    return sums.select("conv_id", "range", *merged.values()).where(F.col(f"_before_{first}").isNotNull())


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest, n_bytes of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    slim = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    ranged = _ranged(slim, "turn", "role", "digest")
    inside = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy("turn", "role", "digest"))
    earlier = F.broadcast(_carried(ranged, n=F.count(F.lit(1))))
    return (
        ranged.withColumn("_inside", inside).join(earlier, ["conv_id", "range"], "left")
        .select("conv_id", (F.col("_inside") + F.coalesce("_before_n", F.lit(0))).cast("long").alias("place"), "digest", "n_bytes")
    )


def whole_turns(turns: DataFrame) -> DataFrame:
    """The conversations as they are: conv_id, depth, digest, n_bytes, length, with a row of depth 0 for each."""
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))
    return _with_starts(turns.withColumnRenamed("place", "depth").join(lengths, "conv_id"), lengths)


def _with_starts(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("binary").alias("digest")
    starts = lengths.select("conv_id", F.lit(0).cast("long").alias("depth"), nothing, F.lit(0).cast("long").alias("n_bytes"), "length")
    return rows.select("conv_id", "depth", "digest", "n_bytes", "length").unionByName(starts)


def spliced(turns: DataFrame, family: int = 5, modulus: int = 9) -> DataFrame:
    """Every conversation c with its first h = crc32(c) % ``modulus`` turns replaced by those of c - c % ``family``."""
    turns = stored(turns, "turns")
    h = hash_of_id(F.col("conv_id"), modulus)
    base = F.col("conv_id") - F.col("conv_id") % family
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    bases = counts.where(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), F.least("n", F.lit(modulus - 1)).alias("n_base"))
    convs = counts.withColumn("h", h).withColumn("base", base).join(bases, "base", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("conv_id", "base", "h", "taken", "length"), "conversations")
    heads = turns.where((F.col("place") < modulus) & (F.col("conv_id") == base)).withColumnRenamed("conv_id", "base")
    first = convs.join(heads, "base").where(F.col("place") <= F.col("h")).withColumn("depth", F.col("place"))
    own = turns.where(F.col("place") > h).join(convs, "conv_id").withColumn("depth", F.col("place") - F.col("h") + F.col("taken"))
    columns = ("conv_id", "depth", "digest", "n_bytes", "length")
    return _with_starts(first.select(*columns).unionByName(own.select(*columns)), convs)


def _prefixes(rows: DataFrame) -> DataFrame:
    """The rows with the key of their first ``depth`` turns (a, b) and the parent's (pa, pb)."""
    started = F.col("depth") > 0
    own = rows.select(
        "conv_id", "depth", "n_bytes", "length",
        F.when(started, F.xxhash64(F.lit(1), "depth", "digest")).otherwise(F.lit(0)).alias("a"),
        F.when(started, F.xxhash64(F.lit(2), "depth", "digest")).otherwise(F.lit(0)).alias("b"),
    )
    ranged = _ranged(own, "depth")
    to_here = Window.partitionBy("conv_id", "range").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = F.broadcast(_carried(ranged, a=F.bit_xor("a"), b=F.bit_xor("b")))
    placed = ranged.withColumns({f"_in_{c}": F.bit_xor(c).over(to_here) for c in ("a", "b")})
    placed = placed.join(earlier, ["conv_id", "range"], "left")
    key = {c: F.col(f"_in_{c}").bitwiseXOR(F.coalesce(f"_before_{c}", F.lit(0).cast("long"))) for c in ("a", "b")}
    return placed.select(
        "conv_id", "depth", "n_bytes", "length", *[k.alias(c) for c, k in key.items()],
        *[k.bitwiseXOR(F.col(c)).alias(f"p{c}") for c, k in key.items()],
    )


def ends_digests(prefixes: DataFrame) -> DataFrame:
    """depth, a, b, ends_sha256: the hash of the ids of the conversations that end at a node.

    Ids are put in order in ranges, each range joins its ids to one text, and the texts of a node stream through one hash."""
    ends = prefixes.where(F.col("depth") == F.col("length")).select(*KEY, "conv_id")
    dealt = ends.repartitionByRange(tasks(ends.sparkSession), *KEY, "conv_id").withColumn("range", F.spark_partition_id())
    texts = stored(dealt, "ends").groupBy(*KEY, "range").agg(F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))
    in_order = texts.repartition(*KEY).sortWithinPartitions(*KEY, "range")

    def run(batches):
        at, state = None, None
        for batch in batches:
            out = []
            for key, ids in zip(zip(*[batch.column(c).to_pylist() for c in KEY]), batch.column("ids").to_pylist()):
                if key == at:
                    state.update(b",")
                else:
                    if at is not None:
                        out.append((*at, state.hexdigest()))
                    at, state = key, hashlib.sha256()
                state.update(ids.encode())
            yield _batch(out, (*KEY, "ends_sha256"))
        if at is not None:
            yield _batch([(*at, state.hexdigest())], (*KEY, "ends_sha256"))

    return in_order.select(*KEY, "ids").mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


def _batch(rows: list[tuple], names) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


SHARD = ("sdepth", "sa", "sb")


def time_forward(nodes: DataFrame, in_memory: int = IN_MEMORY) -> DataFrame:
    """depth, a, b and the totals of every node's subtree within its shard.

    ``nodes``: key, shard (the key of its root), parent's key, and what the node itself holds (TOTALS). Nodes of a shard come in
    reverse level order, so all that a node has been sent lies on top of the queue when its turn comes."""
    in_order = nodes.repartition(*SHARD).sortWithinPartitions(*SHARD, F.col("depth").desc(), "a", "b")

    def run(batches):
        queue = SpillingQueue(in_memory)
        for batch in batches:
            out = []
            for d, a, b, sd, sa, sb, pd, pa_, pb, *totals in zip(*[c.to_pylist() for c in batch.columns]):
                address = (-d, a, b)
                while (top := queue.peek()) is not None and top[:3] == address:
                    totals = [x + y for x, y in zip(totals, queue.pop()[3:])]
                if (d, a, b) != (sd, sa, sb):
                    queue.push((-pd, pa_, pb, 1, *totals[1:]))
                out.append((d, a, b, *totals))
            yield _batch(out, (*KEY, *TOTALS))

    return in_order.select(*KEY, *SHARD, *PARENT, *TOTALS).mapInArrow(run, ", ".join(f"{c} long" for c in (*KEY, *TOTALS)))


def _sent(roots: DataFrame) -> DataFrame:
    """What the roots of shards send to their parents: parent's key, TOTALS."""
    return roots.groupBy(*PARENT).agg(F.count(F.lit(1)).alias(TOTALS[0]), *[F.sum(c).alias(c) for c in TOTALS[1:]])


def _added(nodes: DataFrame, sent: DataFrame) -> DataFrame:
    """The nodes' own totals with what was sent to them."""
    got = sent.select(*[F.col(p).alias(k) for p, k in zip(PARENT, KEY)], *[F.col(c).alias(f"_{c}") for c in TOTALS])
    both = nodes.join(got, list(KEY), "left")
    return both.withColumns({c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in TOTALS}).drop(*[f"_{c}" for c in TOTALS])


def trie(rows: DataFrame, shard_rows: int = SHARD_ROWS, band: int = BAND, in_memory: int = IN_MEMORY) -> DataFrame:
    """One row per node of the conversations in ``rows`` (conv_id, depth, digest, n_bytes, length; depth 0 for each one)."""
    prefixes = stored(_prefixes(rows), "prefixes")
    below = F.col("length") - F.col("depth") + 1
    nodes = prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_bytes").alias("n_bytes"),
        F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.sum(below).alias("rows"),
        F.sum((F.col("depth") == F.col("length")).cast("long")).alias("n_ends"),
    )
    own = [
        F.lit(0).cast("long").alias("n_children"), (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    ]
    magnitude = F.floor(F.log(F.col("rows").cast("double")) / F.log(F.lit(float(shard_rows))))
    nodes = stored(
        nodes.select(*KEY, (F.col("depth") - 1).alias("pdepth"), "pa", "pb", "conv_id", "n_convs", magnitude.alias("size"), *own), "nodes"
    )
    banded = F.when(F.col("size") > 0, F.floor(F.col("depth") / band)).otherwise(F.lit(0)).alias("band")
    deep = nodes.where(F.col("depth") > 0)
    # the shard's root: the first row of the same magnitude and band on the way of the node's smallest member
    paths = prefixes.where(F.col("depth") > 0).select("conv_id", *KEY).join(deep.select(*KEY, "size"), list(KEY))
    firsts = paths.groupBy("conv_id", "size", banded).agg(F.min(F.struct(*KEY)).alias("first"))
    sharded = deep.withColumn("band", banded).join(firsts, ["conv_id", "size", "band"])
    work = stored(
        sharded.select(*KEY, *[F.col(f"first.{k}").alias(s) for s, k in zip(SHARD, KEY)], *PARENT, *TOTALS, "size"), "shards"
    )
    is_root = (F.col("depth") == F.col("sdepth")) & (F.col("a") == F.col("sa")) & (F.col("b") == F.col("sb"))
    low, high = work.where(F.col("size") == 0).drop("size"), work.where(F.col("size") > 0).drop("size")
    roots = work.where(is_root).select(*KEY, *PARENT, "size")

    low_totals = stored(time_forward(low, in_memory), "low-totals")
    low_sent = stored(_sent(low_totals.join(roots.where(F.col("size") == 0), list(KEY))), "low-sent")
    high = stored(_added(high, low_sent), "high-shards")
    local = time_forward(high, in_memory).join(roots.where(F.col("size") > 0), list(KEY))
    # across shard roots: a shard's parent is the shard that its root hangs from
    of = high.select(*[F.col(k).alias(p) for k, p in zip(KEY, PARENT)], *[F.col(s).alias(f"to_{s}") for s in SHARD])
    tree = stored(local.join(of, list(PARENT), "left"), "shard-roots")
    whole_tree = [F.lit(-1).cast("long").alias(s) for s in SHARD]
    to = [F.coalesce(f"to_{s}", F.lit(-1).cast("long")).alias(p) for s, p in zip(SHARD, PARENT)]
    across = time_forward(tree.select(*KEY, *whole_tree, *to, *TOTALS), in_memory)
    high_sent = _sent(across.drop(*TOTALS[:1]).join(tree.select(*KEY, *PARENT), list(KEY)))
    high_totals = time_forward(_added(high, high_sent), in_memory)
    totals = low_totals.unionByName(high_totals)

    # the root of everything, from what the shards below it send
    top = nodes.where(F.col("depth") == 0).select(*KEY, *TOTALS)
    sent_up = low_sent.unionByName(high_sent).groupBy(*PARENT).agg(*[F.sum(c).alias(c) for c in TOTALS])
    totals = totals.unionByName(_added(top, sent_up.where(F.col("pdepth") == 0)))

    parents = nodes.select(*[F.col(k).alias(p) for k, p in zip(KEY, PARENT)], F.col("conv_id").alias("parent_conv_id"))
    empty = F.lit(hashlib.sha256().hexdigest())
    return (
        nodes.drop(*TOTALS).join(totals, list(KEY)).join(ends_digests(prefixes), list(KEY), "left")
        .join(parents, list(PARENT), "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", *TOTALS, F.coalesce("ends_sha256", empty).alias("ends_sha256"),
        )
    )
