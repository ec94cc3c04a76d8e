"""Near-duplicate documents by one-permutation hashing with optimal densification.

A document's set holds its distinct shingles of ``WORDS`` words. One hash function deals the shingles into ``BINS`` bins, and a
bin's value is its least hash; an empty bin takes the value of the first filled bin in an order of its own (a
random permutation per bin), so that bins match with the probability of the Jaccard similarity. Bands of
``ROWS`` bins are bucket keys: at a similarity of 0.85 a pair meets in some bucket with a probability of 1 - 3e-7.

Documents with equal sets are one class first, and only the classes' representatives (least ids) go into buckets. Inside a bucket
the edges form a star: the least member against all others. Candidates first compare their signatures (one byte per bin), and
what remains is decided on the full sets: rows are dealt out by hub and slice and sorted with the hub in front,
so that a task holds one hub's set and streams the others past it; the slices split a hub with many partners.

A star can miss a link between two members that are both too far from the hub. So where the links leave a bucket with several
components, its members are compared with each other inside a task: only across components, in the first bucket that the two share,
and where sizes and signatures allow it; a bucket beyond BLOCK_ROWS members or SLICE shingles is cut into
blocks whose pairs are tasks of their own. Only links come out, never pairs, and no pair of a bucket is lost.

Defined cases: a null text or one without words has an empty set and is linked with nothing; a text with fewer words than a
shingle has its whole sequence as its one shingle; a row without id keeps a null component; rows that repeat an id share the
component of that id, which the row with the least set fingerprint stands for; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constituent360.llm.common import fresh, stored, tasks
from constituent360.operators.components import connected_components

WORDS = 5
BINS, ROWS = 192, 6
BANDS = BINS // ROWS
#: Signatures of a pair at 0.85 agree in at least this share of the bins, but for a chance of 1e-9.
AGREE = 0.69
#: Shingles that are aimed at for one slice of a hub's partners.
SLICE = 400_000
#: Members of one block of a bucket at most, about.
BLOCK_ROWS = 1024
#: Bytes of text that are hashed at once.
BATCH_BYTES = 2_000_000

_RANDOM = np.random.default_rng(20240229)
_odd = lambda n: _RANDOM.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTERS, _BASE = _odd(256), _odd(1)[0]
_PLACES, _SEEDS, _BAND_PLACES = _odd(WORDS), _odd(4), _odd(ROWS)
_BAND_SEEDS = _odd(BANDS)
#: For each bin the rank of every other bin in the order in which it looks for a filled one.
_ORDER = np.argsort(_RANDOM.random((BINS, BINS)), axis=1).astype(np.int32)
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of every text."""
    if not texts:
        return []
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    data = _LOWER[data]
    blank = _IS_BLANK[data]
    first = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    ends = np.cumsum([len(t) + 1 for t in texts])
    if not len(first):
        return [np.zeros(0, np.uint64) for _ in texts]
    place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data)))) if first[0] == 0 else None
    if place is None:
        place = np.zeros(len(data), np.int64)
        place[first[0] :] = np.arange(first[0], len(data)) - np.repeat(first, np.diff(np.append(first, len(data))))
    place[blank] = 0
    value = _LETTERS[data] * _powers(int(place.max()) + 1)[place]
    value[blank] = 0
    words = _mix(np.add.reduceat(value, first))
    start = np.searchsorted(first, np.concatenate([[0], ends[:-1]]))
    stop = np.searchsorted(first, ends)
    n = len(words) - WORDS + 1
    if n > 0:
        grams = sum(words[i : i + n] * _PLACES[i] for i in range(WORDS))
        grams = _mix(grams)
    out = []
    for a, b in zip(start.tolist(), stop.tolist()):
        if b - a >= WORDS:
            out.append(np.unique(grams[a : b - WORDS + 1]))
        elif b > a:
            own = np.append(words[a:b] * _PLACES[: b - a], _SEEDS[:1] * np.uint64(b - a))
            out.append(_mix(own.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The value of every bin; ``shingles`` are sorted and not empty."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))  # bins follow the order of the hashes
    filled = bins[first].astype(np.int64)
    values = np.zeros(BINS, np.uint64)
    values[filled] = shingles[first]
    if len(filled) < BINS:
        empty = np.ones(BINS, bool)
        empty[filled] = False
        empty = np.flatnonzero(empty)
        values[empty] = values[filled[_ORDER[np.ix_(empty, filled)].argmin(axis=1)]]
    return _mix(values + _SEEDS[1])


def band_keys(values: np.ndarray) -> np.ndarray:
    return _mix((values.reshape(BANDS, ROWS) * _BAND_PLACES).sum(axis=1, dtype=np.uint64) + _BAND_SEEDS).view(np.int64)


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_BYTES:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def _binary(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, fp (hash of the text), n, s1, s2 (fingerprint of the set), bands and sig of every row."""

    def run(batches):
        for batch in batches:
            texts = _binary(batch.column("text"))
            for start, end in _slices(texts):
                sets = shingle_sets(texts[start:end])
                with_any = [signature(s) if len(s) else None for s in sets]
                prints = [_mix(s + _SEEDS[2]).sum(dtype=np.uint64) for s in sets]
                others = [np.bitwise_xor.reduce(_mix(s + _SEEDS[3])) if len(s) else np.uint64(0) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, end - start), batch.column("fp").slice(start, end - start),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(np.array(others, np.uint64).view(np.int64)),
                        pa.array([None if v is None else band_keys(v) for v in with_any], pa.list_(pa.int64())),
                        pa.array([None if v is None else v.astype(np.uint8).tobytes() for v in with_any], pa.binary()),
                    ],
                    names=["doc_id", "fp", "n", "s1", "s2", "bands", "sig"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("fp"), "text")
    return rows.mapInArrow(run, "doc_id long, fp long, n long, s1 long, s2 long, bands array<long>, sig binary")


def _least_agreement(num: int, den: int) -> int:
    return int(AGREE * BINS * (num / den) / 0.85)


def _likely(pairs: DataFrame, signatures: DataFrame, num: int, den: int) -> DataFrame:
    """hub, rep, n of the pairs whose sizes and signatures allow the similarity num / den."""
    a = signatures.select(F.col("rep").alias("hub"), F.col("n").alias("n_hub"), F.col("sig").alias("sig_hub"))
    both = pairs.join(signatures, "rep").join(a, "hub")
    both = both.where((F.least("n", "n_hub") * den >= F.greatest("n", "n_hub") * num))
    least = _least_agreement(num, den)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in ("sig", "sig_hub")
            )
            alike = pa.array((x == y).sum(axis=1) >= least)
            yield batch.select(["hub", "rep", "n"]).filter(alike)

    return both.select("hub", "rep", "n", "sig", "sig_hub").mapInArrow(run, "hub long, rep long, n long")


def _verified(pairs: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """a, b of the pairs whose full sets reach the similarity num / den."""
    spark = pairs.sparkSession
    hubs = pairs.groupBy("hub").agg(F.ceil(F.sum("n") / SLICE).cast("int").alias("slices"))
    sliced = pairs.select("hub", "rep").join(hubs, "hub").select(
        "hub", F.pmod(F.xxhash64("rep"), F.col("slices")).cast("int").alias("slice"), "rep", F.lit(1).alias("role")
    )
    fronts = hubs.select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), F.col("hub").alias("rep"), F.lit(0).alias("role")
    )
    rows = (
        sliced.unionByName(fronts).join(texts, "rep")
        .repartition(tasks(spark), "hub", "slice")
        .sortWithinPartitions("hub", "slice", "role")
        .select("hub", "rep", "role", "text")
    )

    def run(batches):
        front = None
        for batch in batches:
            data = _binary(batch.column("text"))
            hub, rep, role = (batch.column(c).to_pylist() for c in ("hub", "rep", "role"))
            found_a, found_b = [], []
            for start, end in _slices(data):
                for i, own in zip(range(start, end), shingle_sets(data[start:end])):
                    if role[i] == 0:
                        front = own
                        continue
                    at = np.searchsorted(front, own)
                    at[at == len(front)] = 0
                    common = int((front[at] == own).sum())
                    if common * den >= num * (len(front) + len(own) - common):
                        found_a.append(hub[i])
                        found_b.append(rep[i])
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _open_members(buckets: DataFrame, named: DataFrame, kept: DataFrame) -> DataFrame:
    """The members of buckets that hold several components and a pair that the star left out, dealt into blocks.

    A bucket of many members is cut into blocks by a hash, and each pair of blocks (lo, hi) is a group; ``block`` is the
    member's own.
    """
    own = buckets.join(named, "rep", "left").select("key", "hub", "rep", F.coalesce("component", "rep").alias("component"))
    several = own.groupBy("key").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("_n")
    )
    several = several.where((F.col("_low") < F.col("_high")) & (F.col("_n") > 2)).select("key")
    members = stored(own.join(several, "key").join(kept, "rep"), "open-members")
    blocks = members.groupBy("key").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / SLICE)).cast("int").alias("blocks")
    )
    members = members.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return members.select(
        "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rep", "component",
        "n", (F.col("rep") == F.col("hub")).alias("tried"), "sig", "bands",
    )


def _groups(batches, columns: list[str]) -> Iterator[dict[str, list]]:
    """The groups (key, lo, hi) of rows that are sorted by them."""
    last, rows = None, {c: [] for c in columns}
    for batch in batches:
        data = {c: batch.column(c).to_pylist() for c in columns}
        keys = list(zip(data["key"], data["lo"], data["hi"]))
        start = 0
        for i, key in enumerate(keys):
            if key != last:
                for c in columns:
                    rows[c] += data[c][start:i]
                if rows["key"]:
                    yield rows
                rows, last, start = {c: [] for c in columns}, key, i
        for c in columns:
            rows[c] += data[c][start:]
    if rows["key"]:
        yield rows


class _Group:
    """A group's members as arrays, and the partners that each has to be compared with."""

    def __init__(self, rows: dict[str, list], num: int, den: int):
        self.num, self.den, self.least = num, den, _least_agreement(num, den)
        self.key = rows["key"][0]
        self.rep, self.n = np.array(rows["rep"], np.int64), np.array(rows["n"], np.int64)
        self.block, self.within = np.array(rows["block"]), rows["lo"][0] == rows["hi"][0]
        self.component, self.tried = np.array(rows["component"], np.int64), np.array(rows["tried"], bool)
        self.bands = np.array(rows["bands"], np.int64)
        self.sig = np.frombuffer(b"".join(rows["sig"]), np.uint8).reshape(-1, BINS)
        self.band = int((self.bands[0] == self.key).argmax())

    def partners(self, i: int) -> np.ndarray:
        """Members behind i in another component, whose first common bucket with i this is, and whose sizes and signatures
        allow the similarity. Pairs with the bucket's hub were compared before."""
        if self.tried[i]:
            return np.zeros(0, np.int64)
        rest = slice(i + 1, None)
        n = self.n[rest]
        likely = (self.component[rest] != self.component[i]) & ~self.tried[rest]
        likely &= np.minimum(n, self.n[i]) * self.den >= np.maximum(n, self.n[i]) * self.num
        if not self.within:
            likely &= self.block[rest] != self.block[i]
        at = np.flatnonzero(likely) + i + 1
        if len(at):
            at = at[(self.sig[at] == self.sig[i]).sum(axis=1) >= self.least]
        if len(at):
            at = at[(self.bands[at] == self.bands[i]).argmax(axis=1) == self.band]
        return at


_MEMBER = ["key", "lo", "hi", "block", "rep", "component", "n", "tried", "sig", "bands"]


def _needed(members: DataFrame, num: int, den: int) -> DataFrame:
    """key, lo, hi, rep of the members that have a partner in their group: their texts have to be read."""

    def run(batches):
        for rows in _groups(batches, _MEMBER):
            group = _Group(rows, num, den)
            needed = np.zeros(len(group.rep), bool)
            for i in range(len(needed)):
                at = group.partners(i)
                needed[at] = True
                needed[i] |= len(at) > 0
            found = group.rep[needed]
            same = [pa.array([rows[c][0]] * len(found), t) for c, t in (("key", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()))]
            yield pa.RecordBatch.from_arrays([*same, pa.array(found)], names=["key", "lo", "hi", "rep"])

    return _by_group(members.select(_MEMBER)).mapInArrow(run, "key long, lo int, hi int, rep long")


def _by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition(tasks(rows.sparkSession), "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "rep")


def _group_links(members: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """a, b of the pairs of partners whose full sets reach the similarity, but for those that others already join."""
    columns = [*_MEMBER, "text"]

    def run(batches):
        for rows in _groups(batches, columns):
            group = _Group(rows, num, den)
            sets: dict[int, np.ndarray] = {}
            data = [t.encode("utf-8", "surrogatepass") for t in rows["text"]]
            for start, end in _slices(data):
                sets.update(zip(range(start, end), shingle_sets(data[start:end])))
            found_a, found_b = [], []
            for i in range(len(data)):
                at = group.partners(i)
                if not len(at):
                    continue
                own = sets[i]
                others = np.concatenate([sets[j] for j in at.tolist()])
                place = np.searchsorted(own, others)
                place[place == len(own)] = 0
                sizes = group.n[at]
                common = np.add.reduceat(own[place] == others, np.cumsum(sizes) - sizes, dtype=np.int64)
                linked = at[common * den >= num * (len(own) + sizes - common)]
                for j in linked.tolist():
                    found_a.append(int(group.rep[i]))
                    found_b.append(int(group.rep[j]))
                    group.component[group.component == group.component[j]] = group.component[i]
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])

    return _by_group(members.join(texts, "rep").select(columns)).mapInArrow(run, "a long, b long")


def components(docs: DataFrame, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id per row: documents are linked if den * intersection >= num * union."""
    drawn = stored(sketches(docs), "sketches")
    nodes = (
        drawn.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
        .groupBy("doc_id").agg(F.min(F.struct("s1", "s2", "n", "fp")).alias("k"), F.count(F.lit(1)).alias("rows"))
        .select("doc_id", "k.s1", "k.s2", "k.n", "k.fp", "rows")
    )
    nodes = stored(nodes, "set-nodes")
    classes = nodes.groupBy("s1", "s2", "n").agg(F.min(F.struct("doc_id", "fp")).alias("r"))
    classes = stored(classes.select("s1", "s2", "n", F.col("r.doc_id").alias("rep"), F.col("r.fp").alias("fp")), "set-classes")
    repeated = not nodes.where(F.col("rows") > 1).isEmpty()
    once = (lambda df: df.dropDuplicates(["rep"])) if repeated else (lambda df: df)
    kept = drawn.select(F.col("doc_id").alias("rep"), "fp", "bands", "sig").join(classes.select("rep", "fp", "n"), ["rep", "fp"])
    kept = stored(once(kept), "class-sketches")
    members = kept.select("rep", F.explode("bands").alias("key"))
    hubs = members.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
    hubs = stored(hubs.where(F.col("hub") < F.col("last")).select("key", "hub"), "hubs")
    buckets = stored(members.join(hubs, "key"), "buckets")
    wanted = stored(classes.join(buckets.select("rep").distinct(), "rep").select("rep", "fp"), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.xxhash64("text").alias("fp"), F.col("text"))
    # the list grows with the documents: it is merged with them, never sent to every task
    texts = stored(once(texts.join(wanted.hint("merge"), ["rep", "fp"]).select("rep", "text")), "texts")

    edges = buckets.where(F.col("rep") != F.col("hub")).select("hub", "rep").distinct()
    likely = stored(_likely(edges, kept.select("rep", "n", "sig"), num, den), "star-edges")
    links = stored(_verified(likely, texts, num, den), "star-links")
    open_ = stored(_open_members(buckets, _named(links), kept.select("rep", "n", "sig", "bands")), "open-groups")
    if not open_.isEmpty():
        needed = stored(_needed(open_, num, den), "needed")
        more = stored(_group_links(open_.join(needed, ["key", "lo", "hi", "rep"]), texts, num, den), "group-links")
        links = links.unionByName(more)
    of_class = classes.join(_named(links), "rep", "left").select("s1", "s2", "n", F.coalesce("component", "rep").alias("component_id"))
    of_doc = nodes.join(stored(of_class, "class-components"), ["s1", "s2", "n"])
    of_doc = stored(of_doc.select(F.col("doc_id").alias("_of"), "component_id"), "doc-components")
    return drawn.join(of_doc, F.col("doc_id") == F.col("_of"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _named(links: DataFrame) -> DataFrame:
    """rep, component of the linked representatives."""
    nodes = links.select(F.col("a").alias("rep")).union(links.select(F.col("b").alias("rep"))).distinct()
    return stored(connected_components(nodes, links, "rep"), "components")


def representatives(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` without the documents whose component holds a smaller id; rows without id stay."""
    found = components(docs, num, den).where(F.col("component_id") < F.col("doc_id"))
    name = fresh(docs, "_gone")
    gone = found.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")
