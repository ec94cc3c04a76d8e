"""Exact removal of repeated byte strings with suffix arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier: in a document with a smaller id, or
further up in the same document. Suffix arrays decide this, but not one over everything: strings that are equal have to
meet in one task, and nothing else has to.

1.  Every string of ``length`` bytes has an anchor, the substring of a third of its length with the least hash. Strings that start
    side by side and share the anchor form a run. Runs whose anchor occurs once have no equals and are
    left. Of equal runs all but the first are repeats as a whole. What remains are different runs around equal anchors.
2.  Their bytes are read again and cut into runs with longer anchors (9/10 of the length), with the same two rules. A run is now
    a few bytes, the anchor, and a few bytes more.
3.  The runs around one anchor are sorted: the anchor is replaced by one symbol of its own, so that a string is a dozen
    symbols; many small groups are written one after the other into a text, and ``lyndon.suffix_array`` sorts its
    suffixes. Neighbours that agree in the length of a string are equal strings, and all but the first of them are repeats.
    An anchor with more than ``MOST_RUNS`` different runs (a passage in a great part of all documents meets other
    text on either side each time) would be one long text in one task; there each string stands for
    itself, and the first of equal ones is found by an aggregate that combines before it shuffles.

Strings are identified by 128 bits of hash in steps 1 and 2 and by their symbols in step 3.

Defined cases: a null text counts as empty; texts shorter than ``length`` lose nothing; a row without id is kept whole and is no
occurrence for others; rows that repeat an id are ordered by a hash of their text, and rows that are equal in both are
one document, each row with the same result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from constituent360.llm.common import discard, stored, tasks
from constituent360.llm.lyndon import suffix_array

LENGTH = 100
#: Different runs around one anchor that are sorted together at most.
MOST_RUNS = 2000
#: Symbols of one suffix array that are aimed at.
SYMBOLS = 30_000
#: Bytes that are hashed at once; longer texts are taken in overlapping pieces.
PIECE = 1 << 21

# A text is its id (doc) and a hash of 64 bits (fp), which tells texts with the same id apart; a place in it (at) is the offset
# (36 bits) and the number of strings of a run (7 bits) in one number.
OFFSET_BITS, COUNT_BITS = 36, 7

_RANDOM = np.random.default_rng(20240301)
_odd = lambda n: _RANDOM.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTERS, _SEEDS = _odd(256), _odd(4)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Runs:
    """The runs of a batch of byte strings: ``owner`` (index of the string), ``start`` (offset in it), ``count``
    (strings of the run), ``anchor`` (offset in the batch), ``first`` (offset in the batch), ``h`` and ``c`` (hashes of the
    anchor and of the run's bytes)."""

    def __init__(self, texts: list[bytes], length: int, anchor: int):
        self.data = data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        n = len(data)
        n_strings = np.maximum(sizes - length + 1, 0)
        if not n_strings.sum():
            self.owner = self.start = self.count = self.anchor = self.first = np.zeros(0, np.int64)
            self.h = self.c = np.zeros(0, np.uint64)
            return
        up, down = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTERS[data] * up[:n], dtype=np.uint64, out=sums[1:])
        grams = _mix((sums[anchor:] - sums[:-anchor]) * down[: n - anchor + 1])
        # the least hash of each window with its place in the low bits; of equal ones the leftmost
        low = np.uint64(max(1, int(n).bit_length()))
        least = ((grams >> low) << low) | np.arange(len(grams), dtype=np.uint64)
        window, span = length - anchor + 1, 1
        while span * 2 <= window:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < window:
            least = np.minimum(least[: len(least) - (window - span)], least[window - span :])
        at = (least & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
        string = np.arange(int(n_strings.sum())) - np.repeat(np.cumsum(n_strings) - n_strings, n_strings)
        owner = np.repeat(np.arange(len(texts)), n_strings)
        string += starts[owner]
        at = at[string]
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])]))
        self.first, self.anchor, self.owner = string[new], at[new], owner[new]
        self.start = self.first - starts[self.owner]
        self.count = np.diff(np.append(new, len(string)))
        self.h = grams[self.anchor]
        ends = self.first + self.count - 1 + length
        self.c = _mix((sums[ends] - sums[self.first]) * down[self.first] + _SEEDS[0] * self.count.astype(np.uint64))


def _binary(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(rows, offsets, bytes) of about PIECE bytes together; pieces of a text overlap so that no string is lost."""
    rows, offsets, parts, size = [], [], [], 0
    for i, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), PIECE):
            part = text[offset : offset + PIECE + length - 1]
            if size and size + len(part) > PIECE:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
            rows.append(i)
            offsets.append(offset)
            parts.append(part)
            size += len(part)
    if rows:
        yield rows, offsets, parts


def _place(offset: np.ndarray, count: np.ndarray) -> np.ndarray:
    return (offset << COUNT_BITS) | count


def text_hash(text: Column) -> Column:
    """The hash that tells rows with the same id apart and orders them."""
    return F.xxhash64(text)


def all_runs(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """h, c, doc, fp, at of the runs of all texts. Equal runs of a batch are collapsed: the later ones come
    without h, since they are repeats whatever else there is."""

    def run(batches):
        for batch in batches:
            texts = _binary(batch.column("text"))
            ids, prints = batch.column("doc").to_numpy(False), batch.column("fp").to_numpy(False)
            for rows, offsets, parts in _pieces(texts, length):
                runs = Runs(parts, length, anchor)
                row = np.array(rows)[runs.owner]
                doc, fp = ids[row], prints[row]
                at = _place(runs.start + np.array(offsets)[runs.owner], runs.count)
                h, c = runs.h.view(np.int64), runs.c.view(np.int64)
                order = np.lexsort((at, fp, doc, c, h))
                alike = lambda x: x[order][1:] == x[order][:-1]
                again, same = np.zeros(len(h), bool), np.zeros(len(h), bool)
                again[order[1:]] = alike(h) & alike(c)
                same[order[1:]] = alike(h) & alike(c) & alike(doc) & alike(fp) & alike(at)  # rows that are equal in all are one document
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[~same], mask=m) for x, m in ((h, again[~same]), (c, None), (doc, None), (fp, None), (at, None))],
                    names=["h", "c", "doc", "fp", "at"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), text_hash(F.col("text")).alias("fp"), F.col("text"))
    rows = rows.where(F.col("doc").isNotNull() & (F.octet_length("text") >= length))
    return rows.mapInArrow(run, "h long, c long, doc long, fp long, at long")


def _collapsed(runs: DataFrame, *carry: str) -> DataFrame:
    """One row per different run with its first place."""
    first = runs.groupBy("h", "c").agg(F.min(F.struct("doc", "fp", "at", *carry)).alias("_first"))
    return first.select("h", "c", *[F.col(f"_first.{c}").alias(c) for c in ("doc", "fp", "at", *carry)])


def _later(runs: DataFrame, firsts: DataFrame) -> DataFrame:
    """doc, fp, at of the runs that are not the first of their kind."""
    known = firsts.select("h", "c", F.struct("doc", "fp", "at").alias("first"))
    both = runs.select("h", "c", "doc", "fp", "at").join(known, ["h", "c"])
    return both.where(F.struct("doc", "fp", "at") != F.col("first")).select("doc", "fp", "at")


def _shared(firsts: DataFrame, name: str) -> DataFrame:
    """h, runs of the anchors that stand in several different runs."""
    counts = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("runs"))
    return stored(counts.where(F.col("runs") > 1), name)


def _short_runs(docs: DataFrame, firsts: DataFrame, length: int, anchor: int) -> DataFrame:
    """h, c, doc, fp, at, left, right of the runs around longer anchors inside the given runs."""
    wanted = firsts.groupBy("doc", "fp").agg(F.collect_list("at").alias("runs"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), text_hash(F.col("text")).alias("fp"), F.col("text"))
    rows = rows.where(F.octet_length("text") >= length).join(
        stored(wanted, "wanted-runs").hint("merge"), ["doc", "fp"]
    )

    def cut(batch):
        texts, ids = _binary(batch.column("text")), batch.column("doc").to_numpy(False)
        prints, lists = batch.column("fp").to_numpy(False), batch.column("runs")
        places = lists.flatten().to_numpy(False)
        rows = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy(False))
        offset = (places >> COUNT_BITS) & ((1 << OFFSET_BITS) - 1)
        ends = offset + (places & ((1 << COUNT_BITS) - 1)) - 1 + length
        step = max(1, PIECE // (2 * length))
        for i in range(0, len(places), step):
            part = slice(i, i + step)
            bits = [texts[r][a:b] for r, a, b in zip(rows[part].tolist(), offset[part].tolist(), ends[part].tolist())]
            runs = Runs(bits, length, anchor)
            row = rows[part][runs.owner]
            data = runs.data.tobytes()
            stops = runs.first + runs.count - 1 + length
            spans = list(zip(runs.first.tolist(), runs.anchor.tolist(), stops.tolist()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(runs.h.view(np.int64)), pa.array(runs.c.view(np.int64)), pa.array(ids[row]), pa.array(prints[row]),
                    pa.array(_place(offset[part][runs.owner] + runs.start, runs.count)),
                    pa.array([data[a:b] for a, b, _ in spans], pa.binary()),
                    pa.array([data[b + anchor : c] for _, b, c in spans], pa.binary()),
                ],
                names=["h", "c", "doc", "fp", "at", "left", "right"],
            )

    def run(batches):
        for batch in batches:
            yield from cut(batch)

    return rows.select("doc", "fp", "text", "runs").mapInArrow(run, "h long, c long, doc long, fp long, at long, left binary, right binary")


def _sorted_repeats(groups: list[tuple[list, ...]], size: int) -> tuple[np.ndarray, ...]:
    """doc, fp, at of the repeated strings in groups of (doc, fp, at, left, right); a string has ``size`` symbols.

    Symbols: 0 ends the text, 1 parts runs, 2 to 257 are bytes, each group's anchor has one of its own from 258 on.
    """
    parts, docs, prints, places, strings = [], [], [], [], []
    at = 0
    for number, group in enumerate(groups):
        for doc, fp, place, left, right in zip(*group):
            symbols = np.empty(len(left) + len(right) + 2, np.int64)
            symbols[: len(left)] = np.frombuffer(left, np.uint8)
            symbols[len(left) + 1 : -1] = np.frombuffer(right, np.uint8)
            symbols += 2
            symbols[len(left)], symbols[-1] = 258 + number, 1
            parts.append(symbols)
            count = place & ((1 << COUNT_BITS) - 1)
            strings += range(at, at + count)
            docs += [doc] * count
            prints += [fp] * count
            places += [((place >> COUNT_BITS) + i) << COUNT_BITS | 1 for i in range(count)]
            at += len(symbols)
    text = np.concatenate([*parts, np.zeros(1, np.int64)])
    order = np.array(suffix_array(text), np.int64)
    index = np.full(len(text), -1, np.int64)
    index[strings] = np.arange(len(strings))
    order = order[index[order] >= 0]  # the strings in the order of their suffixes
    symbols = text[order[:, None] + np.arange(size)[None, :]]
    new = np.concatenate([[True], (symbols[1:] != symbols[:-1]).any(axis=1)])
    kind, own = np.cumsum(new), index[order]
    docs, prints, places = (np.array(x, np.int64)[own] for x in (docs, prints, places))
    by = np.lexsort((places, prints, docs, kind))
    docs, prints, places, kind = docs[by], prints[by], places[by], kind[by]
    later = np.concatenate([[False], kind[1:] == kind[:-1]])
    return docs[later], prints[later], places[later]


def _repeats_by_sorting(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """doc, fp, at of the repeated strings among different runs around equal anchors."""
    size = length - anchor + 1
    dealt = rows.select("h", "doc", "fp", "at", "left", "right").repartition(tasks(rows.sparkSession), "h").sortWithinPartitions("h")

    def run(batches):
        groups, symbols, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column("h").to_numpy(False)
            cuts = np.append(np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])), len(h)).tolist()
            columns = [batch.column(c).to_pylist() for c in ("doc", "fp", "at", "left", "right")]
            for a, b in zip(cuts, cuts[1:]):
                group = tuple(c[a:b] for c in columns)
                if h[a] == last:
                    for old, new in zip(groups[-1], group):
                        old.extend(new)
                else:
                    if symbols >= SYMBOLS:
                        yield _repeated_batch(groups, size)
                        groups, symbols = [], 0
                    groups.append(group)
                    last = h[a]
                symbols += sum(map(len, group[3])) + sum(map(len, group[4])) + 2 * (b - a)
        if groups:
            yield _repeated_batch(groups, size)

    return dealt.mapInArrow(run, "doc long, fp long, at long")


def _repeated_batch(groups, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in _sorted_repeats(groups, size)], names=["doc", "fp", "at"])


def _repeats_by_string(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """The same for anchors with very many runs: every string is a row of its own."""
    size = length - anchor + 1

    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("h", "doc", "fp", "at", "left", "right")]
            out = []
            for key, d, fp, place, a, b in zip(*columns):
                for i in range(place & ((1 << COUNT_BITS) - 1)):
                    string = len(a[i:]).to_bytes(2, "little") + a[i:] + b[: size - 1 - len(a[i:])]
                    out.append((key, string, d, fp, ((place >> COUNT_BITS) + i) << COUNT_BITS | 1))
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names=["h", "c", "doc", "fp", "at"])

    strings = rows.select("h", "doc", "fp", "at", "left", "right").mapInArrow(run, "h long, c binary, doc long, fp long, at long")
    strings = stored(strings, "single-strings")
    return _later(strings, _collapsed(strings))


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc, fp, at of everything repeated: at holds the offset and the number of strings that start from there."""
    short, long = max(1, length // 3), max(1, length * 9 // 10)
    runs = stored(all_runs(docs, length, short), "runs")
    counts = runs.where(F.col("h").isNotNull()).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    again = stored(counts.where(F.col("n") > 1).select("h"), "repeated-anchors")
    kept = stored(runs.join(again, "h"), "repeated-runs")
    found = [stored(runs.where(F.col("h").isNull()).select("doc", "fp", "at"), "repeated-in-batch")]
    discard(runs)
    firsts = stored(_collapsed(kept), "different-runs")
    found.append(stored(_later(kept, firsts), "later-runs"))
    discard(kept)
    open_ = firsts.join(_shared(firsts, "shared-anchors").select("h"), "h")
    pieces = stored(_short_runs(docs, open_, length, long), "short-runs")
    discard(firsts)
    firsts = stored(_collapsed(pieces, "left", "right"), "different-short-runs")
    found.append(stored(_later(pieces, firsts), "later-short-runs"))
    discard(pieces)
    shared = _shared(firsts, "shared-long-anchors")
    open_ = stored(firsts.join(shared, "h"), "runs-to-sort")
    found.append(_repeats_by_sorting(open_.where(F.col("runs") <= MOST_RUNS), length, long))
    hot = open_.where(F.col("runs") > MOST_RUNS)
    if not hot.isEmpty():
        found.append(_repeats_by_string(hot, length, long))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc, fp, runs per text that loses bytes: the packed places of its repeated strings."""
    found = repeats(docs, length)
    return stored(found.groupBy("doc", "fp").agg(F.collect_list("at").alias("runs")), "repeated-spans")


def removed(size: int, places: np.ndarray, length: int) -> np.ndarray:
    """Mask of the bytes of a text that lie in a repeated string."""
    offset = (places >> COUNT_BITS) & ((1 << OFFSET_BITS) - 1)
    ends = offset + (places & ((1 << COUNT_BITS) - 1)) - 1 + length
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, offset, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def apply(docs: DataFrame, found: DataFrame, columns, schema: str, length: int = LENGTH) -> DataFrame:
    """doc_id and what ``columns`` makes of the bytes of every text and the mask of those that go (None: none)."""
    rows = docs.select("doc_id", text_hash(F.col("text")).alias("_fp"), F.col("text"))
    rows = rows.join(
        found.hint("merge"), (F.col("doc_id").cast("long") == F.col("doc")) & (F.col("_fp") == F.col("fp")), "left"
    ).select("doc_id", "text", "runs")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts, lists = _binary(batch.column("text")), batch.column("runs")
            masks = [removed(len(t), p.values.to_numpy(), length) if p.is_valid else None for t, p in zip(texts, lists)]
            made = columns(texts, masks)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made.values()], names=["doc_id", *made])

    return rows.mapInArrow(run, f"doc_id {kind}, {schema}")


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""

    def columns(texts, masks):
        n_removed, n_spans, kept = [], [], []
        for text, mask in zip(texts, masks):
            if mask is None:
                n_removed.append(0)
                n_spans.append(0)
                kept.append(hashlib.sha256(text).hexdigest())
            else:
                n_removed.append(int(mask.sum()))
                n_spans.append(int((mask[1:] & ~mask[:-1]).sum() + mask[:1].sum()))
                kept.append(hashlib.sha256(np.frombuffer(text, np.uint8)[~mask].tobytes()).hexdigest())
        return {
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(kept, pa.string()),
        }

    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return apply(docs, spans(docs, length), columns, schema, length)
