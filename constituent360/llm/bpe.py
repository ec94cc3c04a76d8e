"""Byte-level BPE encoding and decoding with given ranks.

A text is cut into pieces by the tokenizer's pattern; pieces that occur more than once in a batch are encoded once. The
distinct pieces are dealt into buckets by length, and each bucket is a padded matrix of ranks with a row per piece. In every
round each row merges its leftmost pair of least rank: pairs are looked up in an open hash table held in arrays, the
merged row closes up by one place, and rows without a pair that merges leave the matrix. A piece longer than the widest bucket
would need as many rounds over as many places as it has bytes, so it is merged over a heap instead, with the same result.

Defined cases: a null text counts as empty and has no ids; rows stay one for one; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Widths of the buckets, in bytes; longer pieces take the heap.
WIDTHS = (2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256)
#: Rows of one matrix at most.
ROWS = 1 << 15
NONE = np.iinfo(np.int32).max
MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank from lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in data.splitlines() if x.strip())}


class Codec:
    """Ranks as arrays: pairs of ranks in a hash table, token bytes in one buffer with offsets."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.pattern = regex.compile(pattern)
        size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.ranks = ranks
        lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.lengths, self.offsets = lengths, np.concatenate([[0], np.cumsum(lengths)])
        self.buffer = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.byte_rank = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = (np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64)
        self._hash(keys, np.array(merged, np.int32))
        self.pairs = dict(zip(keys.tolist(), merged))
        self.known: dict[str, np.ndarray] = {}

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing: every round places the keys whose slot is free."""
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.iinfo(np.uint64).max, np.uint64)
        self.values = np.full(1 << bits, NONE, np.int32)
        slot, left = ((keys * MIX) >> self.shift).astype(np.int64), np.arange(len(keys))
        self.probes = 0
        while len(left):
            self.probes += 1
            free = self.keys[slot[left]] == np.iinfo(np.uint64).max
            _, first = np.unique(slot[left], return_index=True)
            winners = np.zeros(len(left), bool)
            winners[first] = True
            put = left[free & winners]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = left[~(free & winners)]
            slot[left] = (slot[left] + 1) & self.mask

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or NONE; a negative rank is padding."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = ((keys * MIX) >> self.shift).astype(np.int64)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != np.iinfo(np.uint64).max))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != np.iinfo(np.uint64).max)]
        return out

    def _bucket(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of every piece of at most ``width`` bytes."""
        n = len(pieces)
        lengths = np.array([len(p) for p in pieces], np.int64)
        rows = np.full((n, width), -1, np.int32)
        rows[np.arange(width)[None, :] < lengths[:, None]] = self.byte_rank[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((n, width), NONE, np.int32)
        pair = np.arange(width - 1)[None, :] < (lengths - 1)[:, None]
        ranks[:, :-1][pair] = self.pair_ranks(rows[:, :-1][pair], rows[:, 1:][pair])
        out: list = [None] * n
        ids = np.arange(n)
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(ids)), at]
            done = best == NONE
            if done.any():
                for i, row, size in zip(ids[done].tolist(), rows[done], lengths[done].tolist()):
                    out[i] = row[:size].copy()
                live = ~done
                ids, rows, ranks, lengths, at, best = ids[live], rows[live], ranks[live], lengths[live], at[live], best[live]
                if not len(ids):
                    return out
            n_live, here = np.arange(len(ids)), at[:, None]
            # close up: what stands right of the merged pair moves one place to the left
            shifted = np.arange(width)[None, :] > here
            rows[:, :-1] = np.where(shifted[:, :-1], rows[:, 1:], rows[:, :-1])
            ranks[:, :-1] = np.where(shifted[:, :-1], ranks[:, 1:], ranks[:, :-1])
            rows[n_live, at] = best
            lengths -= 1
            ends = lengths[:, None] <= np.arange(width)[None, :]
            rows[ends] = -1
            ranks[lengths[:, None] - 1 <= np.arange(width)[None, :]] = NONE
            has = np.flatnonzero(at + 1 < lengths)
            ranks[has, at[has]] = self.pair_ranks(rows[has, at[has]], rows[has, at[has] + 1])
            has = np.flatnonzero(at > 0)
            ranks[has, at[has] - 1] = self.pair_ranks(rows[has, at[has] - 1], rows[has, at[has]])
            width = max(2, int(lengths.max()))
            rows, ranks = rows[:, :width], ranks[:, :width]

    def _long(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece: merges in order of (rank, place) from a heap over a linked list."""
        ids = self.byte_rank[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        find = lambda i: self.pairs.get((ids[i] << 32) | ids[after[i]]) if after[i] < n else None
        heap = [(r, i) for i in range(n - 1) if (r := find(i)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if ids[i] < 0 or find(i) != rank:
                continue
            gone = after[i]
            ids[i], ids[gone] = rank, -1
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            for j in (before[i], i):
                if j >= 0 and (r := find(j)) is not None:
                    heapq.heappush(heap, (r, j))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list = [None] * len(pieces)
        lengths = np.array([len(p) for p in pieces])
        low = 1
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)  # a piece that is a token is that token, even if no merges lead to it
            if whole is not None:
                out[i], lengths[i] = np.array([whole], np.int32), 0
        for width in WIDTHS:
            chosen = np.flatnonzero((lengths > low) & (lengths <= width)).tolist()
            for start in range(0, len(chosen), ROWS):
                part = chosen[start : start + ROWS]
                for i, ids in zip(part, self._bucket([pieces[i] for i in part], width)):
                    out[i] = ids
            low = width
        for i in np.flatnonzero(lengths > low).tolist():
            out[i] = self._long(pieces[i])
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        index: dict[str, int] = {}
        streams = []
        for text in texts:
            found = self.pattern.findall(text)
            streams.append(np.fromiter((index.setdefault(p, len(index)) for p in found), np.int64, len(found)))
        ids = self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in index])
        sizes = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        starts = np.cumsum(sizes) - sizes
        return [flat[_ranges(starts[s], sizes[s])] for s in streams]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.buffer[_ranges(self.offsets[:-1][ids], self.lengths[ids])].tobytes()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


#: Characters of the texts that are encoded together.
BATCH_CHARS = 4_000_000


def _slices(values: list):
    start, chars = 0, 0
    for i, value in enumerate(values):
        size = len(value or ())
        if chars and chars + size > BATCH_CHARS:
            yield start, i
            start, chars = i, 0
        chars += size
    if start < len(values):
        yield start, len(values)


_CODECS: dict[tuple[bytes, str], Codec] = {}


class Vocabulary:
    """A rank file's content and the pattern, as they go to the tasks; each Python worker builds its codec once."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.data = file.read()
        self.pattern = pattern

    def codec(self) -> Codec:
        key = (hashlib.sha256(self.data).digest(), self.pattern)
        if key not in _CODECS:
            _CODECS[key] = Codec(read_ranks(self.data), self.pattern)
        return _CODECS[key]


def _mapped(rows: DataFrame, keep: tuple[str, ...], given: str, vocabulary: Vocabulary, columns, schema: str) -> DataFrame:
    """``keep`` columns and what ``columns`` makes of the codec and a batch's values of ``given``."""
    names = [f"c{i}" for i in range(len(keep))]
    rows = rows.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(given).alias("given"))
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        own = shared.value.codec()
        for batch in batches:
            values = batch.column("given").to_pylist()
            for start, end in _slices(values):
                made = columns(own, values[start:end])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n).slice(start, end - start) for n in names], *made.values()], names=[*names, *made]
                )

    kinds = "".join(f"{n} {rows.schema[n].dataType.simpleString()}, " for n in names)
    out = rows.mapInArrow(run, kinds + schema)
    added = [c for c in out.columns if c not in names]
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], *added)


def encoded(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ids (array<int>) of every row's text."""
    return _mapped(
        docs, keep, "text", vocabulary,
        lambda own, texts: {"ids": pa.array(own.encode([t or "" for t in texts]), pa.list_(pa.int32()))}, "ids array<int>",
    )


def decoded(rows: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and bytes (binary) of every row's ids; null ids give no bytes."""
    return _mapped(
        rows, keep, "ids", vocabulary,
        lambda own, ids: {"bytes": pa.array([own.decode(np.array(x or [], np.int64)) for x in ids], pa.binary())}, "bytes binary",
    )


def digests(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 (of the decoded ids) of every row: encodes and decodes in one pass."""

    def columns(own, texts):
        ids = own.encode([t or "" for t in texts])
        return {
            "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(own.decode(x)).hexdigest() for x in ids], pa.string()),
        }

    return _mapped(docs, keep, "text", vocabulary, columns, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def tokenized(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_tokens, ids and exact (the ids decode to the bytes of the text) of every row."""

    def columns(own, texts):
        texts = [t or "" for t in texts]
        ids = own.encode(texts)
        return {
            "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
            "ids": pa.array(ids, pa.list_(pa.int32())),
            "exact": pa.array([own.decode(x) == t.encode("utf-8", "surrogatepass") for x, t in zip(ids, texts)], pa.bool_()),
        }

    return _mapped(docs, keep, "text", vocabulary, columns, "n_tokens bigint, ids array<int>, exact boolean")
