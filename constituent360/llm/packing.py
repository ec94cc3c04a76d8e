"""Vector best-fit packing of tokenized documents into sequences of bounded length.

A document's ids are cut into pieces of at most one sequence; if a document is longer, its first piece takes what is left over, so that
all others fill a sequence by themselves. Pieces are dealt into shards by a hash, longest first within a shard. A bin has three
residual capacities: tokens, documents, and attention cost (the sum of squared lengths). A piece goes to the bin that can take it under
all three and, by rule, leaves the smallest weighted norm of residuals ("norm") or has the largest weighted
product of demand and residual among the fullest ("dot"); if there is none, a new bin is opened. A shard has some ``SHARD_PIECES``
pieces whatever the size of the table, and costs at most about one partly filled bin.

Texts meet the vocabulary through the tiktoken library, which gives the ids of the tokenizers library several times as
fast (tests compare the two); only texts with a very long run without a break go through the latter, whose time does not grow with the
square of a run. Strings of special tokens are ordinary text.

Defined cases: a null text is empty and has only the end token; rows that repeat an id, and rows without id, are documents of
their own; a piece that exceeds the document or attention capacity of an empty bin is an error of the caller's capacities and raises; an
empty table has no piece; other columns are ignored by ``pieces`` and kept by ``pack``.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from constituent360.llm.common import fresh

SHARD_PIECES = 8192
#: Runs of non-blanks or blanks beyond this length go through the tokenizers library.
LONG_RUN = re.compile(r"\S{2000}|\s{2000}")


@dataclass(frozen=True)
class Vocabulary:
    """The same vocabulary for both libraries."""

    ranks: str
    tokenizer: str
    pattern: str
    end: int = 2

    def encoder(self):
        """A function from a text to its ids."""
        import tiktoken
        from tokenizers import Tokenizer

        with open(self.ranks, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        whole = Tokenizer.from_file(self.tokenizer)
        whole.encode_special_tokens = True

        def ids(text: str) -> list[int]:
            if LONG_RUN.search(text):
                return whole.encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        return ids


@dataclass(frozen=True)
class Capacities:
    """What a sequence can take. Every piece has a token, so by default neither documents nor attention cost bind
    before the tokens do."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = field(default=(1.0, 0.05, 0.2))
    rule: str = "norm"


def pieces(docs: DataFrame, vocabulary: Vocabulary, most: int = 1024) -> DataFrame:
    """doc_id, row (a number that tells rows with equal ids apart), piece, start, length, ids (little-endian 32-bit numbers)."""

    def run(batches: Iterator[pa.RecordBatch]):
        encode = vocabulary.encoder()
        names = ["doc_id", "row", "piece", "start", "length", "ids"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        out, held = [], 0
        for batch in batches:
            for doc_id, row, text in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "row", "text")]):
                ids = np.array([*encode(text or ""), vocabulary.end], "<u4")
                ends = list(range(len(ids), 0, -most))[::-1]  # the first piece takes the rest
                for piece, (start, end) in enumerate(zip([0, *ends], ends)):
                    out.append((doc_id, row, piece, start, end - start, ids[start:end].tobytes()))
                held += len(ids)
                if held > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    return slim.mapInArrow(run, "doc_id long, row long, piece int, start long, length long, ids binary")


def best_fit(lengths: np.ndarray, capacities: Capacities) -> tuple[np.ndarray, np.ndarray]:
    """bin and offset of every piece; ``lengths`` descend."""
    n, limit = len(lengths), np.array([capacities.tokens, capacities.documents, capacities.attention], float)
    weights = np.array(capacities.weights) / limit**2
    left = np.empty((3, n))  # residual capacities of the open bins
    name, opened, made = np.empty(n, np.int64), 0, 0
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    least = int(lengths[-1]) if n else 0
    for i, length in enumerate(lengths.tolist()):
        demand = np.array([length, 1.0, float(length) ** 2])
        if (demand > limit).any():
            raise ValueError(f"a piece of {length} tokens does not fit into an empty sequence")
        own = left[:, :opened]
        fits = np.flatnonzero((own[0] >= demand[0]) & (own[1] >= 1) & (own[2] >= demand[2]))
        if len(fits):
            after = own[:, fits] - demand[:, None]
            if capacities.rule == "norm":
                at = fits[np.argmin(weights @ after**2)]
            else:  # the closer the direction of demand and residual, the better: their product over the residual's norm
                residual = own[:, fits]
                at = fits[np.argmax((weights * demand) @ residual / (weights @ residual**2))]
        else:
            at, opened, made = opened, opened + 1, made + 1
            left[:, at], name[at] = limit, made - 1
        bins[i], offsets[i] = name[at], capacities.tokens - left[0, at]
        left[:, at] -= demand
        if left[0, at] < least or left[1, at] < 1 or left[2, at] < least**2:  # nothing that follows can fit
            opened -= 1
            left[:, at], name[at] = left[:, opened], name[opened]
    return bins, offsets


def pack(table: DataFrame, capacities: Capacities = Capacities(), shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """All columns of the pieces with sequence_id and offset (the place in the sequence, without gaps)."""
    n = table.count()
    shards = max(1, math.ceil(n / shard_pieces))
    shard = fresh(table, "shard")
    dealt = table.withColumn(shard, F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    in_order = dealt.repartition(shards, shard).sortWithinPartitions(shard, F.col("length").desc(), "row", "piece")

    def run(batches):
        held, current = [], None

        def packed():
            together = pa.Table.from_batches(held)
            bins, offsets = best_fit(together.column("length").to_numpy(), capacities)
            number = current * (1 << 32) + bins
            together = together.drop_columns([shard]).append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offsets))
            held.clear()
            return together.to_batches()

        for batch in batches:
            numbers = batch.column(shard).to_numpy()
            starts = np.flatnonzero(np.diff(numbers, prepend=numbers[:1] - 1))
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(numbers)]):
                if held and numbers[start] != current:
                    yield from packed()
                current = int(numbers[start])
                held.append(batch.slice(start, end - start))
        if held:
            yield from packed()

    kept = [f for f in table.schema.fields if f.name not in ("sequence_id", "offset")]
    schema = StructType([*kept, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return in_order.select(*[f.name for f in kept], shard).mapInArrow(run, schema)
