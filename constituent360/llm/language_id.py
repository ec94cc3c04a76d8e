"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed against it greedily: the longest
piece that occurs in the labelled text is one phrase, and the next phrase starts behind it. The language that
needs the fewest phrases, times the bits that one phrase costs (the logarithm of the labelled length), per letter wins.

The automata's transitions are one table of displaced rows, so numpy parses many texts in step: texts are cut into blocks of ``BLOCK``
symbols, every block is parsed by itself (a block's end also ends a phrase), and one table look-up moves all blocks
and all languages forward by a symbol. Text is reduced to lower-case letters with single separators.

Labelled text is a bounded sample: per language at most ``per_language`` documents, picked by a hash of the id, and
``passage`` characters from a place in each that the hash gives, so one very long document can't fill the driver.
Everything else runs over all texts, whole.

Defined cases: a null text or one without a letter is ``und`` with score 0; so is every text when nothing is labelled;
ties go to the language that sorts first; a letter that no label shows is a phrase of its own; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constituent360.llm.common import few_of_each

BLOCK = 256
#: Characters that one step of the parser works on at most, unless one text is longer.
BATCH_CHARS = 2_000_000
UNKNOWN, SEPARATOR = 1, 0
#: The lower half of an entry.
NEXT = (1 << 32) - 1
#: Bits are divided by this before they are turned into a confidence, since letters in a text depend on each other.
TEMPER = 16.0


def labelled_sample(docs: DataFrame, per_language: int = 400, passage: int = 250) -> dict[str, list[str]]:
    """Passages by language; ``docs`` holds the rows one may learn from."""
    at = F.pmod(F.xxhash64("doc_id"), F.greatest(F.char_length("text") - passage, F.lit(1))).cast("int") + 1
    known = docs.where(F.col("lang").isNotNull() & F.rlike("text", F.lit(r"\p{L}")))
    rows = (
        few_of_each(known.select("doc_id", "lang", F.substring(F.col("text"), at, F.lit(passage)).alias("passage")), "lang", per_language)
        .orderBy("lang", F.xxhash64("doc_id"), "doc_id", "passage")
        .collect()
    )
    sample = defaultdict(list)
    for row in rows:
        sample[row["lang"]].append(row["passage"])
    return dict(sample)


def symbol_table(texts: list[str]) -> np.ndarray:
    """Code point -> symbol: separators 0, letters that are not in ``texts`` 1, the others from 2."""
    letters = sorted({c for t in texts for c in t.lower() if c.isalpha()})
    ids = {c: i + 2 for i, c in enumerate(letters)}
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            table[point] = ids.get(c.lower()[0], UNKNOWN)
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """The text's symbols with runs of separators made one."""
    seq = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if len(seq) == 0:
        return seq
    keep = seq != SEPARATOR
    keep[1:] |= seq[:-1] != SEPARATOR
    return seq[keep]


def suffix_automaton(seq: list[int]) -> list[dict[int, int]]:
    """The transitions of the automaton that accepts every substring of ``seq``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in seq:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at != -1 and symbol not in moves[at]:
            moves[at][symbol] = new
            at = link[at]
        if at != -1:
            to = moves[at][symbol]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at != -1 and moves[at].get(symbol) == to:
                    moves[at][symbol] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return moves


def displaced(rows: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, entries): the rows of a sparse transition table laid over each other in one array.

    The state in row i is named places[i], and no two share a name. Its move on symbol x is entries[places[i] + x]: the
    state's name in the upper 32 bits, which tells whether the entry is its own, and the next state's name in the lower ones. The
    array's size follows the number of moves (about one and a half times), whatever the width.
    """
    degree = np.fromiter(map(len, rows), np.int64, len(rows))
    size = 2 * int(degree.sum()) + 2 * len(rows) + 2 * width + 256
    free, unnamed = np.ones(size + width, bool), np.ones(size, bool)
    places = np.full(len(rows), -1, np.int64)
    window, start, last = np.arange(256), 0, -1
    for i in np.argsort(-degree, kind="stable").tolist():
        if degree[i] < 2:
            break
        if degree[i] != last:
            start, last = 0, degree[i]
        symbols = np.fromiter(rows[i], np.int64, degree[i])
        while True:  # the first place where all its moves fall into gaps
            at = start + window
            fit = unnamed[at] & free[at[:, None] + symbols].all(axis=1)
            if fit.any():
                break
            start += len(window)
        places[i] = start + int(fit.argmax())
        unnamed[places[i]] = False
        free[places[i] + symbols] = False
    # a single move can go to any gap
    left = np.flatnonzero(degree == 1)
    symbol = np.fromiter((next(iter(rows[i])) for i in left.tolist()), np.int64, len(left))
    order = np.argsort(-symbol, kind="stable")  # gaps rise and symbols fall, so that names differ
    left, symbol = left[order], symbol[order]
    skipped = width
    while len(left):
        gaps = np.flatnonzero(free[skipped:size])[: len(left)] + skipped
        if not len(gaps):
            more = len(left) + width
            free, unnamed, size = np.append(free, np.ones(more, bool)), np.append(unnamed, np.ones(more, bool)), size + more
            continue
        name = gaps - symbol[: len(gaps)]
        _, once = np.unique(name, return_index=True)
        taken = once[unnamed[name[once]]]
        places[left[taken]] = name[taken]
        unnamed[name[taken]], free[gaps[taken]] = False, False
        rest = np.ones(len(left), bool)
        rest[taken] = False
        left, symbol = left[rest], symbol[rest]
        skipped = skipped if len(taken) else int(gaps[-1]) + 1
    none = np.flatnonzero(degree == 0)
    places[none] = np.flatnonzero(unnamed)[: len(none)]
    entries = np.full(int(places.max()) + width + 1, -1, np.int64)
    owner = np.repeat(places, degree)
    symbol = np.fromiter((x for row in rows for x in row), np.int64, len(owner))
    target = np.fromiter((x for row in rows for x in row.values()), np.int64, len(owner))
    entries[owner + symbol] = (owner << 32) | places[target]
    return places, entries


class Model:
    """Automata of all languages in one displaced table of transitions.

    Where an automaton has no move, a phrase ends and the next one starts with this symbol, from the start state.
    """

    def __init__(self, sample: dict[str, list[str]]):
        self.languages = sorted(sample)
        self.table = symbol_table([t for texts in sample.values() for t in texts])
        self.width = int(self.table.max()) + 1 if self.languages else 2
        parts, starts, bits, base = [], [], [], 0
        for name in self.languages:
            seq = np.concatenate([symbols(t + " ", self.table) for t in sample[name]]).tolist()
            places, entries = displaced(suffix_automaton(seq), self.width)
            parts.append(np.where(entries < 0, entries, entries + ((base << 32) | base)))
            starts.append(base + int(places[0]))
            bits.append(math.log2(len(seq) + 1))
            base += len(entries)
        self.entries = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.starts, self.bits = np.array(starts, np.int64), np.array(bits)
        own = self.starts[:, None]
        first = self.entries[own + np.arange(self.width)] if parts else np.zeros((0, self.width), np.int64)
        self.first = np.where(first >> 32 == own, first & NEXT, own)  # a letter that no label shows stays at the start

    def phrases(self, blocks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases per language and block; ``blocks`` is a matrix with a row per block."""
        order = np.argsort(-lengths, kind="stable")
        ends = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(blocks.shape[1]), side="right")
        steps = np.ascontiguousarray(blocks[order].T).astype(np.int64)
        out = np.empty((len(self.starts), len(lengths)), np.int32)
        for i, start in enumerate(self.starts.tolist()):
            state, count, first = np.full(len(lengths), start), np.zeros(len(lengths), np.int32), self.first[i]
            for step, end in zip(steps, ends.tolist()):
                here, symbol = state[:end], step[:end]
                entry = self.entries[here + symbol]
                ended = entry >> 32 != here
                entry &= NEXT
                np.copyto(entry, first[symbol], where=ended)
                count[:end] += ended
                state[:end] = entry
            out[i, order] = count
        return out

    def classify(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        seqs = [symbols(t, self.table) for t in texts]
        lengths = np.array([len(s) for s in seqs], np.int64)
        letters = np.array([int((s != SEPARATOR).sum()) for s in seqs], np.int64)
        names, score = ["und"] * len(texts), np.zeros(len(texts))
        if not self.languages or not letters.any():
            return names, score
        n_blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(seqs)), n_blocks)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        size = np.minimum(lengths[owner] - inside * BLOCK, BLOCK)
        blocks = np.zeros((len(owner), BLOCK), np.uint32)
        blocks[np.arange(BLOCK)[None, :] < size[:, None]] = np.concatenate(seqs)
        total = np.zeros((len(self.languages), len(seqs)))
        np.add.at(total, (slice(None), owner), self.phrases(blocks, size))
        bits = total * self.bits[:, None]
        best = bits.argmin(axis=0)
        share = np.exp2(-np.minimum((bits - bits.min(axis=0)) / TEMPER, 1000))
        share = share.max(axis=0) / share.sum(axis=0)
        for i in np.flatnonzero(letters):
            names[i] = self.languages[best[i]]
            score[i] = share[i]
        return names, score


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about BATCH_CHARS characters."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t) > BATCH_CHARS:
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred and score of every row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col("text").alias("text"))

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for start, end in slices(texts):
                pred, score = shared.value.classify(texts[start:end])
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(n).slice(start, end - start) for n in names], pa.array(pred, pa.string()), pa.array(score)],
                    names=[*names, "lang_pred", "score"],
                )

    kinds = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names))
    out = rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "lang_pred", "score")


def recognised(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows whose text has no letter; a null lang is filled in. Texts whose languages tie stay, however many
    languages there are."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    found = identify(rows, model, keep=("row",)).where(F.col("lang_pred") != "und")
    own = {c: F.col("row")[c] for c in docs.columns}
    own["lang"] = F.coalesce(own["lang"], F.col("lang_pred"))
    return found.select(*[x.alias(c) for c, x in own.items()])


def trained(docs: DataFrame, folds: int = 3, held_out: int = 1, **settings) -> Model:
    """A model of the rows whose crc32 of the id, modulo ``folds``, is not ``held_out``."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("doc_id").isNotNull() & ~is_held_out(folds, held_out))
    return Model(labelled_sample(rows, **settings))


def is_held_out(folds: int, held_out: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held_out, F.lit(False))
