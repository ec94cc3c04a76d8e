"""Toxicity by compression distance with two zstandard dictionaries.

Both dictionaries hold the same ordinary text; the toxic one ends with the passages that set toxic training text apart:
the byte strings of words that toxic documents have far more often than ordinary ones. Every text is cut into
overlapping windows, each is compressed with either dictionary, and the differences of the lengths are summed up per text
(their mean, their positive part, the shares of windows past some thresholds, the largest ones). A logistic model, fitted
on labelled documents that the dictionaries have not seen, turns these into a score; it is shifted so that the cut with
the best F1 at the labels' own balance lies at ``CUT``.

Labels are learned from a bounded sample: at most ``per_class`` documents a class, picked by a hash of the id, and
``passage`` characters from a place in each that the hash gives. All texts are scored whole.

Defined cases: a null text counts as empty, and empty texts get the score of no difference; with only one class labelled
the score is 0 or 1 for all; other columns, labels with a null and repeated label rows are ignored.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constituent360.llm.common import few_of_each

WINDOW, STRIDE, LEVEL = 128, 112, 9
CUT = 0.3
#: Bytes of ordinary text in either dictionary.
ORDINARY_BYTES = 48_000
LONGEST = 10
STEPS = (1, 2, 3, 4, 6)
WORDS = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = 900, passage: int = 4000) -> tuple[list, dict]:
    """(toxic, passage) of the sample, and the number of labelled documents by class."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    # the labels are picked before any text is read: at most per_class rows a class, safe to send to every task
    picked = few_of_each(known, "toxic", per_class).select(F.col("doc_id").alias("_of"), F.col("toxic").alias("_toxic"))
    at = F.xxhash64("doc_id")
    start = F.pmod(at, F.greatest(F.char_length("text") - passage, F.lit(1))).cast("int") + 1
    rows = (
        docs.select("doc_id", "text").where(F.col("text") != "")
        .join(F.broadcast(picked), F.col("doc_id") == F.col("_of"))
        .select("_toxic", at.alias("_at"), "doc_id", F.substring(F.col("text"), start, F.lit(passage)).alias("passage"))
        .orderBy("_toxic", "_at", "doc_id", "passage")
        .collect()
    )
    return [(r["_toxic"], r["passage"]) for r in rows], totals


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def _pieces(data: bytes) -> set[bytes]:
    """The strings of 4 to LONGEST bytes of all words, with a blank before and behind each word."""
    out = set()
    for word in set(WORDS.findall(data)):
        word = b" " + word + b" "
        for size in range(4, LONGEST + 1):
            out.update(word[i : i + size] for i in range(len(word) - size + 1))
    return out


def distinctive(toxic: list[bytes], ordinary: list[bytes], odds: float = 3.5, share: float = 0.02) -> list[bytes]:
    """Strings that a ``share`` of toxic passages hold and that are exp(odds) times rarer in ordinary ones."""
    in_toxic, in_ordinary = Counter(), Counter()
    for data in toxic:
        in_toxic.update(_pieces(data))
    least = max(2, share * len(toxic))
    likely = {p for p, n in in_toxic.items() if n >= least and len(p) >= 5}
    for data in ordinary:
        in_ordinary.update(_pieces(data) & likely)
    ratio = (len(ordinary) + 1) / (len(toxic) + 1)
    weight = {p: math.log((in_toxic[p] + 0.5) * ratio / (in_ordinary[p] + 0.5)) for p in likely}
    kept: list[bytes] = []
    for piece in sorted((p for p in likely if weight[p] > odds), key=lambda p: (-in_toxic[p] * weight[p], -len(p), p)):
        # a string that shares four bytes with a stronger one would only add its ordinary rest
        if not any(piece[i : i + 4] in k for i in range(len(piece) - 3) for k in kept):
            kept.append(piece)
    return kept


class Model:
    """The two dictionaries and the logistic model on the differences."""

    def __init__(self, sample: list[tuple[int, str]], totals: dict[int, int], seed: int = 7):
        rows = [(int(t == 1), lowered(x)) for t, x in sample]
        random.Random(seed).shuffle(rows)
        self.constant = None
        if len({t for t, _ in rows}) < 2:
            self.constant = float(rows[0][0]) if rows else 0.0
            return
        fit, rest = [], []
        for kind in (0, 1):  # two of three documents of a class go into the dictionaries
            own = [x for t, x in rows if t == kind]
            cut = max(1, len(own) * 2 // 3) if len(own) > 1 else 1
            fit.append(own[:cut])
            rest += [(kind, x) for x in (own[cut:] or own)]
        words = [w for x in fit[0] for w in x.split()]
        random.Random(seed).shuffle(words)
        base = b" ".join(words)[:ORDINARY_BYTES] + b" "
        self.ordinary, self.toxic = base, base + b"".join(reversed(distinctive(fit[1], fit[0])))
        x = np.array([self.features(d) for _, d in rest])
        y = np.array([t for t, _ in rest], float)
        n = {k: totals.get(k, 0) for k in (0, 1)}
        weight = np.where(y == 1, n[1] / max(1, y.sum()), n[0] / max(1, (1 - y).sum()))
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        self.coef = _logistic((x - self.mean) / self.scale, y, weight / weight.mean())
        logit = self.logits(x)
        self.coef[0] += math.log(CUT / (1 - CUT)) - _best_cut(logit, y, weight)

    def compressors(self):
        if "_made" not in self.__dict__:
            make = lambda data: zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            self._made = make(self.ordinary), make(self.toxic)
        return self._made

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_made"}

    def differences(self, data: bytes) -> np.ndarray:
        """By how many bytes the toxic dictionary compresses each window better than the ordinary one."""
        plain, toxic = (c.compress for c in self.compressors())
        windows = [data[i : i + WINDOW] for i in range(0, max(1, len(data) - (WINDOW - STRIDE)), STRIDE)]
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows], float)

    def features(self, data: bytes) -> list[float]:
        if not data:
            return [0.0] * (len(STEPS) + 5)
        d = self.differences(data)
        top = np.sort(d)[-3:]
        return [
            d.mean(), np.clip(d - 1, 0, None).mean(), *[(d >= s).mean() for s in STEPS],
            top[-1], top.mean(), math.log1p((d >= 3).sum()),
        ]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.coef[0] + ((x - self.mean) / self.scale) @ self.coef[1:]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x = np.array([self.features(lowered(t)) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Intercept and coefficients by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    coef, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty @ coef
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, slope)
        coef += step
        if np.abs(step).max() < 1e-8:
            break
    return coef


def _best_cut(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the gap at which predicting 1 above it has the best weighted F1."""
    order = np.argsort(-logit, kind="stable")
    true = np.cumsum((weight * y)[order])
    f1 = 2 * true / (np.cumsum(weight[order]) + (weight * y).sum())
    s = logit[order]
    f1[:-1][s[:-1] == s[1:]] = -1  # a cut can't part equal scores
    i = int(f1.argmax())
    return float((s[i] + s[i + 1]) / 2) if i + 1 < len(s) else float(s[i] - 1e-6)


def is_held_out(folds: int = 4, held_out: int = 2):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held_out, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, **settings) -> Model:
    """A model of the labelled rows that are not held out."""
    return Model(*labelled_sample(docs, labels.where(~is_held_out() & F.col("doc_id").isNotNull()), **settings))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and score of every row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col("text").alias("text"))

    def run(batches):
        for batch in batches:
            scores = shared.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(scores)], names=[*names, "score"])

    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    out = rows.mapInArrow(run, f"{kinds}, score double")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "score")
