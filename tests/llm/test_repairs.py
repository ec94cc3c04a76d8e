"""Repeated and null ids, tied documents, alphabets of any size, and the language model against a slow one."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from constituent360.llm import language_id, mixing, suffix_dedup


# ---- mixing


@pytest.mark.parametrize("ids", ["different", "same", "null"])
@pytest.mark.parametrize("texts", ["different", "same"])
def test_targets_are_met_whatever_the_ids(spark, ids, texts):
    i = {"different": F.col("id"), "same": F.lit(7).cast("long"), "null": F.lit(None).cast("long")}[ids]
    text = F.concat(F.lit("one two three four five six seven eight nine "), F.col("id").cast("string") if texts == "different" else F.lit("x"))
    a = spark.range(4000).select(i.alias("doc_id"), text.alias("text"), F.lit("a").alias("source"))
    b = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("two words").alias("text"), F.lit("b").alias("source"))
    mixed = mixing.mix(a.unionByName(b).repartition(5)).groupBy("row.source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max(F.col("taken") - 2 * F.col("size")).alias("over"), F.count("*").alias("n"))
    rows = {r["source"]: r for r in mixed.collect()}
    assert rows["a"]["n"] == 4000 and abs(rows["a"]["taken"] - rows["a"]["target"]) <= 10
    assert rows["b"]["n"] == 1000 and abs(rows["b"]["taken"] - rows["b"]["target"]) <= 2
    assert all(r["over"] <= 0 for r in rows.values())


# ---- repeated strings


def repeats_by_order(rows, length):
    """``rows``: (id, text) in the order that the operator gives them."""
    first, out = set(), {}
    for i, text in rows:
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            string = data[p : p + length]
            if string in first:
                gone[p : p + length] = True
            first.add(string)
        out[i, text] = (len(data), int(gone.sum()), hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("bits", [64, 4])
def test_texts_of_one_id(spark, bits, monkeypatch):
    """Many texts of one id; with few bits of hash they only share an order, so the rows are kept apart by the full hash."""
    if bits < 64:
        monkeypatch.setattr(suffix_dedup, "text_hash", lambda text: F.xxhash64(text).bitwiseAND(F.lit(-16)))
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefgh ") for _ in range(130))
    passages = [word() for _ in range(40)]
    rows = [(1, word() + r.choice(passages) + word()[: r.randrange(60)]) for _ in range(3000)] + [(i, word() + r.choice(passages)) for i in range(2, 60)]
    rows += [(1, rows[0][1]), (1, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    hashes = dict(docs.select("text", suffix_dedup.text_hash(F.col("text"))).distinct().collect())
    want = repeats_by_order(sorted(set(rows), key=lambda x: (x[0], hashes[x[1]])), 100)
    found = collections.Counter((x["doc_id"], x["n_bytes"], x["n_removed"], x["kept_sha256"]) for x in suffix_dedup.digests(docs).collect())
    assert found == collections.Counter((row[0], *want[row]) for row in rows)


# ---- language


def slow_scores(model, sample, text):
    """Phrases counted by searching the labelled text, block by block."""
    own = language_id.symbols(text, model.table).tolist()
    bits = []
    for name in model.languages:
        known = "".join(chr(c) for t in sample[name] for c in language_id.symbols(t + " ", model.table).tolist())
        count = 0
        for at in range(0, len(own), language_id.BLOCK):
            block = "".join(map(chr, own[at : at + language_id.BLOCK]))
            start = 0
            for end in range(1, len(block) + 1):
                if block[start:end] not in known:
                    count += 1
                    start = end - 1 if block[end - 1] in known else end
        bits.append(count * math.log2(len(known) + 1))
    share = [2 ** -((b - min(bits)) / language_id.TEMPER) for b in bits]
    return model.languages[int(np.argmin(bits))], max(share) / sum(share)


def spoken(r, letters, n):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 6))) for _ in range(n))


def alphabets():
    r = random.Random(8)
    han = [chr(0x4E00 + i) for i in range(6000)]
    return {
        "zh": [spoken(r, r.sample(han, 900), 300) for _ in range(4)], "en": [spoken(r, "etaoinshr", 200) for _ in range(4)],
        "fi": [spoken(r, "aäiotnsek", 200) for _ in range(4)], "ru": [spoken(r, "оеаинтср", 200) for _ in range(3)],
    }


def test_predictions_and_scores_equal_a_slow_version():
    sample, r = alphabets(), random.Random(4)
    model = language_id.Model(sample)
    texts = ["", "12", "a", "И", "etaoin shr", "zzz qqq", "ä"] + [t[i : i + 700] for i in (3, 50) for own in sample.values() for t in own]
    texts += [spoken(r, "etaoinshrä", 90), spoken(r, "оеаинтсръ", 30), sample["zh"][0][:40] + " " + sample["en"][0][:90]]
    names, scores = model.classify(texts)
    for text, name, score in zip(texts, names, scores):
        if any(c.isalpha() for c in text):
            assert (name, pytest.approx(score)) == slow_scores(model, sample, text)
        else:
            assert (name, score) == ("und", 0.0)


def test_model_follows_the_labelled_text_not_the_alphabets():
    sample = alphabets()
    alone = language_id.Model({k: v for k, v in sample.items() if k in ("en", "fi")})
    among = language_id.Model(sample)
    n = sum(len(t) for own in sample.values() for t in own)
    assert among.width > 2000 and len(among.entries) < 8 * n + 8 * among.width
    text = spoken(random.Random(3), "etaoinshr", 400)
    own = [m.phrases(*blocks(m, text)).sum(axis=1)[m.languages.index("en")] for m in (alone, among)]
    assert own[0] == own[1]


def blocks(model, text):
    seq = language_id.symbols(text, model.table)
    size = language_id.BLOCK
    rows = [seq[i : i + size] for i in range(0, len(seq), size)]
    out = np.zeros((len(rows), size), np.uint32)
    for i, x in enumerate(rows):
        out[i, : len(x)] = x
    return out, np.array([len(x) for x in rows])


def test_tied_languages_stay(spark):
    """A letter that all of many languages know: no text with a letter is rejected."""
    model = language_id.Model({f"l{i}": ["a b c d e"] for i in range(9)})
    docs = spark.createDataFrame([(1, "A.", None), (2, "De.", "x"), (3, "99", None), (4, None, "y")], "doc_id long, text string, lang string")
    assert sorted(map(tuple, language_id.recognised(docs, model).collect())) == [(1, "A.", "l0"), (2, "De.", "x")]
