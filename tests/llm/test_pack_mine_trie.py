"""Packing, hard negatives and the prefix trie against brute-force versions, with every odd case that the docstrings define."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from constituent360.llm import hard_negatives, packing, prefix_trie

FILES = [public_tokenizers.path(f) for f in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")]
VOCABULARY = packing.Vocabulary(*FILES, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(FILES[1])
    t.encode_special_tokens = True
    return t


# ---- packing


def test_both_libraries_give_the_same_ids(tokenizer):
    encode = VOCABULARY.encoder()
    every = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["a".join(every[i : i + 500]) + " ".join(every[i : i + 500]) for i in range(0, len(every), 500)]
    texts += ["", "<|endoftext|> it's", "x" * 30_000, " " * 30_000 + "x", "\r\n \t\u00a0\u3000 1a_b", "ab" * 5000 + "!" * 5000]
    for text in texts:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


WIDE = "doc_id long, text string, row string, piece string, length string, shard string, sequence_id string, offset string"


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    word = lambda: "".join(r.choice("aeioustrn") for _ in range(r.randint(1, 9)))
    rows = [(i, " ".join(word() for _ in range(r.choice([3, 40, 150, 300, 900])))) for i in range(120)]
    return [*rows, (7, rows[7][1]), (7, "another"), (None, "no id"), (None, None), (500, ""), (501, None), (502, "z" * 9000), (503, " a" * 1023), (504, " a" * 1024)]


@pytest.fixture(scope="module")
def packed(spark, texts):
    docs = spark.createDataFrame([(*t, *["x"] * 6) for t in texts], WIDE).repartition(3)
    cut = packing.pieces(docs, VOCABULARY).cache()
    return cut, packing.pack(cut, shard_pieces=100).collect()


def test_pieces(packed, texts, tokenizer):
    by_row = collections.defaultdict(list)
    for r in packed[0].collect():
        by_row[r["row"]].append(r)
    found = collections.Counter()
    for rows in by_row.values():
        rows.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        assert [r["start"] for r in rows] == [sum(x["length"] for x in rows[:i]) for i in range(len(rows))]
        assert all(r["length"] == 1024 for r in rows[1:]) and 1 <= rows[0]["length"] <= 1024
        ids = b"".join(bytes(r["ids"]) for r in rows)
        found[(rows[0]["doc_id"], ids)] += 1
    want = [(i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in texts]
    assert found == collections.Counter(want)


def test_sequences_have_no_gap_and_are_full(packed):
    bins = collections.defaultdict(list)
    for r in packed[1]:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in bins.values():
        members.sort()
        assert [o for o, _ in members] == [sum(n for _, n in members[:i]) for i in range(len(members))]
        assert sum(n for _, n in members) <= 1024
    together, _ = best_fit_by_hand(sorted((r["length"] for r in packed[1]), reverse=True), packing.Capacities())
    assert len(packed[1]) == packed[0].count() and len(bins) <= together + 2  # one more for each of the two shards


def best_fit_by_hand(lengths, c):
    """The same rules over a plain list of bins."""
    limits, bins, out = (c.tokens, c.documents, c.attention), [], []
    for n in lengths:
        need = (n, 1, n * n)
        open_ = [b for b in bins if all(x >= y for x, y in zip(b, need))]
        if c.rule == "norm":
            rate = lambda b: -sum(w * ((x - y) / z) ** 2 for w, x, y, z in zip(c.weights, b, need, limits))
        else:
            rate = lambda b: sum(w * x * y / z**2 for w, x, y, z in zip(c.weights, b, need, limits)) / sum(
                w * (x / z) ** 2 for w, x, z in zip(c.weights, b, limits)
            )
        out.append(max(map(rate, open_), default=None))
        if open_:
            chosen = max(open_, key=rate)
        else:
            chosen = list(limits)
            bins.append(chosen)
        for i in range(3):
            chosen[i] -= need[i]
    return len(bins), sorted(map(tuple, bins))


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [(1024, 1024, 1024**2), (1024, 3, 1024**2), (1024, 8, 300_000), (50, 2, 2_500)])
def test_best_fit_holds_every_capacity(rule, limits):
    r = np.random.default_rng(3)
    c = packing.Capacities(*limits, weights=(1.0, 0.31, 0.17), rule=rule)
    most = min(limits[0], int(limits[2] ** 0.5))
    lengths = np.sort(r.integers(1, most + 1, 400))[::-1]
    bins, offsets = packing.best_fit(lengths, c)
    used = [lengths[bins == b] for b in range(bins.max() + 1)]
    assert all(u.sum() <= limits[0] and len(u) <= limits[1] and (u.astype(float) ** 2).sum() <= limits[2] for u in used)
    left = sorted((limits[0] - u.sum(), limits[1] - len(u), limits[2] - (u**2).sum()) for u in used)
    count, by_hand = best_fit_by_hand(lengths.tolist(), c)
    # bins with equal residuals are interchangeable, and ties may be broken either way
    assert abs(len(used) - count) <= 1 and abs(sum(x[0] for x in left) - sum(x[0] for x in by_hand)) <= limits[0]


def test_a_piece_beyond_a_capacity_is_an_error():
    with pytest.raises(ValueError, match="does not fit"):
        packing.best_fit(np.array([9]), packing.Capacities(tokens=8))


def test_no_documents(spark):
    cut = packing.pieces(spark.createDataFrame([], WIDE), VOCABULARY)
    assert packing.pack(cut).collect() == []


# ---- hard negatives


def vectors(n, width, seed, spread=40):
    r = np.random.default_rng(seed)
    return [(i, [float(x) for x in r.integers(-spread, spread, width) / 256], int(r.integers(0, 4))) for i in range(n)]


def whole(v):
    return [int(np.floor(np.float64(x) * 256)) if abs(x) < 2**40 else int(x) * 256 for x in v]


def mined_by_hand(rows, anchor):
    kept = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v):
            kept[i] = min(kept.get(i, (label, whole(v))), (label, whole(v)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, v) in kept.items():
        if a % anchor:
            continue
        scored = sorted((-dot(v, w), i, other) for i, (other, w) in kept.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            inside = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(a, p, rank, n, -s, -t) for rank, (t, n, _) in enumerate(inside[:10], 1)]
    return sorted(out)


def mined(spark, rows, anchor):
    wide = [(*r, "x", "y", -1) for r in rows]
    table = spark.createDataFrame(wide, "vec_id long, embedding array<float>, label int, v string, w string, rank long")
    sound = hard_negatives.labelled_vectors(table, F.col("label"))
    return sorted(tuple(r) for r in hard_negatives.mine(sound, F.col("vec_id") % anchor == 0).collect())


def test_hard_negatives(spark, monkeypatch):
    for name, value in (("LEAF", 8), ("SLAB_ROWS", 100), ("STRIP_ROWS", 150), ("LEAST_STRIP", 40), ("GROUP", 5), ("GROWTH", 1)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(600, 6, 1)
    rows += [(700 + i, [0.1] * 6, i % 3) for i in range(80)]  # one vector many times
    rows += [(800, None, 1), (None, [0.1] * 6, 1), (810, [0.1] * 6, None), (820, [0.1, None, 1.0, 1.0, 1.0, 1.0], 1), (830, [float("nan")] * 6, 1)]
    rows += [(840, [float("inf")] * 6, 1), (850, [0.5, 0.25], 2), (860, [], 2), (20, [0.3] * 6, 0), (20, [0.2] * 6, 0), (870, [0.0] * 6, 9)]
    want = mined_by_hand(rows, 10)
    assert len(want) > 1000 and mined(spark, rows, 10) == want


def test_hard_negatives_beyond_exact_doubles(spark):
    rows = vectors(60, 3, 2)
    rows += [(100 + i, [float(2**30 + 2**8 * i), float(2**30 - 2**9 * i), 1.0], i % 2) for i in range(12)]
    assert mined(spark, rows, 10) == mined_by_hand(rows, 10)


@pytest.mark.parametrize("rows", [[], [(0, [0.1], 1)], [(0, [], 1), (10, [], 1), (20, [], 2)], [(0, [0.5], 1), (1, [0.5], 1)]])
def test_few_hard_negatives(spark, rows):
    assert mined(spark, rows, 10) == mined_by_hand(rows, 10)


def test_boxes_bound_products():
    r = np.random.default_rng(4)
    points = r.integers(-50, 50, (40, 5)).astype(float)
    query = r.integers(-50, 50, 5).astype(float)
    least, most = hard_negatives.interval(query, points.min(axis=0)[None], points.max(axis=0)[None])
    assert (points @ query >= least[0]).all() and (points @ query <= most[0]).all()


# ---- prefix trie


def trie_by_hand(rows, splice=True):
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append(((turn is not None, turn or 0), role.encode(), digest, (role, text)))
    own = {c: [x[3] for x in sorted(t)] for c, t in turns.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 if splice else 0 for c in own}
    rebuilt = {c: own.get(c - c % 5, [])[: h[c]] + t[h[c] :] for c, t in own.items()}
    members = collections.defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    return sorted(
        (min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), children[k], leaves[k], saved[k],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(k)).encode()).hexdigest())
        for k, m in members.items()
    )


def conversations():
    r = random.Random(9)
    say = lambda n: f"turn {r.randrange(n)}"
    rows = [(c, t, "user" if t % 2 else "assistant", say(2)) for c in range(150) for t in range(r.randrange(1, 12))]
    rows += [(200, t, "user", say(3)) for t in range(400)]  # one long conversation, and another that follows it for a while
    rows += [(205, t, "user", x[3]) for t, x in enumerate(rows[-400:-100])]
    rows += [(300 + c, t, "system", "always the same") for c in range(60) for t in range(9)]
    rows += [(400, None, "user", "first"), (400, None, "user", "first"), (400, 3, None, None), (400, 3, "b", "é"), (400, 3, "a", "x" * 70_000)]
    rows += [(None, 1, "user", "lost"), (-7, 1, "user", "below zero")]
    return rows


WIDE_TURNS = "conv_id long, turn long, role string, text string, depth string, a string, range string, n_convs string, length string"


def tried(spark, rows, splice=True, **settings):
    turns = prefix_trie.placed_turns(spark.createDataFrame([(*r, *["x"] * 5) for r in rows], WIDE_TURNS).repartition(3))
    built = prefix_trie.spliced(turns) if splice else prefix_trie.whole_turns(turns)
    found = prefix_trie.trie(built, **settings).fillna(-1, ["parent_conv_id"]).collect()
    return sorted(tuple(r) for r in found)


@pytest.mark.parametrize("settings", [{}, {"shard_rows": 4, "band": 3, "in_memory": 2}])
def test_trie(spark, settings):
    rows = [r for r in conversations() if r[0] != -7]
    assert tried(spark, rows, **settings) == trie_by_hand(rows)


def test_trie_of_conversations_as_they_are(spark):
    rows = conversations()
    assert tried(spark, rows, splice=False, shard_rows=8, band=5) == trie_by_hand(rows, splice=False)


def test_no_conversations(spark):
    assert tried(spark, []) == [] and tried(spark, [(None, 1, "user", "x")]) == []
    assert tried(spark, [(3, 1, "user", "x")], splice=False) == trie_by_hand([(3, 1, "user", "x")], splice=False)


def test_spilling_queue_is_sorted():
    r = random.Random(2)
    queue, want = prefix_trie.SpillingQueue(3, block=2), []
    for _ in range(2000):
        if want and r.random() < 0.4:
            assert queue.peek() == want[0] and queue.pop() == want.pop(0)
        else:
            item = (r.randrange(50), r.randrange(50))
            queue.push(item)
            want = sorted([*want, item])
    assert [queue.pop() for _ in range(len(want))] == want and queue.peek() is None and queue.made > prefix_trie.FAN_IN
