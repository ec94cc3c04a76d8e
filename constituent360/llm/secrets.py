"""Secret scan in DataFrame operations only: fixed patterns plus sliding-window entropy.

The patterns find assignments, access keys and hexadecimal runs. On top of them, the runs of key characters are cut at the parts
that the allow list matches, and every piece that holds a letter and a digit is a candidate: a window slides over
it, the counts of its characters are kept up to date one character at a time, and where the Shannon entropy of the window
reaches the threshold of the piece's character class, the windows together give a span. Spans inside a span of a pattern
are left out. The work grows with the length of a run, however long.

Positions are code points, ends exclusive. They come from the lengths of the pieces between matches, so that no
position is ever searched for. Defined cases: a null text counts as empty; rows stay one for one,
whatever their ids; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds of spans, in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "entropy")
# The patterns and the least lengths of what they match.
ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# The bits that about 98 % of random windows of each alphabet reach (40,000 windows drawn of each).
CLASS_BITS = (("^[0-9a-fA-F]+$", 2.95), ("^[a-z0-9]+$", 3.4), ("^[A-Z0-9]+$", 3.4))
MIXED_BITS = 3.68
_WORD = "(?:[a-z]{2,}(?:[_-][a-z]+)*|[A-Z][a-z]+|[0-9]{2,})"
#: Parts of a run that are no secrets: plain segments of a path, identifiers, dates, samples. The run stands between line ends.
ALLOWED = (
    rf"[/\n](?:{_WORD}[/\n])+", r"\n",
    "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    "[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "[eE][xX][aA][mM][pP][lL][eE]|[sS][aA][mM][pP][lL][eE]|[pP][lL][aA][cC][eE][hH][oO][lL][dD]|[xX]{4}|[tT][eE][sS][tT]",
)

SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: int, least: int = 0, group: int = 0) -> Column:
    """The matches whose group has ``least`` characters or more, as an array of (start, kind, end)."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"), value.alias("value"))
    none = F.array().cast(SPANS)

    def step(state, piece):
        start = state["at"] + F.char_length(piece["gap"])
        end = start + F.coalesce(F.char_length(piece["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        keep = F.char_length(piece["value"]) >= least
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    spans = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda s: s["out"])
    # most texts have no match: one look is enough for them
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(none)


def _peaks(codes: Column, threshold: Column) -> Column:
    """struct(first, last): the ends of the first and the last window whose entropy reaches the threshold; ``codes``: the
    places of the characters in ALPHABET."""
    weights = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 2)])
    state = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("s"), F.lit(0).alias("first"), F.lit(0).alias("last")
    )

    def step(old, i):
        into = F.element_at(codes, i)
        out = F.when(i > WINDOW, F.element_at(codes, F.greatest(i - WINDOW, F.lit(1)))).otherwise(F.lit(0))
        counts = F.transform(
            old["counts"], lambda n, k: n + (k + 1 == into).cast("int") - (k + 1 == out).cast("int")
        )
        n_in = F.element_at(old["counts"], into)
        n_out = F.when(out > 0, F.element_at(old["counts"], F.greatest(out, F.lit(1))))
        gain = F.get(weights, n_in + 1) - F.get(weights, n_in)
        loss = F.coalesce(F.get(weights, n_out) - F.get(weights, n_out - 1), F.lit(0.0))
        s = old["s"] + F.when(into == out, F.lit(0.0)).otherwise(gain - loss)
        high = (i >= WINDOW) & (F.lit(math.log2(WINDOW)) - s / WINDOW >= threshold)
        return F.struct(
            counts.alias("counts"), s.alias("s"),
            F.when(high & (old["first"] == 0), i).otherwise(old["first"]).alias("first"),
            F.when(high, i).otherwise(old["last"]).alias("last"),
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.size(codes)), state, step,
        lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")),
    )


def _candidates(start: Column, run: Column) -> Column:
    """(start, run) of what lies between the parts of a run that the allow list matches."""
    pattern = "|".join(f"(?:{p})" for p in ALLOWED)
    framed = F.concat(F.lit("\n"), run, F.lit("\n"))
    gaps = F.arrays_zip(F.split(framed, pattern, -1).alias("gap"), F.regexp_extract_all(framed, F.lit(pattern), F.lit(0)).alias("hit"))
    none = F.array().cast("array<struct<start:int,run:string>>")

    def step(state, piece):
        own = F.struct(state["at"].alias("start"), piece["gap"].alias("run"))
        end = state["at"] + F.char_length(piece["gap"]) + F.coalesce(F.char_length(piece["hit"]), F.lit(0))
        keep = F.char_length(piece["gap"]) >= WINDOW
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["out"], F.array(own))).otherwise(state["out"]).alias("out"))

    return F.aggregate(gaps, F.struct((start - 1).alias("at"), none.alias("out")), step, lambda s: s["out"])


def _class_bits(run: Column) -> Column:
    bits = F.lit(MIXED_BITS)
    for pattern, least in reversed(CLASS_BITS):
        bits = F.when(F.rlike(run, F.lit(pattern)), F.lit(least)).otherwise(bits)
    return bits


def _entropy_spans(text: Column) -> Column:
    runs = F.transform(
        _spans(text, CANDIDATE, 3),
        lambda x: F.struct(x["start"].alias("start"), F.substring(text, x["start"] + 1, x["end"] - x["start"]).alias("run")),
    )
    pieces = F.flatten(F.transform(runs, lambda x: _candidates(x["start"], x["run"])))
    likely = F.filter(pieces, lambda x: F.rlike(x["run"], F.lit("[0-9]")) & F.rlike(x["run"], F.lit("[A-Za-z]")))
    # the characters' places are found once, then taken from an array
    places = lambda run: F.transform(F.filter(F.split(run, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
    coded = F.transform(
        likely, lambda x: F.struct(x["start"].alias("start"), places(x["run"]).alias("codes"), _class_bits(x["run"]).alias("bits"))
    )
    peaks = F.transform(coded, lambda x: F.struct(x["start"].alias("start"), _peaks(x["codes"], x["bits"]).alias("peak")))
    return F.transform(
        F.filter(peaks, lambda x: x["peak"]["last"] > 0),
        lambda x: F.struct(
            (x["start"] + x["peak"]["first"] - WINDOW).alias("start"), F.lit(3).alias("kind"),
            (x["start"] + x["peak"]["last"]).alias("end"),
        ),
    )


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base and extra: the spans of the patterns and those that the entropy adds, in order."""
    text = F.col("_text")
    found = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text")).select(
        "doc_id",
        F.array_sort(
            F.concat(_spans(text, ASSIGN, 0, ASSIGN_LEAST, 2), _spans(text, ACCESS, 1), _spans(text, HEX, 2))
        ).alias("base"),
        F.when(F.rlike(text, F.lit(CANDIDATE)), _entropy_spans(text)).otherwise(F.array().cast(SPANS)).alias("_windows"),
    )
    inside = lambda x: F.exists(F.col("base"), lambda b: (b["start"] <= x["start"]) & (b["end"] >= x["end"]))
    return found.select("doc_id", "base", F.filter("_windows", lambda x: ~inside(x)).alias("extra"))


def written(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long")
