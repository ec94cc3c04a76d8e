"""Line de-duplication by sorted hash ranges, in DataFrame operations only.

Every line becomes (hash, document, position). The hashes are dealt out by range with a secondary sort by
document and position, and a window streams over each sorted range and takes the first occurrence. A line
that a third of all documents hold would be one range, so the range key also has a slice of the document
id: each slice gives its own first occurrence, and a second, small pass over one row per line and slice
gives the first of all. Documents get back a compressed bitmap of the lines to keep, never text.

Defined cases: a null or empty text is one empty line; a line whose key is shorter than ``least`` code points
always stays; a row without id is kept whole and counts for no other row; rows that repeat an id are one
document when lines are compared, and each of them is cut by itself; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from constituent360.llm.common import BLANKS, ascii_lower, stored, tasks

BITS = 64


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, least: int = 10) -> DataFrame:
    """doc_id, copy (hash of the text: tells rows with the same id apart), pos, h1, h2 of every line whose
    key has ``least`` code points or more."""
    keys = F.transform(split_lines(ascii_lower(F.col("text"))), lambda x: F.btrim(x, F.lit(BLANKS)))
    return (
        docs.where(F.col("doc_id").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("copy"), F.posexplode(keys).alias("pos", "key"))
        .where(F.char_length("key") >= least)
        .select("doc_id", "copy", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )


def first_holders(lines: DataFrame) -> DataFrame:
    """h1, h2, holder (least document) of every line found in two or more documents."""
    n = tasks(lines.sparkSession)
    slices = lines.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(n)))
    by_slice = Window.partitionBy("h1", "h2", "slice")
    firsts = (
        slices.select("h1", "h2", "slice", "doc_id", "pos")
        .repartitionByRange(n, "h1", "h2", "slice")
        .sortWithinPartitions("h1", "h2", "slice", "doc_id", "pos")
        .withColumn("before", F.lag("doc_id").over(by_slice.orderBy("doc_id", "pos")))
        # the first occurrence, and the first one in another document of the slice
        .where(F.col("before").isNull() | (F.col("before") < F.col("doc_id")))
        .withColumn("rank", F.row_number().over(by_slice.orderBy("doc_id", "pos")))
        .where(F.col("rank") <= 2)
    )
    of_all = Window.partitionBy("h1", "h2").orderBy("doc_id", "pos")
    return (
        firsts.select("h1", "h2", "doc_id", "pos")
        .repartitionByRange(n, "h1", "h2")
        .sortWithinPartitions("h1", "h2", "doc_id", "pos")
        .withColumn("rank", F.row_number().over(of_all))
        .withColumn("holder", F.first("doc_id").over(of_all))
        .where(F.col("rank") == 2)
        .select("h1", "h2", "holder")
    )


def keep_bitmaps(docs: DataFrame, least: int = 10) -> DataFrame:
    """doc_id, copy, words: the compressed keep bitmap of every document that loses a line.

    ``words`` holds, in order, struct(word, bits) for each run of 64 lines in which a line goes; bit i of
    ``bits`` is set if line 64 * word + i goes. Runs of 64 lines that all stay are not stored.
    """
    lines = stored(line_hashes(docs, least), "line-hashes")
    holders = stored(first_holders(lines), "line-holders")
    gone = lines.join(holders, ["h1", "h2"]).where(F.col("doc_id") != F.col("holder"))
    return (
        gone.groupBy("doc_id", "copy", F.expr(f"cast(pos div {BITS} as int)").alias("word"))
        .agg(F.expr(f"bit_or(shiftleft(1L, cast(pos % {BITS} as int)))").alias("bits"))
        .groupBy("doc_id", "copy")
        .agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
    )


def unpacked(words: Column) -> Column:
    """The bitmap with its empty words, as array<bigint>."""
    return F.flatten(
        F.transform(
            words,
            lambda w, i: F.concat(
                F.array_repeat(
                    F.lit(0).cast("long"),
                    w["word"] - F.when(i > 0, F.get(words, i - 1)["word"]).otherwise(F.lit(-1)) - 1,
                ),
                F.array(w["bits"]),
            ),
        )
    )


def dropped(bitmap: Column, pos: Column) -> Column:
    word = F.get(bitmap, (pos / BITS).cast("int"))
    bit = F.call_function("shiftright", word, pos % BITS).bitwiseAND(F.lit(1).cast("long"))
    return F.coalesce(bit == 1, F.lit(False))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str, n_lines: str, n_dropped: str) -> DataFrame:
    """``docs`` with the kept text and the counts of lines under the names given."""
    packed = bitmaps.select(
        F.col("doc_id").alias("_of"), F.col("copy").alias("_copy"), unpacked(F.col("words")).alias("_bits")
    )
    own = docs.select(F.struct(*docs.columns).alias("_row"))
    lines = split_lines(F.col("_row.text"))
    kept = F.filter(lines, lambda x, i: ~dropped(F.col("_bits"), i))
    joined = own.join(
        packed.hint("merge"), (F.col("_row.doc_id") == F.col("_of")) & (F.xxhash64("_row.text") == F.col("_copy")), "left"
    )
    out = joined.select(
        "_row",
        F.when(F.col("_bits").isNull(), lines).otherwise(kept).alias("_kept"),
        F.size(lines).cast("long").alias("_n"),
    )
    rest = [F.col("_row")[c].alias(c) for c in docs.columns if c not in (text, n_lines, n_dropped)]
    return out.select(
        *rest,
        F.concat_ws("\n", "_kept").alias(text),
        F.col("_n").alias(n_lines),
        (F.col("_n") - F.size("_kept")).alias(n_dropped),
    )
