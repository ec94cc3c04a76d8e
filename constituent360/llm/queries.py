"""One registered query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from constituent360.llm import bpe, graph_ann, hard_negatives, language_id, line_dedup, minhash, mixing, packing, prefix_trie, secrets, sql, suffix_dedup, topk, toxicity
from constituent360.llm.common import stored, table
from constituent360.llm.registry import query


def vocabulary() -> bpe.Vocabulary:
    import public_tokenizers

    return bpe.Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op1_language_id")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.trained(docs))
    return found.select("doc_id", language_id.is_held_out(3, 1).alias("held_out"), "lang_pred", "score")


@query("op2_mixing", sql.MIXING)
def _(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


@query("op3_secrets", sql.SECRETS)
def _(spark, sf_dir):
    found = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    every = F.array_sort(F.concat("base", "extra"))
    return found.select(
        "doc_id", *[secrets.count(F.col("base"), k).alias(f"n_{k}") for k in secrets.KINDS[:3]],
        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"), secrets.written(every).alias("spans"),
    )


@query("op4_toxicity")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", toxicity.is_held_out().alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted")
    )


@query("op5_topk", sql.TOP_K)
def _(spark, sf_dir):
    return topk.top_k(topk.whole_vectors(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0)


@query("op6_bpe")
def _(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


@query("op7_graph_ann")
def _(spark, sf_dir):
    vectors = graph_ann.sound_vectors(table(spark, sf_dir, "embeddings"))
    return graph_ann.search(graph_ann.index(vectors, 20), vectors.where(F.col("vec_id") % 20 == 0), 20)


@query("op8_suffix_dedup")
def _(spark, sf_dir):
    return suffix_dedup.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op9_minhash", sql.NEAR_DUPLICATES)
def _(spark, sf_dir):
    found = minhash.components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


@query("op10_line_dedup", sql.LINE_DEDUP)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs), "kept", "n_lines", "n_dropped")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_packing")
def _(spark, sf_dir):
    import public_tokenizers

    files = [public_tokenizers.path(f) for f in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")]
    cut = packing.pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), packing.Vocabulary(*files, public_tokenizers.PATTERN))
    cut = stored(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(cut).drop("row")


@query("op12_hard_negatives", sql.HARD_NEGATIVES)
def _(spark, sf_dir):
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(hard_negatives.labelled_vectors(table(spark, sf_dir, "embeddings"), moved), F.col("vec_id") % 100 == 0)


@query("op13_prefix_trie", sql.PREFIX_TRIE)
def _(spark, sf_dir):
    return prefix_trie.trie(prefix_trie.spliced(prefix_trie.placed_turns(table(spark, sf_dir, "conversations"))))
