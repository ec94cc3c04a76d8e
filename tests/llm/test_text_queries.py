"""The operators' queries against their SQL, and the others' schemas."""

import duckdb
import pytest

from constituent360.llm import queries, registry  # noqa: F401

# The columns of the queries without SQL.
COLUMNS = {
    "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op7_graph_ann": ["query_id", "rank", "vec_id", "score"],
    "op8_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op11_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
}


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, sf, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    found = registry.RUN[name](spark, sf)
    cursor = connection.execute(registry.SQL[name])
    assert [d[0] for d in cursor.description] == found.columns
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, cursor.fetchall()))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_without_sql(spark, sf, name):
    found = registry.RUN[name](spark, sf)
    assert found.columns == COLUMNS[name]
    if "doc_id" in found.columns:
        assert found.select("doc_id").distinct().count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.RUN) == list(range(1, 14))
