import datetime as dt

import pytest
from pyspark.sql import functions as F

from constituent360.operators import lineage as N
from constituent360.operators import temporal as H
from constituent360.sources.writers import KeyedTable

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


def test_scd2_is_idempotent_and_closes(spark):
    one = spark.createDataFrame([("a", "x"), ("b", None), ("c", "z")], "id string, v string")
    two = spark.createDataFrame([("a", "y"), ("b", None), ("d", "w")], "id string, v string")
    history = H.scd2_merge(H.scd2_start(one, D1), two, ["id"], ["v"], D2)
    rows = {(r["id"], r["v"], r["is_current"], r["change_reason"]) for r in history.collect()}
    assert rows == {("a", "x", False, "initial"), ("a", "y", True, "changed"), ("b", None, True, "initial"), ("c", "z", False, "initial"), ("d", "w", True, "new")}
    again = H.scd2_merge(history, two, ["id"], ["v"], D3)
    assert sorted(map(str, again.collect())) == sorted(map(str, history.select(*again.columns).collect()))
    assert {tuple(r)[:2] for r in H.as_of(history, D1).select("id", "v").collect()} == {("a", "x"), ("b", None), ("c", "z")}
    assert {tuple(r) for r in H.as_of(history, D2).select("id", "v").collect()} == {("a", "y"), ("b", None), ("d", "w")}


def test_upsert_twice_changes_nothing(spark):
    target = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old")], "id string, m int, v string")
    source = spark.createDataFrame([("a", 2, "new"), ("a", 3, "newer"), ("a", 9, "future"), ("b", 1, "seen"), ("c", 2, "add")], "id string, m int, v string")
    once = H.incremental_upsert(target, source, ["id"], "m", 1, 5)
    twice = H.incremental_upsert(once, source, ["id"], "m", 1, 5)
    want = {("a", 3, "newer"), ("b", 1, "old"), ("c", 2, "add")}
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()} == want


def test_change_log(spark):
    a = spark.createDataFrame([("1", "x", 1), ("2", "y", 2)], "id string, s string, n int")
    b = spark.createDataFrame([("1", "x", 5), ("3", "z", None)], "id string, s string, n int")
    got = {(r["id"], r["field"], r["old_value"], r["new_value"]) for r in H.change_log(a, b, ["id"], ["s", "n"], who="w", why="y", where="p", when=D1).collect()}
    assert got == {("1", "n", "1", "5"), ("2", "s", "y", None), ("2", "n", "2", None), ("3", "s", None, "z")}


def test_retention_edges(spark):
    df = spark.createDataFrame([("keep", D1), ("drop", D1 - dt.timedelta(days=1)), ("undated", None)], "id string, d date")
    left = H.apply_retention(df, "d", H.Retention(1, "delete"), dt.date(2025, 1, 1))
    assert {r["id"] for r in left.collect()} == {"keep", "undated"}
    masked = H.apply_retention(df, "d", H.Retention(1, "anonymise", ("id",)), dt.date(2025, 1, 1))
    assert sorted(str(r["id"]) for r in masked.collect()) == ["None", "keep", "undated"]
    with pytest.raises(ValueError):
        H.apply_retention(df, "d", H.Retention(1, "shred"), D1)


def test_restricted_view(spark):
    df = spark.createDataFrame([("a", "s1", 1), ("b", "s2", 2)], "id string, secret string, n int")
    out = H.restrict_view(df, H.Access(hidden=("n",), hashed=("secret",), rows="id = 'a'"))
    assert out.columns == ["id", "secret"] and len(out.first()["secret"]) == 64 and out.count() == 1


def test_upsert_into_a_table(spark, tmp_path):
    source = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z"), ("c", 4, "w")], "id string, m int, v string")
    table = KeyedTable(spark, str(tmp_path / "t"), ["id"], 4)
    assert table.read() is None
    H.upsert_into(table, source, "m", None, 2)
    assert {tuple(r) for r in table.read().collect()} == {("a", 1, "x"), ("b", 2, "y")}
    for _ in range(2):  # a second run of an interval changes nothing
        H.upsert_into(table, source, "m", 2, 9)
        assert {tuple(r) for r in table.read().collect()} == {("a", 3, "z"), ("b", 2, "y"), ("c", 4, "w")}
    H.upsert_into(table, source, "m", 9, 10)
    assert table.read().count() == 3


EDGES = [("b", "a"), ("c", "b"), ("a", "c"), ("d", "c"), ("e", "d"), ("d", "e"), ("f", "e"), ("g", "g"), ("h", "f")]


def test_closure_and_cycles(spark):
    edges = spark.createDataFrame(EDGES, "object_name string, referenced string")
    root = spark.createDataFrame([("e",)], "name string")
    assert {r["node"]: r["distance"] for r in N.downstream(edges, root).collect()} == {"d": 1, "f": 1, "h": 2}
    assert {r["node"] for r in N.upstream(edges, root).collect()} == {"d", "c", "b", "a"}
    assert {r["node"]: r["cycle"] for r in N.cycles(edges).collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "g": "g"}
    none = edges.where("object_name in ('h', 'f')")
    assert N.cycles(none).count() == 0


def test_references(spark):
    modules = spark.createDataFrame([("p", "INSERT INTO [dbo].[Fact] SELECT * FROM dbo.stg JOIN other o UPDATE fact"), ("q", "EXEC('select 1 from stg')")], "object_name string, definition string")
    assets = spark.createDataFrame([("fact",), ("STG",)], "name string")
    assert {(r[0], r[1]) for r in N.extract_refs(modules, assets).collect()} == {("p", "fact"), ("p", "stg"), ("q", "stg")}
    assert [r[0] for r in N.dynamic_modules(modules).collect()] == ["q"]
    assert [r[0] for r in N.writer_modules(modules).collect()] == ["p"]


def test_edge_confidence(spark):
    objects = spark.createDataFrame([("v", "VIEW"), ("p", "PROCEDURE"), ("q", "PROCEDURE")], "name string, type string")
    modules = spark.createDataFrame([("v", "EXEC('x')"), ("p", "sp_executesql @s"), ("q", "select 1")], "object_name string, definition string")
    deps = spark.createDataFrame([("v", "t", 0), ("p", "t", 1), ("q", "t", 0)], "object_name string, referenced string, is_updated int")
    got = {r["object_name"]: (r["lineage_type"], r["confidence"]) for r in N.lineage_edges(deps, objects, modules).collect()}
    assert got == {"v": ("READ", "High"), "p": ("WRITE", "Medium"), "q": ("READ", "High")}


def test_view_columns_match_by_name(spark):
    views = spark.createDataFrame([("v",)], "name string")
    columns = spark.createDataFrame([("v", "id"), ("v", "total"), ("t", "id"), ("t", "other")], "object_name string, column_name string")
    deps = spark.createDataFrame([("v", "t")], "object_name string, referenced string")
    assert [tuple(r) for r in N.view_columns(views, columns, deps).collect()] == [("v", "id", "t", "id")]
