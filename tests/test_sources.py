import datetime as dt
from decimal import Decimal
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from constituent360.sources import readers, writers
from constituent360.streaming import jobs


def test_csv_before_json(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps([{"a": "1", "b": "x"}, {"a": "2"}]))
    schema = readers.text_schema(["a", "b"])
    assert [tuple(r) for r in readers.read_table(spark, str(tmp_path), "t", schema).collect()] == [("1", "x"), ("2", None)]
    (tmp_path / "t.csv").write_text('a,b\n7,"line ""one""\nline two"\n')
    assert [tuple(r) for r in readers.read_table(spark, str(tmp_path), "t", schema, multi_line=True).collect()] == [("7", 'line "one"\nline two')]
    assert readers.describe_schema(readers.read_table(spark, str(tmp_path), "t", schema)) == {"a": "string", "b": "string"}
    with pytest.raises(FileNotFoundError):
        readers.read_table(spark, str(tmp_path), "absent", schema)


def test_field_mapping(spark):
    df = spark.createDataFrame([("1", "a@b.org")], "id string, mail string")
    r = readers.load_source_records(df, "crm", {"source_id": "id", "email": "mail", "phone": "tel"}).first()
    assert (r["source_system"], r["source_id"], r["email"], r["raw_data"]) == ("crm", "1", "a@b.org", {"id": "1", "mail": "a@b.org"})


def test_api_pages(spark):
    pages = ['[{"x": "1"}]', '{"data": [{"x": "2"}, {"x": "3"}]}', '{"results": [{"x": "4"}], "next": null}', '{"data": [], "results": [{"x": "9"}]}', "{}", "[]"]
    df = spark.createDataFrame([(p,) for p in pages], "body string")
    record = StructType([StructField("x", StringType())])
    assert sorted(r[0] for r in readers.explode_api_pages(df, "body", record).collect()) == ["1", "2", "3", "4"]


def test_union_tolerates_missing_columns(spark):
    a, b = spark.createDataFrame([("1", "x")], "id string, p string"), spark.createDataFrame([("2",)], "id string")
    assert {tuple(r) for r in readers.union_sources(a, b).collect()} == {("1", "x"), ("2", None)}


def test_first_per_person(spark):
    df = spark.createDataFrame([("p", 2, "b"), ("p", 1, "a"), ("q", 3, "c"), ("r", 4, "d")], "person string, n int, v string")
    got = readers.to_source_records(df, "gifts", "n", "n", "person").collect()
    assert sorted((r["source_id"], r["v"]) for r in got) == [("1", "a"), ("3", "c"), ("4", "d")]


def test_month_pruning(spark, tmp_path):
    df = spark.createDataFrame([(i, dt.date(2024, 1 + i % 12, 15)) for i in range(24)], "id int, d date")
    path = str(tmp_path / "facts")
    writers.write_partitioned(df, path, "d", "ym", salt=2)
    read = readers.between_months(spark.read.schema("id int, d date, ym string").parquet(path), "d", "ym", dt.date(2024, 3, 1), dt.date(2024, 4, 30))
    assert read.count() == 4
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan


def test_rerun_replaces_its_day_only(spark, tmp_path):
    path = str(tmp_path / "f")
    day = lambda d, n: spark.range(n).withColumn("day", F.lit(d))
    for df in (day("a", 3), day("b", 2), day("b", 5)):
        writers.replace_partitions(df, path, ["day"])
    assert {r["day"]: r["count"] for r in spark.read.parquet(path).groupBy("day").count().collect()} == {"a": 3, "b": 5}


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        writers.write_dataset(spark.range(1), str(tmp_path / "x"), "xls")


def test_stream_upsert_survives_replay_and_late_rows(spark, tmp_path):
    source, table = tmp_path / "in", writers.KeyedTable(spark, str(tmp_path / "table"), ["id"], 3)
    schema = "id string, t int, v string"
    add = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
    run = lambda check: jobs.upsert_stream(
        jobs.read_stream(spark, str(source), spark.createDataFrame([], schema).schema), table, ["t"], str(tmp_path / check)
    ).awaitTermination()
    add([("a", 5, "five"), ("b", 1, "one")])
    run("c")
    add([("a", 3, "late"), ("b", 2, "two"), ("c", 1, "new")])
    run("c")
    want = {("a", 5, "five"), ("b", 2, "two"), ("c", 1, "new")}
    assert {tuple(r) for r in table.read().select("id", "t", "v").collect()} == want
    run("fresh")  # a lost checkpoint replays everything, which changes nothing
    assert {tuple(r) for r in table.read().select("id", "t", "v").collect()} == want
    add([("d", 1, "after")])
    run("fresher")  # batch ids start again, and new rows still arrive
    assert {tuple(r) for r in table.read().select("id", "t", "v").collect()} == want | {("d", 1, "after")}


def test_upsert_replaces_touched_folders_only(spark, tmp_path):
    table = writers.KeyedTable(spark, str(tmp_path / "t"), ["id"], 8)
    rows = spark.range(100).selectExpr("id", "1 as v")
    table.upsert(rows, None)
    names = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    before = names()
    table.upsert(spark.createDataFrame([(5, 2)], "id long, v int"), lambda old, new: old.join(new, "id", "left_anti").unionByName(new))
    after = names()
    assert len({p.parent.name for p in set(before) ^ set(after)}) == 1
    assert {(r["id"], r["v"]) for r in table.read().collect()} == {(i, 2 if i == 5 else 1) for i in range(100)}


def test_metric_refresh_of_shuffled_history(spark, tmp_path):
    for i, hour in enumerate((7, 3, 9, 1)):
        rows = [(dt.datetime(2024, 1, 1, hour), "a", 1.0), (dt.datetime(2024, 1, 1, 3), "b", 2.0)]
        spark.createDataFrame(rows, "ts timestamp, k string, v double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    table = writers.KeyedTable(spark, str(tmp_path / "t"), ["window_start", "window_end", "k"], 3)
    stream = jobs.read_stream(spark, str(tmp_path / "in"), schema, files_per_batch=1)
    jobs.refresh_table(jobs.metric_refresh(stream, "ts", "v", ["k"]), table, str(tmp_path / "c")).awaitTermination()
    got = {(r["window_start"].hour, r["k"], r["n"], r["total"]) for r in table.read().collect()}
    assert got == {(h, "a", 1, 1.0) for h in (1, 3, 7, 9)} | {(3, "b", 4, 8.0)}


def test_staging_filters(spark, tmp_path):
    spark.createDataFrame([(1, 5.0), (2, 0.0), (3, None), (4, -1.0)], "id int, donation_amount double").write.parquet(str(tmp_path / "in"))
    stream = jobs.read_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    jobs.write_stream(jobs.staging_donations(stream), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert [r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]


def test_extract_audit(spark):
    started, ended = dt.datetime(2024, 1, 1, 2), dt.datetime(2024, 1, 1, 2, 1)
    good = readers.extract_audit(spark.range(3), "crm", "people", started, ended).first()
    assert (good["success"], good["records_extracted"], good["duration_seconds"], good["error_message"]) == (True, 3, 60.0, None)
    bad = readers.extract_audit(spark.range(0), "crm", "people", started, ended).first()
    assert bad["success"] is False and bad["error_message"] == "expected 1 records or more, got 0"


def test_json_arrays_round_trip(spark, tmp_path):
    """Several files, quotes, line breaks, nulls, repeated rows and a data set without rows."""
    schema = "id bigint, name string, amount decimal(12,2)"
    rows = [(i % 7 or None, ['a "b"', "x\ny,[]", None, ""][i % 4], Decimal(f"{i % 3}.50")) for i in range(100)]
    writers.write_json_arrays(spark.createDataFrame(rows, schema), f"{tmp_path}/t.json", 30)
    assert len(list(tmp_path.glob("t.json/*/*.txt"))) == 4
    got = readers.read_table(spark, str(tmp_path), "t", schema)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, rows)) and got.columns == ["id", "name", "amount"]
    writers.write_json_arrays(spark.createDataFrame([], schema), f"{tmp_path}/none.json")
    assert readers.read_table(spark, str(tmp_path), "none", schema).isEmpty()
