"""Clusters of stored records after each batch against one run over everything."""

import uuid

from pyspark.sql import functions as F

from constituent360.operators import identity
from constituent360.operators import matching as M
from constituent360.operators.match_store import TABLES, MatchStore, profile_id
from constituent360.session import scratch
from test_matching import SCHEMA, population, row


def clusters(df):
    return {r["record_key"]: r["cluster"] for r in df.collect()}


def new_store(spark, folders=4):
    return MatchStore(spark, f"{scratch(spark, 'store')}/{uuid.uuid4().hex}", folders=folders)


def test_batches_equal_one_run(spark):
    raw = spark.createDataFrame(population(150, 11), SCHEMA)
    batch = F.crc32("source_id") % 3
    store = new_store(spark)
    for number in range(3):
        store.add(raw.where(batch == number))
        so_far = raw.where(batch <= number)
        if number:
            assert clusters(store.clusters()) == clusters(identity.unify(so_far).clusters)
    before = clusters(store.clusters())
    store.add(raw.where(batch == 1))  # again: nothing changes
    assert clusters(store.clusters()) == before and store.clusters().count() == len(before)


def test_a_record_joins_clusters_stored_apart(spark):
    """Two stored clusters meet through a third record, twice in a row, and the name follows the least record."""
    steps = [
        [row("b", "1", "one@x.org", None, "Ann", "Lee"), row("b", "2", None, "3125550001", "Bob", "Ray"), row("b", "3", "three@x.org", "7735550009")],
        [row("c", "4", "one@x.org", "3125550001"), row("d", "9")],
        [row("a", "0", "three@x.org", "3125550001"), row("a", "5", "", "12")],
    ]
    store, seen = new_store(spark), []
    for rows in steps:
        seen += rows
        store.add(spark.createDataFrame(rows, SCHEMA))
        assert clusters(store.clusters()) == clusters(identity.unify(spark.createDataFrame(seen, SCHEMA)).clusters)
    store.add(spark.createDataFrame([], SCHEMA))
    assert len(set(clusters(store.clusters()).values())) == 3


def test_copies_that_do_not_match_by_themselves_are_drawn_in(spark):
    """Copies without an address stay apart until a record matches their profile."""
    half = dict(phone="5551234", first="Ann", last="Lee", address=None, zip_code="60601")
    cfg = M.MatchConfig(name_weight=0.5, address_weight=0.1, phone_weight=0.2, domain_weight=0.0, zip_weight=0.2, auto_threshold=0.9, review_threshold=0.5)
    old = [row("b", str(i), f"info@n{i % 2}.org", **half) for i in range(6)]
    new = [row("a", "9", "info@n1.org", **{**half, "address": "1 Oak St"})]
    store = MatchStore(spark, f"{scratch(spark, 'store')}/t", cfg, 4)
    store.add(spark.createDataFrame(old, SCHEMA))
    store.add(spark.createDataFrame(new, SCHEMA))
    assert clusters(store.clusters()) == clusters(identity.unify(spark.createDataFrame(old + new, SCHEMA), cfg).clusters)


def test_a_batch_reads_what_it_touches(spark):
    """A shared mailbox is one row, and a few records read a few folders whatever the number of stored records."""
    many = [row("s", f"{i:04d}", "all@x.org", None, f"N{i}", "Lee", None, None, f"{60000 + i % 500}") for i in range(800)]
    many += [row("t", f"{i:04d}", None, f"{5550000 + i}", "Al", f"Ray{i}", None, f"{i} Oak", f"{60000 + i}") for i in range(800)]
    store = new_store(spark, folders=40)
    store.add(spark.createDataFrame(many, SCHEMA))
    new = M.prepare(spark.createDataFrame([row("u", "1", "all@x.org", "5550007", "Al", "Ray7", None, "7 Oak", "60007")], SCHEMA))
    wanted = store.blocks_of(M.profiles(new).withColumn("pid", profile_id()))
    assert store._read("blocks").count() >= 800
    assert store.touched("blocks", wanted).count() <= 800 * 2 * len(store.families) / 40
    assert [r["record_key"] for r in store.found("blocks", wanted).select("record_key").distinct().collect()] == ["t:0007"]
    keys = new.select(F.lit("personal_email").alias("kind"), F.col("personal_email").alias("value"))
    assert store.found("keys", keys).count() == 1 and store._read("members").count() < 1600
    assert set(TABLES) == {"keys", "blocks", "members", "stars", "merged"}
