"""Matching of arriving records against stored ones, reading only the blocks that the new records touch.

What later batches need of earlier ones lies in plain Parquet folders, dealt by a hash of the column that looks it up, and is only
ever appended to:

* ``keys``: one record for each e-mail and phone. The others of such a group are in its cluster already.
* ``blocks``: the compared values of one record for each different profile, under every block of ``matching.reachable`` it is in.
* ``members``: the records of profiles whose copies don't match by themselves; a match of the profile draws them in.
* ``stars``: the cluster of every record when it arrived; ``merged``: clusters that became part of another one since.

A batch reads the folders that its keys fall into, so with folders of equal size its work follows the batch and not the store.
Records stored before are left as they are; a batch that was broken off is added again as a whole, because ``stars``, which tells
what is stored, is written last and the rows before it hold nothing but what the batch would find anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from constituent360.operators import identity as I
from constituent360.operators import matching as M
from constituent360.operators.components import component_edges
from constituent360.session import cut_lineage
from constituent360.sources.readers import exists

FOLDER = "_folder"
_VALUES = ", ".join(f"{c} string" for c in (*M.COMPARED, "personal_email", "full_phone"))
#: The columns of each table, and those that look a row up.
TABLES = {
    "keys": ("kind string, value string, record_key string", ("kind", "value")),
    "blocks": (f"family int, block long, pid string, record_key string, {_VALUES}", ("family", "block")),
    "members": ("pid string, record_key string", ("pid",)),
    "stars": ("record_key string, cluster string", ("record_key",)),
    "merged": ("old string, cluster string", ("old",)),
}
_ROW = ("record_key", *M.COMPARED, "personal_email", "full_phone")


def profile_id() -> Column:
    """Names a combination of compared values, whichever record holds it."""
    return F.sha2(F.to_json(F.struct(*M.COMPARED)), 256)


class MatchStore:
    """Clusters of all records added so far. ``cfg`` and ``folders`` belong to the path and stay as they were when it was begun;
    ``folders`` should be the number of records expected over the number that one task reads with ease."""

    def __init__(self, spark: SparkSession, path: str, cfg: M.MatchConfig = M.MatchConfig(), folders: int = 64):
        self.spark, self.path, self.cfg, self.folders = spark, path.rstrip("/"), cfg, folders
        self.families = M.reachable(cfg, cfg.auto_threshold)

    def _folder(self, columns: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.folders)).cast("int")

    def _read(self, name: str) -> DataFrame:
        schema, path = TABLES[name][0], f"{self.path}/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], f"{schema}, {FOLDER} int")
        return self.spark.read.schema(f"{schema}, {FOLDER} int").parquet(path)

    def _append(self, name: str, rows: DataFrame) -> None:
        schema, by = TABLES[name]
        dealt = rows.select(*[c.split()[0] for c in schema.split(", ")], self._folder(by).alias(FOLDER))
        # a folder with a hot key is split, small ones are put together in a task
        dealt.hint("rebalance", FOLDER).write.mode("append").partitionBy(FOLDER).parquet(f"{self.path}/{name}")

    def touched(self, name: str, wanted: DataFrame) -> DataFrame:
        """The stored rows of the folders that the wanted keys fall into; at most one number per folder comes to the driver."""
        numbers = [r[0] for r in wanted.select(self._folder(TABLES[name][1]).alias("f")).distinct().collect()]
        return self._read(name).where(F.col(FOLDER).isin(numbers)).drop(FOLDER)

    def found(self, name: str, wanted: DataFrame) -> DataFrame:
        """The stored rows that the wanted keys name."""
        by = list(TABLES[name][1])
        return self.touched(name, wanted).join(wanted.select(*by).distinct(), by, "left_semi")

    def blocks_of(self, profiles: DataFrame) -> DataFrame:
        """The rows of ``blocks`` of some profiles."""
        out = None
        for number, family in enumerate(self.families):
            present = profiles
            for c in family.equal:
                present = present.where(F.col(c).isNotNull())
            rows = present.select(
                F.lit(number).alias("family"), F.xxhash64(*family.equal).alias("block"), "pid",
                F.col("profile").alias("record_key"), *M.COMPARED, "personal_email", "full_phone",
            )
            out = rows if out is None else out.unionByName(rows)
        return out

    def _closed(self, profiles: DataFrame) -> DataFrame:
        """Profiles whose copies match each other, so that one record stands for all of them."""
        kinds = M.copy_matches(profiles.withColumn("copies", F.lit(2)), self.cfg)
        return kinds.where(F.col("match_type") != M.REVIEW).select("profile")

    def add(self, raw: DataFrame) -> None:
        """Match new records with each other and with the stored ones, and store them."""
        cfg = self.cfg
        arrived = cut_lineage(M.prepare(M.spread(raw), cfg).select(*_ROW).dropDuplicates(["record_key"]))
        new = cut_lineage(arrived.join(self.found("stars", arrived), "record_key", "left_anti"))
        names = new.select("record_key")

        # equal e-mails and phones
        keys = cut_lineage(_keys(new))
        known = cut_lineage(self.found("keys", keys))
        edges = I.group_edges(new).unionByName(
            keys.join(known.withColumnRenamed("record_key", "b"), ["kind", "value"]).select(F.col("record_key").alias("a"), "b")
        )
        first = keys.join(known, ["kind", "value"], "left_anti").groupBy("kind", "value").agg(F.min("record_key").alias("record_key"))

        # scores: the new profiles and one record of each stored profile that shares a block with them
        own = cut_lineage(M.profiles(new).withColumn("pid", profile_id()))
        blocks = cut_lineage(self.blocks_of(own))
        near = cut_lineage(self.found("blocks", blocks))
        others = near.dropDuplicates(["pid"]).select(*_ROW).join(names, "record_key", "left_anti")
        both = cut_lineage(others.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True))))
        p = cut_lineage(M.profiles(both, "is_new").withColumn("pid", profile_id()))
        auto = cut_lineage(M.scored_profiles(p, cfg, cfg.auto_threshold, new_only=True))
        edges = edges.unionByName(I.score_edges(both, p, auto, cfg))
        matched = auto.select(F.explode(F.array("profile_a", "profile_b")).alias("profile")).distinct()
        drawn = cut_lineage(p.join(matched, "profile", "left_semi").join(self._closed(p), "profile", "left_anti").select("pid", "profile"))
        edges = edges.unionByName(
            self.found("members", drawn).join(drawn, "pid").select(F.col("record_key").alias("a"), F.col("profile").alias("b"))
        )
        edges = cut_lineage(edges.where("a <> b").distinct())

        # merge: stored records stand for their clusters
        ends = edges.select(F.explode(F.array("a", "b")).alias("record_key")).distinct().join(names, "record_key", "left_anti")
        current = self._current(cut_lineage(self.found("stars", cut_lineage(ends))))
        for side in ("a", "b"):
            at = current.select(F.col("record_key").alias(side), F.col("cluster").alias("_c"))
            edges = edges.join(at, side, "left").withColumn(side, F.coalesce("_c", side)).drop("_c")
        joined = component_edges(edges)
        clusters = names.join(joined.withColumnRenamed("hi", "record_key"), "record_key", "left").select(
            "record_key", F.coalesce("lo", "record_key").alias("cluster")
        )
        moved = joined.join(names, F.col("hi") == F.col("record_key"), "left_anti").select(F.col("hi").alias("old"), F.col("lo").alias("cluster"))

        opened = own.join(self._closed(own), "profile", "left_anti").select("pid")
        stored = {
            "keys": first,
            "blocks": blocks.join(near.select("family", "pid"), ["family", "pid"], "left_anti"),
            "members": new.withColumn("pid", profile_id()).join(opened, "pid", "left_semi"),
            "merged": moved,
            "stars": clusters,
        }
        for name, rows in {name: cut_lineage(rows) for name, rows in stored.items()}.items():
            self._append(name, rows)

    def _current(self, stars: DataFrame) -> DataFrame:
        """Follow the clusters of a few records to what they are now; as many steps as batches renamed one of them."""
        while True:
            steps = cut_lineage(self.found("merged", stars.select(F.col("cluster").alias("old")))).groupBy("old").agg(F.min("cluster").alias("_now"))
            if steps.isEmpty():
                return stars
            stars = cut_lineage(
                stars.join(steps, F.col("cluster") == F.col("old"), "left").select("record_key", F.coalesce("_now", "cluster").alias("cluster"))
            )

    def clusters(self) -> DataFrame:
        """(record_key, cluster) of all records; the cluster is named by its least record, as in ``identity.unify``."""
        now = component_edges(self._read("merged"), "old", "cluster")
        return self._read("stars").join(now, F.col("cluster") == F.col("hi"), "left").select("record_key", F.coalesce("lo", "cluster").alias("cluster"))


def _keys(records: DataFrame) -> DataFrame:
    """(kind, value, record_key) of the e-mails and phones that match by themselves."""
    kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in ("personal_email", "full_phone")]
    return records.select("record_key", F.explode(F.array(*kinds)).alias("k")).select("k.kind", "k.value", "record_key").where("value IS NOT NULL")
