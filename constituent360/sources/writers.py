"""Writers: data sets, partitioned facts, the mailing list, keyed tables and tables of changes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from constituent360.functions.dates import year_month
from constituent360.session import cut_lineage
from constituent360.sources.readers import exists

BUCKET = "_bucket"


def write_dataset(df: DataFrame, path: str, fmt: str) -> None:
    """CSV with header, JSON records or Parquet; an existing data set is replaced."""
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError(f"unknown format: {fmt}")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(path)


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    """Files that hold one array of about ``rows_per_file`` records each, as exports of web services do; equal rows are dealt out like
    others. A data set without rows is one empty array."""
    # written first: a task that is run again then reads the same rows in the same order, and deals them out the same way
    rows = cut_lineage(df.select(F.to_json(F.struct(*df.columns)).alias("record")))
    slices = max(1, -(-rows.count() // rows_per_file))
    dealt = rows.withColumn("_slice", F.pmod(F.xxhash64("record", F.monotonically_increasing_id()), F.lit(slices)))
    every = df.sparkSession.range(slices).select(F.col("id").alias("_slice"))
    arrays = every.join(dealt, "_slice", "left").groupBy("_slice").agg(F.array_join(F.collect_list("record"), ",\n").alias("records"))
    lines = arrays.select("_slice", F.concat(F.lit("["), "records", F.lit("]")).alias("value"))
    lines.write.mode("overwrite").partitionBy("_slice").text(path)


def write_audited(
    spark: SparkSession, extract: Callable[[SparkSession], DataFrame], path: str, fmt: str, source: str, table: str,
    clock: Callable[[], dt.datetime], least: int = 1,
) -> DataFrame:
    """Run an extract, write it and return its audit row, in the form of ``readers.extract_audit``. The records are counted by the
    write itself, as they pass. An error in reading or writing is recorded (its first line) and not raised, with no
    records extracted. ``clock`` is read before and after.

    ``extract`` gets a session of its own in the same application: a session that has observed a write can no longer
    score models that keep a summary of their training (logistic regression, random forest)."""
    started, records, error = clock(), 0, None
    try:
        seen = Observation()
        write_dataset(extract(spark.newSession()).observe(seen, F.count(F.lit(1)).alias("records")), path, fmt)
        records = int(seen.get.get("records", 0))
        if records < least:
            error = f"expected {least} records or more, got {records}"
    except PySparkException as failure:
        error = str(failure).strip().split("\n")[0]
    ended = clock()
    row = (source, table, error is None, records, started, (ended - started).total_seconds(), error)
    return spark.createDataFrame(
        [row], "source string, table string, success boolean, records_extracted long, extracted_at timestamp_ntz, duration_seconds double, error_message string"
    )


def write_partitioned(df: DataFrame, path: str, date: str, name: str, salt: int | None = None) -> None:
    """Facts by month. Rows are dealt out by month and by ``salt`` slices of a month (as many as there are shuffle
    partitions unless given); small slices are put together again and large ones split when their sizes are known."""
    keyed = df.withColumn(name, year_month(F.col(date)))
    slices = salt or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = keyed.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(slices)))
    keyed.hint("rebalance", name, "_slice").drop("_slice").write.mode("overwrite").partitionBy(name).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions present in the rows: a rerun of one day leaves the others alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_mailing_list(listing: DataFrame, path: str) -> None:
    """Ordered CSV for the mail house, dates as yyyy-MM-dd."""
    date = "most_recent_one_time_date"
    ordered = listing.orderBy("DirectMailSubType", "postal_code", "crm_household_id")
    ordered.withColumn(date, F.date_format(date, "yyyy-MM-dd")).write.mode("overwrite").option("header", True).csv(path)


class KeyedTable:
    """A Parquet table with one row per key, in folders by a hash of the key. An upsert reads and replaces only the
    folders that its rows fall into. Applying the same rows again leaves the table as it is, so a replayed
    batch needs no record of what was applied, whatever its number."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 32):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _stored(self) -> DataFrame | None:
        return self.spark.read.parquet(self.path) if exists(self.spark, self.path) else None

    def read(self) -> DataFrame | None:
        found = self._stored()
        return None if found is None else found.drop(BUCKET)

    def upsert(self, rows: DataFrame, pick: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Put ``rows`` in; ``pick`` makes the new rows of the touched folders of (old rows, new rows)."""
        fresh = cut_lineage(self._dealt(rows))
        touched = [r[BUCKET] for r in fresh.select(BUCKET).distinct().collect()]  # one number per folder
        if not touched:
            return
        old = self._stored()
        merged = fresh if old is None else pick(old.where(F.col(BUCKET).isin(touched)).select(fresh.columns), fresh)
        # written aside first: a folder is only replaced by rows that are all there
        replace_partitions(cut_lineage(merged).repartition(F.col(BUCKET)), self.path, [BUCKET])


class Changes:
    """The latest row per key, merged when it is read: changes are appended in folders by day, ``read`` takes the latest row of each
    key from them and from the folded rows, and ``fold`` moves days that are over into the folders of the keys that they
    changed. Adding or folding rows twice changes nothing, so a step that was broken off is simply run again."""

    DAY = "_day"

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], day: str, buckets: int = 32):
        self.spark, self.keys, self.order, self.day = spark, list(keys), list(order), day
        self.added, self.folded = f"{path.rstrip('/')}/added", KeyedTable(spark, f"{path.rstrip('/')}/folded", keys, buckets)

    def add(self, rows: DataFrame) -> None:
        rows.withColumn(self.DAY, F.to_date(self.day)).write.mode("append").partitionBy(self.DAY).parquet(self.added)

    def _added(self) -> DataFrame | None:
        return self.spark.read.parquet(self.added) if exists(self.spark, self.added) else None

    def _latest(self, rows: DataFrame, *more: str) -> DataFrame:
        picked = F.max_by(F.struct(*rows.columns), F.struct(*self.order))
        return rows.groupBy(*more, *self.keys).agg(picked.alias("_row")).select("_row.*")

    def read(self) -> DataFrame | None:
        added, folded = self._added(), self.folded.read()
        added = None if added is None else added.drop(self.DAY)
        if added is None or folded is None:
            return folded if added is None else self._latest(added)
        return self._latest(folded.unionByName(added))

    def fold(self, until: str) -> None:
        """Fold the days before ``until`` (yyyy-MM-dd) and empty their folders."""
        added = self._added()
        over = None if added is None else added.where(F.col(self.DAY) < F.lit(until).cast("date"))
        if over is None or over.isEmpty():
            return
        days = [r[0] for r in over.select(self.DAY).distinct().collect()]  # one row per day
        self.folded.upsert(
            self._latest(over.drop(self.DAY)), lambda old, new: self._latest(old.unionByName(new), BUCKET).select(new.columns)
        )
        for day in days:
            over.drop(self.DAY).limit(0).write.mode("overwrite").parquet(f"{self.added}/{self.DAY}={day}")
