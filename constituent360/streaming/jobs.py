"""Streaming staging, change-driven upserts and metric refresh."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from constituent360.operators.temporal import latest_per_key
from constituent360.sources.writers import BUCKET, Changes, KeyedTable


def read_stream(spark: SparkSession, path: str, schema: StructType, pattern: str | None = None, files_per_batch: int = 100) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def staging_donations(stream: DataFrame, amount: str = "donation_amount") -> DataFrame:
    """Gifts with a positive amount, stamped with their processing time."""
    return stream.where(F.col(amount) > 0).withColumn("processed_at", F.current_timestamp())


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available to a Parquet folder, exactly once, then stop."""
    return (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def _start(stream: DataFrame, apply, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode).foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def upsert_stream(stream: DataFrame, table: KeyedTable, order: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Keep a table at the latest row per key. A late row does not replace a newer one: the later of the two stays.
    A batch that is applied twice, or again under a new checkpoint, changes nothing."""

    def latest(old: DataFrame, new: DataFrame) -> DataFrame:
        return latest_per_key(old.unionByName(new), [BUCKET, *table.keys], list(order)).select(new.columns)

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.upsert(latest_per_key(batch, table.keys, list(order)), latest)

    return _start(stream, apply, checkpoint)


def change_stream(stream: DataFrame, changes: Changes, checkpoint: str) -> StreamingQuery:
    """Add every batch to a table of changes. What is written follows the batch, whatever the table holds, and a batch that is
    added twice changes nothing in the view."""
    return _start(stream, lambda batch, batch_id: changes.add(batch), checkpoint)


def metric_refresh(
    stream: DataFrame, ts: str, value: str, by: Sequence[str], window: str = "1 hour", late: str | None = None
) -> DataFrame:
    """Count and sum per time window and label. With ``late``, windows are closed that long after the latest time seen and
    rows for them are dropped: for live feeds. Without it nothing is dropped, as history in any order needs."""
    rows = stream if late is None else stream.withWatermark(ts, late)
    return (
        rows.groupBy(F.window(ts, window).alias("w"), *by)
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n", "total")
    )


def append_closed(metric: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the windows of a metric with a lateness to a Parquet folder when they close: each window once, for good. Its state
    is dropped then, so what is kept between batches follows the lateness and not the history. A restart from the same
    checkpoint goes on where the last run ended; windows that are still open come with a later run."""
    return write_stream(metric, path, checkpoint)


def refresh_table(metric: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Write the changed windows of each batch into the table."""

    def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [old[k].eqNullSafe(new[k]) for k in [BUCKET, *table.keys]])
        return old.join(new, same, "left_anti").unionByName(new)

    return _start(metric, lambda batch, batch_id: table.upsert(batch, replaced), checkpoint, "update")
