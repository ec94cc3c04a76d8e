"""Session settings and lineage cutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Sizes are measured at run time: AQE broadcasts a side only after seeing that it is small, and
# splits a skewed partition of a sort-merge join when it is not.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "constituent360", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``. Only a local master may leave it unset: it then gets
    a folder of its own in the warehouse, since driver and executors are one process."""
    context = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can read")
        current = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate-{context.applicationId}"
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back: a lost executor costs no recomputation, and later steps
    read only the columns and rows that they need."""
    path = scratch(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
