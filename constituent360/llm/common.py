"""Small helpers that the text operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from constituent360.session import scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space in all contracts: space and the code points 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Has Spark remove the shuffle files of a job when it ends, not when the driver next collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them back, so that later jobs neither
    recompute them nor depend on an executor that may be lost. The shuffle files behind them go at once."""
    spark = df.sparkSession
    path, before = scratch(spark, name), spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.folder = path
    return out


def discard(table: DataFrame) -> None:
    """Remove the files of a stored table that nothing reads any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(column):
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def few_of_each(rows: DataFrame, by: str, most: int, margin: int = 4) -> DataFrame:
    """The ``most`` rows of each value of ``by`` with the least hashes of doc_id (ties by id).

    The number of rows of each value comes first (one row per value, to the driver); it gives a bound on the hash that
    about ``margin`` times as many rows pass, so that only these are sorted, however many rows there are.
    """
    steps = 1 << 31
    ticket = F.pmod(F.xxhash64("doc_id"), F.lit(steps))
    counts = rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return rows.limit(0)
    bounds = F.create_map(*[F.lit(x) for r in counts for x in (r[by], min(steps, steps * margin * most // r["n"] + 1))])
    order = Window.partitionBy(by).orderBy("_ticket", "doc_id")
    low = rows.where(F.col(by).isNotNull()).withColumn("_ticket", ticket).where(F.col("_ticket") < F.element_at(bounds, F.col(by)))
    return low.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= most).drop("_ticket", "_nth")
