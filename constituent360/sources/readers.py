"""Readers for landed source data. Schemas are given, never inferred."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from constituent360.functions.dates import year_month


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def text_schema(columns) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_table(spark: SparkSession, base: str, name: str, schema, multi_line: bool = False) -> DataFrame:
    """``<name>.csv`` with a header if there is one, else ``<name>.json`` holding an array of records.
    Both may be folders of part files. CSV files are split among tasks, unless ``multi_line`` says that fields hold line
    breaks: then a file is one task."""
    if exists(spark, f"{base}/{name}.csv"):
        return (
            spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", multi_line)
            .csv(f"{base}/{name}.csv")
        )
    if exists(spark, f"{base}/{name}.json"):
        return spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(f"{base}/{name}.json")
    raise FileNotFoundError(f"No data file found for table: {name}")


def describe_schema(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def load_source_records(df: DataFrame, source_system: str, mapping: dict[str, str]) -> DataFrame:
    """Rename mapped columns to record fields, tag the source and keep the whole row as a string map.
    Mapped columns that the data lacks are skipped."""
    present = {field: c for field, c in mapping.items() if c in df.columns}
    raw = F.map_from_arrays(
        F.array(*[F.lit(c) for c in df.columns]), F.array(*[F.col(c).cast("string") for c in df.columns])
    )
    return df.select(
        F.lit(source_system).alias("source_system"), *[F.col(c).alias(field) for field, c in present.items()], raw.alias("raw_data")
    )


def to_source_records(df: DataFrame, source_system: str, id_col: str, order: str, first_per: str | None = None) -> DataFrame:
    """Contact rows from transactions: optionally only the first row per person."""
    rows = df
    if first_per:
        others = [c for c in df.columns if c != first_per]
        rows = df.groupBy(first_per).agg(F.min_by(F.struct(*others), order).alias("_r")).select(first_per, "_r.*")
    return rows.withColumns({"source_system": F.lit(source_system), "source_id": F.col(id_col).cast("string")})


def union_sources(*sources: DataFrame) -> DataFrame:
    out = sources[0]
    for df in sources[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def explode_api_pages(pages: DataFrame, text: str, record: StructType) -> DataFrame:
    """Records of landed API pages. A page is a list of records, or an object holding the list under
    ``data`` or else ``results``."""
    wrapped = StructType([StructField("data", ArrayType(record)), StructField("results", ArrayType(record))])
    page = F.col(text)
    whole = F.from_json(page, wrapped)
    listed = F.when(F.ltrim(page).startswith("["), F.from_json(page, ArrayType(record))).otherwise(
        F.coalesce(whole["data"], whole["results"])
    )
    others = [c for c in pages.columns if c != text]
    return pages.select(*others, F.explode(listed).alias("_r")).select(*others, "_r.*")


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, properties: dict | None = None,
              partition_column: str | None = None, bounds: tuple | None = None, partitions: int = 32) -> DataFrame:
    """Database extract. A table is read whole, in parallel ranges of the partition column when given."""
    is_query = table_or_query.strip().lower().startswith("select")
    options = {"url": url, **(properties or {})}
    if partition_column and bounds:
        options["dbtable"] = f"({table_or_query}) q" if is_query else table_or_query
        options.update(partitionColumn=partition_column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions))
    elif is_query:
        options["query"] = table_or_query
    else:
        options["dbtable"] = table_or_query
    return spark.read.format("jdbc").options(**options).load()


def extract_audit(
    df: DataFrame, source: str, table: str, started: dt.datetime, ended: dt.datetime, least: int = 1
) -> DataFrame:
    """One audit row per extract: when it ran and for how long, the records read, and whether there were as many as
    expected at ``least``."""
    enough = F.col("records_extracted") >= least
    return df.agg(F.count("*").alias("records_extracted")).select(
        F.lit(source).alias("source"), F.lit(table).alias("table"), enough.alias("success"), "records_extracted",
        F.lit(started).cast("timestamp_ntz").alias("extracted_at"),
        F.lit((ended - started).total_seconds()).alias("duration_seconds"),
        F.when(~enough, F.concat(F.lit(f"expected {least} records or more, got "), F.col("records_extracted").cast("string")))
        .alias("error_message"),
    )


def between_months(df: DataFrame, date: str, month: str, start, end) -> DataFrame:
    """Filter on a date and on the month it is partitioned by, so whole partitions are skipped."""
    low, high = F.lit(start), F.lit(end)
    return df.where(
        F.col(month).between(year_month(low), year_month(high)) & F.col(date).between(low, high)
    )
