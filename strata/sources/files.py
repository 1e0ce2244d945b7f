"""Batch sources and sinks: JDBC, CSV, Parquet and JSON layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition: Mapping[str, object] | None = None,
) -> DataFrame:
    """Full-table JDBC read.

    Without ``partition`` the read is one task on one connection. With
    ``partition={"column", "lowerBound", "upperBound", "numPartitions"}`` Spark
    issues one range query per partition, in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition:
        reader = (
            reader.option("partitionColumn", partition["column"])
            .option("lowerBound", str(partition["lowerBound"]))
            .option("upperBound", str(partition["upperBound"]))
            .option("numPartitions", str(partition["numPartitions"]))
        )
    return reader.load()


def read_sales_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """CSV with a header. An explicit schema avoids the extra inference pass
    (and the inference of ``HH:mm:ss`` text as a timestamp on today's date)."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_sales_csv(df: DataFrame, path: str) -> None:
    """Land a frame as CSV files with a header. Blanks around text are kept
    (the writer trims them by default), so a read gives back the same text."""
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def read_layer(
    spark: SparkSession, base: str, name: str, fmt: str = "parquet", merge_schema: bool = False
) -> DataFrame:
    """Scan one layer table ``<base>/<name>``. ``merge_schema`` unions the
    columns of files appended with an evolved schema."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(f"{base.rstrip('/')}/{name}")


def read_nanos_layer(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose nanosecond timestamps are read as longs (nanoseconds since
    the epoch; ``nanos_to_timestamp`` converts them). Spark has a session setting
    for it and no reader option; it has to be on (``build_session`` does it) and is
    left as it is, as reads are lazy and it concerns all of them."""
    if spark.conf.get(NANOS_AS_LONG, "false").lower() != "true":
        raise ValueError(f"set {NANOS_AS_LONG} to true to read nanosecond timestamps")
    return spark.read.parquet(path)


NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


PARQUET_CODEC = "zstd"  # of layer tables; about a third smaller than Spark's default


def _layout(df: DataFrame, partition_by: Sequence[str], files: int | None, shuffle: bool) -> DataFrame:
    if files is None:
        # AQE rebalance: small partitions merged, skewed ones split, so each
        # partition directory gets few files and a hot value several tasks.
        return df.hint("rebalance", *partition_by) if partition_by else df
    if not shuffle:
        return df.coalesce(files)
    if partition_by:
        return df.repartition(files, *partition_by)
    return df.repartition(files)


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    files: int | None = None,
    shuffle: bool = True,
    mode: str = "overwrite",
    fmt: str = "parquet",
    present_only: bool = False,
) -> None:
    """Write a layer table.

    Partition columns that the frame lacks are skipped. A partitioned write is
    rebalanced on its partition columns (AQE sizes the tasks, splitting hot
    values). ``files`` instead fixes the task count: ``repartition(files,
    *partition_by)`` by default, ``coalesce(files)`` with ``shuffle=False``. With
    ``present_only`` an overwrite replaces the partitions that ``df`` has rows of
    and leaves the others as they are.
    """
    cols = [c for c in (partition_by or []) if c in df.columns]
    writer = _layout(df, cols, files, shuffle).write.mode(mode).format(fmt)
    if cols:
        writer = writer.partitionBy(*cols)
    if fmt == "parquet":
        writer = writer.option("compression", PARQUET_CODEC)
    writer.option("partitionOverwriteMode", "dynamic" if present_only else "static").save(path)


def append_layer(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Append rows to a layer table (one row per ingested record)."""
    write_layer(df, path, partition_by=partition_by, mode="append")


def write_json_lines(df: DataFrame, path: str, files: int | None = None) -> None:
    """Land a frame of one text column as JSON-lines files."""
    out = df.repartition(files) if files else df
    out.write.mode("overwrite").text(path)
