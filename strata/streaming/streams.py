"""Structured Streaming sources and sinks.

* JSON file source with an explicit schema and a files-per-trigger limit.
* Streaming read of an append-only layer table.
* Append sink to Parquet with a checkpoint (exactly-once file sink).
* Complete-mode sink through ``foreachBatch``: each batch writes the whole
  result as the next snapshot version, committed under (query id, batch id), so
  a replayed batch changes nothing and readers only ever see committed versions.
* Update-mode sink through ``foreachBatch``: each batch rewrites the partitions of
  the groups that changed, committed in the same way.

Triggers are parameters: ``{"processingTime": "30 seconds"}`` for a running
service, ``{"availableNow": True}`` to drain what is there and stop (tests,
scheduled runs).
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from strata.operators.clean import with_ingest_meta
from strata.sources.snapshots import expire_snapshots, path_exists, replace_rows, write_snapshot

# Order event records; every field nullable, so a malformed field becomes NULL
# and the record is kept (PERMISSIVE parsing).
ORDER_EVENT_SCHEMA = StructType(
    [
        StructField("order_id", LongType(), True),
        StructField("customer_id", LongType(), True),
        StructField("product", StringType(), True),
        StructField("amount", DoubleType(), True),
        StructField("status", StringType(), True),
        StructField("event_time", TimestampType(), True),
    ]
)

# Fixed values of the order stream: files per trigger and event-time watermark.
MAX_FILES_PER_TRIGGER = 10
WATERMARK_DELAY = "10 minutes"


def orders_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = ORDER_EVENT_SCHEMA,
    max_files: int = MAX_FILES_PER_TRIGGER,
    watermark: str | None = WATERMARK_DELAY,
    source: str = "stream",
) -> DataFrame:
    """JSON-lines files arriving under ``path`` -> stamped, watermarked rows.

    With no stateful operator downstream the watermark drops nothing: late
    rows are kept. The event time must be ``TIMESTAMP`` (not NTZ) for it.
    """
    df = (
        spark.readStream.format("json")
        .schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("mode", "PERMISSIVE")
        .load(path)
    )
    df = with_ingest_meta(df, source)
    if watermark:
        df = df.withWatermark("event_time", watermark)
    return df


def table_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """Stream the files appended to a Parquet layer table."""
    reader = spark.readStream.format("parquet").schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _apply_trigger(writer, trigger: Mapping[str, object] | None):
    if trigger:
        writer = writer.trigger(**trigger)
    return writer


def start_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    partition_by: list[str] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append every new row to Parquet; the checkpoint makes restarts resume
    exactly where the last committed batch ended."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return _apply_trigger(writer, trigger).start()


def start_complete(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Complete-mode aggregate written as one snapshot version per batch (the
    Parquet sink itself accepts append mode only).

    A batch is committed under (query id, batch id). One that is already in the
    history (a crash between that commit and the stream's own) is evaluated
    without being written, so its state is stored and nothing changes; a query
    with a new checkpoint has a new id, and its batches become the next
    versions.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_snapshot(batch, path, operation="STREAMING UPDATE", txn=f"{query_id}/{batch_id}")

    writer = df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    if query_name:
        writer = writer.queryName(query_name)
    return _apply_trigger(writer, trigger).start()


def start_update(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str],
    partition_by: list[str],
    gone: Column | None = None,
    keep_versions: int | None = None,
    trigger: Mapping[str, object] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Update-mode aggregate kept in a partitioned snapshot table: each batch holds
    the groups that changed, and only their partitions are written again.

    Groups for which ``gone`` holds are removed; columns that begin with ``_``
    serve ``gone`` and are not stored. A batch is committed under (query id,
    batch id), so a replayed one changes nothing. With ``keep_versions``, data that
    only older versions list is removed after each batch.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        txn = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}/{batch_id}"
        replace_rows(batch, path, keys, partition_by, gone, "STREAMING UPDATE", txn)
        if keep_versions:
            expire_snapshots(spark, path, keep_versions)

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    if query_name:
        writer = writer.queryName(query_name)
    return _apply_trigger(writer, trigger).start()


def reconciled(batch: DataFrame, schema: StructType | None) -> DataFrame:
    """``batch`` with the columns of the sink's ``schema`` first, in their order
    (NULL where it lacks one), then its new ones. Of two numeric types the wider is
    taken; a change to a type that cannot hold the old values is an error."""
    if schema is None:
        return batch
    have = {f.name: f.dataType for f in batch.schema}
    columns = []
    for field in schema:
        kind = field.dataType
        if field.name not in have:
            columns.append(F.lit(None).cast(kind).alias(field.name))
            continue
        if have[field.name] != kind:
            old, new = (_WIDTH.get(t.typeName(), (None, 0)) for t in (kind, have[field.name]))
            if old[0] is None or old[0] != new[0]:
                raise ValueError(f"column {field.name}: {have[field.name].simpleString()} does not fit {kind.simpleString()}")
            kind = kind if old[1] >= new[1] else have[field.name]
        columns.append(F.col(field.name).cast(kind).alias(field.name))
    known = set(schema.fieldNames())
    return batch.select(*columns, *[F.col(c) for c in batch.columns if c not in known])


# Types that widen into one another: (family, width).
_WIDTH = {"byte": ("int", 1), "short": ("int", 2), "integer": ("int", 4), "long": ("int", 8), "float": ("real", 4), "double": ("real", 8)}


def sink_schema(spark: SparkSession, path: str) -> StructType | None:
    """The newest schema of an evolving sink (None before its first batch)."""
    if not path_exists(spark, f"{path}/_schema"):
        return None
    rows = spark.read.schema("lote string, written_at timestamp, schema_json string").parquet(f"{path}/_schema")
    newest = rows.agg(F.max_by("schema_json", "written_at")).first()[0]
    return None if newest is None else StructType.fromJson(json.loads(newest))


def start_evolving_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append every new row to Parquet while the schema grows: a stream restarted on
    the same checkpoint with more (or fewer, or wider) columns goes on in the same
    sink (``read_evolved``).

    Each batch is brought to the sink's schema and written to a directory of its
    own, named by (query id, batch id), so a replayed batch writes the same one.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        had = sink_schema(spark, path)
        out = reconciled(batch, had)
        out.write.mode("overwrite").parquet(f"{path}/lote={name}")
        if had is None or out.schema != had:
            row = spark.createDataFrame([(name, out.schema.json())], "lote string, schema_json string")
            row = row.select("lote", F.current_timestamp().alias("written_at"), "schema_json")
            row.coalesce(1).write.mode("append").parquet(f"{path}/_schema")

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    if query_name:
        writer = writer.queryName(query_name)
    return _apply_trigger(writer, trigger).start()


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """An evolving sink in its newest schema; columns that a batch lacked are NULL."""
    schema = sink_schema(spark, path)
    if schema is None:
        raise FileNotFoundError(f"no batch at {path}")
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key of a watermarked stream. State is kept for as long as the
    watermark's delay after a key's first row, so it does not grow with the
    stream; a repetition that comes later than that is late itself."""
    return df.dropDuplicatesWithinWatermark(keys)


def run_until_done(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Block until an ``availableNow`` query has drained its input."""
    query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def wait_for_any(spark: SparkSession, timeout_s: float | None = None) -> bool:
    """Block until any of the session's streams ends, raising its error if it
    failed; False when ``timeout_s`` ran out first."""
    return spark.streams.awaitAnyTermination(timeout_s) is not False


def event_time_ntz(df: DataFrame, col: str = "event_time") -> DataFrame:
    """Back to wall-clock (NTZ) for output: the inverse of the session-zone
    parse of the JSON text."""
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))
