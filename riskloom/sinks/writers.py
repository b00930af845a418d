"""Tables, micro-batch partitions, JDBC tables and topics as targets."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from riskloom.session import settings, state_settings

TRIGGER = "10 seconds"


def database_for(custom: str | None, default: str) -> str:
    """The named database as it is, else the default one."""
    return custom.strip() if custom else default


def save_table(
    df: DataFrame,
    name: str,
    database: str | None = None,
    default_database: str = "default",
    fmt: str = "parquet",
    path: str | None = None,
    partition_by: Sequence[str] = (),
) -> str:
    """Create or replace a catalog table, with its database; returns the full name."""
    target = database_for(database, default_database)
    df.sparkSession.sql(f"create database if not exists `{target}`")
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(f"`{target}`.`{name}`")
    return f"{target}.{name}"


def running_stream(spark: SparkSession) -> str:
    """Id of the stream whose micro-batch this thread works on, or nothing outside of one.

    It belongs to the checkpoint: a restart keeps it, a new checkpoint has another.
    """
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def batch_key(stream: str, batch_id: int) -> int:
    """Number of a micro-batch that no other stream's batch has.

    Batches count from 0 in every stream, so the stream's id goes above them. Outside of a
    stream, and for the empty first batch -1, the key is the batch id.
    """
    if not stream or batch_id < 0:
        return batch_id
    return ((crc32(stream.encode()) & 0x7FFFFFFF) << 32) | batch_id


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    stream: str | None = None,
) -> None:
    """Write a micro-batch to a partition of its own; a repeat replaces it.

    ``stream`` is by default the one that runs. A stream with a new checkpoint counts its
    batches from 0 again and writes beside the earlier one's. Delta tables are appended to
    instead, and skip a batch they already hold.
    """
    stream = running_stream(df.sparkSession) if stream is None else stream
    key = batch_key(stream, batch_id)
    if fmt == "delta":
        rows = df.withColumn("batch_id", F.lit(key).cast("bigint"))
        options = delta_batch(path, batch_id, stream)
        writer = rows.write.format(fmt).mode("append").options(**options)
        writer.partitionBy("batch_id", *partition_by).save(path)
    else:
        save_partitioned(df, f"{path}/batch_id={key}", fmt, partition_by)


def delta_batch(path: str, batch_id: int, stream: str = "") -> dict[str, str]:
    """Options by which a Delta table knows a stream's batch it has already taken.

    Ids count from 0 in a stream; the empty first batch of a table has -1.
    """
    app = f"riskloom:{path}:{stream}" if stream else f"riskloom:{path}"
    return {"txnAppId": app, "txnVersion": str(batch_id + 1)}


def save_partitioned(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace a folder. Rows are first brought together by partition value.

    Spark sizes these groups as it runs: small ones share a task, a large one is
    split, so a day becomes few files without falling to one task.
    """
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    else:
        writer = df.write
    writer.format(fmt).mode("overwrite").save(path)


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    available_now: bool = False,
) -> StreamingQuery:
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return start(writer, df.sparkSession, checkpoint, available_now)


def each_batch(
    df: DataFrame,
    function: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(function).outputMode("append")
    return start(writer, df.sparkSession, checkpoint, available_now)


def start(
    writer: DataStreamWriter, spark: SparkSession, checkpoint: str, available_now: bool
) -> StreamingQuery:
    """Start every ten seconds, or once through all that is there."""
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=TRIGGER)
    with settings(spark, state_settings(spark)):
        return writer.option("checkpointLocation", checkpoint).start()


def jdbc_append(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Append to a JDBC table; the server turns text into its own column types."""
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()


def publish(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send key and value columns to a topic."""
    (
        messages.write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic, **options})
        .save()
    )


def with_batch_header(messages: DataFrame, batch_id: int, stream: str | None = None) -> DataFrame:
    """Messages with the key of their micro-batch as a header."""
    stream = running_stream(messages.sparkSession) if stream is None else stream
    value = F.lit(str(batch_key(stream, batch_id))).cast("binary")
    header = F.struct(F.lit("batch").alias("key"), value.alias("value"))
    return messages.withColumn("headers", F.array(header))


def empty_table(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> None:
    """An empty first batch, so that a reader finds the table from the start."""
    write_batch(spark.createDataFrame([], schema), path, -1, fmt)
