"""Topics, tables, JDBC tables and seed files as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom.schemas import struct_of

TOPIC_MESSAGE = struct_of(
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)


def topic_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    """From the earliest message on; messages gone from the topic do not stop the job."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **extra,
    }


def topic_stream(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """A topic as a stream. Pass ``maxOffsetsPerTrigger`` to bound a micro-batch."""
    return (
        spark.readStream.format("kafka").options(**topic_options(servers, topic, **extra)).load()
    )


def table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """An append-only table as a stream. File formats need ``schema``; Delta has its own."""
    reader = spark.readStream.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    return reader.load(path)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 1,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read; with a partition column it runs as many parallel reads."""
    options = {"url": url, "dbtable": table, **extra}
    if partition_column:
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def jdbc_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headered CSV file (or a folder of them) under a fixed schema."""
    return spark.read.schema(schema).option("header", True).csv(path)
