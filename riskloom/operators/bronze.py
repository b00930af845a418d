"""Raw topic messages to bronze rows, and bronze rows to parsed payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.schemas import PAYLOAD


def envelope(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Bronze rows from topic messages: text key and payload, metadata, ingestion day."""
    at = F.current_timestamp() if ingested_at is None else ingested_at.cast("timestamp")
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_payload"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        at.alias("ingestion_timestamp"),
        F.date_format(at, "yyyy-MM-dd").alias("ingestion_date"),
    )


def parse_payload(bronze: DataFrame) -> DataFrame:
    """Payload columns under the fixed schema; a malformed payload gives NULLs.

    ``inline`` keeps each payload parsed once; fields of a plain struct column would be
    parsed again in every filter and projection that Spark moves below it.
    """
    return bronze.select(
        "raw_payload",
        F.inline(F.array(F.from_json("raw_payload", PAYLOAD))),
        "kafka_offset",
        F.col("ingestion_date").alias("bronze_ingestion_date"),
    )
