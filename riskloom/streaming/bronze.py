"""Topic to bronze table, unparsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.bronze import envelope
from riskloom.sinks.writers import append_stream


def ingest(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    ingested_at: Column | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    return append_stream(
        envelope(messages, ingested_at),
        path,
        checkpoint,
        fmt,
        partition_by=["ingestion_date"],
        available_now=available_now,
    )
