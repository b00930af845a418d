"""Alert topic to the operational alert table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom import schemas as S
from riskloom.operators.alerts import ID_BUCKETS, extract_alerts, new_alerts, rejected_alerts
from riskloom.session import ADAPTIVE_CONF, settings
from riskloom.sinks.keyed import KeyStore
from riskloom.sinks.writers import (
    batch_key,
    each_batch,
    empty_table,
    running_stream,
    write_batch,
)
from riskloom.streaming.alert_ids import AlertIds, as_id, following


_KEY = S.struct_of("transaction_id string")


def stored_alerts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "delta":  # takes no schema from outside
        return spark.read.format(fmt).load(path)
    schema = T.StructType([*S.OPERATIONAL_ALERTS.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.format(fmt).schema(schema).load(path)


def consume(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    now: Column | None = None,
    order: Sequence[str] = ("event_time",),
    available_now: bool = False,
    rejects: str | None = None,
    id_buckets: int = ID_BUCKETS,
    key_buckets: int | None = None,
    compact_every: int = 100,
) -> StreamingQuery:
    """Insert an alert per transaction that has none; a failed batch is run again.

    A repeated batch does not see its own earlier output, and replaces it. Messages that
    can't be stored go to ``rejects`` under the same batch, by default beside the table.
    Ids are handed out by ``AlertIds`` in a folder beside the table.

    With ``key_buckets`` the stored transactions are kept in a ``KeyStore`` beside the table,
    in so many buckets: a batch then reads the buckets of its own transactions and the last
    ``compact_every`` batches' keys, not all stored alerts.
    """
    spark = messages.sparkSession
    rejects = rejects or f"{path.rstrip('/')}_rejected"
    empty_table(spark, path, S.OPERATIONAL_ALERTS, fmt)
    empty_table(spark, rejects, rejected_alerts(_empty(spark, messages)).schema, fmt)
    ids = AlertIds(spark, f"{path.rstrip('/')}_ids")
    keys = None
    if key_buckets:
        keys = KeyStore(spark, f"{path.rstrip('/')}_keys", _KEY, key_buckets)
        if not keys.exists():
            keys.create(stored_alerts(spark, path, fmt))

    def insert(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = running_stream(session)
        key = batch_key(stream, batch_id)
        with settings(session, ADAPTIVE_CONF):
            batch.persist()
            try:
                existing = stored_alerts(session, path, fmt).filter(F.col("batch_id") != key)
                lane, number = ids.open(stream, batch_id, existing)
                incoming = extract_alerts(batch)
                known = existing
                if keys:
                    store = replace(keys, spark=session)
                    if batch_id and batch_id % compact_every == 0:
                        store.compact()
                    known = store.look_up(incoming, without_batch=key)
                rows = new_alerts(known, incoming, now, order, number - 1, id_buckets)
                rows = rows.withColumn("alert_id", as_id(F.col("alert_id"), lane))
                write_batch(rows, path, batch_id, fmt)
                write_batch(rejected_alerts(batch), rejects, batch_id, fmt)
                own = stored_alerts(session, path, fmt).filter(F.col("batch_id") == key)
                if keys:
                    store.add(own, batch_id, stream)
                ids.close(stream, batch_id, lane, following(own, number))
            finally:
                batch.unpersist()

    return each_batch(messages, insert, checkpoint, available_now)


def _empty(spark: SparkSession, messages: DataFrame) -> DataFrame:
    return spark.createDataFrame([], messages.schema)
