"""Alert messages out of scored rows, and operational alert rows out of messages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas as S
from riskloom.functions.scalars import json_row, money, score
from riskloom.operators.dedup import first_row

ID_BUCKETS = 1024


def suspects(silver: DataFrame) -> DataFrame:
    return silver.filter("is_fraud_suspect")


def alert_messages(silver: DataFrame) -> DataFrame:
    """Key and JSON value of each suspect row, ready for a topic."""
    return suspects(silver).select(
        F.col("transaction_id").alias("key"), json_row(silver.columns).alias("value")
    )


def _read_messages(messages: DataFrame) -> DataFrame:
    """Fields of the messages. A time may have a fraction and a zone or not; without a zone
    it is in UTC, the session's."""
    texts = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == "event_time" else f.dataType)
            for f in S.ALERT_MESSAGE.fields
        ]
    )
    payload = F.from_json(F.col("value").cast("string"), texts)
    others = [c for c in messages.columns if c not in ("key", "value")]
    # inlined, each message is parsed once, whatever is filtered later
    rows = messages.select(*others, F.inline(F.array(payload)))
    return rows.withColumn("event_time", F.col("event_time").try_cast("timestamp"))


def extract_alerts(messages: DataFrame) -> DataFrame:
    """Alert columns of messages that can be stored; level and reason get defaults."""
    level = F.when(F.col("risk_score") < F.lit(S.CRITICAL_LEVEL), F.lit("HIGH")).otherwise(
        F.lit("CRITICAL")
    )
    rows = _read_messages(messages).filter(_usable())
    return rows.withColumns(
        {
            "risk_level": F.coalesce(F.col("risk_level"), level),
            "fraud_reason": F.coalesce(F.col("fraud_reason"), F.lit(S.REASON_DEFAULT_ALERT)),
        }
    )


def rejected_alerts(messages: DataFrame) -> DataFrame:
    """Messages that lack what an alert must have, for a quarantine table."""
    return _read_messages(messages).filter(~_usable())


def _usable() -> Column:
    """All of the alert table's columns that take no NULL, as they will be stored."""
    stored = [F.col(c) for c in ("transaction_id", "account_id", "customer_id", "event_time")]
    stored += [money("amount"), score("risk_score")]
    return reduce(and_, [c.isNotNull() for c in stored])


def number_rows(
    rows: DataFrame, key: str, name: str, after: int = 0, buckets: int = ID_BUCKETS
) -> DataFrame:
    """Add unique ids above ``after``, the same for the same rows.

    Rows are numbered inside hash buckets, and bucket b of n takes every n-th id from
    b on: one pass, no global sort, and gaps only where buckets differ in size. Very
    large batches want more buckets, as each is numbered in one task.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        rows.withColumn("_bucket", bucket)
        .withColumn(name, (inside - 1) * buckets + F.col("_bucket") + F.lit(after + 1))
        .drop("_bucket")
    )


def absent_alerts(
    existing: DataFrame, incoming: DataFrame, order: Sequence[str] = ("event_time",)
) -> DataFrame:
    """Incoming rows whose transaction has no alert yet; the first of several wins.

    The stored ids are first cut down to the incoming ones. That side is usually one
    small micro-batch, so Spark can send it to the stored table and not shuffle that.
    """
    fresh = first_row(incoming, ["transaction_id"], order)
    sent = incoming.select("transaction_id").distinct()
    known = existing.select("transaction_id").join(sent, "transaction_id", "left_semi")
    return fresh.join(known, "transaction_id", "left_anti")


def new_alerts(
    existing: DataFrame,
    incoming: DataFrame,
    now: Column | None = None,
    order: Sequence[str] = ("event_time",),
    after: int | None = None,
    buckets: int = ID_BUCKETS,
) -> DataFrame:
    """Full alert rows to add, with ids above ``after`` (else the last id) and defaults."""
    now = F.current_timestamp() if now is None else now
    if after is None:
        after = existing.agg(F.coalesce(F.max("alert_id"), F.lit(0))).first()[0]
    fresh = absent_alerts(existing, incoming, order)
    rows = number_rows(fresh, "transaction_id", "alert_id", after, buckets)
    return rows.select(
        "alert_id",
        "transaction_id",
        "account_id",
        "customer_id",
        money("amount").alias("amount"),
        score("risk_score").alias("risk_score"),
        "risk_level",
        "fraud_reason",
        F.lit("PENDING").alias("status"),
        F.lit(None).cast("string").alias("operator_notes"),
        "event_time",
        now.alias("created_at"),
        now.alias("updated_at"),
    )
