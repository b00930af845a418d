"""Fact rows: first silver row per transaction, joined to four dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import date_key, money, score, surrogate_key
from riskloom.operators.asof import asof_join, asof_join_all, meetings
from riskloom.operators.dedup import first_row
from riskloom.operators.scd2 import backdate_first
from riskloom.operators.skew import BROADCAST_ROWS, fits, lookup_join

SPREAD = ("transaction_id",)

# Columns of silver that the fact is made of; no others are shuffled.
FACT_INPUT = (
    "transaction_id",
    "customer_id",
    "account_id",
    "merchant_id",
    "amount",
    "currency",
    "payment_method",
    "risk_score",
    "is_fraud_suspect",
    "fraud_reason",
    "event_time",
    "processed_at",
    "kafka_offset",
)


def join_version(
    rows: DataFrame,
    dim: DataFrame,
    key: str,
    sk: str,
    backdate: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
    counted: DataFrame | None = None,
    bucket: str = "day",
) -> DataFrame:
    """Add ``sk`` of the version that held at the event time, NULL if none did.

    A small history is broadcast; a larger one is joined in the order of time, inside
    ``bucket``s of it.
    """
    versions = _versions(dim, key, sk, backdate)
    if not fits(versions, broadcast_rows):
        return asof_join(rows, versions, key, [sk], "event_time", SPREAD, bucket, counted=counted)
    at = F.col("event_time")
    held = (at >= F.col("_from")) & (F.col("_to").isNull() | (at < F.col("_to")))
    joined = lookup_join(rows, versions, [key], SPREAD, held, broadcast_rows)
    return joined.drop("_from", "_to")


def _versions(dim: DataFrame, key: str, sk: str, backdate: bool) -> DataFrame:
    return backdate_first(dim, key, backdate).select(
        key, sk, F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to")
    )


def join_versions(
    rows: DataFrame,
    dims: Sequence[tuple[DataFrame, str, str]],
    backdate: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``join_version`` for several (dimension, key, sk).

    Large histories share one shuffle of the rows, if the versions that the combinations of
    keys meet there are no more than the rows; else each has its own.
    """
    large = [d for d in dims if not fits(d[0], broadcast_rows)]
    together = []
    if len(large) > 1:
        n_rows, met = meetings(rows if counted is None else counted, [d[:2] for d in large])
        together = large if met <= n_rows else []
    for dim, key, sk in dims:
        if (dim, key, sk) not in together:
            rows = join_version(rows, dim, key, sk, backdate, broadcast_rows, counted)
    if not together:
        return rows
    histories = [(_versions(*d, backdate), d[1], [d[2]]) for d in together]
    return asof_join_all(rows, histories, "event_time", SPREAD, counted=counted)


def join_merchant(
    rows: DataFrame,
    merchants: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    found = merchants.select("merchant_id", "merchant_sk")
    return lookup_join(rows, found, ["merchant_id"], SPREAD, None, broadcast_rows, counted)


def join_date(rows: DataFrame, dates: DataFrame) -> DataFrame:
    """Add ``date_sk``, NULL for a day outside the calendar.

    The calendar has a row per day, whatever the size of the data.
    """
    days = F.broadcast(dates.select("date_sk"))
    return rows.join(days, date_key("event_time") == F.col("date_sk"), "left")


def blocked_transactions(alerts: DataFrame) -> DataFrame:
    """Ids that triage has blocked, for ``build_fact(blocked=...)``."""
    return alerts.filter(F.col("status") == "BLOCKED").select(
        "transaction_id", F.lit(True).alias("is_blocked_flag")
    )


def build_fact(
    silver: DataFrame,
    customers: DataFrame,
    accounts: DataFrame,
    merchants: DataFrame,
    dates: DataFrame,
    loaded_at: Column | None = None,
    backdate: bool = True,
    blocked: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Pass dimensions that are tables: each is counted before it is broadcast.

    Versions are joined last: rows then lie by their keys, and the fact's files hold long
    runs of one version.
    """
    size = {"broadcast_rows": broadcast_rows, "counted": silver}
    needed = silver.select(*FACT_INPUT).withColumns(
        {"amount": money("amount"), "risk_score": score("risk_score")}
    )
    rows = first_row(needed, ["transaction_id"], ["processed_at", "kafka_offset"])
    rows = rows.drop("processed_at", "kafka_offset")
    rows = join_merchant(rows, merchants, **size).drop("merchant_id")
    histories = [
        (customers, "customer_id", "customer_sk"),
        (accounts, "account_id", "account_sk"),
    ]
    rows = join_versions(rows, histories, backdate, **size)
    rows = join_date(rows, dates)
    if blocked is None:
        rows = rows.withColumn("is_blocked_flag", F.lit(False))
    else:
        rows = rows.join(blocked, "transaction_id", "left").fillna(False, ["is_blocked_flag"])
    at = F.current_timestamp() if loaded_at is None else loaded_at
    return rows.select(
        surrogate_key("transaction_id").alias("transaction_sk"),
        "transaction_id",
        "customer_sk",
        "account_sk",
        "merchant_sk",
        "date_sk",
        "amount",
        "currency",
        "payment_method",
        "risk_score",
        "is_fraud_suspect",
        "is_blocked_flag",
        "fraud_reason",
        F.col("event_time").cast("timestamp").alias("event_time"),
        at.alias("inserted_at"),
    )
