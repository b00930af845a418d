"""Validity flag, quarantine reason, and the split into good and bad rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import schemas as S


def quarantine_reason(
    strict: bool = False, nan_is_invalid: bool = True, max_ahead: str | None = None
) -> Column:
    """The first rule a row breaks, or NULL.

    ``strict`` also rejects a missing currency or event time. ``max_ahead`` (an
    interval such as ``"1 hour"``) rejects rows timed after their ingestion day's
    end plus that much: one such row would move the watermark past its peers.
    """
    amount = F.col("amount")
    not_positive = amount <= 0
    if nan_is_invalid:
        not_positive = not_positive | F.isnan(amount)
    rules = [
        (F.col("transaction_id").isNull(), S.REASON_MISSING_ID),
        (amount.isNull(), S.REASON_MISSING_AMOUNT),
        (not_positive, S.REASON_INVALID_AMOUNT),
    ]
    if strict:
        rules.append((F.col("currency").isNull(), S.REASON_MISSING_CURRENCY))
        rules.append((F.col("event_time").isNull(), S.REASON_MISSING_TIME))
    if max_ahead:
        day_end = F.expr(
            f"cast(bronze_ingestion_date as timestamp) + interval 1 day + interval {max_ahead}"
        )
        rules.append((F.col("event_time") > day_end, S.REASON_FUTURE_TIME))
    reason = F.lit(None).cast("string")
    for broken, text in reversed(rules):
        reason = F.when(broken, F.lit(text)).otherwise(reason)
    return reason


def validate(rows: DataFrame, **options) -> DataFrame:
    """Add ``is_valid`` and ``dlq_reason``; options as for ``quarantine_reason``."""
    reason = quarantine_reason(**options)
    return rows.select("*", reason.isNull().alias("is_valid"), reason.alias("dlq_reason"))


def valid_rows(validated: DataFrame) -> DataFrame:
    """Good rows without the debug columns, with their event day."""
    return (
        validated.filter("is_valid")
        .drop("is_valid", "dlq_reason", "raw_payload")
        .withColumn("event_date", F.to_date("event_time"))
    )


def quarantined_rows(validated: DataFrame) -> DataFrame:
    return validated.filter(~F.col("is_valid"))


def bad_currency() -> Column:
    """True for a currency outside the accepted codes; NULL currency passes."""
    return F.coalesce(~F.col("currency").isin(*S.CURRENCIES), F.lit(False))


def quarantine_currency(validated: DataFrame) -> DataFrame:
    """Turn good rows with an unknown currency into quarantined ones."""
    bad = F.col("is_valid") & bad_currency()
    return validated.withColumns(
        {
            "is_valid": F.col("is_valid") & ~bad,
            "dlq_reason": F.when(bad, F.lit(S.REASON_INVALID_CURRENCY)).otherwise(
                F.col("dlq_reason")
            ),
        }
    )
