"""Declared data checks, all row checks of a table in one scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators.validate import bad_currency


class CheckFailed(Exception):
    """Raised by ``require``; the message lists the failed checks."""


@dataclass(frozen=True)
class RowCheck:
    name: str
    column: str
    violated: Column


@dataclass(frozen=True)
class UniqueCheck:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ReferenceCheck:
    column: str
    parent: DataFrame
    parent_column: str


def not_null(*columns: str) -> list[RowCheck]:
    return [RowCheck("not_null", c, F.col(c).isNull()) for c in columns]


def accepted_values(column: str, values: Sequence[str]) -> list[RowCheck]:
    """NULL passes; pair with ``not_null`` to reject it."""
    outside = F.coalesce(~F.col(column).isin(*values), F.lit(False))
    return [RowCheck("accepted_values", column, outside)]


def unique(*columns: str) -> list[UniqueCheck]:
    return [UniqueCheck(columns)]


def refers_to(column: str, parent: DataFrame, parent_column: str) -> list[ReferenceCheck]:
    """Each non-NULL value must be in the parent."""
    return [ReferenceCheck(column, parent, parent_column)]


def batch_asserts() -> list[RowCheck]:
    """What every row bound for silver must meet."""
    amount = F.col("amount")
    return [
        RowCheck("amount_positive", "amount", amount.isNull() | (amount <= 0)),
        RowCheck("currency_known", "currency", bad_currency()),
    ]


def run_checks(df: DataFrame, table: str, checks: Sequence) -> DataFrame:
    """Rows of (table_name, check_name, column_name, violations, passed)."""
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    parts = [_run_rows(df, row_checks)] if row_checks else []
    parts += [_run_unique(df, c) for c in checks if isinstance(c, UniqueCheck)]
    parts += [_run_reference(df, c) for c in checks if isinstance(c, ReferenceCheck)]
    results = reduce(DataFrame.unionByName, parts)
    return results.select(
        F.lit(table).alias("table_name"),
        "check_name",
        "column_name",
        "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def require(results: DataFrame) -> None:
    """Stop on a failed check. Results have one row per declared check."""
    failed = results.filter(~F.col("passed")).collect()
    if failed:
        raise CheckFailed(
            "; ".join(
                f"{r.table_name}.{r.column_name} {r.check_name}: {r.violations}" for r in failed
            )
        )


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (
        df.dropna(subset=list(columns))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values of ``column`` missing from the parent, with their row count.

    Counted per value before the join, so a value in very many rows is one row there.
    """
    values = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    known = parent.select(F.col(parent_column).alias(column))
    return values.join(known, column, "left_anti")


def _run_rows(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    counts = df.agg(*[F.count_if(c.violated).alias(f"_c{i}") for i, c in enumerate(checks)])
    lines = [_line(c.name, c.column, F.col(f"_c{i}")) for i, c in enumerate(checks)]
    return counts.select(F.inline(F.array(*lines)))


def _run_unique(df: DataFrame, check: UniqueCheck) -> DataFrame:
    count = duplicate_keys(df, check.columns).agg(F.count(F.lit(1)).alias("_c"))
    line = _line("unique", ", ".join(check.columns), F.col("_c"))
    return count.select(F.inline(F.array(line)))


def _run_reference(df: DataFrame, check: ReferenceCheck) -> DataFrame:
    lost = orphans(df, check.column, check.parent, check.parent_column)
    count = lost.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("_c"))
    return count.select(F.inline(F.array(_line("relationships", check.column, F.col("_c")))))


def _line(name: str, column: str, count: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(column).alias("column_name"),
        count.cast("bigint").alias("violations"),
    )


# --- The declared checks of the gold tables ---------------------------------


def customer_checks() -> list:
    return [
        *unique("customer_sk"),
        *not_null("customer_sk", "customer_id", "email", "risk_profile"),
        *accepted_values("risk_profile", S.RISK_PROFILES),
    ]


def account_checks() -> list:
    return [
        *unique("account_sk"),
        *not_null("account_sk", "account_id", "account_type", "account_status"),
        *accepted_values("account_status", S.ACCOUNT_STATUSES),
    ]


def merchant_checks() -> list:
    return [*unique("merchant_id"), *not_null("merchant_id", "category")]


def date_checks() -> list:
    return [*unique("date_sk"), *not_null("date_sk", "full_date")]


def fact_checks(merchants: DataFrame, dates: DataFrame) -> list:
    return [
        *unique("transaction_id"),
        *not_null(
            "transaction_id",
            "merchant_sk",
            "date_sk",
            "amount",
            "currency",
            "is_fraud_suspect",
            "risk_score",
        ),
        *accepted_values("currency", S.CURRENCIES),
        *refers_to("merchant_sk", merchants, "merchant_sk"),
        *refers_to("date_sk", dates, "date_sk"),
    ]


def fact_constraints(
    customers: DataFrame, accounts: DataFrame, merchants: DataFrame, dates: DataFrame
) -> list:
    """Keys and NOT NULL columns of the table definition."""
    return [
        *unique("transaction_sk"),
        *not_null(
            "transaction_sk",
            "transaction_id",
            "amount",
            "currency",
            "payment_method",
            "risk_score",
            "is_fraud_suspect",
            "event_time",
        ),
        *refers_to("customer_sk", customers, "customer_sk"),
        *refers_to("account_sk", accounts, "account_sk"),
        *refers_to("merchant_sk", merchants, "merchant_sk"),
        *refers_to("date_sk", dates, "date_sk"),
    ]


def version_constraints(sk: str, *columns: str) -> list:
    return [*unique(sk), *not_null(sk, *columns, "valid_from")]


def merchant_constraints() -> list:
    return [
        *unique("merchant_sk"),
        *unique("merchant_id"),
        *not_null("merchant_sk", "merchant_id"),
    ]


def date_constraints() -> list:
    return [
        *unique("date_sk"),
        *not_null(
            "date_sk", "full_date", "day", "month", "year", "day_of_week", "day_name", "is_weekend"
        ),
    ]


def alert_constraints() -> list:
    return [
        *unique("alert_id"),
        *unique("transaction_id"),
        *not_null(
            "alert_id",
            "transaction_id",
            "account_id",
            "customer_id",
            "amount",
            "risk_score",
            "risk_level",
            "fraud_reason",
            "event_time",
        ),
    ]
