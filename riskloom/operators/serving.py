"""The triage and analytics queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.scalars import readable_reason, short_id


def alerts_queue(alerts: DataFrame, status: str = "PENDING", limit: int = 50) -> DataFrame:
    """The riskiest alerts of a status, newest first among equals."""
    return (
        alerts.filter(F.col("status") == status)
        .orderBy(F.col("risk_score").desc(), F.col("event_time").desc(), "transaction_id")
        .limit(limit)
    )


def alert_detail(alerts: DataFrame, transaction_id: str | DataFrame) -> DataFrame:
    """The alert of one transaction, or of each in a table of ids; none if absent."""
    if isinstance(transaction_id, str):
        return alerts.filter(F.col("transaction_id") == transaction_id)
    wanted = transaction_id.select("transaction_id").distinct()
    return alerts.join(wanted, "transaction_id", "left_semi")


def accepted_actions(actions: DataFrame) -> DataFrame:
    return actions.filter(F.col("status").isin(*S.TRIAGE_STATUSES))


def rejected_actions(actions: DataFrame) -> DataFrame:
    known = F.coalesce(F.col("status").isin(*S.TRIAGE_STATUSES), F.lit(False))
    return actions.filter(~known)


def apply_triage(alerts: DataFrame, actions: DataFrame) -> DataFrame:
    """Alerts after the latest accepted action on each.

    Actions have transaction_id, status, operator_notes and acted_at.
    """
    latest = (
        accepted_actions(actions)
        .groupBy("transaction_id")
        .agg(
            F.max_by(
                F.struct("status", "operator_notes", "acted_at"),
                F.struct("acted_at", "status", "operator_notes"),
            ).alias("_act")
        )
    )
    acted = F.col("_act").isNotNull()
    joined = alerts.join(latest, "transaction_id", "left").withColumns(
        {
            "status": F.when(acted, F.col("_act.status")).otherwise(F.col("status")),
            "operator_notes": F.when(acted, F.col("_act.operator_notes")).otherwise(
                F.col("operator_notes")
            ),
            "updated_at": F.when(acted, F.col("_act.acted_at")).otherwise(F.col("updated_at")),
        }
    )
    return joined.select(*alerts.columns)


def triaged_rows(alerts: DataFrame, actions: DataFrame) -> DataFrame:
    """Only the alerts that an accepted action changes, as they are afterwards."""
    acted = accepted_actions(actions).select("transaction_id").distinct()
    return apply_triage(alerts.join(acted, "transaction_id", "left_semi"), actions)


def risk_history(dim_customer: DataFrame, customer_id: str | None = None) -> DataFrame:
    """Versions of one customer, newest first; of all customers without an id."""
    rows = dim_customer.select(
        "customer_id",
        "full_name",
        "email",
        "risk_profile",
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )
    if customer_id is None:
        return rows
    return rows.filter(F.col("customer_id") == customer_id).orderBy(F.desc("valid_from"))


def customer_versions(dim_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Versions of the customers whose ``customer_id`` is given, numbered from the newest.

    A customer's versions are few, whatever the number of customers.
    """
    wanted = customers.select("customer_id").distinct()
    rows = risk_history(dim_customer).join(wanted, "customer_id", "left_semi")
    newest = Window.partitionBy("customer_id").orderBy(F.desc("valid_from"))
    return rows.withColumn("version_rank", F.row_number().over(newest))


def fraud_metrics(fact: DataFrame) -> DataFrame:
    """One row of totals; the rate is 0 for an empty fact."""
    suspect = F.col("is_fraud_suspect")
    totals = fact.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(suspect).alias("total_suspected_fraud"),
        F.coalesce(F.sum(F.when(suspect, F.col("amount"))), F.lit(0)).alias(
            "total_fraud_amount"
        ),
    )
    share = F.col("total_suspected_fraud") * 100 / F.col("total_transactions")
    rate = F.when(F.col("total_transactions") > 0, F.round(share, 2)).otherwise(F.lit(0.0))
    return totals.withColumn("fraud_rate_percentage", rate)


def display_rows(alerts: DataFrame) -> DataFrame:
    """What the triage page shows for each alert."""
    return alerts.select(
        "transaction_id",
        F.round(F.col("risk_score") * 100, 0).cast("int").alias("score_percent"),
        (F.col("risk_level") == "CRITICAL").alias("is_critical"),
        "amount",
        F.concat(short_id("transaction_id"), F.lit("...")).alias("short_id"),
        "customer_id",
        "event_time",
        readable_reason("fraud_reason").alias("reason_text"),
    )
