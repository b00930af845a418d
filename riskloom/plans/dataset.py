"""The given test tables in the shapes the operators work on.

Every function keeps all rows of its table; the arithmetic only makes up values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.scalars import json_row, money, score
from riskloom.operators import rules, validate
from riskloom.operators.scd2 import scd2_from_log
from riskloom.operators.velocity import score_with_velocity
from riskloom.session import prepare

SNAPSHOTS = ("2024-01-05", "2024-01-10", "2024-01-15", "2024-01-20")
LOADED_AT = "2024-02-01 00:00:00"

PAYLOAD_COLUMNS = (
    "transaction_id",
    "account_id",
    "customer_id",
    "merchant_id",
    "merchant_category",
    "amount",
    "currency",
    "payment_method",
    "event_time",
)


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = source(spark, sf_dir, "events").schema
    # A stream takes a folder or a pattern; this pattern fits a folder and a single file.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def loaded_at() -> Column:
    return F.lit(LOADED_AT).cast("timestamp")


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def transactions(events: DataFrame) -> DataFrame:
    """A card transaction per event; also valid on a stream."""
    return events.selectExpr(
        "'TX-' || event_id as transaction_id",
        "'ACC-' || user_id as account_id",
        "'CUST-' || user_id as customer_id",
        "'MERCH-' || (event_id % 2200) as merchant_id",
        "case event_type when 'purchase' then 'crypto' when 'signup' then 'gambling' "
        "else event_type end as merchant_category",
        "case when event_id % 97 = 0 then null when event_id % 89 = 0 then -value "
        "else round(value * 50, 2) end as amount",
        "case when event_id % 211 = 0 then 'XXX' when event_id % 307 = 0 then null "
        "when event_id % 4 = 0 then 'BRL' when event_id % 4 = 1 then 'USD' "
        "when event_id % 4 = 2 then 'EUR' else 'GBP' end as currency",
        "case event_id % 5 when 0 then 'CREDIT_CARD' when 1 then 'DEBIT_CARD' when 2 then 'PIX' "
        "when 3 then 'PAYPAL' else 'CRYPTO' end as payment_method",
        "cast(ts as timestamp) as event_time",
        "event_id as kafka_offset",
        "cast(ts as timestamp) + interval 5 seconds as processed_at",
    )


def replayed(tx: DataFrame) -> DataFrame:
    """Transactions, those paid by PIX sent once more an hour later."""
    copies = F.when(F.col("payment_method") == "PIX", F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    again = F.col("_copy") == 1
    return (
        tx.withColumn("_copy", F.explode(copies))
        .withColumns(
            {
                "kafka_offset": F.when(again, -1 - F.col("kafka_offset")).otherwise(
                    F.col("kafka_offset")
                ),
                "processed_at": F.when(
                    again, F.col("processed_at") + F.expr("interval 1 hour")
                ).otherwise(F.col("processed_at")),
            }
        )
        .drop("_copy")
    )


def topic_messages(events: DataFrame) -> DataFrame:
    """Topic messages with the events' own property text as payload."""
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        *_topic_columns("event_id", F.col("ts")),
    )


def payload_messages(tx: DataFrame) -> DataFrame:
    """Topic messages with the transactions as JSON."""
    return tx.select(
        F.col("account_id").cast("binary").alias("key"),
        json_row(PAYLOAD_COLUMNS).cast("binary").alias("value"),
        *_topic_columns("kafka_offset", F.col("event_time")),
    )


def _topic_columns(number: str, at: Column) -> list[Column]:
    return [
        F.lit("transactions").alias("topic"),
        F.pmod(F.col(number), F.lit(4)).cast("int").alias("partition"),
        F.col(number).alias("offset"),
        at.cast("timestamp").alias("timestamp"),
    ]


def document_messages(documents: DataFrame) -> DataFrame:
    """Topic messages whose payload is prose, so never valid JSON of a transaction."""
    return documents.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        F.lit(0).alias("partition"),
        (-1 - F.col("doc_id")).alias("offset"),
        F.lit("2024-01-31 00:00:00").cast("timestamp").alias("timestamp"),
    )


def ingested_at() -> Column:
    return F.col("timestamp") + F.expr("interval 5 seconds")


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(source(spark, sf_dir, "events"))


def scored(valid: DataFrame) -> DataFrame:
    return rules.flag(rules.score(valid))


def valid(rows: DataFrame) -> DataFrame:
    return validate.valid_rows(validate.validate(rows))


def accepted(rows: DataFrame) -> DataFrame:
    """Valid rows with a known (or no) currency."""
    return validate.valid_rows(validate.quarantine_currency(validate.validate(rows)))


def silver(rows: DataFrame) -> DataFrame:
    """Scored silver rows; the velocity batch is the event day."""
    return score_with_velocity(accepted(rows), ["event_date"])


def alerts(silver_rows: DataFrame) -> DataFrame:
    """An operational alert per suspect, with a status by payment method."""
    rows = silver_rows.filter("is_fraud_suspect")
    method = F.col("payment_method")
    return rows.select(
        (F.col("kafka_offset") + 1).alias("alert_id"),
        "transaction_id",
        "account_id",
        "customer_id",
        money("amount").alias("amount"),
        score("risk_score").alias("risk_score"),
        F.when(F.col("risk_score") < F.lit(S.CRITICAL_LEVEL), "HIGH")
        .otherwise("CRITICAL")
        .alias("risk_level"),
        "fraud_reason",
        F.when(method == "CRYPTO", "APPROVED")
        .when(method == "PAYPAL", "BLOCKED")
        .otherwise("PENDING")
        .alias("status"),
        F.lit(None).cast("string").alias("operator_notes"),
        "event_time",
        F.col("processed_at").alias("created_at"),
        F.col("processed_at").alias("updated_at"),
    )


def triage_actions(rows: DataFrame) -> DataFrame:
    """Actions by payment method; crypto purchases get a later one on top."""
    method = F.col("payment_method")
    status = (
        F.when(method == "CREDIT_CARD", "APPROVED")
        .when(method == "DEBIT_CARD", "BLOCKED")
        .when(method == "PIX", "CLOSED")
    )
    first = F.struct(
        status.alias("status"),
        F.lit("first look").alias("operator_notes"),
        (F.col("event_time") + F.expr("interval 1 hour")).alias("acted_at"),
    )
    second = F.struct(
        F.lit("BLOCKED").alias("status"),
        F.lit("second look").alias("operator_notes"),
        (F.col("event_time") + F.expr("interval 2 hours")).alias("acted_at"),
    )
    acts = F.when(
        (F.col("merchant_category") == "crypto") & status.isNotNull(), F.array(first, second)
    ).when(status.isNotNull(), F.array(first))
    return rows.select("transaction_id", F.explode(acts).alias("a")).select(
        "transaction_id", "a.*"
    )


def _extracted(customers: DataFrame) -> DataFrame:
    """Customers at four snapshots: indebted ones come late, some rich ones leave."""
    times = F.array(*[F.lit(d).cast("timestamp") for d in SNAPSHOTS])
    rows = customers.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    rows = rows.withColumn("snapshot_at", F.get(times, F.col("k")))
    late = (F.col("c_acctbal") < 0) & (F.col("k") < 2)
    gone = (F.col("c_acctbal") > 9000) & (F.col("k") == 3)
    return rows.filter(~late & ~gone)


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _extracted(source(spark, sf_dir, "customer"))
    n, k, segment = F.col("c_custkey"), F.col("k"), F.col("c_mktsegment")
    moved = (segment == "BUILDING") & (k >= 2)
    return rows.select(
        _text("CUST-", n).alias("customer_id"),
        F.concat("c_name", F.lit("-v"), k.cast("string")).alias("full_name"),
        F.concat(_text("c", n), F.when(moved, "@mail.example.org").otherwise("@example.org")).alias(
            "email"
        ),
        _text("55", n + 10_000_000).alias("phone"),
        F.get(F.array(*[F.lit(p) for p in S.RISK_PROFILES]), ((n * k) % 4).cast("int")).alias(
            "risk_profile"
        ),
        F.when((segment == "FURNITURE") & (k >= 2), F.lit(None)).otherwise(segment).alias("city"),
        _text("N", F.col("c_nationkey")).alias("state"),
        "snapshot_at",
    )


def account_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _extracted(source(spark, sf_dir, "customer"))
    n, k = F.col("c_custkey"), F.col("k")
    raised = F.abs(F.col("c_acctbal")).cast(S.MONEY) + F.when(k >= 2, 500).otherwise(0)
    return rows.select(
        _text("ACC-", n).alias("account_id"),
        _text("CUST-", n).alias("customer_id"),
        F.when((F.col("c_mktsegment") == "MACHINERY") & (k >= 1), "DEBIT")
        .otherwise("CREDIT")
        .alias("account_type"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", raised)
        .otherwise(F.abs(F.col("c_acctbal")))
        .cast(S.MONEY)
        .alias("credit_limit"),
        F.get(
            F.array(*[F.lit(s) for s in S.ACCOUNT_STATUSES]),
            ((n + k * F.col("c_nationkey")) % 4).cast("int"),
        ).alias("account_status"),
        "snapshot_at",
    )


def extract(log: DataFrame, number: int) -> DataFrame:
    """The extract of one snapshot out of the log of all."""
    return log.filter(F.col("snapshot_at") == F.lit(SNAPSHOTS[number]).cast("timestamp")).drop(
        "snapshot_at"
    )


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = customer_log(spark, sf_dir)
    return scd2_from_log(log, "customer_id", S.CUSTOMER_TRACKED, "snapshot_at", "customer_sk")


def account_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = account_log(spark, sf_dir)
    return scd2_from_log(log, "account_id", S.ACCOUNT_TRACKED, "snapshot_at", "account_sk")


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = source(spark, sf_dir, "part")
    created = F.expr("timestamp '2018-01-01 00:00:00' + make_dt_interval(p_size)")
    return parts.select(
        _text("MERCH-", F.col("p_partkey")).alias("merchant_id"),
        F.col("p_name").alias("merchant_name"),
        F.lower("p_type").alias("category"),
        F.col("p_brand").alias("country"),
        F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )
