"""The registered queries: each operator over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions import scalars
from riskloom.operators import alerts as alert_ops
from riskloom.operators import checks, dims, rules, scd2, serving, validate, velocity
from riskloom.operators.bronze import envelope, parse_payload
from riskloom.operators.dedup import first_row, first_row_by_min
from riskloom.operators.fact import build_fact, join_date, join_merchant, join_version
from riskloom.plans import dataset as D
from riskloom.plans import stream_jobs
from riskloom.plans.comparable import comparable
from riskloom.plans.gold import GoldRun, run_gold_batch
from riskloom.session import prepare, scratch_path, written
from riskloom.sinks.kept import KeptMetrics, KeptQueue, both
from riskloom.sinks.keyed import GrowingUnique, KeyStore
from riskloom.sinks.versions import HistoryStore, VersionedTable
from riskloom.sinks.writers import save_partitioned, write_batch
from riskloom.sources.readers import seed, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Payload fields that the given tables have no values for.
UNUSED = ("device_id", "ip_address", "region")


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(function(prepare(spark), sf_dir))

    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


# --- Parse and validate -----------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as JSON payloads, and documents as malformed ones."""
    good = D.payload_messages(D.tx(spark, sf_dir))
    junk = D.document_messages(D.source(spark, sf_dir, "documents"))
    return envelope(good.unionByName(junk), D.ingested_at())


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate(parse_payload(_bronze(spark, sf_dir)))


@query
def bronze_envelope(spark, sf_dir):
    return envelope(D.topic_messages(D.source(spark, sf_dir, "events")), D.ingested_at())


@query
def parse_json_props(spark, sf_dir):
    events = D.source(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k int").alias("p")).select(
        "event_id", "p.k"
    )


@query
def parse_payload_rows(spark, sf_dir):
    return parse_payload(_bronze(spark, sf_dir)).drop("raw_payload", *UNUSED)


@query
def validate_flags(spark, sf_dir):
    return _validated(spark, sf_dir).select("kafka_offset", "is_valid")


@query
def validate_reasons(spark, sf_dir):
    rows = _validated(spark, sf_dir)
    return rows.groupBy("dlq_reason").agg(F.count(F.lit(1)).alias("row_count"))


@query
def valid_rows(spark, sf_dir):
    return validate.valid_rows(_validated(spark, sf_dir)).drop(*UNUSED)


@query
def dlq_rows(spark, sf_dir):
    """Broken rows; the raw text is compared by hash where it came from a document."""
    rows = validate.quarantined_rows(validate.quarantine_currency(_validated(spark, sf_dir)))
    no_id = F.col("transaction_id").isNull()
    return rows.select(
        "kafka_offset",
        "transaction_id",
        "amount",
        "currency",
        "bronze_ingestion_date",
        "dlq_reason",
        F.when(no_id, F.md5("raw_payload")).alias("raw_md5"),
    )


def _silver_by_day(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "silver")
    rows = D.silver(D.tx(spark, sf_dir))
    columns = [c for c in S.SILVER.fieldNames() if c in rows.columns]
    save_partitioned(rows.select(*columns), path, partition_by=["event_date"])
    return table(spark, path)


@query
def scan_silver(spark, sf_dir):
    """Silver written as a table by day, then read with the columns it needs."""
    return _silver_by_day(spark, sf_dir).select(
        "transaction_id", "account_id", "amount", "risk_score", "event_date"
    )


@query
def scan_silver_days(spark, sf_dir):
    """Ten days of silver: only their folders are read."""
    day = F.col("event_date")
    rows = _silver_by_day(spark, sf_dir).filter((day >= "2024-01-10") & (day < "2024-01-20"))
    return rows.groupBy(day.cast("string").alias("event_date")).agg(
        F.count("*").alias("tx_count"),
        F.sum(scalars.money("amount")).cast("double").alias("amount"),
    )


@query
def scalar_functions(spark, sf_dir):
    rows = D.tx(spark, sf_dir)
    at = F.col("event_time")
    return rows.select(
        "transaction_id",
        scalars.surrogate_key("transaction_id").alias("transaction_sk"),
        scalars.date_key(at).alias("date_sk"),
        F.hour(at).alias("hour"),
        F.to_date(at).alias("event_date"),
        F.date_format(at, "yyyy-MM-dd").alias("day_text"),
        F.dayofmonth(at).alias("day"),
        F.month(at).alias("month"),
        F.year(at).alias("year"),
        scalars.weekday(F.to_date(at)).alias("day_of_week"),
        F.date_format(at, "EEEE").alias("day_name"),
        scalars.money("amount").alias("amount"),
        F.coalesce(F.col("currency"), F.lit("none")).alias("currency"),
        scalars.short_id("transaction_id").alias("short_id"),
        scalars.readable_reason("payment_method").alias("method_text"),
        F.least(F.col("amount"), F.lit(5000.0)).alias("amount_capped"),
    )


# --- Scoring ----------------------------------------------------------------


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.scored(D.valid(D.tx(spark, sf_dir)))


@query
def rule_scores(spark, sf_dir):
    rows = rules.score(D.valid(D.tx(spark, sf_dir)))
    return rows.select(
        "transaction_id", "risk_score", F.concat_ws(",", "rule_hits").alias("rule_hits")
    )


@query
def rule_flags(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "transaction_id", "risk_score", "is_fraud_suspect", "fraud_reason"
    )


@query
def velocity_in_batch(spark, sf_dir):
    rows = velocity.velocity_in_batch(_scored(spark, sf_dir), ["event_date"])
    return rows.select(
        "transaction_id", "velocity_hit", "risk_score", "is_fraud_suspect", "fraud_reason"
    )


@query
def velocity_tumbling(spark, sf_dir):
    return velocity.velocity_tumbling(D.valid(D.tx(spark, sf_dir)), "6 hours", threshold=2)


@query
def velocity_trailing(spark, sf_dir):
    rows = velocity.velocity_trailing(D.valid(D.tx(spark, sf_dir)), seconds=6 * 3600)
    return rows.select("transaction_id", "account_id", "event_time", "tx_count")


def _messages(rows: DataFrame) -> DataFrame:
    columns = [c for c in S.SILVER.fieldNames() if c in rows.columns]
    as_silver = rows.withColumn("risk_score", F.col("risk_score").cast("double"))
    return alert_ops.alert_messages(as_silver.select(*columns))


@query
def alerts_json(spark, sf_dir):
    """Alert messages, their JSON read back field by field."""
    sent = _messages(D.silver(D.tx(spark, sf_dir)))
    back = F.from_json("value", S.SILVER, scalars.JSON_TIME)
    return sent.select("key", back.alias("p")).select(
        "key",
        *[
            f"p.{c}"
            for c in ("account_id", "amount", "currency", "risk_score", "is_fraud_suspect",
                      "fraud_reason", "event_time", "event_date", "kafka_offset")
        ],
    )


@query
def alerts_extract(spark, sf_dir):
    return alert_ops.extract_alerts(_messages(D.silver(D.tx(spark, sf_dir))))


# --- First row per key ------------------------------------------------------


@query
def dedup_first_row(spark, sf_dir):
    rows = D.replayed(D.tx(spark, sf_dir))
    kept = first_row(rows, ["transaction_id"], ["processed_at", "kafka_offset"])
    return kept.select("transaction_id", "amount", "currency", "processed_at", "kafka_offset")


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]


@query
def dedup_min_by(spark, sf_dir):
    return first_row_by_min(D.source(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


@query
def dedup_first_lineitem(spark, sf_dir):
    return first_row(D.source(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


# --- Dimensions -------------------------------------------------------------


@query
def dim_date(spark, sf_dir):
    """The date dimension with the transactions of each day."""
    per_day = D.tx(spark, sf_dir).groupBy(scalars.date_key("event_time").alias("date_sk"))
    counts = per_day.agg(F.count(F.lit(1)).alias("tx_count"))
    days = dims.dim_date(spark).join(counts, "date_sk", "left")
    return days.fillna(0, ["tx_count"])


@query
def dim_merchant(spark, sf_dir):
    return dims.dim_merchant(D.raw_merchants(spark, sf_dir))


def _folded(log, key, tracked, sk) -> DataFrame:
    """One snapshot run after another, each on the table the last one wrote."""
    history = scd2.first_versions(D.extract(log, 0), key, sk, D.SNAPSHOTS[0])
    for number in range(1, len(D.SNAPSHOTS)):
        history = scd2.scd2_apply(
            written(history, "history"), D.extract(log, number), key, tracked, sk,
            D.SNAPSHOTS[number],
        )
    return history


@query
def scd2_apply_customer(spark, sf_dir):
    log = D.customer_log(spark, sf_dir)
    return _folded(log, "customer_id", S.CUSTOMER_TRACKED, "customer_sk")


@query
def scd2_apply_account(spark, sf_dir):
    log = D.account_log(spark, sf_dir)
    return _folded(log, "account_id", S.ACCOUNT_TRACKED, "account_sk")


@query
def scd2_from_log_extracts(spark, sf_dir):
    return D.customer_history(spark, sf_dir)


@query
def scd2_from_log(spark, sf_dir):
    """Status and priority of each customer's latest order, as a history."""
    orders = D.source(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp")
    )
    latest = F.max_by(F.struct("o_orderstatus", "o_orderpriority", "o_orderkey"), "o_orderkey")
    log = orders.groupBy("o_custkey", "o_orderdate").agg(latest.alias("r")).select(
        "o_custkey", "o_orderdate", "r.*"
    )
    return scd2.scd2_from_log(
        log, "o_custkey", ["o_orderstatus", "o_orderpriority"], "o_orderdate", "version_sk",
        bucket="month",
    )


@query
def scd2_backdate_customer(spark, sf_dir):
    rows = scd2.backdate_first(D.customer_history(spark, sf_dir), "customer_id")
    return rows.select("customer_sk", "customer_id", "valid_from", "valid_to")


@query
def scd2_backdate_account(spark, sf_dir):
    rows = scd2.backdate_first(D.account_history(spark, sf_dir), "account_id")
    return rows.select("account_sk", "account_id", "valid_from", "valid_to")


# --- Fact -------------------------------------------------------------------


@query
def fact_scd2_customer(spark, sf_dir):
    rows = D.tx(spark, sf_dir).select("transaction_id", "customer_id", "event_time")
    dim = written(D.customer_history(spark, sf_dir), "dim_customer")
    return join_version(rows, dim, "customer_id", "customer_sk")


@query
def fact_scd2_account(spark, sf_dir):
    """Without back-dating: events before the first snapshot find no version."""
    rows = D.tx(spark, sf_dir).select("transaction_id", "account_id", "event_time")
    dim = written(D.account_history(spark, sf_dir), "dim_account")
    return join_version(rows, dim, "account_id", "account_sk", backdate=False)


@query
def fact_merchant(spark, sf_dir):
    rows = D.tx(spark, sf_dir).select("transaction_id", "merchant_id")
    return join_merchant(rows, dims.dim_merchant(D.raw_merchants(spark, sf_dir)))


@query
def fact_date(spark, sf_dir):
    rows = D.tx(spark, sf_dir).select("transaction_id", "event_time")
    return join_date(rows, dims.dim_date(spark))


def _dimensions(spark, sf_dir):
    return (
        written(D.customer_history(spark, sf_dir), "dim_customer"),
        written(D.account_history(spark, sf_dir), "dim_account"),
        dims.dim_merchant(D.raw_merchants(spark, sf_dir)),
        dims.dim_date(spark),
    )


@query
def fact_transactions(spark, sf_dir):
    """The star schema's fact, from silver rows some of which came twice."""
    rows = D.replayed(D.silver(D.tx(spark, sf_dir)))
    return build_fact(rows, *_dimensions(spark, sf_dir), loaded_at=D.loaded_at())


@query
def fact_transactions_large(spark, sf_dir):
    """The same with nothing broadcast but the calendar, as for dimensions of any size."""
    rows = D.replayed(D.silver(D.tx(spark, sf_dir)))
    dimensions = _dimensions(spark, sf_dir)
    return build_fact(rows, *dimensions, loaded_at=D.loaded_at(), broadcast_rows=0)


def _write_seeds(spark, sf_dir, number) -> str:
    path = scratch_path(spark, "seeds")
    for name, rows in (
        ("raw_customers", D.extract(D.customer_log(spark, sf_dir), number)),
        ("raw_accounts", D.extract(D.account_log(spark, sf_dir), number)),
        ("raw_merchants", D.raw_merchants(spark, sf_dir)),
    ):
        rows.write.option("header", True).csv(f"{path}/{name}")
    return path


@query
def gold_batch_summary(spark, sf_dir):
    """Two daily runs over seed files; check results and row counts of the second."""
    silver = written(D.silver(D.tx(spark, sf_dir)).drop("rule_hits"), "silver")
    base = scratch_path(spark, "gold")
    first = GoldRun(base, "run1", D.SNAPSHOTS[0], _write_seeds(spark, sf_dir, 0))
    run_gold_batch(spark, first, silver, D.loaded_at(), stop_on_failure=False)
    second = GoldRun(base, "run2", D.SNAPSHOTS[2], _write_seeds(spark, sf_dir, 2), "run1")
    return run_gold_batch(spark, second, silver, D.loaded_at(), stop_on_failure=False)


# --- Checks -----------------------------------------------------------------


@query
def check_asserts(spark, sf_dir):
    return checks.run_checks(D.tx(spark, sf_dir), "transactions", checks.batch_asserts())


@query
def check_unique(spark, sf_dir):
    lines = checks.run_checks(
        D.source(spark, sf_dir, "lineitem"),
        "lineitem",
        [*checks.unique(*LINE_KEY), *checks.unique("l_orderkey")],
    )
    again = D.replayed(D.tx(spark, sf_dir))
    return lines.unionByName(
        checks.run_checks(again, "transactions", checks.unique("transaction_id"))
    )


@query
def check_not_null(spark, sf_dir):
    declared = checks.not_null("transaction_id", "amount", "currency", "event_time")
    customers = checks.not_null("customer_id", "email", "risk_profile", "city")
    return checks.run_checks(D.tx(spark, sf_dir), "transactions", declared).unionByName(
        checks.run_checks(D.customer_log(spark, sf_dir), "customers", customers)
    )


@query
def check_accepted_values(spark, sf_dir):
    rows = checks.run_checks(
        D.tx(spark, sf_dir),
        "transactions",
        [
            *checks.accepted_values("currency", S.CURRENCIES),
            *checks.accepted_values("merchant_category", S.RISKY_CATEGORIES),
        ],
    )
    return rows.unionByName(
        checks.run_checks(
            D.customer_log(spark, sf_dir),
            "customers",
            checks.accepted_values("risk_profile", S.RISK_PROFILES),
        )
    )


@query
def check_relationships(spark, sf_dir):
    merchants = dims.dim_merchant(D.raw_merchants(spark, sf_dir))
    orders = D.source(spark, sf_dir, "orders")
    return checks.run_checks(
        D.tx(spark, sf_dir),
        "transactions",
        checks.refers_to("merchant_id", merchants, "merchant_id"),
    ).unionByName(
        checks.run_checks(
            D.source(spark, sf_dir, "lineitem"),
            "lineitem",
            checks.refers_to("l_orderkey", orders, "o_orderkey"),
        )
    )


@query
def checks_constraints(spark, sf_dir):
    """Keys, NOT NULLs and foreign keys of the fact, its dimensions and the alerts."""
    customers, accounts, merchants, dates = _dimensions(spark, sf_dir)
    silver = written(D.silver(D.tx(spark, sf_dir)), "silver")
    fact = written(
        build_fact(D.replayed(silver), customers, accounts, merchants, dates, D.loaded_at()),
        "fact",
    )
    alerts = written(D.alerts(silver), "alerts")
    declared = checks.fact_constraints(customers, accounts, merchants, dates)
    return (
        checks.run_checks(fact, "fact_transactions", declared)
        .unionByName(
            checks.run_checks(
                customers, "dim_customer", checks.version_constraints("customer_sk", "customer_id")
            )
        )
        .unionByName(
            checks.run_checks(
                accounts,
                "dim_account",
                checks.version_constraints("account_sk", "account_id", "customer_id"),
            )
        )
        .unionByName(checks.run_checks(merchants, "dim_merchant", checks.merchant_constraints()))
        .unionByName(checks.run_checks(dates, "dim_date", checks.date_constraints()))
        .unionByName(
            checks.run_checks(alerts, "operational_alerts", checks.alert_constraints())
        )
    )


# --- Serving ----------------------------------------------------------------


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.alerts(D.silver(D.tx(spark, sf_dir)))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = D.silver(D.tx(spark, sf_dir))
    return serving.fraud_metrics(
        rows.select(scalars.money("amount").alias("amount"), "is_fraud_suspect")
    )


@query
def fraud_metrics(spark, sf_dir):
    return metrics(spark, sf_dir)


@query
def alerts_queue(spark, sf_dir):
    return serving.alerts_queue(_alerts(spark, sf_dir))


@query
def alert_detail(spark, sf_dir):
    """The detail of every transaction that was paid in dollars."""
    wanted = D.tx(spark, sf_dir).filter(F.col("currency") == "USD")
    return serving.alert_detail(_alerts(spark, sf_dir), wanted)


@query
def risk_profile_history(spark, sf_dir):
    return serving.risk_history(D.customer_history(spark, sf_dir))


@query
def customer_versions(spark, sf_dir):
    """Versions of every customer who paid in dollars, newest first."""
    payers = D.tx(spark, sf_dir).filter(F.col("currency") == "USD")
    return serving.customer_versions(D.customer_history(spark, sf_dir), payers)


@query
def alerts_upsert_ignore(spark, sf_dir):
    """Alerts of replayed transactions that dollar and euro alerts do not hold yet."""
    rows = D.silver(D.tx(spark, sf_dir))
    stored = written(D.alerts(rows.filter(F.col("currency").isin("USD", "EUR"))), "alerts")
    sent = _messages_with_time(D.replayed(rows).filter("is_fraud_suspect"))
    incoming = written(alert_ops.extract_alerts(sent), "incoming")
    new = alert_ops.new_alerts(stored, incoming, D.loaded_at(), ["event_time", "sent_at"])
    return new.drop("alert_id")


def _messages_with_time(rows: DataFrame) -> DataFrame:
    columns = [c for c in S.SILVER.fieldNames() if c in rows.columns]
    return rows.withColumn("risk_score", F.col("risk_score").cast("double")).select(
        F.col("transaction_id").alias("key"),
        scalars.json_row(columns).alias("value"),
        F.col("processed_at").alias("sent_at"),
    )


@query
def alerts_triage_apply(spark, sf_dir):
    rows = D.tx(spark, sf_dir)
    return serving.apply_triage(_alerts(spark, sf_dir), D.triage_actions(rows))


@query
def triage_rejects(spark, sf_dir):
    return serving.rejected_actions(D.triage_actions(D.tx(spark, sf_dir)))


@query
def alerts_display(spark, sf_dir):
    return serving.display_rows(_alerts(spark, sf_dir))


# --- Sinks and streams ------------------------------------------------------


@query
def seed_csv_roundtrip(spark, sf_dir):
    path = _write_seeds(spark, sf_dir, 2)
    return seed(spark, f"{path}/raw_accounts", S.RAW_ACCOUNTS)


@query
def stream_bronze_ingest(spark, sf_dir):
    return stream_jobs.bronze_ingest(spark, sf_dir)


@query
def stream_silver_score(spark, sf_dir):
    return stream_jobs.silver_score(spark, sf_dir)


@query
def stream_router_counts(spark, sf_dir):
    return stream_jobs.router_counts(spark, sf_dir)


@query
def stream_dedup(spark, sf_dir):
    return stream_jobs.dedup(spark, sf_dir)


@query
def stream_velocity(spark, sf_dir):
    return stream_jobs.velocity(spark, sf_dir)


@query
def stream_recovery(spark, sf_dir):
    return stream_jobs.recovery(spark, sf_dir)


@query
def stream_late_rows(spark, sf_dir):
    return stream_jobs.late(spark, sf_dir)


@query
def stream_late_sink(spark, sf_dir):
    return stream_jobs.late_sink(spark, sf_dir)


@query
def stream_alert_upsert(spark, sf_dir):
    return stream_jobs.alert_upsert(spark, sf_dir)


@query
def stream_silver_score_batches(spark, sf_dir):
    return stream_jobs.silver_score_batches(spark, sf_dir)


@query
def stream_dead_letters(spark, sf_dir):
    return stream_jobs.dead_letters(spark, sf_dir)


@query
def stream_alert_restart(spark, sf_dir):
    return stream_jobs.alert_restart(spark, sf_dir)


@query
def alerts_rejected(spark, sf_dir):
    return stream_jobs.alerts_rejected(spark, sf_dir)


@query
def stream_alert_restart_indexed(spark, sf_dir):
    """The same alerts where each batch looks its transactions up in buckets of stored ones,
    which are compacted after every batch."""
    return stream_jobs.alert_restart(spark, sf_dir, key_buckets=64, compact_every=1)


# --- Kept between runs ------------------------------------------------------

BATCHES = 3


def _batches(rows: DataFrame, number: str = "kafka_offset") -> list[DataFrame]:
    """Rows in batches, the last one twice, as after a failure."""
    part = F.pmod(F.coalesce(F.col(number), F.lit(0)), F.lit(BATCHES))
    parts = [(i, rows.filter(part == i)) for i in range(BATCHES)]
    return [*parts, parts[-1]]


@query
def fraud_metrics_kept(spark, sf_dir):
    """Metrics added up from what each batch of the fact left behind."""
    base = scratch_path(spark, "kept")
    kept = KeptMetrics(spark, f"{base}/totals")
    sink = both(lambda rows, i: write_batch(rows, f"{base}/fact", i), kept.add)
    rows = D.silver(D.tx(spark, sf_dir)).withColumn("amount", scalars.money("amount"))
    rows = written(rows.drop("rule_hits"), "silver")
    for number, batch in _batches(rows):
        sink(batch, number)
    return kept.metrics()


@query
def alerts_queue_kept(spark, sf_dir):
    """The queue after triage, out of the first alerts of each batch."""
    kept = KeptQueue(spark, scratch_path(spark, "queue"))
    rows = written(_alerts(spark, sf_dir), "alerts")
    for number, batch in _batches(rows, "alert_id"):
        kept.add(batch, number)
    return kept.first(written(D.triage_actions(D.tx(spark, sf_dir)), "actions"))


@query
def check_unique_growing(spark, sf_dir):
    """Uniqueness of a table that came in batches, each checked as it came."""
    keys = KeyStore(spark, scratch_path(spark, "keys"), S.struct_of("transaction_id string"), 64)
    growing = GrowingUnique(keys)
    rows = written(D.replayed(D.tx(spark, sf_dir)).select("transaction_id", "kafka_offset"), "tx")
    for number, batch in _batches(rows):
        growing.add(batch, number)
        if number == 0:
            keys.compact()
    return growing.result("transactions")


@query
def scd2_store_customer(spark, sf_dir):
    """Extract after extract into a store that never writes closed versions again."""
    store = HistoryStore(
        spark, scratch_path(spark, "store"), S.DIM_CUSTOMER, "customer_id", S.CUSTOMER_TRACKED,
        "customer_sk",
    )
    log = D.customer_log(spark, sf_dir)
    for number, at in enumerate(D.SNAPSHOTS):
        store.apply(D.extract(log, number), at, at)
    return store.history()


@query
def table_replace(spark, sf_dir):
    """A table replaced out of itself: orders by status before, read while it was replaced,
    and after."""
    versions = VersionedTable(spark, scratch_path(spark, "versions"))
    versions.replace(D.source(spark, sf_dir, "orders"), "all")
    before = versions.read()
    versions.replace(before.filter("o_orderstatus <> 'O'"), "closed")
    parts = [("before", before), ("after", versions.read())]
    counts = [
        rows.groupBy("o_orderstatus").agg(
            F.count("*").alias("order_count"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
        ).withColumn("seen", F.lit(name))
        for name, rows in parts
    ]
    return counts[0].unionByName(counts[1])
