"""The streaming jobs run to the end of the given tables, and their tables read back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators.alerts import alert_messages
from riskloom.operators.bronze import envelope
from riskloom.operators.dedup import dedup_stream, late_rows
from riskloom.operators.velocity import velocity_tumbling
from riskloom.plans import dataset as D
from riskloom.session import scratch_path, written
from riskloom.sinks.writers import append_stream
from riskloom.sources.readers import table, table_stream
from riskloom.streaming import alerts, bronze, silver
from riskloom.streaming.alert_ids import LANES
from riskloom.streaming.held import TrailingVelocity


@dataclass(frozen=True)
class Folders:
    base: str

    def table(self, name: str) -> str:
        return f"{self.base}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"


def _ingest(messages: DataFrame, folders: Folders) -> None:
    bronze.ingest(
        messages,
        folders.table("bronze"),
        folders.checkpoint("bronze"),
        ingested_at=D.ingested_at(),
        available_now=True,
    ).awaitTermination()


def _processed_at():
    return F.col("event_time") + F.expr("interval 5 seconds")


def _score(spark: SparkSession, folders: Folders) -> None:
    """Quarantine and scoring over the bronze table, as two queries."""
    path = folders.table("bronze")
    silver.quarantine(
        table_stream(spark, path, S.BRONZE),
        folders.table("dead_letters"),
        folders.checkpoint("dead_letters"),
        available_now=True,
        processed_at=_processed_at(),
    ).awaitTermination()
    router = silver.Router(
        silver.table_sink(folders.table("silver"), partition_by=["event_date"]),
        silver.table_sink(folders.table("alerts")),
        silver.table_sink(folders.table("routed_letters")),
        velocity_batch=["event_date"],
    )
    rows = silver.deduplicated_stream(
        table_stream(spark, path, S.BRONZE), processed_at=_processed_at()
    )
    silver.route(rows, router, folders.checkpoint("silver"), available_now=True).awaitTermination()


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.payload_messages(D.replayed(D.transactions(D.event_stream(spark, sf_dir))))


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = Folders(scratch_path(spark, "stream"))
    _ingest(D.topic_messages(D.event_stream(spark, sf_dir)), folders)
    return table(spark, folders.table("bronze"), schema=S.BRONZE)


def _silver_table(spark: SparkSession, folders: Folders) -> DataFrame:
    return table(spark, folders.table("silver"))


def silver_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = Folders(scratch_path(spark, "stream"))
    _ingest(_messages(spark, sf_dir), folders)
    _score(spark, folders)
    return _silver_table(spark, folders).select(
        "transaction_id", "account_id", "amount", "currency", "risk_score", "is_fraud_suspect",
        "fraud_reason", "event_time", "event_date",
    )


# Runs of the same checkpoint that a stream is cut into, each a micro-batch with the next part in
# time: rows that came after later ones would miss the counts that these have closed. Files stay
# small, so that all cores read a micro-batch.
PARTS = 8
ROWS_PER_FILE = 100_000
TRAILING_SECONDS = 6 * 3600


def _parts(rows: DataFrame) -> list[DataFrame]:
    """Rows in ``PARTS`` spans of event time; those without a time come first."""
    low, high = rows.agg(F.min("event_time"), F.max("event_time")).first()
    edges = [F.lit(low + (high - low) * i / PARTS).cast("timestamp") for i in range(1, PARTS)]
    number = sum(F.coalesce((F.col("event_time") >= e).cast("int"), F.lit(0)) for e in edges)
    return [rows.filter(number == i) for i in range(PARTS)]


def _append_part(part: DataFrame, path: str) -> None:
    """Append transactions to a bronze table; all cores write, however the source was cut."""
    cores = part.sparkSession.sparkContext.defaultParallelism
    rows = envelope(D.payload_messages(part.repartition(cores, "kafka_offset")), D.ingested_at())
    rows.write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def silver_score_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trailing velocity rule over a stream cut into many micro-batches."""
    folders = Folders(scratch_path(spark, "stream"))
    router = silver.Router(
        silver.table_sink(folders.table("silver"), partition_by=["event_date"]),
        silver.table_sink(folders.table("alerts")),
        silver.table_sink(folders.table("dead_letters")),
        velocity=TrailingVelocity(folders.table("waiting"), TRAILING_SECONDS),
    )
    for part in _parts(D.replayed(D.tx(spark, sf_dir))):
        _append_part(part, folders.table("bronze"))
        stream = table_stream(spark, folders.table("bronze"), S.BRONZE)
        for query in silver.score_stream(
            stream, router, folders.checkpoint("score"), True, _processed_at()
        ):
            query.awaitTermination()
    router.drain(spark)
    return _silver_table(spark, folders).select(
        "transaction_id", "account_id", "amount", "risk_score", "is_fraud_suspect",
        "fraud_reason", "event_time", "event_date",
    )


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one call of ``score_stream`` quarantines, with the reason."""
    folders = Folders(scratch_path(spark, "stream"))
    _ingest(_messages(spark, sf_dir), folders)
    router = silver.Router(
        *[silver.table_sink(folders.table(n)) for n in ("silver", "alerts", "dead_letters")],
        velocity_batch=["event_date"],
    )
    stream = table_stream(spark, folders.table("bronze"), S.BRONZE)
    for query in silver.score_stream(
        stream, router, folders.checkpoint("score"), True, _processed_at()
    ):
        query.awaitTermination()
    return table(spark, folders.table("dead_letters")).select(
        "kafka_offset", "transaction_id", "amount", "currency", "dlq_reason"
    )


def router_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = Folders(scratch_path(spark, "stream"))
    _ingest(_messages(spark, sf_dir), folders)
    _score(spark, folders)
    counts = None
    for name in ("silver", "alerts", "dead_letters"):
        rows = table(spark, folders.table(name)).agg(F.count(F.lit(1)).alias("row_count"))
        rows = rows.select(F.lit(name).alias("sink"), "row_count")
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


def _dedup_to(rows: DataFrame, folders: Folders) -> None:
    columns = rows.select("transaction_id", "account_id", "amount", "event_time", "kafka_offset")
    append_stream(
        dedup_stream(columns).drop("kafka_offset"),
        folders.table("kept"),
        folders.checkpoint("kept"),
        available_now=True,
    ).awaitTermination()


def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = Folders(scratch_path(spark, "stream"))
    _dedup_to(D.replayed(D.transactions(D.event_stream(spark, sf_dir))), folders)
    return table(spark, folders.table("kept"))


def velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed six-hour windows in which an account was busy."""
    folders = Folders(scratch_path(spark, "stream"))
    rows = D.transactions(D.event_stream(spark, sf_dir)).withWatermark("event_time", S.WATERMARK)
    append_stream(
        velocity_tumbling(rows, "6 hours", threshold=2),
        folders.table("bursts"),
        folders.checkpoint("bursts"),
        available_now=True,
    ).awaitTermination()
    return table(spark, folders.table("bursts"))


def _run_in_two(
    spark: SparkSession, sf_dir: str, first: DataFrame, second: DataFrame
) -> tuple[Folders, DataFrame]:
    """Deduplicate a table that gets its second part after the first run has ended."""
    folders = Folders(scratch_path(spark, "stream"))
    for part in (first, second):
        part.write.mode("append").parquet(folders.table("incoming"))
        stream = table_stream(spark, folders.table("incoming"), part.schema)
        _dedup_to(stream, folders)
    return folders, table(spark, folders.table("kept"))


def recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped halfway through the time span and started again from its checkpoint."""
    rows = D.replayed(D.tx(spark, sf_dir))
    low, high = rows.agg(F.min("event_time"), F.max("event_time")).first()
    middle = F.lit(low + (high - low) / 2).cast("timestamp")
    _, kept = _run_in_two(
        spark,
        sf_dir,
        rows.filter(F.col("event_time") < middle),
        rows.filter(F.col("event_time") >= middle),
    )
    return kept


def late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PIX transactions come in a second run: those behind the watermark are dropped."""
    rows = D.tx(spark, sf_dir)
    is_pix = F.col("payment_method") == "PIX"
    _, kept = _run_in_two(spark, sf_dir, rows.filter(~is_pix), rows.filter(is_pix))
    dropped = late_rows(rows, kept)
    return dropped.select("transaction_id", "account_id", "amount", "event_time")


def late_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``score_stream`` with a sink for late rows: in a second run come all PIX transactions
    and what is left of the others, all of them twice. Rows by the sink they reached."""
    folders = Folders(scratch_path(spark, "stream"))
    router = silver.Router(
        *[silver.table_sink(folders.table(n)) for n in ("silver", "alerts", "dead_letters")],
        late=silver.table_sink(folders.table("late")),
    )
    rows = D.tx(spark, sf_dir)
    low, high = rows.agg(F.min("event_time"), F.max("event_time")).first()
    middle = F.lit(low + (high - low) / 2).cast("timestamp")
    early = (F.col("event_time") < middle) & (F.col("payment_method") != "PIX")
    rest = rows.filter(~early)
    for part in (rows.filter(early), rest.unionByName(rest)):
        part = envelope(D.payload_messages(part), D.ingested_at())
        part.write.mode("append").parquet(folders.table("bronze"))
        stream = table_stream(spark, folders.table("bronze"), S.BRONZE)
        for query in silver.score_stream(
            stream, router, folders.checkpoint("score"), True, _processed_at(), late_cells=(3600, 8)
        ):
            query.awaitTermination()
    columns = ("transaction_id", "amount", "payment_method", "event_time", "processed_at")
    scored, late = (
        table(spark, folders.table(name)).select(F.lit(name).alias("sink"), *columns)
        for name in ("silver", "late")
    )
    # Late copies in different Arrow batches all reach the sink.
    late = late.distinct()
    return scored.unionByName(late)


def alert_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored stream to alert messages to operational alerts."""
    folders = Folders(scratch_path(spark, "stream"))
    _ingest(_messages(spark, sf_dir), folders)
    _score(spark, folders)
    message = S.struct_of("key string, value string")
    alerts.consume(
        table_stream(spark, f"{folders.table('alerts')}/*", message),
        folders.table("operational_alerts"),
        folders.checkpoint("operational_alerts"),
        now=D.loaded_at(),
        available_now=True,
    ).awaitTermination()
    stored = alerts.stored_alerts(spark, folders.table("operational_alerts"))
    return stored.drop("alert_id", "batch_id", "operator_notes")


def _alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert messages with their offset; of some the customer or the time is missing."""
    rows = D.silver(D.tx(spark, sf_dir))
    columns = [c for c in S.SILVER.fieldNames() if c in rows.columns]
    messages = alert_messages(
        rows.withColumn("risk_score", F.col("risk_score").cast("double")).select(*columns)
    )
    number = F.get_json_object("value", "$.kafka_offset").cast("long")
    no_customer = F.regexp_replace("value", '"customer_id"', '"customer"')
    no_time = F.regexp_replace("value", '"event_time":"[^"]*"', '"event_time":"soon"')
    value = F.when(number % 7 == 0, no_customer).when(number % 11 == 0, no_time)
    return messages.select("key", F.coalesce(value, "value").alias("value"), number.alias("number"))


def _consume_in_turns(spark: SparkSession, sf_dir: str, **options) -> tuple[Folders, int]:
    """Two streams into one alert table, each stopped and started again for every part;
    the second one's messages are all of the first's and more."""
    folders = Folders(scratch_path(spark, "stream"))
    messages = written(_alert_messages(spark, sf_dir), "messages")
    starts = 0
    for turn in range(3):
        for name, own in (("one", F.col("number") % 2 == 0), ("two", F.lit(True))):
            part = messages.filter(own & (F.col("number") % 3 == turn)).select("key", "value")
            part.write.mode("append").parquet(folders.table(name))
            alerts.consume(
                table_stream(spark, folders.table(name), S.struct_of("key string, value string")),
                folders.table("operational_alerts"),
                folders.checkpoint(name),
                now=D.loaded_at(),
                available_now=True,
                **options,
            ).awaitTermination()
            starts += 1
    return folders, starts


def alert_restart(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Alerts and their ids after two streams with restarts: as many ids as alerts, and ids
    that stay small."""
    folders, starts = _consume_in_turns(spark, sf_dir, **options)
    stored = alerts.stored_alerts(spark, folders.table("operational_alerts"))
    bound = LANES * (starts + 1) * 1024 * 1024
    return stored.rollup("risk_level").agg(
        F.count("*").alias("alert_count"),
        F.countDistinct("alert_id").alias("id_count"),
        F.countDistinct("transaction_id").alias("transaction_count"),
        F.bool_and((F.col("alert_id") > 0) & (F.col("alert_id") < bound)).alias("ids_in_bounds"),
    )


def alerts_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that can't be stored, from the reject table of the consumer."""
    folders = Folders(scratch_path(spark, "stream"))
    _alert_messages(spark, sf_dir).select("key", "value").write.parquet(folders.table("in"))
    alerts.consume(
        table_stream(spark, folders.table("in"), S.struct_of("key string, value string")),
        folders.table("operational_alerts"),
        folders.checkpoint("alerts"),
        now=D.loaded_at(),
        available_now=True,
    ).awaitTermination()
    rejected = table(spark, f"{folders.table('operational_alerts')}_rejected")
    return rejected.select("transaction_id", "customer_id", "event_time", "risk_score")
