"""Bronze table to silver rows, alerts and quarantine.

Two queries over bronze: a stateless one that quarantines broken rows, and a
stateful one that deduplicates and scores the good ones. So a broken row never enters
the dedup state and cannot hold up scoring.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom import schemas as S
from riskloom.operators import alerts, rules, validate
from riskloom.operators.bronze import parse_payload
from riskloom.operators.checks import CheckFailed
from riskloom.operators.dedup import dedup_stream, first_row
from riskloom.operators.late import LANES, SPAN_SECONDS, dedup_or_late
from riskloom.operators.rules import Rule
from riskloom.operators.velocity import mark_bursts, score_marked
from riskloom.session import ADAPTIVE_CONF, scratch_path, settings
from riskloom.sinks.writers import (
    append_stream,
    each_batch,
    publish,
    with_batch_header,
    write_batch,
)
from riskloom.streaming.held import TrailingVelocity

log = logging.getLogger(__name__)

Sink = Callable[[DataFrame, int], None]


def quarantine(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = False,
    processed_at: Column | None = None,
    known_currency: bool = True,
    scoring: Sequence[Rule] | None = None,
    **options,
) -> StreamingQuery:
    """Append broken bronze rows, with their reason and rule score, by ingestion day."""
    rows = _checked(bronze, known_currency, options)
    letters = dead_letters(_stamped(rows, processed_at), scoring)
    return append_stream(
        letters, path, checkpoint, fmt, ["bronze_ingestion_date"], available_now
    )


def deduplicated_stream(
    bronze: DataFrame,
    quarantine_after_dedup: bool = False,
    watermark: str = S.WATERMARK,
    processed_at: Column | None = None,
    thin: bool = True,
    known_currency: bool = True,
    untimed: bool = True,
    mark_late: bool = False,
    late_cells: tuple[int, int] = (SPAN_SECONDS, LANES),
    **options,
) -> DataFrame:
    """Parsed and deduplicated rows with their validity columns, for a router to score.

    Only good rows enter the dedup step, without their raw text; broken ones are left to
    ``quarantine``, which ``score_stream`` starts along with this. Without
    ``known_currency`` rows of other currencies go on to the router and its policy.
    ``quarantine_after_dedup`` keeps broken rows in the stream through the dedup step,
    where all rows with NULL keys fall into one. A row without event time never leaves the
    state; ``untimed=False`` leaves such rows out. With ``mark_late`` rows behind the watermark
    are not dropped but marked in a column ``is_late``; rows without event time then take no
    state. ``late_cells`` are the seconds and lanes of ``dedup_or_late``.
    """
    cells = dict(zip(("span_seconds", "lanes"), late_cells))
    dedup = partial(dedup_or_late, **cells) if mark_late else dedup_stream
    rows = _checked(bronze, known_currency and not quarantine_after_dedup, options)
    if quarantine_after_dedup:
        rows = dedup(rows, watermark, thin=thin)
    else:
        good = rows.filter("is_valid").drop("raw_payload")
        if not untimed:
            good = good.filter(F.col("event_time").isNotNull())
        rows = dedup(good, watermark, thin=thin).withColumn(
            "raw_payload", F.lit(None).cast("string")
        )
    return _stamped(rows, processed_at)


def score_stream(
    bronze: DataFrame,
    router: Router,
    checkpoint: str,
    available_now: bool = False,
    processed_at: Column | None = None,
    known_currency: bool = True,
    quarantine_after_dedup: bool = False,
    **options,
) -> tuple[StreamingQuery, ...]:
    """Quarantine and scoring over ``bronze`` in one call: every row goes to one of the
    router's sinks, but for copies and, if the router has no sink for them, rows behind the
    watermark.

    The stateless query sends broken rows to the router's dead letters, and rows without
    event time to silver: the watermark could never take these out of the dedup state, so of
    them one per transaction and micro-batch stays. The stateful query deduplicates and
    routes the others. Each has a checkpoint below ``checkpoint``, and sinks get batches of
    both, which ``write_batch`` keeps apart. With
    ``quarantine_after_dedup`` the stateful one alone runs and routes all rows.
    Further options are those of ``deduplicated_stream``.
    """
    rows = deduplicated_stream(
        bronze,
        quarantine_after_dedup,
        processed_at=processed_at,
        known_currency=known_currency,
        untimed=False,
        mark_late=router.late is not None,
        **options,
    )
    if quarantine_after_dedup:
        return (route(rows, router, f"{checkpoint}/scored", available_now),)
    checks = {k: v for k, v in options.items() if k not in ("watermark", "thin", "late_cells")}
    broken = _stamped(_checked(bronze, known_currency, checks), processed_at)

    beside = each_batch(
        broken.filter("not is_valid or event_time is null"),
        router.route_beside,
        f"{checkpoint}/broken",
        available_now,
    )
    return beside, route(rows, router, f"{checkpoint}/scored", available_now)


def _checked(bronze: DataFrame, known_currency: bool, options: dict) -> DataFrame:
    rows = validate.validate(parse_payload(bronze), **options)
    return validate.quarantine_currency(rows) if known_currency else rows


def _stamped(rows: DataFrame, processed_at: Column | None) -> DataFrame:
    at = F.current_timestamp() if processed_at is None else processed_at
    return rows.withColumn("processed_at", at)


def dead_letters(checked: DataFrame, scoring: Sequence[Rule] | None = None) -> DataFrame:
    """Quarantined rows in the columns of the dead-letter table."""
    rows = rules.flag(rules.score(validate.quarantined_rows(checked), scoring))
    return rows.withColumn("risk_score", F.col("risk_score").cast("double")).select(
        *S.DEAD_LETTERS.fieldNames()
    )


@dataclass
class Router:
    """Scores one micro-batch and sends it to the silver, alert and quarantine sinks.

    ``velocity_batch`` names columns that part a micro-batch for the velocity rule;
    without any, an account's rows in the micro-batch count together. With ``velocity`` the
    rule counts a trailing span of event time instead, whatever the micro-batches: rows
    then wait for the watermark, and ``drain`` scores the last ones of a stream that has
    ended. Sinks write under the batch id, so a batch run again replaces its own output.

    The micro-batch is first written to ``staging`` (by default in the shared folder,
    two batches kept) and counted on the way. The velocity rule joins the batch to its
    own counts; from files, neither that nor a lost executor runs the stateful plan
    again. Rows marked ``is_late`` (``deduplicated_stream(mark_late=True)``) go to the sink
    ``late`` unscored, with ``dlq_reason`` where they are broken.
    """

    silver: Sink
    alerts: Sink
    dead_letters: Sink
    velocity_batch: Sequence[str] = ()
    on_violation: str = "quarantine"
    scoring: Sequence[Rule] | None = None
    staging: str | None = None
    velocity: TrailingVelocity | None = None
    late: Sink | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with settings(batch.sparkSession, ADAPTIVE_CONF):
            staged, counts = self._stage(batch, batch_id)
            if "is_late" in staged.columns:
                if counts["late"]:
                    late = staged.filter("is_late")
                    self.late(late.drop("is_late", "is_valid", "raw_payload"), batch_id)
                staged = staged.filter("not is_late").drop("is_late")
            self._route(staged, counts, batch_id)

    def route_beside(self, batch: DataFrame, batch_id: int) -> None:
        """Route a micro-batch of rows that have no place in the dedup state: broken ones, and
        good ones without event time, whose velocity counts among each other."""
        session = batch.sparkSession
        with settings(session, ADAPTIVE_CONF):
            batch = batch.persist()
            try:
                if self.on_violation == "fail":
                    bad = batch.filter(F.col("is_valid") & validate.bad_currency()).count()
                    if bad:
                        raise CheckFailed(f"batch {batch_id}: {bad} unknown currencies")
                checked = validate.quarantine_currency(batch)
                self.dead_letters(dead_letters(checked, self.scoring), batch_id)
                good = checked.filter("is_valid")
                once = first_row(good, ["transaction_id"], ["processed_at", "kafka_offset"])
                self._send(to_silver(once, self.velocity_batch, self.scoring), batch_id)
            finally:
                batch.unpersist()

    def _stage(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, dict[str, int]]:
        spark = batch.sparkSession
        self.staging = self.staging or scratch_path(spark, "staging")
        path = f"{self.staging}/slot={batch_id % 2}"
        late = F.col("is_late") if "is_late" in batch.columns else F.lit(False)
        valid = F.col("is_valid") & ~late
        counts = Observation()
        batch.observe(
            counts,
            F.count_if(valid).alias("valid"),
            F.count_if(~F.col("is_valid") & ~late).alias("broken"),
            F.count_if(valid & validate.bad_currency()).alias("bad_currency"),
            F.count_if(late).alias("late"),
        ).write.mode("overwrite").parquet(path)
        return spark.read.schema(batch.schema).parquet(path), counts.get

    def _route(self, batch: DataFrame, counts: dict[str, int], batch_id: int) -> None:
        bad_currency = counts["bad_currency"]
        if bad_currency:
            if self.on_violation == "fail":
                raise CheckFailed(f"batch {batch_id}: {bad_currency} unknown currencies")
            batch = validate.quarantine_currency(batch)

        good, suspects = counts["valid"] - bad_currency, 0
        if self.velocity:
            ripe = self.velocity.release(validate.valid_rows(batch), batch_id)
            good, suspects = self._send(_silver(score_marked(ripe, self.scoring)), batch_id)
        elif good:
            rows = to_silver(batch, self.velocity_batch, self.scoring)
            good, suspects = self._send(rows, batch_id)
        broken = counts["broken"] + bad_currency
        if broken:
            self.dead_letters(dead_letters(batch, self.scoring), batch_id)
        log.info(
            "batch %s: %s silver rows, %s alerts, %s quarantined", batch_id, good, suspects, broken
        )

    def _send(self, rows: DataFrame, batch_id: int) -> tuple[int, int]:
        """Silver rows and their alerts to the sinks; the numbers of both."""
        silver = rows.persist()
        try:
            sent = silver.agg(F.count("*"), F.count_if("is_fraud_suspect")).first()
            if sent[0]:
                self.silver(silver, batch_id)
            if sent[1]:
                self.alerts(alerts.alert_messages(silver), batch_id)
            return sent[0], sent[1]
        finally:
            silver.unpersist()

    def drain(self, spark: SparkSession) -> int:
        """Score the rows that still wait for the watermark of a stream that has ended for
        good; the number of them. Run again, it replaces its own output."""
        schema = validate.valid_rows(
            validate.validate(parse_payload(spark.createDataFrame([], S.BRONZE)))
        ).withColumn("processed_at", F.current_timestamp()).schema
        with settings(spark, ADAPTIVE_CONF):
            left = self.velocity.rest(spark, schema)
            if left is None:
                return 0
            return self._send(_silver(score_marked(left[0], self.scoring)), left[1])[0]


def to_silver(
    checked: DataFrame,
    velocity_batch: Sequence[str] = (),
    scoring: Sequence[Rule] | None = None,
) -> DataFrame:
    """Scored silver rows of a checked static batch, velocity rule included."""
    return _silver(score_marked(mark_bursts(validate.valid_rows(checked), velocity_batch), scoring))


def _silver(scored: DataFrame) -> DataFrame:
    return scored.withColumn("risk_score", F.col("risk_score").cast("double")).select(
        *S.SILVER.fieldNames()
    )


def table_sink(path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> Sink:
    return lambda rows, batch_id: write_batch(rows, path, batch_id, fmt, partition_by)


def topic_sink(servers: str, topic: str, **options: str) -> Sink:
    """Messages to a topic, each with its batch's key in the header ``batch``: a repeated
    batch sends its messages again, and readers know them by the header and the key."""
    return lambda rows, batch_id: publish(with_batch_header(rows, batch_id), servers, topic, **options)


def route(
    rows: DataFrame, router: Router, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    return each_batch(rows, router, checkpoint, available_now)


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows behind the watermark that the query has dropped, from its progress."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
