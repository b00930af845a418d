"""What the dashboard polls, kept up to date by the batches that change it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas as S
from riskloom.operators.serving import accepted_actions, apply_triage, triaged_rows
from riskloom.sinks.writers import write_batch

TOTALS = T.StructType(
    [
        *S.struct_of("total_transactions bigint, total_suspected_fraud bigint").fields,
        T.StructField("total_fraud_amount", T.DecimalType(38, 2)),
        *S.struct_of("event_date date, batch_id bigint").fields,
    ]
)


def day_totals(fact: DataFrame) -> DataFrame:
    """Sums per day of event time that add up to the metrics of the whole fact."""
    suspect = F.col("is_fraud_suspect")
    amount = F.sum(F.when(suspect, F.col("amount")).cast(T.DecimalType(28, 2)))
    return fact.groupBy(F.to_date("event_time").alias("event_date")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(suspect).alias("total_suspected_fraud"),
        F.coalesce(amount, F.lit(0)).cast(T.DecimalType(38, 2)).alias("total_fraud_amount"),
    )


def merged_metrics(totals: DataFrame) -> DataFrame:
    """``serving.fraud_metrics`` of all rows that the totals stand for."""
    names = ("total_transactions", "total_suspected_fraud", "total_fraud_amount")
    row = totals.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    share = F.col("total_suspected_fraud") * 100 / F.col("total_transactions")
    rate = F.when(F.col("total_transactions") > 0, F.round(share, 2)).otherwise(F.lit(0.0))
    return row.withColumn("fraud_rate_percentage", rate)


@dataclass(frozen=True)
class KeptMetrics:
    """Totals of a fact that grows by batches: a row for each batch and day.

    ``add`` is a sink: it reads its own batch alone, and a repeated batch replaces its
    totals. Reading adds up the rows, whatever the size of the fact.
    """

    spark: SparkSession
    path: str

    def add(self, rows: DataFrame, batch_id: int) -> None:
        write_batch(day_totals(rows).coalesce(1), self.path, batch_id)

    def totals(self) -> DataFrame:
        return self.spark.read.schema(TOTALS).parquet(self.path)

    def metrics(self) -> DataFrame:
        return merged_metrics(self.totals())


def both(*sinks):
    """A sink that hands a batch to several, in order."""

    def send(rows: DataFrame, batch_id: int) -> None:
        for sink in sinks:
            sink(rows, batch_id)

    return send


def queue_order() -> list[Column]:
    """Riskiest first, newest first among equals; NULLs last, as ``serving.alerts_queue``."""
    return [F.col("risk_score").desc(), F.col("event_time").desc(), F.col("transaction_id").asc()]


@dataclass(frozen=True)
class KeptQueue:
    """The first ``size`` alerts of a status, out of the first ones of each batch.

    ``add`` writes a batch's alerts, and beside them the first ``size`` of each status.
    Triage takes alerts away and none comes back to PENDING. A batch whose kept rows may
    have run out above the last place is read again in full, so the result is that of
    sorting everything.
    """

    spark: SparkSession
    path: str
    size: int = 50

    def add(self, rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, f"{self.path}/alerts", batch_id)
        firsts = self._places(self.spark_rows(rows), ["status"])
        last = F.col("_place") == self.size
        kept = firsts.filter(F.col("_place") <= self.size).withColumn("_cut", last).drop("_place")
        write_batch(kept.coalesce(1), f"{self.path}/first", batch_id)

    @staticmethod
    def spark_rows(rows: DataFrame) -> DataFrame:
        return rows.select(*S.OPERATIONAL_ALERTS.fieldNames())

    @staticmethod
    def _places(rows: DataFrame, parts: list[str]) -> DataFrame:
        window = Window.partitionBy(*parts).orderBy(*queue_order())
        return rows.withColumn("_place", F.row_number().over(window))

    def _read(self, name: str, *more: T.StructField) -> DataFrame:
        batch = T.StructField("batch_id", T.LongType())
        schema = T.StructType([*S.OPERATIONAL_ALERTS.fields, *more, batch])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def alerts(self) -> DataFrame:
        return self._read("alerts")

    def first(self, actions: DataFrame, status: str = "PENDING") -> DataFrame:
        """The queue of ``status`` after ``actions``, the riskiest first."""
        kept = self._read("first", T.StructField("_cut", T.BooleanType())).filter(
            F.col("status") == status
        )
        again = self._used_up(kept, actions, status)
        parts = [kept.filter(~F.col("batch_id").isin(again)).drop("_cut")]
        if again:
            parts.append(self.alerts().filter(F.col("batch_id").isin(again)))
        rows = apply_triage(reduce(DataFrame.unionByName, parts).drop("batch_id"), actions)
        if status in S.TRIAGE_STATUSES:  # alerts that triage brought here, from any place
            moved = triaged_rows(self.alerts().drop("batch_id"), actions)
            acted = accepted_actions(actions).select("transaction_id").distinct()
            rows = rows.join(acted, "transaction_id", "left_anti").unionByName(moved)
        rows = rows.select(*S.OPERATIONAL_ALERTS.fieldNames())
        return rows.filter(F.col("status") == status).orderBy(*queue_order()).limit(self.size)

    def _used_up(self, kept: DataFrame, actions: DataFrame, status: str) -> list[int]:
        """Batches that left alerts out, some of which may come before the last place."""
        acted = accepted_actions(actions).select("transaction_id").distinct()
        left = kept.join(acted, "transaction_id", "left_anti")
        places = left.orderBy(*queue_order()).limit(self.size)
        marked = places.select(*_KEYS).withColumn("_is_place", F.lit(True))
        cuts = kept.filter("_cut").select(*_KEYS, "batch_id").withColumn("_is_place", F.lit(False))
        # one row for each batch that left alerts out, and at most ``size`` places
        rows = cuts.unionByName(marked, allowMissingColumns=True)
        ahead = Window.orderBy(*queue_order(), F.col("_is_place").desc()).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        before = F.sum(F.col("_is_place").cast("int")).over(ahead)
        short = rows.withColumn("_before", before).filter(
            ~F.col("_is_place") & (F.col("_before") < self.size)
        )
        return [r.batch_id for r in short.select("batch_id").collect()]


_KEYS = ("risk_score", "event_time", "transaction_id")
