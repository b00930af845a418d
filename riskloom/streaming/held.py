"""Velocity in event time, the same however a stream is cut into micro-batches.

A row's velocity is the number of its account's rows in the span up to the row's own time.
It is known once the clock, the newest event time less the watermark delay, has passed that
time: then no earlier row is let in any more. So rows wait, and are scored in the batch
whose clock passes them, by all rows up to then.

What waits and the counts of the last span are two small tables in a folder, not keyed
state: a hot account goes through the sliced joins of ``velocity_trailing``, and nothing
is read but those tables and the batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas as S
from riskloom.functions.scalars import micros
from riskloom.operators.velocity import velocity_trailing
from riskloom.sinks.writers import running_stream

CLOCK = S.struct_of("stream string, batch_id bigint, newest bigint")
COUNTS = S.struct_of("account_id string, event_time timestamp, _n bigint")


@dataclass
class TrailingVelocity:
    """Holds rows of one stream back until their trailing count is known.

    ``path`` belongs to one stream, as its checkpoint does. ``delay`` is at least the
    watermark delay of the stream. Two turns are kept there, so a batch that is run again
    starts from what the batch before it left.
    """

    path: str
    seconds: int
    delay: str = S.WATERMARK
    threshold: int = S.VELOCITY_COUNT

    def release(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Rows of this and earlier batches that the clock has passed, with ``velocity_hit``.

        Rows without an event time are released at once and hit nothing.
        """
        spark = rows.sparkSession
        stream = running_stream(spark)
        before = self._before(spark, stream, batch_id)
        newest = rows.agg(F.max(micros("event_time"))).first()[0]
        if before and before.newest is not None:
            newest = before.newest if newest is None else max(newest, before.newest)
        waited, counts = self._held(spark, rows.schema, before)
        arrived = rows.unionByName(waited)
        closed = self._closed(newest)
        ready = F.col("event_time").isNull() | F.coalesce(F.col("event_time") <= closed, F.lit(False))
        ripe = arrived.where(ready)
        self._keep(spark, Row(stream, batch_id, newest), arrived.where(~ready), ripe, counts, closed)
        return self._marked(ripe, counts)

    def rest(self, spark: SparkSession, schema: T.StructType) -> tuple[DataFrame, int] | None:
        """What still waits of a stream that has ended for good, marked, and the next batch id."""
        last = max(self._clocks(spark).values(), key=lambda c: c.batch_id, default=None)
        if last is None:
            return None
        waited, counts = self._held(spark, schema, last)
        return self._marked(waited, counts), last.batch_id + 1

    def _marked(self, rows: DataFrame, counts: DataFrame) -> DataFrame:
        counted = velocity_trailing(rows, self.seconds, earlier=counts)
        hit = F.coalesce(F.col("tx_count") >= self.threshold, F.lit(False))
        return counted.withColumn("velocity_hit", hit).drop("tx_count")

    def _closed(self, newest):
        """The clock; like the watermark it has whole milliseconds."""
        at = None if newest is None else newest // 1000
        return F.timestamp_millis(F.lit(at).cast("long")) - F.expr(f"interval {self.delay}")

    def _turn(self, batch_id: int, name: str) -> str:
        return f"{self.path}/turn={batch_id % 2}/{name}"

    def _clocks(self, spark: SparkSession) -> dict[int, Row]:
        """The clock of each turn that was finished."""
        empty = spark.createDataFrame([], CLOCK).coalesce(1)
        # a folder without a clock, so that there is one to read from the start
        empty.write.mode("overwrite").json(f"{self.path}/clock/none")
        rows = spark.read.schema(CLOCK).json(f"{self.path}/clock/*").collect()
        return {r.batch_id % 2: r for r in rows}

    def _before(self, spark: SparkSession, stream: str, batch_id: int) -> Row | None:
        clocks = self._clocks(spark)
        if any(c.stream != stream for c in clocks.values()):
            raise ValueError(f"{self.path} holds rows of another stream")
        if batch_id == 0:
            return None
        before = clocks.get((batch_id - 1) % 2)
        if before is None or before.batch_id != batch_id - 1:
            raise ValueError(f"{self.path} lacks what batch {batch_id - 1} left")
        return before

    def _held(
        self, spark: SparkSession, schema: T.StructType, clock: Row | None
    ) -> tuple[DataFrame, DataFrame]:
        """Waiting rows, and counts of the span before the clock."""
        if clock is None:
            return spark.createDataFrame([], schema), spark.createDataFrame([], COUNTS)
        return (
            spark.read.schema(schema).parquet(self._turn(clock.batch_id, "waiting")),
            spark.read.schema(COUNTS).parquet(self._turn(clock.batch_id, "counts")),
        )

    def _keep(self, spark, clock: Row, waiting, ripe, counts, closed) -> None:
        """Write what the next batch starts from; the clock last."""
        stream, batch_id, newest = clock
        waiting.write.mode("overwrite").parquet(self._turn(batch_id, "waiting"))
        span = F.expr(f"interval {self.seconds} seconds")
        keys = ["account_id", "event_time"]
        recent = (
            ripe.groupBy(*keys)
            .agg(F.count("transaction_id").alias("_n"))
            .unionByName(counts)
            .where(F.col("event_time") >= closed - span)
        )
        recent.write.mode("overwrite").parquet(self._turn(batch_id, "counts"))
        row = spark.createDataFrame([(stream, batch_id, newest)], CLOCK).coalesce(1)
        row.write.mode("overwrite").json(f"{self.path}/clock/{batch_id % 2}")

