"""Alert ids that stay unique over restarts, repeated batches and several streams.

Every stream has a lane: ids are ``number * LANES + lane``, and two streams have
different lanes. Numbers go on from batch to batch. What comes after a batch is written
down beside the table, under the stream and the batch, so that a repeated batch gives the
same ids and a restart adds nothing. Numbers grow with the alerts alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas as S

# 20 bits for the stream; 43 bits are left for the numbers of each.
LANES = 1 << 20

LEDGER = S.struct_of("stream string, lane bigint, batch_id bigint, next bigint")


@dataclass
class AlertIds:
    """Numbers of one table's alerts, kept in a folder beside it."""

    spark: SparkSession
    path: str

    def _entries(self) -> list:
        """Two entries at most for each stream: its last two batches."""
        empty = self.spark.createDataFrame([], LEDGER).coalesce(1)
        # an entry without a stream makes the folder readable from the start
        empty.write.mode("overwrite").json(f"{self.path}/none")
        return self.spark.read.schema(LEDGER).json(f"{self.path}/*").collect()

    def open(self, stream: str, batch_id: int, stored: DataFrame) -> tuple[int, int]:
        """(lane, number to begin with) for a batch of a stream.

        ``stored`` are the alerts without those of this batch. A stream's first batch
        begins above all of them, also those that were numbered in another way.
        """
        entries = self._entries()
        own = {e.batch_id: e for e in entries if e.stream == stream}
        if batch_id - 1 in own:
            before = own[batch_id - 1]
            return before.lane, before.next
        taken = {e.lane for e in entries if e.stream != stream}
        lane = next(iter(own.values())).lane if own else free_lane(stream, taken)
        highest = stored.agg(F.max("alert_id")).first()[0] or 0
        return lane, highest // LANES + 1

    def close(self, stream: str, batch_id: int, lane: int, following: int) -> None:
        """Write down the number that comes after the batch."""
        row = self.spark.createDataFrame([(stream, lane, batch_id, following)], LEDGER)
        name = f"{stream or 'batch'}-{batch_id % 2}"
        row.coalesce(1).write.mode("overwrite").json(f"{self.path}/{name}")


def free_lane(stream: str, taken: set[int]) -> int:
    """A lane by the stream's id; the next free one if another stream has it."""
    lane = crc32(stream.encode()) % LANES
    if len(taken) >= LANES:
        raise ValueError("all lanes of alert ids are taken")
    while lane in taken:
        lane = (lane + 1) % LANES
    return lane


def as_id(number: Column, lane: int) -> Column:
    return number * F.lit(LANES) + F.lit(lane)


def following(rows: DataFrame, number: int) -> int:
    """The number after all those of the given alerts; ``number`` if there are none."""
    highest = rows.agg(F.max("alert_id")).first()[0]
    return number if highest is None else max(number, highest // LANES + 1)
