"""One row per key: the first in an order, or on a stream the first seen."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.schemas import WATERMARK


def first_row(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key, NULLs of ``order`` last.

    Spark keeps one row per key in each map task before the shuffle, so any number
    of copies of one row stays cheap.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (
        rows.withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") == 1)
        .drop("_position")
    )


def first_row_by_min(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Same result as ``first_row`` by aggregation."""
    rank = F.struct(*[part for c in order for part in _nulls_last(c)])
    others = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.min_by(F.struct(*others), rank).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in rows.columns])
    )


def thin_copies(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row per key in each Arrow batch, ahead of a shuffle by key.

    A stream can not aggregate before its dedup step without a second state store.
    This needs no state, and a message sent a great many times shrinks to one row per
    batch, so it does not fall whole to the one task that owns its key.
    """
    keys = list(keys)

    def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbered = pa.Table.from_batches([batch]).select(keys)
            numbered = numbered.append_column("_row", pa.array(range(batch.num_rows)))
            firsts = numbered.group_by(keys, use_threads=False).aggregate([("_row", "min")])
            yield batch.take(firsts["_row_min"].combine_chunks())

    return rows.mapInArrow(first_of_each, rows.schema)


def dedup_stream(
    rows: DataFrame,
    delay: str = WATERMARK,
    keys: Sequence[str] = ("transaction_id", "event_time"),
    thin: bool = True,
) -> DataFrame:
    """Drop repeats of ``keys`` within the watermark; later rows are dropped too.

    ``thin=False`` skips ``thin_copies``, for sources known to repeat little.
    """
    if thin:
        rows = thin_copies(rows, keys)
    return rows.withWatermark("event_time", delay).dropDuplicates(list(keys))


def dedup_stream_by_id(rows: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Drop repeats of a transaction id that come within ``delay``, whatever their time."""
    return rows.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(
        ["transaction_id"]
    )


def late_rows(
    valid: DataFrame, kept: DataFrame, keys: Sequence[str] = ("transaction_id", "event_time")
) -> DataFrame:
    """Valid rows whose key never reached the deduplicated table: dropped as late."""
    on = None
    for key in keys:
        same = valid[key].eqNullSafe(kept[key])
        on = same if on is None else on & same
    return valid.join(kept.select(*keys), on, "left_anti")


def _nulls_last(name: str) -> list[Column]:
    return [F.col(name).isNull(), F.col(name)]
