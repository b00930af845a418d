"""Stream dedup that puts rows behind the watermark out instead of dropping them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from riskloom.operators.dedup import thin_copies
from riskloom.schemas import WATERMARK

SPAN_SECONDS = 60
LANES = 64


def dedup_or_late(
    rows: DataFrame,
    delay: str = WATERMARK,
    keys: Sequence[str] = ("transaction_id", "event_time"),
    thin: bool = True,
    span_seconds: int = SPAN_SECONDS,
    lanes: int = LANES,
) -> DataFrame:
    """``rows`` with ``is_late``: the first of ``keys`` ahead of the watermark, and every row
    behind it. Copies ahead of the watermark are dropped, as by ``dedup_stream``.

    ``keys`` hold ``event_time``. The state has a cell for each span of event time and lane
    (a hash of the keys) and holds the keys seen there; it goes when the watermark has
    passed the span. One Python call of some milliseconds serves a cell, which holds the keys
    of a span over ``lanes``: thin streams want long spans and few lanes. Rows without event time have no state: of them the first per key
    and micro-batch comes out, not late. The copies of a late row come out too, but for those
    that ``thin`` takes out of an Arrow batch.

    Spark drops late rows ahead of a stateful step by the column that carries the
    watermark. So that column moves in rows of its own, which end before the shuffle; the
    others carry a NULL there and pass. The function reads the watermark from its state.
    Columns travel as JSON, timestamps as microseconds, so Python never changes a value;
    timestamps inside nested columns keep milliseconds.
    """
    if "event_time" not in keys:
        raise ValueError("keys must hold event_time: the watermark ends their state")
    if span_seconds < 1 or lanes < 1:
        raise ValueError("span_seconds and lanes start at 1")
    if thin:
        rows = thin_copies(rows, keys)
    times = [f.name for f in rows.schema if isinstance(f.dataType, T.TimestampType)]
    plain = [
        F.unix_micros(f"`{c}`").alias(c) if c in times else F.col(f"`{c}`") for c in rows.columns
    ]
    packed = rows.select(*plain).schema
    at = F.unix_micros("event_time")
    key = F.to_json(F.struct(*[c for c, name in zip(plain, rows.columns) if name in keys]))
    clock = F.when(F.col("event_time").isNull(), F.array(F.lit(None).cast("timestamp"))).otherwise(
        F.array(F.lit(None).cast("timestamp"), F.col("event_time"))
    )
    cells = rows.select(
        key.alias("_key"),
        at.alias("_at"),
        F.to_json(F.struct(*plain)).alias("_row"),
        F.explode(clock).alias("_clock"),
    )
    cells = (
        cells.withWatermark("_clock", delay)
        .filter(F.col("_clock").isNull())
        .withColumn("_span", F.expr(f"_at div {span_seconds * 1_000_000}"))
        .withColumn("_lane", F.pmod(F.xxhash64("_key"), F.lit(lanes)))
    )
    marked = cells.groupBy("_span", "_lane").applyInPandasWithState(
        _cell_step(span_seconds * 1000),
        "_row string, is_late boolean",
        "seen array<string>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    row = F.from_json("_row", packed).alias("r")
    return marked.select(row, "is_late").select(
        *[
            (F.timestamp_micros(f"r.`{c}`") if c in times else F.col(f"r.`{c}`")).alias(c)
            for c in rows.columns
        ],
        "is_late",
    )


def _cell_step(span_ms: int):
    def step(
        cell: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        timed = not pd.isna(cell[0])
        seen = set(state.get[0]) if state.exists else set()
        before = len(seen)
        passed = state.getCurrentWatermarkMs()
        for chunk in chunks:
            picked, marks = [], []
            for row, (key, at) in enumerate(zip(chunk["_key"].tolist(), chunk["_at"].tolist())):
                late = at <= passed * 1000
                if late or key not in seen:
                    picked.append(row)
                    marks.append(late)
                if not late:
                    seen.add(key)
            if picked:
                yield pd.DataFrame({"_row": chunk["_row"].to_numpy()[picked], "is_late": marks})
        if not timed or not seen:
            return
        end = (int(cell[0]) + 1) * span_ms
        if end <= passed:
            state.remove()
            return
        if len(seen) > before:
            state.update((sorted(seen),))
        state.setTimeoutTimestamp(end)

    return step
