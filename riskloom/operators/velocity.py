"""How many transactions an account makes in a batch, a window or a trailing span."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.functions.scalars import micros
from riskloom.operators.rules import (
    Rule,
    add_velocity,
    default_rules,
    flag,
    score,
    velocity_rule,
)
from riskloom.operators.skew import ROWS_PER_SLICE, attach, heavy_keys

ROW_ID = ("transaction_id", "event_time")


def mark_bursts(
    rows: DataFrame,
    batch: Sequence[str] = (),
    threshold: int = S.VELOCITY_COUNT,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add ``velocity_hit``: the account has ``threshold`` or more rows in its batch.

    Counts are made before the shuffle, and only accounts over the threshold come
    back to the rows, so a hot account costs one count row and never one task.
    """
    keys = ["account_id", *batch]
    counts = rows.groupBy(*keys).agg(F.count("transaction_id").alias("_n"))
    bursts = counts.filter(F.col("_n") >= threshold).select(*keys, F.lit(True).alias("_burst"))
    heavy = heavy_keys(counts, keys, "_n", rows_per_slice)
    marked = attach(rows, bursts, keys, ROW_ID, heavy=heavy, null_safe=True)
    return marked.withColumn("velocity_hit", F.coalesce("_burst", F.lit(False))).drop("_burst")


def velocity_in_batch(rows: DataFrame, batch: Sequence[str] = (), **options) -> DataFrame:
    """Flagged rows scored again with the velocity rule."""
    marked = mark_bursts(rows, batch, **options)
    return add_velocity(marked, F.col("velocity_hit"))


def score_with_velocity(
    rows: DataFrame,
    batch: Sequence[str] = (),
    rules: Sequence[Rule] | None = None,
    **options,
) -> DataFrame:
    """Unscored rows scored by all rules at once, velocity among them.

    The same score, flag and reason as scoring first and ``velocity_in_batch`` after,
    but the rows cross the shuffle before they get the columns of the score.
    """
    return score_marked(mark_bursts(rows, batch, **options), rules)


def score_marked(marked: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Rows that carry ``velocity_hit``, scored by all rules and the velocity rule."""
    rules = default_rules() if rules is None else rules
    return flag(score(marked, [*rules, velocity_rule()]), S.REASON_CRITICAL)


def velocity_tumbling(
    rows: DataFrame, width: str, threshold: int = S.VELOCITY_COUNT
) -> DataFrame:
    """Accounts with ``threshold`` or more rows in an event-time window.

    Also valid on a stream with a watermark: the window is sent once it is closed.
    """
    return (
        rows.groupBy(F.window("event_time", width).alias("w"), "account_id")
        .agg(F.count("transaction_id").alias("tx_count"))
        .filter(F.col("tx_count") >= threshold)
        .select(
            "account_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "tx_count",
        )
    )


def velocity_trailing(
    rows: DataFrame,
    seconds: int,
    bucket_seconds: int | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Add ``tx_count``: rows of the account in the ``seconds`` up to each row.

    ``earlier`` has counts (account_id, event_time, _n) of rows that are no longer there.

    Rows are first counted per account and instant. Each instant then adds its count
    when it comes and takes it away when it leaves the trailing span, so a running sum
    gives every answer in one pass. The sums run inside time buckets; what is still in
    the span at the end of a bucket is added at the start of the next, so they are
    whole while no task holds more than one bucket of one account.
    """
    span = seconds * 1_000_000
    width = (bucket_seconds or 6 * seconds) * 1_000_000
    if width < span:
        raise ValueError("a bucket must be at least as long as the trailing span")
    keys = ["account_id", "event_time"]
    counts = rows.groupBy(*keys).agg(F.count("transaction_id").alias("_n"))
    if earlier is not None:
        both = counts.unionByName(earlier.select(*keys, "_n"))
        counts = both.groupBy(*keys).agg(F.sum("_n").alias("_n"))
    heavy = heavy_keys(counts, keys, "_n", rows_per_slice)

    ticks = counts.withColumn("_at", micros("event_time"))
    ticks = ticks.withColumn("_home", F.floor(F.col("_at") / F.lit(width)))
    home, at, n = F.col("_home"), F.col("_at"), F.col("_n")
    leaves = at + span + 1
    next_start = (home + 1) * width
    comes = _step(home, at, n, F.col("event_time"))
    within = F.array(comes, _step(home, leaves, -n))
    across = F.array(comes, _step(home + 1, next_start, n), _step(home + 1, leaves, -n))
    changes = F.when(leaves < next_start, within).when(leaves >= next_start, across)
    steps = ticks.select("account_id", F.inline(changes))
    so_far = (
        Window.partitionBy("account_id", "_bucket")
        .orderBy("_when")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums = (
        steps.withColumn("tx_count", F.sum("_change").over(so_far))
        .filter(F.col("event_time").isNotNull())
        .select(*keys, "tx_count")
    )
    return attach(rows, sums, keys, ROW_ID, heavy=heavy, null_safe=True)


def _step(bucket: Column, when: Column, change: Column, event_time: Column | None = None) -> Column:
    """A change of the running count; only a tick itself carries its event time."""
    tick = F.lit(None).cast("timestamp") if event_time is None else event_time
    return F.struct(
        bucket.alias("_bucket"),
        when.alias("_when"),
        change.alias("_change"),
        tick.alias("event_time"),
    )
