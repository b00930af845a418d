"""Versioned dimensions: rows valid in ``[valid_from, valid_to)``, NULL end = current."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.scalars import surrogate_key
from riskloom.schemas import FIRST_VERSION_FROM


def snapshot_time(at: datetime | str) -> Column:
    return F.lit(str(at)).cast("timestamp")


def first_versions(extract: DataFrame, key: str, sk: str, at: datetime | str) -> DataFrame:
    """A history that starts with this extract; copies of a row collapse into one.

    Of rows of one key that differ the smallest stays; ``conflicting_keys`` counts these keys.
    """
    return _opened(_one_per_key(extract, key), key, sk, at)


def conflicting_keys(extract: DataFrame, key: str) -> DataFrame:
    """One row: ``failures``, the number of keys with more than one distinct row."""
    rows = extract.select(F.col(key).alias("_key"), F.struct(*extract.columns).alias("_row")).distinct()
    return rows.groupBy("_key").count().where("count > 1").agg(F.count("*").alias("failures"))


def _opened(extract: DataFrame, key: str, sk: str, at: datetime | str) -> DataFrame:
    time = snapshot_time(at)
    return extract.select(
        surrogate_key(key, time).alias(sk),
        *extract.columns,
        time.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def changed_versions(
    current: DataFrame,
    extract: DataFrame,
    key: str,
    tracked: Sequence[str],
    sk: str,
    at: datetime | str,
    close_missing: bool = False,
) -> DataFrame:
    """Current versions after one extract, together with those it closes.

    A key with a changed tracked column gets its version closed and a new one; a
    new key gets a version; all else stays, including keys the extract lacks
    unless ``close_missing``. Copies of an extract row collapse into one; of rows of one key
    that differ the smallest stays, and ``conflicting_keys`` counts these keys.
    """
    time = snapshot_time(at)
    fresh = _opened(_one_per_key(extract, key), key, sk, at).select(*current.columns)
    old = current.select(F.col(key).alias("_key"), F.struct(*current.columns).alias("old"))
    new = fresh.select(F.col(key).alias("_key"), F.struct(*current.columns).alias("new"))
    both = old.join(new, "_key", "full")

    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()
    same = F.lit(True)
    for name in tracked:
        same = same & F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    changed = had & has & ~same
    closes = changed | (had & ~has) if close_missing else changed
    kept = F.when(closes, F.col("old").withField("valid_to", time)).otherwise(F.col("old"))
    added = F.when(has & (~had | changed), F.col("new"))
    return both.select(
        F.explode(F.filter(F.array(kept, added), lambda v: v.isNotNull())).alias("v")
    ).select("v.*")


def scd2_apply(
    history: DataFrame,
    extract: DataFrame,
    key: str,
    tracked: Sequence[str],
    sk: str,
    at: datetime | str,
    close_missing: bool = False,
) -> DataFrame:
    """The whole history after one extract. Closed versions pass through unshuffled."""
    current = history.filter(F.col("valid_to").isNull())
    closed = history.filter(F.col("valid_to").isNotNull())
    return closed.unionByName(
        changed_versions(current, extract, key, tracked, sk, at, close_missing)
    )


def scd2_from_log(
    log: DataFrame,
    key: str,
    tracked: Sequence[str],
    at: str,
    sk: str,
    bucket: str | None = None,
) -> DataFrame:
    """The history of a change log in one pass; same rows as applying it step by step.

    The log holds one row per key and time; rows without either have no place in a
    history and are left out (``checks.not_null`` counts them). ``bucket`` (``"day"``,
    ``"month"``, ...) cuts a key's log into time buckets, so that a key with very many
    rows is spread over tasks; leave it out where rows per key are few, as for daily
    extracts.
    """
    names = [c for c in log.columns if c not in (key, at)]
    rows = log.dropna(subset=[key, at]).withColumn("_state", F.struct(*tracked))
    if bucket is None:
        ordered = Window.partitionBy(key).orderBy(at)
        before = F.lag("_state").over(ordered)
        versions = rows.withColumn("_before", before).filter(
            ~F.col("_state").eqNullSafe(F.col("_before"))
        )
        end = F.lead(at).over(ordered)
    else:
        versions = _bucket_versions(rows, key, at, bucket)
        ordered = Window.partitionBy(key, "_bucket").orderBy(at)
        end = F.coalesce(F.lead(at).over(ordered), F.col("_next_change"))
    return versions.select(
        surrogate_key(key, at).alias(sk),
        key,
        *names,
        F.col(at).alias("valid_from"),
        end.alias("valid_to"),
    )


def _bucket_versions(rows: DataFrame, key: str, at: str, bucket: str) -> DataFrame:
    """Rows that start a version, with the first change after their bucket."""
    # The filter keeps both uses of the rows alike, so that Spark can share them.
    rows = rows.withColumn("_bucket", F.date_trunc(bucket, F.col(at))).filter(
        F.col("_bucket").isNotNull()
    )
    ordered = Window.partitionBy(key, "_bucket").orderBy(at)
    rows = rows.withColumn("_before", F.lag("_state").over(ordered))
    inner = F.col("_before").isNotNull() & ~F.col("_state").eqNullSafe(F.col("_before"))
    rows = rows.withColumn("_inner", inner)

    # One row per key and bucket: few enough per key to be ordered in one task.
    edges = rows.groupBy(key, "_bucket").agg(
        F.min(at).alias("_first_at"),
        F.min_by("_state", at).alias("_first"),
        F.max_by("_state", at).alias("_last"),
        F.min(F.when(F.col("_inner"), F.col(at))).alias("_inner_change"),
    )
    by_key = Window.partitionBy(key)
    before = F.lag("_last").over(by_key.orderBy("_bucket"))
    edges = edges.withColumn("_starts", ~F.col("_first").eqNullSafe(before))
    first_change = F.when(F.col("_starts"), F.col("_first_at")).otherwise(F.col("_inner_change"))
    edges = edges.withColumn("_change", first_change)
    later = by_key.orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("_next_change", F.min("_change").over(later)).select(
        key, "_bucket", "_first_at", "_starts", "_next_change"
    )
    starts = F.col("_inner") | (F.col("_starts") & (F.col(at) == F.col("_first_at")))
    return rows.join(edges, [key, "_bucket"]).filter(starts)


def backdate_first(history: DataFrame, key: str, backdate: bool = True) -> DataFrame:
    """Let the first version of each key hold since ever.

    Events before the first snapshot would otherwise find no version. A key has at
    most one version per snapshot run, so its window stays small.
    """
    if not backdate:
        return history
    order = F.row_number().over(Window.partitionBy(key).orderBy("valid_from"))
    since_ever = F.lit(str(FIRST_VERSION_FROM)).cast("timestamp")
    return history.withColumn(
        "valid_from", F.when(order == 1, since_ever).otherwise(F.col("valid_from"))
    )


def _one_per_key(extract: DataFrame, key: str) -> DataFrame:
    return (
        extract.groupBy(F.col(key).alias("_key"))
        .agg(F.min(F.struct(*extract.columns)).alias("_row"))
        .select("_row.*")
    )
