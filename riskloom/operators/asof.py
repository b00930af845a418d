"""The version that held at a row's time, for histories and keys of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.skew import ROWS_PER_SLICE, heavy_keys

_CELL = ["_key", "_bucket"]


def asof_join(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    values: Sequence[str],
    at: str,
    spread_on: Sequence[str],
    bucket: str = "day",
    rows_per_slice: int = ROWS_PER_SLICE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join: add ``values`` of the version with ``_from <= at < _to`` (NULL: no end).

    The versions of a key must not overlap. Rows and versions are put in one order of time
    and each row takes the last version before it, so a row meets one version of its key
    where an equi-join meets all. The order is made inside a key's time buckets: what holds
    when a bucket begins is found from one row per key and bucket, and put before the
    bucket's rows. Buckets of more than ``rows_per_slice`` rows are cut into slices by a
    hash of ``spread_on``, with the bucket's versions in each. Rows without key or time
    find no version.

    Buckets are counted in ``counted``: a table that has the keys and times of all ``rows``,
    so that what makes these is not run once more; by default ``rows``.
    """
    found = F.col(key).isNotNull() & F.col(at).isNotNull()
    row = F.struct(*[F.col(c) for c in rows.columns])
    cell = [
        F.when(found, F.col(key)).alias("_key"),
        F.when(found, F.date_trunc(bucket, at)).alias("_bucket"),
    ]
    known = rows.select(
        *cell,
        F.xxhash64(*spread_on).alias("_spread"),
        F.col(at).alias("_when"),
        row.alias("_row"),
    )
    held = versions.filter(F.col(key).isNotNull() & F.col("_from").isNotNull()).select(
        F.col(key).alias("_key"),
        F.date_trunc(bucket, "_from").alias("_bucket"),
        F.col("_from").alias("_when"),
        F.struct(*values, "_to").alias("_version"),
    )
    source = rows if counted is None else counted
    counts = source.groupBy(*cell).agg(F.count("*").alias("_n"))
    heavy = heavy_keys(counts, _CELL, "_n", rows_per_slice)
    before = _before_buckets(counts, held)
    lookups = held.select(*_CELL, "_when", "_version").unionByName(
        before.withColumn("_when", F.lit(None).cast("timestamp"))
    )
    lookups = _in_all_slices(lookups, heavy, _CELL)
    events = _in_one_slice(known, heavy, _CELL, F.col("_spread"))

    both = events.select(*_CELL, "_slice", "_when", "_row", _none(lookups, "_version")).unionByName(
        lookups.select(*_CELL, "_slice", "_when", _none(events, "_row"), "_version")
    )
    # a version holds from its first instant on, so it comes before rows of that instant
    order = [F.col("_when").asc_nulls_first(), F.col("_row").isNotNull()]
    so_far = (
        Window.partitionBy(*_CELL, "_slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = both.withColumn("_held", F.last("_version", ignorenulls=True).over(so_far)).filter(
        F.col("_row").isNotNull()
    )
    ends = F.col("_held._to")
    holds = ends.isNull() | (F.col("_when") < ends)
    return joined.select(
        "_row.*", *[F.when(holds, F.col(f"_held.{v}")).alias(v) for v in values]
    )


def asof_join_all(
    rows: DataFrame,
    histories: Sequence[tuple[DataFrame, str, Sequence[str]]],
    at: str,
    spread_on: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``asof_join`` with several histories (versions, key, values) in one shuffle of the rows.

    Rows are brought together by all the keys at once, and each combination of keys that
    occurs gets the versions of its keys; ``meetings`` counts these beforehand. For versions
    that are few per key: there are no buckets of time. A combination of more than
    ``rows_per_slice`` rows is cut into slices, with its versions in each.
    """
    keys = [key for _, key, _ in histories]
    counts = _key_counts(rows if counted is None else counted, keys)
    heavy = heavy_keys(counts, keys, "_n", rows_per_slice)
    both = _in_one_slice(rows, heavy, keys, F.xxhash64(*spread_on)).withColumn("_is_row", F.lit(True))
    names = [f"_version_{i}" for i in range(len(histories))]
    for name, (versions, key, values) in zip(names, histories):
        # a version that ends as it begins holds for no row
        lasts = F.col("_to").isNull() | (F.col("_from") < F.col("_to"))
        held = versions.filter(F.col("_from").isNotNull() & lasts).select(
            key, F.col("_from").alias(at), F.struct(*values, "_to").alias(name)
        )
        met = _in_all_slices(counts.select(*keys).join(held, key), heavy, keys)
        met = met.withColumn("_is_row", F.lit(False))
        both = both.unionByName(met, allowMissingColumns=True)

    so_far = (
        Window.partitionBy(*keys, "_slice")
        .orderBy(F.col(at).asc_nulls_first(), "_is_row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = both.withColumns(
        {name: F.last(name, ignorenulls=True).over(so_far) for name in names}
    ).filter("_is_row")
    found = []
    for name, (_, _, values) in zip(names, histories):
        ends = F.col(f"{name}._to")
        holds = ends.isNull() | (F.col(at) < ends)
        found += [F.when(holds, F.col(f"{name}.{v}")).alias(v) for v in values]
    return joined.select(*rows.columns, *found)


def meetings(rows: DataFrame, histories: Sequence[tuple[DataFrame, str]]) -> tuple[int, int]:
    """The number of rows, and of versions that ``asof_join_all`` would put beside them."""
    counts = _key_counts(rows, [key for _, key in histories])
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"))
    for i, (versions, key) in enumerate(histories):
        own = versions.groupBy(key).agg(F.count("*").alias("_versions"))
        wanted = counts.groupBy(key).agg(F.count("*").alias("_times"))
        met = own.join(wanted, key).agg(F.sum(F.col("_versions") * F.col("_times")).alias(f"_met_{i}"))
        total = total.crossJoin(met)
    found = total.first()
    return found[0], sum(n or 0 for n in found[1:])


def _key_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("_n"))


def _before_buckets(counts: DataFrame, held: DataFrame) -> DataFrame:
    """The last version before each bucket that has rows, if there is one.

    One row per key and bucket at most is ordered per key, whatever the rows and versions.
    """
    none = F.lit(None).cast(held.schema["_version"].dataType).alias("_last")
    edges = held.groupBy(*_CELL).agg(F.max_by("_version", "_when").alias("_last"))
    cells = (
        counts.select(*_CELL, "_n", none)
        .unionByName(edges.select(*_CELL, F.lit(0).cast("long").alias("_n"), "_last"))
        .groupBy(*_CELL)
        .agg(F.sum("_n").alias("_n"), F.first("_last", ignorenulls=True).alias("_last"))
    )
    earlier = (
        Window.partitionBy("_key")
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = cells.withColumn("_version", F.last("_last", ignorenulls=True).over(earlier))
    return carried.filter((F.col("_n") > 0) & F.col("_version").isNotNull()).select(
        *_CELL, "_version"
    )


def _in_one_slice(
    df: DataFrame, heavy: DataFrame, keys: Sequence[str], spread: Column
) -> DataFrame:
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    cut = _with_slices(df, heavy, keys).withColumn("_slice", F.pmod(spread, slices).cast("int"))
    return cut.drop("_slices")


def _in_all_slices(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    slices = F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)
    return _with_slices(df, heavy, keys).withColumn("_slice", F.explode(slices)).drop("_slices")


def _with_slices(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    same = [F.col(k).eqNullSafe(F.col(f"_heavy_{k}")) for k in keys]
    joined = df.join(F.broadcast(heavy), reduce(Column.__and__, same), "left")
    return joined.drop(*[f"_heavy_{k}" for k in keys])


def _none(like: DataFrame, name: str) -> Column:
    return F.lit(None).cast(like.schema[name].dataType).alias(name)
