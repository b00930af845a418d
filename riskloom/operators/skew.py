"""Left join in which a hot key is shared out over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key outside the HEAVY_KEYS heaviest has at most 1/HEAVY_KEYS of all rows.
HEAVY_KEYS = 65_536
ROWS_PER_SLICE = 1_000_000
# Rows of a lookup table that may be broadcast; checked before each use.
BROADCAST_ROWS = 200_000


def heavy_keys(
    counts: DataFrame,
    keys: Sequence[str],
    count: str,
    rows_per_slice: int = ROWS_PER_SLICE,
    limit: int = HEAVY_KEYS,
) -> DataFrame:
    """The heaviest keys with the number of slices each is to be cut into.

    At most ``limit`` rows whatever the data, so safe to broadcast.
    """
    return (
        counts.filter(F.col(count) > rows_per_slice)
        .orderBy(F.col(count).desc(), *keys)
        .limit(limit)
        .select(
            *[F.col(k).alias(f"_heavy_{k}") for k in keys],
            F.ceil(F.col(count) / rows_per_slice).cast("int").alias("_slices"),
        )
    )


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str],
    heavy: DataFrame,
    condition: Column | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Left join ``lookup`` onto ``rows`` on ``keys`` (and ``condition``).

    ``heavy`` comes from ``heavy_keys``; it decides the spread, never the result.
    Rows of a heavy key are cut into slices by a hash of ``spread_on``, and its
    lookup rows are repeated once per slice. The hash is of row values, not random,
    so a recomputed task makes the same slices. NULL keys are sliced like others;
    they find a NULL lookup key only under ``null_safe``.
    """
    keys = list(keys)
    heavy = F.broadcast(heavy)
    heavy_columns = ["_slices", *[f"_heavy_{k}" for k in keys]]

    is_heavy = _all([F.col(k).eqNullSafe(F.col(f"_heavy_{k}")) for k in keys])
    sliced = (
        rows.join(heavy, is_heavy, "left")
        .withColumn("_slice", _slice(spread_on))
        .drop(*heavy_columns)
    )
    is_heavy = _all([F.col(f"_key_{k}").eqNullSafe(F.col(f"_heavy_{k}")) for k in keys])
    slices = F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)
    repeated = (
        _renamed(lookup, keys)
        .join(heavy, is_heavy, "left")
        .withColumn("_key_slice", F.explode(slices))
        .drop(*heavy_columns)
    )
    on = [_same(k, null_safe) for k in keys]
    on.append(F.col("_slice") == F.col("_key_slice"))
    if condition is not None:
        on.append(condition)
    joined = sliced.join(repeated, _all(on), "left")
    return joined.drop("_slice", "_key_slice", *[f"_key_{k}" for k in keys])


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str],
    condition: Column | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join that broadcasts ``lookup`` only after counting it, else ``attach``.

    Heavy keys are looked for in ``counted``: a table that ``rows`` comes from, so
    that a chain of joins is not run once more for each link.
    """
    if not fits(lookup, broadcast_rows):
        source = rows if counted is None else counted
        counts = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        heavy = heavy_keys(counts, keys, "_n")
        return attach(rows, lookup, keys, spread_on, heavy, condition)
    on = [_same(k) for k in keys]
    if condition is not None:
        on.append(condition)
    joined = rows.join(F.broadcast(_renamed(lookup, keys)), _all(on), "left")
    return joined.drop(*[f"_key_{k}" for k in keys])


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; for a table only footers are read."""
    return df.count() <= max_rows


def _renamed(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    return lookup.withColumnsRenamed({k: f"_key_{k}" for k in keys})


def _same(key: str, null_safe: bool = False) -> Column:
    left, right = F.col(key), F.col(f"_key_{key}")
    return left.eqNullSafe(right) if null_safe else left == right


def _slice(spread_on: Sequence[str]) -> Column:
    return F.when(
        F.col("_slices").isNotNull(), F.pmod(F.xxhash64(*spread_on), F.col("_slices"))
    ).otherwise(F.lit(0)).cast("int")


def _all(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result
