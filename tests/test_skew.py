import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.operators import skew, velocity

from .conftest import rows_of

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hot_rows(spark):
    """A third of the rows on one account, some without one, copies at one instant."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        account = "hot" if i % 3 == 0 else None if i % 10 == 1 else f"a{rng.randrange(60)}"
        second = 0 if i % 30 == 0 else rng.randrange(4 * 3600)
        rows.append((f"t{i}", account, START + timedelta(seconds=second, microseconds=i % 7)))
    rows.append(("late", "hot", None))
    return spark.createDataFrame(
        rows, "transaction_id string, account_id string, event_time timestamp"
    ).persist()


def _heavy(rows, keys, per_slice):
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return skew.heavy_keys(counts, keys, "n", per_slice)


def test_heavy_keys_are_bounded(hot_rows):
    heavy = _heavy(hot_rows, ["account_id"], 10)
    top = heavy.orderBy(F.desc("_slices")).first()
    assert top._heavy_account_id == "hot" and top._slices == 31
    counts = hot_rows.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    assert skew.heavy_keys(counts, ["account_id"], "n", 1, limit=3).count() == 3


@pytest.mark.parametrize("per_slice", [5, 10_000])
def test_attach_is_a_left_join(hot_rows, per_slice):
    lookup = (
        hot_rows.groupBy("account_id")
        .agg(F.min("event_time").alias("first_at"))
        .filter("account_id is null or account_id <> 'a1'")
    )
    heavy = _heavy(hot_rows, ["account_id"], per_slice)
    for null_safe in (False, True):
        joined = skew.attach(
            hot_rows, lookup, ["account_id"], velocity.ROW_ID, heavy, null_safe=null_safe
        )
        right = lookup.withColumnRenamed("account_id", "k")
        same = F.col("account_id").eqNullSafe(F.col("k")) if null_safe else F.expr("account_id = k")
        assert rows_of(joined) == rows_of(hot_rows.join(right, same, "left").drop("k"))


def test_attach_spreads_a_hot_key(hot_rows):
    heavy = _heavy(hot_rows, ["account_id"], 20)
    sliced = hot_rows.join(
        heavy, F.col("account_id").eqNullSafe(F.col("_heavy_account_id")), "left"
    ).withColumn("s", skew._slice(velocity.ROW_ID))
    sizes = sliced.filter("account_id = 'hot'").groupBy("s").count().collect()
    assert len(sizes) > 10 and max(r["count"] for r in sizes) < 60


def test_lookup_join_both_ways(hot_rows):
    lookup = hot_rows.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    args = (hot_rows, lookup, ["account_id"], velocity.ROW_ID)
    assert skew.fits(lookup, 1000) and not skew.fits(lookup, 3)
    assert rows_of(skew.lookup_join(*args)) == rows_of(
        skew.lookup_join(*args, broadcast_rows=3, counted=hot_rows)
    )


@pytest.mark.parametrize("per_slice", [5, 10_000])
def test_bursts_match_a_window_count(spark, hot_rows, per_slice):
    rows = hot_rows.withColumn("hour", F.hour("event_time"))
    marked = velocity.mark_bursts(rows, ["hour"], 3, per_slice)
    rows.createOrReplaceTempView("hot_rows")
    expected = spark.sql(
        "select *, count(transaction_id) over (partition by account_id, hour) >= 3 as velocity_hit "
        "from hot_rows"
    )
    assert rows_of(marked) == rows_of(expected)


@pytest.mark.parametrize("bucket", [600, 700, 7200])
def test_trailing_counts_match_brute_force(hot_rows, bucket):
    counted = velocity.velocity_trailing(hot_rows, 600, bucket, rows_per_slice=5).collect()
    rows = [(r.account_id, r.event_time) for r in counted]
    span = timedelta(seconds=600)
    assert len(counted) == hot_rows.count()
    for row in counted:
        if row.event_time is None:
            assert row.tx_count is None
            continue
        expected = sum(
            1
            for account, at in rows
            if account == row.account_id
            and at is not None
            and row.event_time - span <= at <= row.event_time
        )
        assert row.tx_count == expected


def test_trailing_bucket_must_hold_the_span(hot_rows):
    with pytest.raises(ValueError):
        velocity.velocity_trailing(hot_rows, 600, 60)


def test_tumbling_windows(hot_rows):
    busy = velocity.velocity_tumbling(hot_rows.dropna(), "1 hour")
    assert busy.filter("account_id = 'hot'").count() == 4
    assert busy.filter("tx_count < 3").count() == 0


def test_scoring_at_once_equals_scoring_in_two_steps(spark, sf_dir):
    from riskloom.plans import dataset as D

    valid = D.valid(D.tx(spark, sf_dir))
    once = velocity.score_with_velocity(valid, ["event_date"])
    steps = velocity.velocity_in_batch(D.scored(valid), ["event_date"])
    assert rows_of(once.select(*steps.columns)) == rows_of(steps)
