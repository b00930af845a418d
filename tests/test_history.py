import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators import asof, dedup, fact, scd2
from riskloom.plans import gold
from riskloom.operators.dims import dim_date, dim_merchant
from riskloom.plans import dataset as D

from .conftest import rows_of

DAY = timedelta(days=1)
START = datetime(2024, 1, 1)


def _extract(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, level string")


def _apply(history, extract, at, **options):
    return scd2.scd2_apply(history, extract, "id", ["level"], "sk", at, **options)


def test_one_snapshot_step(spark):
    first = scd2.first_versions(
        _extract(
            spark, [("a", "x", "LOW"), ("b", "y", None), ("c", "z", "LOW"), ("d", "w", "LOW")]
        ),
        "id", "sk", START,
    )
    second = _apply(
        first,
        _extract(
            spark, [("a", "x", "HIGH"), ("b", "y2", None), ("c", "z", None), ("e", "v", "LOW")]
        ),
        START + DAY,
    )
    versions = {
        (r.id, r.name, r.level, r.valid_from.day, r.valid_to and r.valid_to.day)
        for r in second.collect()
    }
    assert versions == {
        ("a", "x", "LOW", 1, 2),
        ("a", "x", "HIGH", 2, None),
        ("b", "y", None, 1, None),  # an untracked change makes no version
        ("c", "z", "LOW", 1, 2),
        ("c", "z", None, 2, None),  # a change to NULL does
        ("d", "w", "LOW", 1, None),  # gone from the extract: stays open
        ("e", "v", "LOW", 2, None),
    }
    assert second.select("sk").distinct().count() == 7


def test_close_missing(spark):
    first = scd2.first_versions(_extract(spark, [("a", "x", "LOW")]), "id", "sk", START)
    gone = _apply(first, _extract(spark, [("b", "x", "LOW")]), START + DAY, close_missing=True)
    ends = {r.id: r.valid_to for r in gone.collect()}
    assert ends["a"] is not None and ends["b"] is None


def test_same_extract_changes_nothing_and_copies_collapse(spark):
    extract = _extract(spark, [("a", "x", "LOW")] * 50)
    first = scd2.first_versions(extract.distinct(), "id", "sk", START)
    assert rows_of(_apply(first, extract, START + DAY)) == rows_of(first)


def test_fold_equals_one_pass(spark, sf_dir):
    log = D.customer_log(spark, sf_dir)
    history = scd2.first_versions(D.extract(log, 0), "customer_id", "customer_sk", D.SNAPSHOTS[0])
    for number in (1, 2, 3):
        history = scd2.scd2_apply(
            history, D.extract(log, number), "customer_id", S.CUSTOMER_TRACKED, "customer_sk",
            D.SNAPSHOTS[number],
        )
    one_pass = D.customer_history(spark, sf_dir)
    assert rows_of(history.select(*one_pass.columns)) == rows_of(one_pass)


@pytest.mark.parametrize("bucket", ["hour", "day", "month"])
def test_buckets_change_nothing(spark, bucket):
    rng = random.Random(3)
    seen, rows = set(), []
    for i in range(1500):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(20)}"
        at = START + timedelta(minutes=rng.randrange(60 * 24 * 40))
        if (key, at) not in seen:
            seen.add((key, at))
            rows.append((key, at, rng.choice(["x", "y", None]), rng.choice([1, 2]), i))
    log = spark.createDataFrame(rows, "id string, at timestamp, a string, b int, i int").persist()
    plain = scd2.scd2_from_log(log, "id", ["a", "b"], "at", "sk")
    bucketed = scd2.scd2_from_log(log, "id", ["a", "b"], "at", "sk", bucket)
    assert rows_of(plain) == rows_of(bucketed)


def test_backdate(spark, sf_dir):
    history = D.customer_history(spark, sf_dir)
    dated = scd2.backdate_first(history, "customer_id")
    firsts = dated.filter(F.col("valid_from") == F.lit("1900-01-01").cast("timestamp"))
    assert firsts.count() == history.select("customer_id").distinct().count()
    assert scd2.backdate_first(history, "customer_id", backdate=False) is history


def test_version_join_is_half_open_and_same_both_ways(spark):
    dim = spark.createDataFrame(
        [
            ("a", "a1", START, START + DAY),
            ("a", "a2", START + DAY, None),
            ("b", "b1", START + DAY, START + 2 * DAY),
        ],
        "account_id string, account_sk string, valid_from timestamp, valid_to timestamp",
    )
    rows = spark.createDataFrame(
        [
            ("1", "a", START - DAY),
            ("2", "a", START),
            ("3", "a", START + DAY),
            ("4", "b", START + 2 * DAY),
            ("5", "b", START),
            ("6", None, START),
            ("7", "a", None),
        ],
        "transaction_id string, account_id string, event_time timestamp",
    )
    for limit in (1000, 0):
        joined = fact.join_version(
            rows, dim, "account_id", "account_sk", backdate=False, broadcast_rows=limit,
            counted=rows,
        )
        found = {r.transaction_id: r.account_sk for r in joined.collect()}
        assert found == {
            "1": None, "2": "a1", "3": "a2", "4": None, "5": None, "6": None, "7": None
        }
    dated = fact.join_version(rows, dim, "account_id", "account_sk")
    found = {r.transaction_id: r.account_sk for r in dated.collect()}
    assert found["1"] == "a1" and found["5"] == "b1" and found["4"] is None


def test_fact_same_with_and_without_broadcast(spark, sf_dir):
    rows = D.replayed(D.silver(D.tx(spark, sf_dir)))
    dims = (
        D.customer_history(spark, sf_dir),
        D.account_history(spark, sf_dir),
        dim_merchant(D.raw_merchants(spark, sf_dir)),
        dim_date(spark),
    )
    small = fact.build_fact(rows, *dims, loaded_at=D.loaded_at())
    large = fact.build_fact(rows, *dims, loaded_at=D.loaded_at(), broadcast_rows=0)
    assert rows_of(small) == rows_of(large)
    assert dict(small.dtypes)["amount"] == "decimal(12,2)"
    assert small.filter("is_blocked_flag").count() == 0


def test_fact_with_triage(spark, sf_dir):
    rows = D.silver(D.tx(spark, sf_dir))
    dims = (
        D.customer_history(spark, sf_dir),
        D.account_history(spark, sf_dir),
        dim_merchant(D.raw_merchants(spark, sf_dir)),
        dim_date(spark),
    )
    blocked = fact.blocked_transactions(D.alerts(rows))
    built = fact.build_fact(rows, *dims, blocked=blocked)
    assert built.filter("is_blocked_flag").count() == blocked.count() > 0


def test_amount_too_large_becomes_null(spark):
    from riskloom.functions.scalars import money

    rows = spark.createDataFrame([(1e11,), (2.675,), (float("nan"),)], "v double")
    values = [r[0] for r in rows.select(money("v")).collect()]
    assert values == [None, Decimal("2.68"), None]


def test_first_row_ways_agree_with_nulls_last(spark):
    rng = random.Random(9)
    rows = [
        (f"k{rng.randrange(30)}", rng.choice([None, 1, 2, 3]), i) for i in range(600)
    ] + [("hot", None if i % 2 else 5, i) for i in range(300)]
    data = spark.createDataFrame(rows, "k string, at int, n int")
    a = dedup.first_row(data, ["k"], ["at", "n"])
    b = dedup.first_row_by_min(data, ["k"], ["at", "n"])
    assert rows_of(a) == rows_of(b)
    assert a.filter("k = 'hot'").first().at == 5


def test_thinning_keeps_every_key(spark):
    rows = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 9000 as string)) as k",
        "if(id % 3 = 0, null, timestamp_seconds(id % 9000)) as t",
        "id",
    ).coalesce(2)
    thinned = dedup.thin_copies(rows, ["k", "t"])
    assert thinned.filter("k = 'hot'").count() <= 10
    assert rows_of(thinned.select("k", "t").distinct()) == rows_of(rows.select("k", "t").distinct())
    assert thinned.join(rows, "id", "left_anti").isEmpty()


def test_calendar(spark):
    days = dim_date(spark)
    assert days.count() == 4018
    sunday = days.filter("date_sk = 20240107").first()
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (0, "Sunday", True)
    assert {r.day_of_week for r in days.select("day_of_week").distinct().collect()} == set(range(7))


def test_conflicting_rows_of_a_key_are_counted(spark):
    rows = [("a", "x", "LOW"), ("a", "x", "LOW"), ("b", "x", "LOW"), ("b", "x", "HIGH"), ("c", None, None)]
    extract = _extract(spark, rows)
    assert scd2.conflicting_keys(extract, "id").first()["failures"] == 1
    assert scd2.first_versions(extract, "id", "sk", START).count() == 3


@pytest.mark.parametrize("per_slice", [3, 1_000_000])
def test_asof_as_a_range_join(spark, per_slice):
    rng = random.Random(2)
    start = datetime(2024, 1, 1)
    spans = []
    for key in ("hot", "a", "b"):
        at = start
        for n in range(60 if key == "hot" else 4):
            begin = at + timedelta(minutes=rng.randrange(1, 900))
            at = begin + timedelta(minutes=rng.randrange(1, 900))
            end = None if n == 59 else at
            spans.append((key, f"{key}{n}", begin, end))
            at += timedelta(minutes=rng.choice([0, 0, 300]))  # some gaps between versions
    spans.append((None, "no key", start, None))
    versions = spark.createDataFrame(spans, "k string, sk string, _from timestamp, _to timestamp")
    rows = [
        (f"t{i}", rng.choice(["hot"] * 6 + ["a", "b", "c", None]),
         start + timedelta(minutes=rng.randrange(80_000)))
        for i in range(400)
    ]
    rows += [(f"e{i}", k, at) for i, (k, _, begin, end) in enumerate(spans) for at in (begin, end)]
    events = spark.createDataFrame(rows, "id string, k string, at timestamp")
    joined = asof.asof_join(events, versions, "k", ["sk"], "at", ["id", "at"], "day", per_slice)
    assert joined.columns == ["id", "k", "at", "sk"]

    def held(key, at):
        for k, sk, begin, end in spans:
            if key is not None and k == key and at and begin <= at and (end is None or at < end):
                return sk
        return None

    expected = sorted(((i, k, at, held(k, at)) for i, k, at in rows), key=repr)
    assert rows_of(joined) == expected
    assert len({r[3] for r in expected}) > 50


@pytest.mark.parametrize("per_slice", [1_000_000, 3])
def test_asof_of_two_keys_at_once(spark, per_slice):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)

    def history(prefix):
        spans = []
        for n in range(5):
            at = start
            for v in range(n + 1):
                end = at + timedelta(minutes=rng.randrange(1, 600))
                spans.append((f"{prefix}{n}", f"{prefix}{n}.{v}", at, None if v == n else end))
                at = end + timedelta(minutes=rng.choice([0, 0, 100]))
        return [*spans, (None, "no key", start, None), (f"{prefix}9", "no start", None, None)]

    customers, accounts = history("c"), history("a")
    rows = [
        (f"t{i}", rng.choice(["c1", "c2", "c4", "c7", "c9", None]),
         rng.choice(["a3", "a3", "a4", "a8", None]),
         rng.choice([None] + [start + timedelta(minutes=rng.randrange(-300, 3000))] * 20))
        for i in range(300)
    ]
    rows += [(f"e{i}", "c4", a, b) for i, (a, _, b, _) in enumerate(accounts)]
    rows += [(f"f{i}", c, "a4", b) for i, (c, _, _, b) in enumerate(customers)]
    events = spark.createDataFrame(rows, "id string, c string, a string, at timestamp")

    def versions(spans, key, sk):
        return spark.createDataFrame(
            spans, f"{key} string, {sk} string, _from timestamp, _to timestamp"
        )

    histories = [
        (versions(customers, "c", "c_sk"), "c", ["c_sk"]),
        (versions(accounts, "a", "a_sk"), "a", ["a_sk"]),
    ]
    joined = asof.asof_join_all(events, histories, "at", ["id"], per_slice)
    assert joined.columns == ["id", "c", "a", "at", "c_sk", "a_sk"]

    def held(spans, key, at):
        for k, sk, begin, end in spans:
            if key and k == key and at and begin and begin <= at and (end is None or at < end):
                return sk
        return None

    expected = [(i, c, a, at, held(customers, c, at), held(accounts, a, at)) for i, c, a, at in rows]
    assert rows_of(joined) == sorted(expected, key=repr)
    assert len({r[4:] for r in expected}) > 20
    pairs = {(c, a) for _, c, a, _ in rows}
    met = sum(s[0] == c for c, _ in pairs for s in customers if c)
    met += sum(s[0] == a for _, a in pairs for s in accounts if a)
    assert asof.meetings(events, [h[:2] for h in histories]) == (len(rows), met)


def test_large_fact_finds_first_rows_once(spark, sf_dir):
    """No step of the fact runs a second time for rows without key or time."""
    rows = D.silver(D.tx(spark, sf_dir)).localCheckpoint()
    customers, accounts = D.customer_history(spark, sf_dir), D.account_history(spark, sf_dir)
    seeds = D.raw_merchants(spark, sf_dir)
    dims = [d.localCheckpoint() for d in (customers, accounts, dim_merchant(seeds))]
    large = fact.build_fact(rows, *dims, dim_date(spark), D.loaded_at(), broadcast_rows=0)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number() windowspecdefinition(transaction_id") == 1


def test_conflicting_extract_rows_are_reported(spark, tmp_path):
    extract = spark.createDataFrame(
        [("c1", "x"), ("c1", "y"), ("c2", "x"), ("c2", "x")], "customer_id string, city string"
    )
    extract.write.parquet(str(tmp_path / "run" / "raw_customers"))
    job = gold.GoldRun(str(tmp_path), "run", "2024-01-01", "")
    row = gold._conflicts(spark, job, "raw_customers", extract.schema, "customer_id").first()
    assert (row.violations, row.passed, row.check_name) == (1, False, "conflicting_keys")
