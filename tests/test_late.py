"""Rows behind the watermark come out marked, and their state goes."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators.late import dedup_or_late
from riskloom.sinks.writers import append_stream, each_batch
from riskloom.sources.readers import table, table_stream
from riskloom.streaming import silver

from .test_streams import _bronze_rows, _collecting_router

SCHEMA = "transaction_id string, event_time timestamp, n long, amount decimal(20,4), v double, `a b` string"
NOON = datetime(2024, 1, 1, 12)
DELAY = timedelta(minutes=10)


def _row(name, minutes, n=2**60 + 1, v=0.1):
    at = None if minutes is None else NOON + timedelta(minutes=minutes)
    return (name, at, n, Decimal("1234567890123456.7891"), v, None)


# One list per run; a run is one micro-batch and one without data.
RUNS = [
    [_row("a", 0), _row("a", 0), _row("b", 0.5), _row("n", None), _row("n", None)],
    [_row("a", 0), _row("c", -9), _row(None, 1), _row("far", -200), _row("n", None)],
    [_row("d", 60, None, float("nan")), _row("a", 0)],
    [_row("a", 0), _row("d", 60), _row("e", 50), _row("f", 50.001), _row("é\"\\", 61)],
    [_row("z", 300, None, None)],
]


def _brute(runs, delay=DELAY):
    seen, high, out = set(), None, []
    for run in runs:
        passed, untimed = high and high - delay, set()
        for row in run:
            key, at = row[:2], row[1]
            if at is None:
                if key not in untimed:
                    out.append((row, False))
                untimed.add(key)
            elif passed and at <= passed:
                out.append((row, True))
            elif key not in seen:
                seen.add(key)
                out.append((row, False))
        times = [row[1] for row in run if row[1]]
        high = max([*times, high] if high else times, default=high)
    return out


def _run(spark, tmp_path, runs, **options):
    query = None
    path = str(tmp_path / "in")
    for rows in runs:
        frame = spark.createDataFrame(rows, SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(path)
        query = append_stream(
            dedup_or_late(table_stream(spark, path, frame.schema), "10 minutes", **options),
            str(tmp_path / "out"),
            str(tmp_path / "c"),
            available_now=True,
        )
        query.awaitTermination()
    return query, table(spark, str(tmp_path / "out"))


@pytest.mark.parametrize("lanes, span", [(1, 3600), (64, 1)])
def test_equals_a_plain_loop(spark, tmp_path, lanes, span):
    query, kept = _run(spark, tmp_path, RUNS, thin=False, lanes=lanes, span_seconds=span)
    names = ["transaction_id", "event_time", "n", "amount", "v", "a b"]
    found = [(tuple(r[c] for c in names), r.is_late) for r in kept.collect()]
    expected = _brute(RUNS)
    assert sum(late for _, late in expected) == 3
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    # all cells but that of the last row are gone
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1


def test_many_copies_over_arrow_batches(spark, tmp_path):
    copies = [_row("hot", 0, n) for n in range(25_000)] + [_row(f"k{n}", 1) for n in range(300)]
    _, kept = _run(spark, tmp_path, [copies, [_row("hot", 0)], [_row("z", 90)], [_row("hot", 0)]])
    rows = kept.groupBy("transaction_id").agg(F.count("*"), F.count_if("is_late")).collect()
    assert {r[0]: tuple(r[1:]) for r in rows if r[0] in ("hot", "z")} == {"hot": (2, 1), "z": (1, 0)}
    assert len(rows) == 302 and all(r[1] == 1 for r in rows if r[0] != "hot")


def test_columns_of_any_name_and_empty_runs(spark, tmp_path):
    path, schema = str(tmp_path / "in"), "transaction_id string, event_time timestamp, is_vip boolean, cell int, r int"
    rows = []
    spark.createDataFrame([], schema).write.parquet(path)
    each_batch(
        dedup_or_late(table_stream(spark, path, spark.createDataFrame([], schema).schema)),
        lambda batch, _: rows.extend(batch.collect()),
        str(tmp_path / "c"),
        True,
    ).awaitTermination()
    assert rows == []
    with pytest.raises(ValueError, match="event_time"):
        dedup_or_late(spark.createDataFrame([], schema), keys=["transaction_id"])


@pytest.mark.parametrize("after", [False, True])
def test_router_sends_late_rows_to_their_sink(spark, tmp_path, after):
    seen = {"silver": [], "alerts": [], "dead": []}
    late = []
    router = _collecting_router(seen, late=lambda rows, batch_id: late.extend(rows.collect()))
    path = str(tmp_path / "bronze")
    batches = [[("a", "12:00:00"), "{bad"], [("a", "12:00:00"), ("b", "11:55:00"), ("c", "03:00:00"), ("n", None)]]
    for number, batch in enumerate(batches):
        _bronze_rows(spark, batch, number * 100).coalesce(1).write.mode("append").parquet(path)
        stream = table_stream(spark, path, S.BRONZE)
        for query in silver.score_stream(
            stream, router, str(tmp_path / "c"), True, quarantine_after_dedup=after
        ):
            query.awaitTermination()
    assert sorted(r.transaction_id for r in seen["silver"]) == ["a", "b", "n"]
    assert [r.transaction_id for r in late] == ["c"]
    assert [r.dlq_reason for r in seen["dead"]] == [S.REASON_MISSING_ID]
    assert late[0].event_time == datetime(2024, 1, 1, 3) and late[0].amount == 5
