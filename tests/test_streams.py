import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators import rules, validate
from riskloom.operators.alerts import extract_alerts, rejected_alerts
from riskloom.operators.bronze import parse_payload
from riskloom.operators.checks import CheckFailed
from riskloom.operators.dedup import dedup_stream, dedup_stream_by_id, late_rows
from riskloom.plans import dataset as D
from riskloom.plans import stream_jobs
from riskloom.sinks import writers
from riskloom.sinks.writers import append_stream, write_batch
from riskloom.sources.readers import TOPIC_MESSAGE, table, table_stream
from riskloom.streaming import alerts, bronze, silver
from riskloom.streaming.alert_ids import LANES, AlertIds, following, free_lane
from riskloom.streaming.held import TrailingVelocity

from .conftest import rows_of

# One list per micro-batch: payload or (id, time).
BATCHES = [
    [("a", "12:00:00"), ("a", "12:00:00"), "{bad", "null"],
    ["nope", ("b", "11:55:00"), ("c", "03:00:00"), ("a", "12:00:01")],
    [("z", "16:00:00")],
    [("n", "12:10:00"), "[]", ("n2", None)],
]


def _payload(row):
    if isinstance(row, str):
        return row
    time = f',"event_time":"2024-01-01T{row[1]}Z"' if row[1] else ""
    return f'{{"transaction_id":"{row[0]}","account_id":"x","amount":5{time}}}'


def _bronze_rows(spark, batch, start):
    return spark.createDataFrame(
        [
            (None, _payload(r), "transactions", 0, start + i, datetime(2024, 1, 1),
             datetime(2024, 1, 1), "2024-01-01")
            for i, r in enumerate(batch)
        ],
        S.BRONZE,
    )


def _feed(spark, tmp_path, job):
    """Run ``job`` after each batch has come in, on the same checkpoints."""
    path = str(tmp_path / "bronze")
    for number, batch in enumerate(BATCHES):
        _bronze_rows(spark, batch, number * 100).coalesce(1).write.mode("append").parquet(path)
        job(table_stream(spark, path, S.BRONZE))


def _collecting_router(seen, **options):
    def sink(name):
        return lambda rows, batch_id: seen[name].extend(rows.collect())

    return silver.Router(sink("silver"), sink("alerts"), sink("dead"), **options)


def test_lateness_with_quarantine_first(spark, tmp_path):
    seen = {"silver": [], "alerts": [], "dead": []}

    def job(stream):
        silver.quarantine(
            stream, str(tmp_path / "dead"), str(tmp_path / "c1"), available_now=True
        ).awaitTermination()
        silver.route(
            silver.deduplicated_stream(stream), _collecting_router(seen), str(tmp_path / "c2"), True
        ).awaitTermination()

    _feed(spark, tmp_path, job)
    kept = [(r.transaction_id, r.event_time and r.event_time.second) for r in seen["silver"]]
    assert sorted(kept, key=str) == sorted(
        [("a", 0), ("b", 0), ("a", 1), ("z", 0), ("n2", None)], key=str
    )
    dead = table(spark, str(tmp_path / "dead"))
    assert dead.count() == 4
    assert set(dead.columns) == set(S.DEAD_LETTERS.fieldNames())
    assert set(seen["silver"][0].asDict()) == set(S.SILVER.fieldNames())


def test_lateness_with_quarantine_after_dedup(spark, tmp_path):
    seen = {"silver": [], "alerts": [], "dead": []}

    def job(stream):
        rows = silver.deduplicated_stream(stream, quarantine_after_dedup=True)
        router = _collecting_router(seen)
        silver.route(rows, router, str(tmp_path / "c"), True).awaitTermination()

    _feed(spark, tmp_path, job)
    assert sorted(r.transaction_id for r in seen["silver"]) == ["a", "a", "b", "n2", "z"]
    assert [r.dlq_reason for r in seen["dead"]] == [S.REASON_MISSING_ID]


def test_dropped_rows_are_counted_and_found(spark, tmp_path):
    queries = []

    def job(stream):
        rows = parse_payload(stream).select("transaction_id", "event_time", "kafka_offset")
        rows = rows.filter("transaction_id is not null")
        query = append_stream(
            dedup_stream(rows, thin=False), str(tmp_path / "kept"), str(tmp_path / "c"),
            available_now=True,
        )
        query.awaitTermination()
        queries.append(query)

    _feed(spark, tmp_path, job)
    assert sum(silver.rows_dropped_late(q) for q in queries) == 2
    rows = parse_payload(table(spark, str(tmp_path / "bronze"), schema=S.BRONZE))
    valid = validate.valid_rows(validate.validate(rows))
    lost = late_rows(valid, table(spark, str(tmp_path / "kept")))
    assert {r.transaction_id for r in lost.collect()} == {"c", "n"}


def test_dedup_by_id_ignores_the_time(spark, tmp_path):
    def job(stream):
        rows = parse_payload(stream).select("transaction_id", "event_time")
        rows = rows.filter("event_time is not null")
        append_stream(
            dedup_stream_by_id(rows), str(tmp_path / "kept"), str(tmp_path / "c"),
            available_now=True,
        ).awaitTermination()

    _feed(spark, tmp_path, job)
    kept = table(spark, str(tmp_path / "kept"))
    assert sorted(r.transaction_id for r in kept.collect()) == ["a", "b", "z"]


def test_topic_messages_become_bronze(spark, tmp_path):
    messages = spark.createDataFrame(
        [(b"k", b"{}", "transactions", 1, 7, datetime(2024, 1, 1))], TOPIC_MESSAGE
    )
    messages.write.parquet(str(tmp_path / "topic"))
    bronze.ingest(
        table_stream(spark, str(tmp_path / "topic"), TOPIC_MESSAGE),
        str(tmp_path / "bronze"),
        str(tmp_path / "c"),
        available_now=True,
    ).awaitTermination()
    row = table(spark, str(tmp_path / "bronze"), schema=S.BRONZE).first()
    assert (row.kafka_key, row.raw_payload, row.kafka_partition, row.kafka_offset) == (
        "k", "{}", 1, 7,
    )
    assert row.ingestion_date == row.ingestion_timestamp.strftime("%Y-%m-%d")


def _batch(spark, currencies):
    rows = spark.createDataFrame(
        [(f"t{i}", "acc", c, i) for i, c in enumerate(currencies)],
        "transaction_id string, account_id string, currency string, kafka_offset bigint",
    )
    rows = rows.selectExpr(
        "cast(null as string) as raw_payload",
        "transaction_id", "account_id", "'c' as customer_id", "'m' as merchant_id",
        "'crypto' as merchant_category", "9000.0d as amount", "currency",
        "'PIX' as payment_method", "cast(null as string) as device_id",
        "cast(null as string) as ip_address", "cast(null as string) as region",
        "timestamp '2024-01-01 12:00:00' as event_time", "kafka_offset",
        "'2024-01-01' as bronze_ingestion_date",
    )
    return validate.validate(rows).withColumn("processed_at", F.current_timestamp())


def test_a_repeated_batch_replaces_its_output(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("silver", "alerts", "dead")]
    router = silver.Router(*[silver.table_sink(p) for p in paths])
    for _ in range(2):
        router(_batch(spark, ["USD", "XXX", None]), 3)
    router(_batch(spark, ["EUR"]), 4)
    assert [table(spark, p).count() for p in paths] == [3, 3, 1]
    assert table(spark, paths[2]).first().dlq_reason == S.REASON_INVALID_CURRENCY


def test_no_alerts_are_sent_without_suspects(spark):
    seen = {"silver": [], "alerts": [], "dead": []}
    calm = _batch(spark, ["USD"]).withColumn("amount", F.lit(10.0))
    _collecting_router(seen)(calm, 0)
    assert len(seen["silver"]) == 1 and not seen["alerts"] and not seen["dead"]
    _collecting_router(seen)(_batch(spark, ["USD"]), 1)
    assert [r.key for r in seen["alerts"]] == ["t0"]


def test_fail_policy_writes_nothing(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("silver", "alerts", "dead")]
    router = silver.Router(*[silver.table_sink(p) for p in paths], on_violation="fail")
    with pytest.raises(CheckFailed):
        router(_batch(spark, ["USD", "XXX"]), 1)
    assert not any((tmp_path / n).exists() for n in ("silver", "alerts", "dead"))


def test_router_velocity(spark):
    rows = silver.to_silver(_batch(spark, ["USD"] * 3))
    assert {(r.risk_score, r.fraud_reason) for r in rows.collect()} == {(1.0, S.REASON_CRITICAL)}
    apart = silver.to_silver(_batch(spark, ["USD"] * 3), ["transaction_id"])
    assert {r.risk_score for r in apart.collect()} == {0.75}


def test_router_uses_own_rules(spark):
    always = [rules.Rule("always", F.lit(True), Decimal("0.9"))]
    row = silver.to_silver(_batch(spark, ["USD"]), scoring=always).first()
    assert row.risk_score == 0.95 and row.is_fraud_suspect


def test_stream_and_batch_agree(spark, sf_dir):
    streamed = stream_jobs.silver_score(spark, sf_dir)
    batch = D.silver(D.tx(spark, sf_dir)).withColumn(
        "risk_score", F.col("risk_score").cast("double")
    )
    assert rows_of(streamed) == rows_of(batch.select(*streamed.columns))


def test_day_partitions_make_few_files(spark, tmp_path):
    rows = spark.range(2000, numPartitions=8).selectExpr("id", "id % 5 as day")
    write_batch(rows, str(tmp_path / "t"), 0, partition_by=["day"])
    assert len(list((tmp_path / "t").glob("batch_id=0/day=*/*.parquet"))) <= 10


def test_new_checkpoint_keeps_what_is_stored(spark, tmp_path):
    message = {"account_id": "A", "customer_id": "C", "amount": 1.0, "risk_score": 0.9,
               "event_time": "2024-01-01T12:00:00Z"}
    path = str(tmp_path / "alerts")
    for turn, name in enumerate(("one", "two")):
        source = str(tmp_path / f"in{turn}")
        rows = [(name, json.dumps({**message, "transaction_id": name})), ("x", "broken")]
        spark.createDataFrame(rows, "key string, value string").write.parquet(source)
        stream = spark.readStream.schema("key string, value string").parquet(source)
        for _ in range(2):  # the second start finds nothing new
            alerts.consume(
                stream, path, str(tmp_path / f"checkpoint{turn}"), available_now=True
            ).awaitTermination()
    stored = alerts.stored_alerts(spark, path).collect()
    assert {r.transaction_id for r in stored} == {"one", "two"}
    assert len({r.alert_id for r in stored}) == 2
    assert spark.read.parquet(f"{path}_rejected").count() == 2


def test_delta_batches_know_their_stream():
    one, two = (writers.delta_batch("t", 0, s) for s in ("a", "b"))
    assert one["txnAppId"] != two["txnAppId"] and one["txnVersion"] == "1"
    assert writers.batch_key("a", 0) != writers.batch_key("b", 0) != 0
    assert writers.batch_key("", 7) == 7


def test_every_row_reaches_a_sink(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("silver", "alerts", "dead")]
    router = silver.Router(*[silver.table_sink(p) for p in paths])

    def job(stream):
        for query in silver.score_stream(stream, router, str(tmp_path / "c"), available_now=True):
            query.awaitTermination()

    _feed(spark, tmp_path, job)
    dead = table(spark, paths[2])
    # all four broken rows; of the others one copy and two late rows are left out
    broken = sum(isinstance(r, str) for batch in BATCHES for r in batch)
    assert dead.count() == broken
    kept = {r.transaction_id for r in table(spark, paths[0]).collect()}
    assert table(spark, paths[0]).count() + dead.count() == sum(map(len, BATCHES)) - 1 - 2
    assert kept == {"a", "b", "z", "n2"}


def test_rows_without_time_stay_out_of_the_state(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("silver", "alerts", "dead")]
    router = silver.Router(*[silver.table_sink(p) for p in paths])
    path = str(tmp_path / "bronze")
    batches = [[("n", None), ("n", None), ("m", None), ("a", "12:00:00")], [("b", "16:00:00")]]
    for number, batch in enumerate(batches):
        _bronze_rows(spark, batch, number * 100).coalesce(1).write.mode("append").parquet(path)
        stream = table_stream(spark, path, S.BRONZE)
        for query in silver.score_stream(stream, router, str(tmp_path / "c"), available_now=True):
            query.awaitTermination()
    kept = [r.transaction_id for r in table(spark, paths[0]).collect()]
    assert sorted(kept) == ["a", "b", "m", "n"]
    # 16:00 moved the watermark past 12:00; nothing else was ever there
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 1


def test_unknown_currency_without_time(spark, tmp_path):
    rows = _bronze_rows(
        spark, ['{"transaction_id":"x","amount":5,"currency":"XXX"}', "{bad", ("n", None)], 0
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "bronze"))
    stream = table_stream(spark, str(tmp_path / "bronze"), S.BRONZE)
    seen = {"silver": [], "alerts": [], "dead": []}
    for query in silver.score_stream(
        stream, _collecting_router(seen), str(tmp_path / "c"), True, known_currency=False
    ):
        query.awaitTermination()
    assert [r.transaction_id for r in seen["silver"]] == ["n"]
    assert sorted(r.dlq_reason for r in seen["dead"]) == sorted(
        [S.REASON_INVALID_CURRENCY, S.REASON_MISSING_ID]
    )
    failing = _collecting_router(seen, on_violation="fail")
    with pytest.raises(Exception, match="unknown currencies"):
        for query in silver.score_stream(
            stream, failing, str(tmp_path / "c2"), True, known_currency=False
        ):
            query.awaitTermination()


def test_one_query_quarantines_after_dedup(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("silver", "alerts", "dead")]
    router = silver.Router(*[silver.table_sink(p) for p in paths])

    def job(stream):
        queries = silver.score_stream(
            stream, router, str(tmp_path / "c"), available_now=True,
            quarantine_after_dedup=True, watermark="10 minutes",
        )
        assert len(queries) == 1
        queries[0].awaitTermination()

    _feed(spark, tmp_path, job)
    # rows without keys fall into one, and go to the dead letters once
    assert table(spark, paths[2]).count() == 1
    assert {r.transaction_id for r in table(spark, paths[0]).collect()} == {"a", "b", "z", "n2"}


def _timed(spark, rows):
    return spark.createDataFrame(
        [(i, a, datetime.fromisoformat(f"2024-01-01T{t}") if t else None) for i, a, t in rows],
        "transaction_id string, account_id string, event_time timestamp",
    )


TIMED = [
    [("1", "A", "10:00:00"), ("2", "A", "10:05:00"), ("3", "B", "10:06:00"), ("4", "A", None)],
    [("5", "A", "09:58:00"), ("6", "A", "10:30:00"), ("7", "B", "10:31:00")],
    [],
    [("8", "B", "10:25:00"), ("9", "A", "10:50:00"), ("10", "A", "11:20:00")],
]


def _released(spark, path, batches, **options):
    """(id, hit) of all rows, batch by batch and then the rest."""
    held = TrailingVelocity(path, seconds=1800, delay="10 minutes", **options)
    seen, schema = [], None
    for batch_id, batch in enumerate(batches):
        rows = _timed(spark, batch)
        schema = rows.schema
        out = held.release(rows, batch_id)
        seen.append({r.transaction_id: r.velocity_hit for r in out.collect()})
    rest, following = held.rest(spark, schema)
    assert following == len(batches)
    return [*seen, {r.transaction_id: r.velocity_hit for r in rest.collect()}]


def test_trailing_velocity_whatever_the_cut(spark, tmp_path):
    cut = _released(spark, str(tmp_path / "a"), TIMED)
    whole = _released(spark, str(tmp_path / "b"), [[r for b in TIMED for r in b]])
    merged = {k: v for part in cut for k, v in part.items()}
    assert merged == {k: v for part in whole for k, v in part.items()}
    assert sum(map(len, cut)) == len(merged) == 10
    # 09:58, 10:00, 10:05 are scored together though 09:58 came later
    assert merged["2"] and not merged["1"] and not merged["4"]
    assert cut[0] == {"4": False} and set(cut[1]) == {"5", "1", "2", "3"}
    # at 10:30 are 10:00 and 10:05 still in the span, from an earlier batch's counts
    assert merged["6"] and set(cut[2]) == set() and merged["8"] is False


def test_trailing_velocity_repeats_a_batch(spark, tmp_path):
    path = str(tmp_path / "held")
    held = TrailingVelocity(path, seconds=1800, delay="10 minutes")
    held.release(_timed(spark, TIMED[0]), 0)
    first = rows_of(held.release(_timed(spark, TIMED[1]), 1))
    assert rows_of(held.release(_timed(spark, TIMED[1]), 1)) == first
    assert held.release(_timed(spark, TIMED[2]), 2).isEmpty()
    with pytest.raises(ValueError, match="lacks what batch"):
        held.release(_timed(spark, []), 5)


def test_a_cut_stream_scores_as_a_whole_one(spark, tmp_path):
    """Through the router: one start over all files, and a start for every file."""
    found = []
    for name, max_files in (("whole", None), ("cut", 1)):
        base = tmp_path / name
        router = silver.Router(
            *[silver.table_sink(str(base / n)) for n in ("silver", "alerts", "dead")],
            velocity=TrailingVelocity(str(base / "held"), seconds=3600),
        )
        path = str(base / "bronze")
        hours = [[(f"{h}-{i}", f"{12 + h}:{i * 7:02d}:00") for i in range(8)] for h in range(3)]
        for number, batch in enumerate(hours):
            rows = _bronze_rows(spark, batch, number * 100).coalesce(1)
            rows.write.mode("append").parquet(path)
            if max_files or number == 2:
                stream = table_stream(spark, path, S.BRONZE, max_files=max_files)
                for query in silver.score_stream(stream, router, str(base / "c"), available_now=True):
                    query.awaitTermination()
        waiting = table(spark, str(base / "silver")).count()
        assert waiting < 24 and router.drain(spark) == 24 - waiting
        router.drain(spark)  # replaces its own output
        rows = table(spark, str(base / "silver"))
        found.append(rows_of(rows.select("transaction_id", "risk_score", "event_time")))
    assert len(found[0]) == 24 and found[0] == found[1]


def test_alert_ids_over_restarts(spark, tmp_path):
    stored = spark.createDataFrame([(5 * LANES + 3,)], "alert_id long")
    nothing = spark.createDataFrame([], "alert_id long")
    given, number = set(), {}
    for batch_id in range(6):
        for stream in ("one", "two"):
            ids = AlertIds(spark, str(tmp_path / "ids"))  # as after a restart
            lane, first = ids.open(stream, batch_id, stored)
            assert ids.open(stream, batch_id, nothing)[0] == lane
            assert first == number.get(stream, 6)
            assert batch_id == 0 or ids.open(stream, batch_id, nothing) == (lane, first)
            new = {(first + i) * LANES + lane for i in range(3)}
            assert not new & given
            given |= new
            rows = spark.createDataFrame([(i,) for i in new], "alert_id long")
            number[stream] = following(rows, first)
            ids.close(stream, batch_id, lane, number[stream])
    assert max(given) < (6 + 6 * 3) * LANES and following(nothing, 9) == 9


def test_lanes_differ():
    lane = free_lane("a", set())
    assert free_lane("a", {lane}) == (lane + 1) % LANES


def test_each_payload_is_parsed_once(spark):
    rows = [(b"k", json.dumps({"transaction_id": "t", "amount": 5}).encode())]
    messages = spark.createDataFrame(rows, "key binary, value binary")
    bronze_rows = spark.createDataFrame([], S.BRONZE)
    checked = validate.validate(parse_payload(bronze_rows))
    for df in (
        validate.valid_rows(checked),
        silver.dead_letters(checked.withColumn("processed_at", F.current_timestamp())),
        extract_alerts(messages),
        rejected_alerts(messages),
    ):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1


def test_score_batches_of_a_table_out_of_order(spark, tmp_path):
    """Files of the table that each span the whole time: counts go on over the micro-batches."""
    start = datetime(2024, 1, 1)
    for user in (1, 2):
        rows = [
            (100 * user + n, start + timedelta(hours=n), user, "view", 1.0, "{}") for n in range(80)
        ]
        events = spark.createDataFrame(
            rows,
            "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
        )
        events.coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    scored = stream_jobs.silver_score_batches(spark, str(tmp_path)).collect()
    first = {}
    accounts = {r.account_id for r in scored}
    for account in accounts:
        first[account] = sorted(r.event_time for r in scored if r.account_id == account)[:2]
    assert len(accounts) == 2 and len(scored) > 150
    for r in scored:
        # from an account's third hour on there are three rows or more in six hours
        assert (r.risk_score > 0.5) == (r.event_time not in first[r.account_id])
