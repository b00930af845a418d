"""Stores kept between runs: versions, histories, keys, totals and queues."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators import checks, scd2, serving
from riskloom.plans import dataset as D
from riskloom.plans.gold import GoldRun, run_gold_batch
from riskloom.plans.registry import _write_seeds
from riskloom.sinks.kept import KeptMetrics, KeptQueue
from riskloom.sinks.keyed import GrowingUnique, KeyStore
from riskloom.sinks.versions import HistoryStore, VersionedTable
from riskloom.sinks.writers import with_batch_header

from .conftest import rows_of

KEY = S.struct_of("transaction_id string")


def _ids(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], KEY)


def test_readers_keep_the_version_they_opened(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no version"):
        table.read()
    assert table.replace(spark.range(3)) == 0
    old = table.read()
    with pytest.raises(Exception, match="broken"):  # a run that fails leaves the old one
        table.replace(old.select(F.raise_error(F.lit("broken")).alias("id")))
    assert table.read().count() == 3
    assert table.replace(old.filter("id < 1")) == 1
    assert old.count() == 3 and table.read().count() == 1
    assert table.read(0).count() == 3


def _store(spark, path):
    return HistoryStore(
        spark, str(path), S.DIM_CUSTOMER, "customer_id", S.CUSTOMER_TRACKED, "customer_sk"
    )


def test_closed_versions_stay_where_they_are(spark, sf_dir, tmp_path):
    store = _store(spark, tmp_path)
    log = D.customer_log(spark, sf_dir).persist()
    history = None
    for number, at in enumerate(D.SNAPSHOTS):
        extract = D.extract(log, number)
        before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("data/*/part=closed/*.parquet")}
        store.apply(extract, at, at)
        if number == 2:  # started again
            store.apply(extract, at, at)
        assert all(p.stat().st_mtime_ns == t for p, t in before.items())
        if history is None:
            history = scd2.first_versions(extract, "customer_id", "customer_sk", at)
        else:
            history = scd2.scd2_apply(
                history, extract, "customer_id", S.CUSTOMER_TRACKED, "customer_sk", at
            )
        assert rows_of(store.history()) == rows_of(history.select(*S.DIM_CUSTOMER.fieldNames()))
    assert store.current().filter("valid_to is not null").count() == 0
    first = store.history(D.SNAPSHOTS[0])
    assert first.count() == D.extract(log, 0).count()
    with pytest.raises(ValueError, match="other runs followed"):
        store.apply(D.extract(log, 0), D.SNAPSHOTS[0], D.SNAPSHOTS[0])
    plan = store.current()._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "part#" in plan


def test_gold_run_with_kept_histories(spark, sf_dir, tmp_path):
    silver = D.silver(D.tx(spark, sf_dir)).drop("rule_hits")
    results = []
    for base, histories in (("whole", None), ("parted", str(tmp_path / "histories"))):
        before = None
        for number in (0, 2):
            job = GoldRun(
                str(tmp_path / base), f"d{number}", D.SNAPSHOTS[number],
                _write_seeds(spark, sf_dir, number), before, histories=histories,
            )
            out = run_gold_batch(spark, job, silver, D.loaded_at(), stop_on_failure=False)
            before = job.run
        results.append(rows_of(out))
    assert results[0] == results[1]


def test_keys_are_looked_up_in_their_buckets(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path), KEY, 16)
    store.create()
    for batch in range(4):
        rows = _ids(spark, *[f"t{i}" for i in range(batch * 10, batch * 10 + 20)], None, "hot")
        store.add(rows, batch)
        if batch == 1:
            store.add(rows, batch)  # a repeat
            store.compact()
            store.add(rows, batch)  # and one after it was compacted
        if batch == 2:
            store.merge_runs()
    found = {r.transaction_id: r.row_count for r in store.look_up(_ids(spark, "t5", "t15", "hot", "no", None)).collect()}
    assert found == {"t5": 1, "t15": 2, "hot": 4}
    but_one = store.look_up(_ids(spark, "t15", "t5"), without_batch=0)
    assert rows_of(but_one) == [("t15", 1)]
    assert store.totals().agg(F.sum("row_count")).first()[0] == 4 * 21
    plan = store.look_up(_ids(spark, "t5"))._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "bucket#" in plan
    assert store.look_up(_ids(spark)).count() == 0


def test_growing_unique_equals_the_full_check(spark, tmp_path):
    draw = random.Random(3)
    growing = GrowingUnique(KeyStore(spark, str(tmp_path), KEY, 8))
    seen = []
    for batch in range(4):
        rows = [f"k{draw.randrange(60)}" for _ in range(30)] + [None, "same", "same"]
        rows = [] if batch == 2 else rows
        seen += rows
        for _ in range(2 if batch == 3 else 1):
            growing.add(_ids(spark, *rows), batch)
        if batch == 1:
            growing.store.compact()
        whole = checks.run_checks(_ids(spark, *seen), "t", checks.unique("transaction_id"))
        assert rows_of(growing.result("t")) == rows_of(whole)


def test_kept_metrics_read_their_own_batch_alone(spark, sf_dir, tmp_path):
    rows = D.silver(D.tx(spark, sf_dir)).select(
        F.col("amount").cast(S.MONEY).alias("amount"), "is_fraud_suspect", "event_time", "kafka_offset"
    ).persist()
    kept = KeptMetrics(spark, str(tmp_path))
    for batch in (0, 1, 2, 1):
        kept.add(rows.filter(F.col("kafka_offset") % 3 == batch), batch)
    whole = serving.fraud_metrics(rows)
    assert [float(v) for v in kept.metrics().first()] == [float(v) for v in whole.first()]
    kept.add(rows.limit(0), 3)  # an empty batch
    assert [float(v) for v in kept.metrics().first()] == [float(v) for v in whole.first()]


@pytest.mark.parametrize("status", ["PENDING", "BLOCKED"])
@pytest.mark.parametrize("acted", ["false", "risk_score > 0.8", "true", "alert_id % 5 = 0"])
def test_kept_queue_equals_the_full_sort(spark, sf_dir, tmp_path, acted, status):
    alerts = D.alerts(D.silver(D.tx(spark, sf_dir))).withColumn(
        "status", F.when(F.col("alert_id") % 4 > 0, "PENDING").otherwise(F.col("status"))
    ).persist()
    kept = KeptQueue(spark, str(tmp_path), 5)
    for batch in (0, 1, 2, 3, 2):
        kept.add(alerts.filter(F.col("alert_id") % 4 == batch), batch)
    kept.add(alerts.limit(0), 4)
    actions = alerts.filter(acted).select(
        "transaction_id",
        F.when(F.col("alert_id") % 2 == 0, "BLOCKED").otherwise("APPROVED").alias("status"),
        F.lit("x").alias("operator_notes"),
        F.col("event_time").alias("acted_at"),
    )
    whole = serving.alerts_queue(serving.apply_triage(alerts, actions), status, 5)
    columns = S.OPERATIONAL_ALERTS.fieldNames()
    got = [tuple(r) for r in kept.first(actions, status).collect()]
    assert got == [tuple(r) for r in whole.select(*columns).collect()]


def test_messages_carry_their_batch(spark):
    sent = with_batch_header(spark.createDataFrame([("k", "v")], "key string, value string"), 7)
    assert sent.first().headers[0].key == "batch" and bytes(sent.first().headers[0].value) == b"7"
