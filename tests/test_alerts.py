import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators import alerts, checks, serving

from .conftest import rows_of

AT = datetime(2024, 1, 1, 12)


def _messages(spark, payloads):
    return spark.createDataFrame(
        [(p.get("transaction_id"), json.dumps(p), i) for i, p in enumerate(payloads)],
        "key string, value string, offset int",
    )


PAYLOADS = [
    {"transaction_id": "a", "account_id": "A", "customer_id": "C", "amount": 6000.125,
     "risk_score": 0.85, "fraud_reason": "why", "event_time": "2024-01-01T12:00:00.000Z"},
    {"transaction_id": "b", "account_id": "A", "customer_id": "C", "amount": 1.0,
     "risk_score": 0.9, "event_time": "2024-01-01T14:00:00.123456+02:00"},
    {"transaction_id": "c", "account_id": "A", "customer_id": "C", "amount": 2.0,
     "risk_score": 1.0, "risk_level": "LOW", "event_time": "2024-01-01T12:00:00Z"},
    {"transaction_id": "d"},
    {"risk_score": 0.8},
]


def test_extract_defaults(spark):
    extracted = alerts.extract_alerts(_messages(spark, PAYLOADS)).collect()
    rows = {r.transaction_id: r for r in extracted}
    assert set(rows) == {"a", "b", "c"}
    assert (rows["a"].risk_level, rows["a"].fraud_reason) == ("HIGH", "why")
    assert (rows["b"].risk_level, rows["b"].fraud_reason) == ("CRITICAL", S.REASON_DEFAULT_ALERT)
    assert rows["c"].risk_level == "LOW"
    assert rows["b"].event_time.microsecond == 123456
    rejected = alerts.rejected_alerts(_messages(spark, PAYLOADS))
    assert {r.offset for r in rejected.collect()} == {3, 4}


def test_event_times_in_any_iso_form(spark):
    times = ["T12:00:00Z", "T12:00:00+00:00", "T12:00:00", "T14:00:00.000+02:00", "T12:00:00.0Z"]
    payloads = [{**PAYLOADS[0], "transaction_id": t, "event_time": f"2024-01-01{t}"} for t in times]
    rows = alerts.extract_alerts(_messages(spark, payloads)).collect()
    assert len(rows) == len(times) and len({r.event_time for r in rows}) == 1


def test_what_lacks_a_required_column_is_rejected(spark):
    payloads = [
        {k: v for k, v in PAYLOADS[0].items() if k != name}
        for name in ("transaction_id", "account_id", "customer_id", "amount", "risk_score", "event_time")
    ]
    payloads.append({**PAYLOADS[0], "event_time": "soon"})
    messages = _messages(spark, payloads)
    assert alerts.extract_alerts(messages).isEmpty()
    assert alerts.rejected_alerts(messages).count() == len(payloads)


def test_insert_if_absent(spark):
    none = spark.createDataFrame([], S.OPERATIONAL_ALERTS)
    incoming = alerts.extract_alerts(_messages(spark, PAYLOADS[:2] * 3))
    first = alerts.new_alerts(none, incoming, F.lit(AT), ["offset"])
    assert first.schema.simpleString() == S.OPERATIONAL_ALERTS.simpleString()
    rows = first.collect()
    assert len({r.alert_id for r in rows}) == 2 and min(r.alert_id for r in rows) >= 1
    assert {(r.status, r.operator_notes) for r in rows} == {("PENDING", None)}
    assert {r.amount for r in rows} == {Decimal("6000.13"), Decimal("1.00")}
    later = alerts.new_alerts(
        first, alerts.extract_alerts(_messages(spark, PAYLOADS[:3])), F.lit(AT), ["offset"]
    )
    third = later.collect()
    assert [r.transaction_id for r in third] == ["c"]
    assert third[0].alert_id > max(r.alert_id for r in rows)


def test_numbers_are_unique_and_repeat(spark):
    rows = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("k"))
    numbered = alerts.number_rows(rows, "k", "n", after=100)
    got = [r.n for r in numbered.collect()]
    assert len(set(got)) == 5000 and min(got) > 100
    assert max(got) < 100 + 5000 + 20 * alerts.ID_BUCKETS
    again = alerts.number_rows(rows.repartition(7), "k", "n", after=100)
    assert rows_of(again) == rows_of(numbered)


@pytest.fixture(scope="module")
def stored(spark):
    rows = [
        (i, f"t{i}", "A", "C", Decimal("10.00"), Decimal(score), "HIGH", "a;b_c", status, None,
         AT, AT, AT)
        for i, score, status in [
            (1, "0.8500", "PENDING"), (2, "0.9500", "PENDING"), (3, "0.8500", "APPROVED"),
        ]
    ]
    return spark.createDataFrame(rows, S.OPERATIONAL_ALERTS)


def test_queue_and_detail(stored):
    assert [r.alert_id for r in serving.alerts_queue(stored).collect()] == [2, 1]
    assert [r.alert_id for r in serving.alerts_queue(stored, "APPROVED").collect()] == [3]
    assert [r.alert_id for r in serving.alerts_queue(stored, limit=1).collect()] == [2]
    assert serving.alert_detail(stored, "t3").first().status == "APPROVED"
    assert serving.alert_detail(stored, "none").isEmpty()


def test_queue_is_a_top_k(stored, capsys):
    serving.alerts_queue(stored).explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_triage(spark, stored):
    actions = spark.createDataFrame(
        [
            ("t1", "APPROVED", "ok", datetime(2024, 1, 2)),
            ("t1", "BLOCKED", "no", datetime(2024, 1, 3)),
            ("t2", "CLOSED", "?", datetime(2024, 1, 2)),
            ("t9", "BLOCKED", "?", datetime(2024, 1, 2)),
            ("t2", None, "?", datetime(2024, 1, 2)),
        ],
        "transaction_id string, status string, operator_notes string, acted_at timestamp",
    )
    after = {r.transaction_id: r for r in serving.apply_triage(stored, actions).collect()}
    assert (after["t1"].status, after["t1"].operator_notes) == ("BLOCKED", "no")
    assert after["t1"].updated_at == datetime(2024, 1, 3)
    assert after["t2"].status == "PENDING" and after["t3"].status == "APPROVED"
    assert [r.transaction_id for r in serving.triaged_rows(stored, actions).collect()] == ["t1"]
    assert serving.rejected_actions(actions).count() == 2


def test_display(stored):
    row = serving.display_rows(stored).filter("transaction_id = 't2'").first()
    assert (row.score_percent, row.reason_text, row.is_critical) == (95, "a • b c", False)


def test_metrics_of_an_empty_fact(spark):
    empty = spark.createDataFrame([], "amount decimal(12,2), is_fraud_suspect boolean")
    row = serving.fraud_metrics(empty).first()
    assert (row.total_transactions, row.total_suspected_fraud) == (0, 0)
    assert float(row.total_fraud_amount) == 0.0 and row.fraud_rate_percentage == 0.0


def test_history_of_one_customer(spark, sf_dir):
    from riskloom.plans import dataset as D

    rows = serving.risk_history(D.customer_history(spark, sf_dir), "CUST-1").collect()
    assert [r.is_current for r in rows] == [True] + [False] * (len(rows) - 1)
    assert [r.valid_from for r in rows] == sorted((r.valid_from for r in rows), reverse=True)


def test_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    rows = spark.createDataFrame(
        [(1, "USD", 1), (1, "XXX", 3), (None, None, 3), (None, "EUR", None)],
        "k int, currency string, ref int",
    )
    results = checks.run_checks(
        rows,
        "t",
        [
            *checks.not_null("k", "currency"),
            *checks.accepted_values("currency", S.CURRENCIES),
            *checks.unique("k"),
            *checks.refers_to("ref", parent, "id"),
        ],
    ).collect()
    found = {(r.check_name, r.column_name): (r.violations, r.passed) for r in results}
    assert found == {
        ("not_null", "k"): (2, False),
        ("not_null", "currency"): (1, False),
        ("accepted_values", "currency"): (1, False),
        ("unique", "k"): (1, False),
        ("relationships", "ref"): (2, False),
    }


def test_require_stops_on_failure(spark):
    rows = spark.createDataFrame([(1, "USD")], "amount int, currency string")
    checks.require(checks.run_checks(rows, "silver", checks.batch_asserts()))
    bad = rows.withColumn("amount", F.lit(-1))
    with pytest.raises(checks.CheckFailed, match="silver.amount"):
        checks.require(checks.run_checks(bad, "silver", checks.batch_asserts()))
