from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators import rules, validate
from riskloom.operators.bronze import parse_payload
from riskloom.plans import dataset as D

# value, night, category -> score, suspect, score with velocity, suspect with velocity
TRUTH = [
    ((0, 0, 0), 0.05, False, 0.55, False),
    ((0, 0, 1), 0.35, False, 0.85, True),
    ((0, 1, 0), 0.35, False, 0.85, True),
    ((0, 1, 1), 0.65, False, 1.00, True),
    ((1, 0, 0), 0.45, False, 0.95, True),
    ((1, 0, 1), 0.75, True, 1.00, True),
    ((1, 1, 0), 0.75, True, 1.00, True),
    ((1, 1, 1), 1.00, True, 1.00, True),
]


@pytest.fixture(scope="module")
def truth_rows(spark):
    data = []
    for i, ((value, night, category), *_) in enumerate(TRUTH):
        amount = 5000.01 if value else 5000.0
        time = "05:59:59" if night else "06:00:00"
        data.append((i, amount, "jewelry" if category else "CRYPTO", f"2024-01-01 {time}"))
    rows = spark.createDataFrame(data, "i int, amount double, merchant_category string, t string")
    return rows.withColumn("event_time", F.col("t").cast("timestamp"))


def test_truth_table(truth_rows):
    flagged = rules.flag(rules.score(truth_rows))
    for velocity in (False, True):
        result = rules.add_velocity(flagged, F.lit(velocity)).orderBy("i").collect()
        for row, (_, score, suspect, fast_score, fast_suspect) in zip(result, TRUTH, strict=True):
            assert float(row.risk_score) == (fast_score if velocity else score)
            assert row.is_fraud_suspect == (fast_suspect if velocity else suspect)
            assert (row.fraud_reason == S.REASON_CRITICAL) == row.is_fraud_suspect
            assert ("velocity" in row.rule_hits) == velocity


def test_reason_before_velocity(truth_rows):
    reasons = {r.fraud_reason for r in rules.flag(rules.score(truth_rows)).collect()}
    assert reasons == {None, S.REASON_HIGH}


def test_null_operands_add_nothing(spark):
    rows = spark.createDataFrame(
        [(None, None, None)], "amount double, merchant_category string, event_time timestamp"
    )
    row = rules.flag(rules.score(rows)).first()
    assert row.risk_score == Decimal("0.0500") and row.rule_hits == []
    assert row.is_fraud_suspect is False


def test_case_option(truth_rows):
    hits = rules.score(truth_rows, rules.default_rules(normalize_case=True))
    assert hits.filter(F.array_contains("rule_hits", "risky_category")).count() == len(TRUTH)


def test_own_rules_use_decimals(spark):
    rows = spark.range(1)
    thirds = [rules.Rule(str(i), F.lit(True), Decimal("0.1300")) for i in range(5)]
    row = rules.flag(rules.score(rows, thirds)).first()
    assert row.risk_score == Decimal("0.7000") and row.is_fraud_suspect


PAYLOADS = [
    ("not json", S.REASON_MISSING_ID),
    ("{bad", S.REASON_MISSING_ID),
    ("null", S.REASON_MISSING_ID),
    ("[]", S.REASON_MISSING_ID),
    (None, S.REASON_MISSING_ID),
    ('{"amount":5}', S.REASON_MISSING_ID),
    ('{"transaction_id":"b","amount":"x"}', S.REASON_MISSING_AMOUNT),
    ('{"transaction_id":"g","amount":"12.5"}', S.REASON_MISSING_AMOUNT),
    ('{"transaction_id":"d","amount":-1}', S.REASON_INVALID_AMOUNT),
    ('{"transaction_id":"z","amount":0}', S.REASON_INVALID_AMOUNT),
    ('{"transaction_id":"c","amount":NaN}', S.REASON_INVALID_AMOUNT),
    ('{"transaction_id":"e","amount":5,"event_time":"garbage"}', None),
    ('{"transaction_id":7,"amount":5,"extra":1}', None),
    (
        '{"transaction_id":"ok","amount":5.5,"currency":"USD",'
        '"event_time":"2024-01-01T03:00:00.123456+02:00"}',
        None,
    ),
]


@pytest.fixture(scope="module")
def parsed(spark):
    bronze = spark.createDataFrame(
        [(p, i, "2024-01-01") for i, (p, _) in enumerate(PAYLOADS)],
        "raw_payload string, kafka_offset bigint, ingestion_date string",
    )
    return parse_payload(bronze)


def test_reasons(parsed):
    result = validate.validate(parsed).orderBy("kafka_offset").collect()
    assert [r.dlq_reason for r in result] == [reason for _, reason in PAYLOADS]
    assert [r.is_valid for r in result] == [reason is None for _, reason in PAYLOADS]


def test_parsed_values(parsed):
    by_id = {r.transaction_id: r for r in parsed.collect()}
    assert by_id["7"].amount == 5.0
    assert by_id["e"].event_time is None
    assert str(by_id["ok"].event_time.replace(tzinfo=None)).endswith(".123456")


def test_nan_passes_when_asked_as_in_the_first_version(parsed):
    rows = validate.validate(parsed, nan_is_invalid=False)
    assert rows.filter("transaction_id = 'c'").first().is_valid


def test_strict_mode(parsed):
    rows = validate.validate(parsed, strict=True).filter("dlq_reason is not null")
    reasons = {r.transaction_id: r.dlq_reason for r in rows.collect()}
    assert reasons["e"] == S.REASON_MISSING_CURRENCY and "ok" not in reasons


def test_future_rows_are_quarantined_when_asked(spark):
    rows = spark.createDataFrame(
        [("a", "2024-01-01 23:30:00"), ("b", "2024-01-02 00:30:00"), ("c", "2024-01-02 02:00:00")],
        "transaction_id string, t string",
    ).selectExpr(
        "transaction_id", "5.0d as amount", "'USD' as currency",
        "cast(t as timestamp) as event_time", "'2024-01-01' as bronze_ingestion_date",
    )
    bad = validate.quarantined_rows(validate.validate(rows, max_ahead="1 hour")).collect()
    assert [(r.transaction_id, r.dlq_reason) for r in bad] == [("c", S.REASON_FUTURE_TIME)]


def test_currency_policy(spark):
    rows = spark.createDataFrame(
        [("a", "USD"), ("b", None), ("c", "XXX")], "transaction_id string, currency string"
    ).selectExpr("*", "1.0d as amount", "current_timestamp() as event_time")
    checked = validate.quarantine_currency(validate.validate(rows))
    assert {r.transaction_id for r in validate.valid_rows(checked).collect()} == {"a", "b"}
    bad = validate.quarantined_rows(checked).first()
    assert (bad.transaction_id, bad.dlq_reason) == ("c", S.REASON_INVALID_CURRENCY)


HISTOGRAMS = {
    "sf0.001": {0.05: 137, 0.35: 144, 0.45: 21, 0.55: 248, 0.65: 29,
                0.75: 20, 0.85: 239, 0.95: 28, 1.0: 112},
    "sf0.01": {0.05: 1339, 0.35: 1397, 0.45: 220, 0.55: 2463, 0.65: 291,
               0.75: 184, 0.85: 2450, 0.95: 401, 1.0: 1040},
}


@pytest.mark.parametrize("name", sorted(HISTOGRAMS))
def test_score_histogram(spark, sf_dir, name):
    from riskloom.operators.velocity import velocity_in_batch

    rows = D.tx(spark, sf_dir.replace("sf0.001", name))
    scored = velocity_in_batch(D.scored(D.valid(rows)), ["event_date"])
    counts = scored.groupBy("risk_score").count().collect()
    assert {float(r.risk_score): r["count"] for r in counts} == HISTOGRAMS[name]
