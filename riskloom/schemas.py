"""Table schemas and the fixed values that results must agree on."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# These decide results and must stay exactly as they are.

CURRENCIES = ("USD", "EUR", "BRL", "GBP", "JPY", "CAD", "AUD")
RISKY_CATEGORIES = ("crypto", "jewelry", "gambling")
RISK_PROFILES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
ACCOUNT_STATUSES = ("ACTIVE", "SUSPENDED", "CLOSED", "BLOCKED")
TRIAGE_STATUSES = ("APPROVED", "BLOCKED")

REASON_MISSING_ID = "Schema Enforcement Failed: Missing transaction_id ou JSON malformado"
REASON_MISSING_AMOUNT = "Missing amount"
REASON_INVALID_AMOUNT = "Invalid amount (negative or zero)"
REASON_HIGH = "High Risk: Consolidated score exceeded threshold (>= 70%)"
REASON_CRITICAL = "Critical Risk: Velocity or Consolidated Score exceeded threshold"
REASON_DEFAULT_ALERT = "Score exceeded threshold"

BASE_WEIGHT = Decimal("0.05")
VALUE_WEIGHT = Decimal("0.40")
NIGHT_WEIGHT = Decimal("0.30")
CATEGORY_WEIGHT = Decimal("0.30")
VELOCITY_WEIGHT = Decimal("0.50")
SCORE_CAP = Decimal("1.0")
SUSPECT_THRESHOLD = Decimal("0.70")
CRITICAL_LEVEL = Decimal("0.90")
HIGH_VALUE = 5000
NIGHT_HOURS = (0, 5)
VELOCITY_COUNT = 3
WATERMARK = "10 minutes"
FIRST_VERSION_FROM = datetime(1900, 1, 1)
CALENDAR = ("2020-01-01", "2030-12-31")

# Reasons of the currency check and of the optional checks.
REASON_INVALID_CURRENCY = "Invalid currency"
REASON_MISSING_CURRENCY = "Missing currency"
REASON_MISSING_TIME = "Missing event_time"
REASON_FUTURE_TIME = "Event time too far in the future"

MONEY = T.DecimalType(12, 2)
SCORE = T.DecimalType(5, 4)


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "money": MONEY,
    "score": SCORE,
}


def struct_of(fields: str) -> T.StructType:
    """A schema from ``"name type, ..."``; needs no session, unlike a DDL string."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PAYLOAD = struct_of(
    "transaction_id string, account_id string, customer_id string, merchant_id string, "
    "merchant_category string, amount double, currency string, payment_method string, "
    "device_id string, ip_address string, region string, event_time timestamp"
)

BRONZE = struct_of(
    "kafka_key string, raw_payload string, kafka_topic string, kafka_partition int, "
    "kafka_offset bigint, kafka_timestamp timestamp, ingestion_timestamp timestamp, "
    "ingestion_date string"
)

SILVER = T.StructType(
    PAYLOAD.fields
    + struct_of(
        "kafka_offset bigint, bronze_ingestion_date string, risk_score double, "
        "is_fraud_suspect boolean, fraud_reason string, processed_at timestamp, "
        "event_date date"
    ).fields
)

DEAD_LETTERS = T.StructType(
    struct_of("raw_payload string").fields
    + [f for f in SILVER.fields if f.name != "event_date"]
    + struct_of("is_valid boolean, dlq_reason string").fields
)

ALERT_MESSAGE = struct_of(
    "transaction_id string, account_id string, customer_id string, amount double, "
    "risk_score double, risk_level string, fraud_reason string, event_time timestamp"
)

OPERATIONAL_ALERTS = struct_of(
    "alert_id bigint, transaction_id string, account_id string, customer_id string, "
    "amount money, risk_score score, risk_level string, "
    "fraud_reason string, status string, operator_notes string, event_time timestamp, "
    "created_at timestamp, updated_at timestamp"
)

RAW_CUSTOMERS = struct_of(
    "customer_id string, full_name string, email string, phone string, "
    "risk_profile string, city string, state string"
)

RAW_ACCOUNTS = struct_of(
    "account_id string, customer_id string, account_type string, "
    "credit_limit money, account_status string"
)

RAW_MERCHANTS = struct_of(
    "merchant_id string, merchant_name string, category string, country string, "
    "created_at string"
)

CUSTOMER_TRACKED = ("risk_profile", "city", "state", "phone", "email")
ACCOUNT_TRACKED = ("credit_limit", "account_status")

DIM_CUSTOMER = T.StructType(
    struct_of("customer_sk string").fields
    + RAW_CUSTOMERS.fields
    + struct_of("valid_from timestamp, valid_to timestamp").fields
)

DIM_ACCOUNT = T.StructType(
    struct_of("account_sk string").fields
    + RAW_ACCOUNTS.fields
    + struct_of("valid_from timestamp, valid_to timestamp").fields
)
