"""The registered queries as plain SQL over the given tables.

The first parts repeat the made-up values of ``dataset``; the rest states what each
operator must return.
"""

from __future__ import annotations

from riskloom import schemas as S


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


TX = """
tx as (
  select 'TX-' || event_id as transaction_id,
    'ACC-' || user_id as account_id,
    'CUST-' || user_id as customer_id,
    'MERCH-' || (event_id % 2200) as merchant_id,
    case event_type when 'purchase' then 'crypto' when 'signup' then 'gambling'
      else event_type end as merchant_category,
    case when event_id % 97 = 0 then null when event_id % 89 = 0 then -value
      else round(value * 50, 2) end as amount,
    case when event_id % 211 = 0 then 'XXX' when event_id % 307 = 0 then null
      when event_id % 4 = 0 then 'BRL' when event_id % 4 = 1 then 'USD'
      when event_id % 4 = 2 then 'EUR' else 'GBP' end as currency,
    case event_id % 5 when 0 then 'CREDIT_CARD' when 1 then 'DEBIT_CARD'
      when 2 then 'PIX' when 3 then 'PAYPAL' else 'CRYPTO' end as payment_method,
    ts as event_time, event_id as kafka_offset,
    ts + interval 5 second as processed_at
  from events)"""

BRONZE = """
docs as (select text, -1 - doc_id as kafka_offset from documents),
bronze as (
  select *, strftime(event_time + interval 5 second, '%Y-%m-%d') as bronze_ingestion_date,
    cast(null as varchar) as raw_md5 from tx
  union all by name
  select kafka_offset, '2024-01-31' as bronze_ingestion_date, md5(text) as raw_md5 from docs)"""


def _validated(source: str, currency: bool = False) -> str:
    bad = (
        f"when currency not in ({_list(S.CURRENCIES)}) then '{S.REASON_INVALID_CURRENCY}'"
        if currency
        else ""
    )
    return f"""
validated as (
  select *, cast(event_time as date) as event_day,
    case when transaction_id is null then '{S.REASON_MISSING_ID}'
      when amount is null then '{S.REASON_MISSING_AMOUNT}'
      when amount <= 0 then '{S.REASON_INVALID_AMOUNT}' {bad} end as dlq_reason
  from {source})"""


SCORED = f"""
scored as (
  select *, cast(round(least(0.05 + hv + nt + rc, 1.0), 4) as double) as score1
  from (
    select *, case when amount > 5000 then 0.4 else 0 end as hv,
      case when hour(event_time) between 0 and 5 then 0.3 else 0 end as nt,
      case when merchant_category in ({_list(S.RISKY_CATEGORIES)}) then 0.3 else 0 end as rc
    from validated where dlq_reason is null) v)"""

VELOCITY = f"""
counted as (
  select *, count(transaction_id) over (partition by account_id, event_day) >= 3 as velocity_hit
  from scored),
rescored as (
  select *, cast(round(least(score1 + case when velocity_hit then 0.5 else 0 end, 1.0), 4)
    as double) as risk_score
  from counted),
silver as (
  select *, risk_score >= 0.7 or score1 >= 0.7 as is_fraud_suspect,
    case when risk_score >= 0.7 then '{S.REASON_CRITICAL}'
      when score1 >= 0.7 then '{S.REASON_HIGH}' end as fraud_reason,
    cast(event_day as varchar) as event_date
  from rescored)"""

TRAILING_FRAME = """(partition by account_id order by event_time
    range between interval 6 hour preceding and current row)"""

ALERTS = """
alerts as (
  select kafka_offset + 1 as alert_id, transaction_id, account_id, customer_id,
    round(amount, 2) as amount, risk_score,
    case when risk_score < 0.9 then 'HIGH' else 'CRITICAL' end as risk_level, fraud_reason,
    case payment_method when 'CRYPTO' then 'APPROVED' when 'PAYPAL' then 'BLOCKED'
      else 'PENDING' end as status,
    cast(null as varchar) as operator_notes, event_time,
    processed_at as created_at, processed_at as updated_at
  from silver where is_fraud_suspect)"""

REPLAYED = """
replayed as (
  select * from {source}
  union all
  select * replace (-1 - kafka_offset as kafka_offset,
    processed_at + interval 1 hour as processed_at)
  from {source} where payment_method = 'PIX')"""

EXTRACTED = """
snapshots as (
  select * from (values (0, timestamp '2024-01-05'), (1, timestamp '2024-01-10'),
    (2, timestamp '2024-01-15'), (3, timestamp '2024-01-20')) as v(k, snapshot_at)),
extracted as (
  select * from customer, snapshots
  where not (c_acctbal < 0 and k < 2) and not (c_acctbal > 9000 and k = 3))"""

CUSTOMER_LOG = """
customer_log as (
  select 'CUST-' || c_custkey as customer_id, c_name || '-v' || k as full_name,
    'c' || c_custkey || case when c_mktsegment = 'BUILDING' and k >= 2
      then '@mail.example.org' else '@example.org' end as email,
    '55' || (c_custkey + 10000000) as phone,
    case (c_custkey * k) % 4 when 0 then 'LOW' when 1 then 'MEDIUM' when 2 then 'HIGH'
      else 'CRITICAL' end as risk_profile,
    case when c_mktsegment = 'FURNITURE' and k >= 2 then null else c_mktsegment end as city,
    'N' || c_nationkey as state, snapshot_at, k
  from extracted)"""

ACCOUNT_LOG = """
account_log as (
  select 'ACC-' || c_custkey as account_id, 'CUST-' || c_custkey as customer_id,
    case when c_mktsegment = 'MACHINERY' and k >= 1 then 'DEBIT' else 'CREDIT' end
      as account_type,
    round(abs(c_acctbal) + case when c_mktsegment = 'HOUSEHOLD' and k >= 2 then 500 else 0 end, 2)
      as credit_limit,
    case (c_custkey + k * c_nationkey) % 4 when 0 then 'ACTIVE' when 1 then 'SUSPENDED'
      when 2 then 'CLOSED' else 'BLOCKED' end as account_status, snapshot_at, k
  from extracted)"""


def _history(log: str, name: str, key: str, tracked, at: str, sk: str) -> str:
    same = " and ".join(f"{c} is not distinct from prior.{c}" for c in tracked)
    packed = ", ".join(f"{c} := {c}" for c in tracked)
    return f"""
{name}_changes as (
  select *, not (lag(1) over w is not null and {same}) as is_change
  from (select *, lag(struct_pack({packed})) over (partition by {key} order by {at}) as prior
        from {log}) l
  window w as (partition by {key} order by {at})),
{name} as (
  select md5({key} || cast({at} as varchar)) as {sk}, * exclude ({at}, prior, is_change),
    {at} as valid_from,
    lead({at}) over (partition by {key} order by {at}) as valid_to
  from {name}_changes where is_change)"""


def _customers(snapshots: str) -> str:
    log = f"(select * exclude (k) from customer_log where k in ({snapshots}))"
    tracked = S.CUSTOMER_TRACKED
    return _history(log, "customers", "customer_id", tracked, "snapshot_at", "customer_sk")


def _accounts(snapshots: str) -> str:
    log = f"(select * exclude (k) from account_log where k in ({snapshots}))"
    return _history(log, "accounts", "account_id", S.ACCOUNT_TRACKED, "snapshot_at", "account_sk")


def _backdated(name: str, key: str) -> str:
    return f"""
{name}_since as (
  select * replace (case when row_number() over (partition by {key} order by valid_from) = 1
    then timestamp '1900-01-01' else valid_from end as valid_from)
  from {name})"""


MERCHANTS = """
merchants as (
  select md5('MERCH-' || p_partkey) as merchant_sk, 'MERCH-' || p_partkey as merchant_id,
    p_name as merchant_name, lower(p_type) as category, p_brand as country,
    timestamp '2018-01-01' + to_days(p_size) as created_at
  from part)"""

DATES = """
dates as (
  select cast(strftime(d, '%Y%m%d') as integer) as date_sk, cast(d as date) as full_date,
    cast(day(d) as integer) as day, cast(month(d) as integer) as month,
    cast(year(d) as integer) as year, cast(dayofweek(d) as integer) as day_of_week,
    dayname(d) as day_name, dayofweek(d) in (0, 6) as is_weekend
  from (select unnest(generate_series(timestamp '2020-01-01', timestamp '2030-12-31',
    interval 1 day)) as d))"""

ACCEPTED = f"{TX},{_validated('tx', currency=True)}"
SILVER = f"{ACCEPTED},{SCORED},{VELOCITY}"
CUSTOMERS = f"{EXTRACTED},{CUSTOMER_LOG},{_customers('0, 1, 2, 3')}"
ACCOUNTS = f"{EXTRACTED},{ACCOUNT_LOG},{_accounts('0, 1, 2, 3')}"


def _fact(rows: str, snapshots: str) -> str:
    return f"""{EXTRACTED},{CUSTOMER_LOG},{ACCOUNT_LOG},
{_customers(snapshots)},{_accounts(snapshots)},{MERCHANTS},{DATES},
{_backdated('customers', 'customer_id')},{_backdated('accounts', 'account_id')},
first_rows as (
  select * from {rows} qualify row_number() over
    (partition by transaction_id order by processed_at nulls last, kafka_offset) = 1),
fact as (
  select md5(t.transaction_id) as transaction_sk, t.transaction_id, c.customer_sk, a.account_sk,
    m.merchant_sk, d.date_sk, round(t.amount, 2) as amount, t.currency, t.payment_method,
    t.risk_score, t.is_fraud_suspect, false as is_blocked_flag, t.fraud_reason, t.event_time,
    timestamp '2024-02-01' as inserted_at
  from first_rows t
  left join customers_since c on t.customer_id = c.customer_id and t.event_time >= c.valid_from
    and (t.event_time < c.valid_to or c.valid_to is null)
  left join accounts_since a on t.account_id = a.account_id and t.event_time >= a.valid_from
    and (t.event_time < a.valid_to or a.valid_to is null)
  left join merchants m on t.merchant_id = m.merchant_id
  left join dates d on cast(strftime(t.event_time, '%Y%m%d') as integer) = d.date_sk)"""


FACT = f"{SILVER},{REPLAYED.format(source='silver')},{_fact('replayed', '0, 1, 2, 3')}"
# The gold batch runs on the first and the third extract only.
GOLD = f"{SILVER},{_fact('silver', '0, 2')}"


def _check(table: str, check: str, column: str, count: str) -> str:
    return (
        f"select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name, "
        f"cast(n as bigint) as violations, n = 0 as passed from ({count}) c"
    )


def _nulls(name: str, source: str, *columns: str) -> list[str]:
    return [
        _check(name, "not_null", c, f"select count(*) n from {source} where {c} is null")
        for c in columns
    ]


def _unique(name: str, source: str, *columns: str) -> str:
    keys = ", ".join(columns)
    present = " and ".join(f"{c} is not null" for c in columns)
    return _check(
        name,
        "unique",
        keys,
        f"select count(*) n from (select 1 from {source} where {present} "
        f"group by {keys} having count(*) > 1)",
    )


def _accepted(name: str, source: str, column: str, values) -> str:
    return _check(
        name,
        "accepted_values",
        column,
        f"select count(*) n from {source} where {column} not in ({_list(values)})",
    )


def _refers(name: str, source: str, column: str, parent: str, parent_column: str) -> str:
    return _check(
        name,
        "relationships",
        column,
        f"select count(*) n from {source} x where {column} is not null and not exists "
        f"(select 1 from {parent} p where p.{parent_column} = x.{column})",
    )


def _union(parts: list[str]) -> str:
    return " union all ".join(parts)


FACT_CHECKS = [
    _unique("fact_transactions", "fact", "transaction_id"),
    *_nulls(
        "fact_transactions", "fact", "transaction_id", "merchant_sk", "date_sk", "amount",
        "currency", "is_fraud_suspect", "risk_score",
    ),
    _accepted("fact_transactions", "fact", "currency", S.CURRENCIES),
    _refers("fact_transactions", "fact", "merchant_sk", "merchants", "merchant_sk"),
    _refers("fact_transactions", "fact", "date_sk", "dates", "date_sk"),
]
CUSTOMER_CHECKS = [
    _unique("dim_customer", "customers", "customer_sk"),
    *_nulls("dim_customer", "customers", "customer_sk", "customer_id", "email", "risk_profile"),
    _accepted("dim_customer", "customers", "risk_profile", S.RISK_PROFILES),
]
ACCOUNT_CHECKS = [
    _unique("dim_account", "accounts", "account_sk"),
    *_nulls(
        "dim_account", "accounts", "account_sk", "account_id", "account_type", "account_status"
    ),
    _accepted("dim_account", "accounts", "account_status", S.ACCOUNT_STATUSES),
]
MERCHANT_CHECKS = [
    _unique("dim_merchant", "merchants", "merchant_id"),
    *_nulls("dim_merchant", "merchants", "merchant_id", "category"),
]
DATE_CHECKS = [
    _unique("dim_date", "dates", "date_sk"),
    *_nulls("dim_date", "dates", "date_sk", "full_date"),
]
CONSTRAINTS = [
    _unique("fact_transactions", "fact", "transaction_sk"),
    *_nulls(
        "fact_transactions", "fact", "transaction_sk", "transaction_id", "amount", "currency",
        "payment_method", "risk_score", "is_fraud_suspect", "event_time",
    ),
    _refers("fact_transactions", "fact", "customer_sk", "customers", "customer_sk"),
    _refers("fact_transactions", "fact", "account_sk", "accounts", "account_sk"),
    _refers("fact_transactions", "fact", "merchant_sk", "merchants", "merchant_sk"),
    _refers("fact_transactions", "fact", "date_sk", "dates", "date_sk"),
    _unique("dim_customer", "customers", "customer_sk"),
    *_nulls("dim_customer", "customers", "customer_sk", "customer_id", "valid_from"),
    _unique("dim_account", "accounts", "account_sk"),
    *_nulls("dim_account", "accounts", "account_sk", "account_id", "customer_id", "valid_from"),
    _unique("dim_merchant", "merchants", "merchant_sk"),
    _unique("dim_merchant", "merchants", "merchant_id"),
    *_nulls("dim_merchant", "merchants", "merchant_sk", "merchant_id"),
    _unique("dim_date", "dates", "date_sk"),
    *_nulls(
        "dim_date", "dates", "date_sk", "full_date", "day", "month", "year", "day_of_week",
        "day_name", "is_weekend",
    ),
    _unique("operational_alerts", "alerts", "alert_id"),
    _unique("operational_alerts", "alerts", "transaction_id"),
    *_nulls(
        "operational_alerts", "alerts", "alert_id", "transaction_id", "account_id",
        "customer_id", "amount", "risk_score", "risk_level", "fraud_reason", "event_time",
    ),
]


def _count(name: str, source: str) -> str:
    return (
        f"select '{name}' as table_name, 'row_count' as check_name, '' as column_name, "
        f"count(*) as violations, true as passed from {source}"
    )


def _conflicts(name: str, log: str, key: str) -> str:
    """Keys with several rows in the third extract."""
    rows = f"select 1 from {log} where k = 2 group by {key} having count(*) > 1"
    return _check(name, "conflicting_keys", key, f"select count(*) n from ({rows})")


ACTIONS = """
acts as (
  select transaction_id, status, 'first look' as operator_notes,
    event_time + interval 1 hour as acted_at
  from (select *, case payment_method when 'CREDIT_CARD' then 'APPROVED'
    when 'DEBIT_CARD' then 'BLOCKED' when 'PIX' then 'CLOSED' end as status from tx) s
  where status is not null
  union all
  select transaction_id, 'BLOCKED', 'second look', event_time + interval 2 hour
  from tx where merchant_category = 'crypto'
    and payment_method in ('CREDIT_CARD', 'DEBIT_CARD', 'PIX'))"""

PARSED = (
    "transaction_id, account_id, customer_id, merchant_id, merchant_category, amount, currency, "
    "payment_method, event_time, kafka_offset, bronze_ingestion_date"
)
LINE_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
FIRST_LINE = (
    "select * from lineitem qualify row_number() over "
    f"(partition by l_orderkey, l_linenumber order by {LINE_ORDER}) = 1"
)
FOLD_CUSTOMERS = f"with {CUSTOMERS} select * from customers"

ORACLE: dict[str, str] = {
    "bronze_envelope": """
        select cast(user_id as varchar) as kafka_key, props as raw_payload,
          'transactions' as kafka_topic, cast(event_id % 4 as integer) as kafka_partition,
          event_id as kafka_offset, ts as kafka_timestamp,
          ts + interval 5 second as ingestion_timestamp,
          strftime(ts + interval 5 second, '%Y-%m-%d') as ingestion_date
        from events""",
    "parse_json_props": """
        select event_id, cast(json_extract(props, '$.k') as integer) as k from events""",
    "parse_payload_rows": f"with {TX},{BRONZE} select {PARSED} from bronze",
    "validate_flags": f"""with {TX},{BRONZE},{_validated('bronze')}
        select kafka_offset, dlq_reason is null as is_valid from validated""",
    "validate_reasons": f"""with {TX},{BRONZE},{_validated('bronze')}
        select dlq_reason, count(*) as row_count from validated group by 1""",
    "valid_rows": f"""with {TX},{BRONZE},{_validated('bronze')}
        select {PARSED}, cast(event_day as varchar) as event_date
        from validated where dlq_reason is null""",
    "dlq_rows": f"""with {TX},{BRONZE},{_validated('bronze', currency=True)}
        select kafka_offset, transaction_id, amount, currency, bronze_ingestion_date, dlq_reason,
          raw_md5
        from validated where dlq_reason is not null""",
    "scan_silver": f"""with {SILVER}
        select transaction_id, account_id, amount, risk_score, event_date from silver""",
    "scalar_functions": f"""with {TX}
        select transaction_id, md5(transaction_id) as transaction_sk,
          cast(strftime(event_time, '%Y%m%d') as integer) as date_sk,
          cast(hour(event_time) as integer) as hour,
          cast(cast(event_time as date) as varchar) as event_date,
          strftime(event_time, '%Y-%m-%d') as day_text,
          cast(day(event_time) as integer) as day, cast(month(event_time) as integer) as month,
          cast(year(event_time) as integer) as year,
          cast(dayofweek(event_time) as integer) as day_of_week, dayname(event_time) as day_name,
          round(amount, 2) as amount, coalesce(currency, 'none') as currency,
          substring(transaction_id, 1, 12) as short_id,
          replace(payment_method, '_', ' ') as method_text,
          least(amount, 5000.0) as amount_capped
        from tx""",
    "rule_scores": f"""with {TX},{_validated('tx')},{SCORED}
        select transaction_id, score1 as risk_score,
          concat_ws(',', case when hv > 0 then 'high_value' end, case when nt > 0 then 'night' end,
            case when rc > 0 then 'risky_category' end) as rule_hits
        from scored""",
    "rule_flags": f"""with {TX},{_validated('tx')},{SCORED}
        select transaction_id, score1 as risk_score, score1 >= 0.7 as is_fraud_suspect,
          case when score1 >= 0.7 then '{S.REASON_HIGH}' end as fraud_reason
        from scored""",
    "velocity_in_batch": f"""with {TX},{_validated('tx')},{SCORED},{VELOCITY}
        select transaction_id, velocity_hit, risk_score, is_fraud_suspect, fraud_reason
        from silver""",
    "velocity_tumbling": f"""with {TX},{_validated('tx')}
        select account_id, time_bucket(interval 6 hour, event_time) as window_start,
          time_bucket(interval 6 hour, event_time) + interval 6 hour as window_end,
          count(transaction_id) as tx_count
        from validated where dlq_reason is null group by 1, 2, 3 having count(*) >= 2""",
    "velocity_trailing": f"""with {TX},{_validated('tx')}
        select transaction_id, account_id, event_time,
          count(transaction_id) over (partition by account_id order by event_time
            range between interval 6 hour preceding and current row) as tx_count
        from validated where dlq_reason is null""",
    "alerts_json": f"""with {SILVER}
        select transaction_id as key, account_id, amount, currency, risk_score, is_fraud_suspect,
          fraud_reason, event_time, event_date, kafka_offset
        from silver where is_fraud_suspect""",
    "alerts_extract": f"""with {SILVER}
        select transaction_id, account_id, customer_id, amount, risk_score,
          case when risk_score < 0.9 then 'HIGH' else 'CRITICAL' end as risk_level,
          fraud_reason, event_time
        from silver where is_fraud_suspect""",
    "dedup_first_row": f"""with {TX},{REPLAYED.format(source='tx')}
        select transaction_id, amount, currency, processed_at, kafka_offset from replayed
        qualify row_number() over (partition by transaction_id
          order by processed_at nulls last, kafka_offset) = 1""",
    "dedup_min_by": FIRST_LINE,
    "dedup_first_lineitem": FIRST_LINE,
    "dim_date": f"""with {TX},{DATES},
        used as (select cast(strftime(event_time, '%Y%m%d') as integer) as date_sk,
          count(*) as tx_count from tx group by 1)
        select d.* replace (cast(full_date as varchar) as full_date),
          coalesce(tx_count, 0) as tx_count
        from dates d left join used using (date_sk)""",
    "dim_merchant": f"with {MERCHANTS} select * from merchants",
    "scd2_apply_customer": FOLD_CUSTOMERS,
    "scd2_apply_account": f"with {ACCOUNTS} select * from accounts",
    "scd2_from_log_extracts": FOLD_CUSTOMERS,
    "scd2_from_log": f"""with order_log as (
          select o_custkey, o_orderdate, arg_max(o_orderstatus, o_orderkey) as o_orderstatus,
            arg_max(o_orderpriority, o_orderkey) as o_orderpriority, max(o_orderkey) as o_orderkey
          from orders group by 1, 2),
        {_history('order_log', 'order_versions', 'o_custkey',
                  ['o_orderstatus', 'o_orderpriority'], 'o_orderdate', 'version_sk')}
        select * from order_versions""",
    "scd2_backdate_customer": f"""with {CUSTOMERS},{_backdated('customers', 'customer_id')}
        select customer_sk, customer_id, valid_from, valid_to from customers_since""",
    "scd2_backdate_account": f"""with {ACCOUNTS},{_backdated('accounts', 'account_id')}
        select account_sk, account_id, valid_from, valid_to from accounts_since""",
    "fact_scd2_customer": f"""with {TX},{CUSTOMERS},{_backdated('customers', 'customer_id')}
        select t.transaction_id, t.customer_id, t.event_time, c.customer_sk from tx t
        left join customers_since c on t.customer_id = c.customer_id
          and t.event_time >= c.valid_from
          and (t.event_time < c.valid_to or c.valid_to is null)""",
    "fact_scd2_account": f"""with {TX},{ACCOUNTS}
        select t.transaction_id, t.account_id, t.event_time, a.account_sk from tx t
        left join accounts a on t.account_id = a.account_id and t.event_time >= a.valid_from
          and (t.event_time < a.valid_to or a.valid_to is null)""",
    "fact_merchant": f"""with {TX},{MERCHANTS}
        select t.transaction_id, t.merchant_id, m.merchant_sk
        from tx t left join merchants m using (merchant_id)""",
    "fact_date": f"""with {TX},{DATES}
        select t.transaction_id, t.event_time, d.date_sk from tx t
        left join dates d on cast(strftime(t.event_time, '%Y%m%d') as integer) = d.date_sk""",
    "fact_transactions": f"with {FACT} select * from fact",
    "fact_transactions_large": f"with {FACT} select * from fact",
    "gold_batch_summary": f"with {GOLD} "
    + _union(
        [
            *CUSTOMER_CHECKS,
            *ACCOUNT_CHECKS,
            *MERCHANT_CHECKS,
            *DATE_CHECKS,
            *FACT_CHECKS,
            _conflicts("raw_customers", "customer_log", "customer_id"),
            _conflicts("raw_accounts", "account_log", "account_id"),
            _count("dim_customer", "customers"),
            _count("dim_account", "accounts"),
            _count("dim_merchant", "merchants"),
            _count("dim_date", "dates"),
            _count("fact_transactions", "fact"),
        ]
    ),
    "check_asserts": f"with {TX} "
    + _union(
        [
            _check("transactions", "amount_positive", "amount",
                   "select count(*) n from tx where amount is null or amount <= 0"),
            _check("transactions", "currency_known", "currency",
                   f"select count(*) n from tx where currency not in ({_list(S.CURRENCIES)})"),
        ]
    ),
    "check_unique": f"with {TX},{REPLAYED.format(source='tx')} "
    + _union(
        [
            _unique("lineitem", "lineitem", "l_orderkey", "l_linenumber"),
            _unique("lineitem", "lineitem", "l_orderkey"),
            _unique("transactions", "replayed", "transaction_id"),
        ]
    ),
    "check_not_null": f"with {TX},{EXTRACTED},{CUSTOMER_LOG} "
    + _union(
        [
            *_nulls("transactions", "tx", "transaction_id", "amount", "currency", "event_time"),
            *_nulls("customers", "customer_log", "customer_id", "email", "risk_profile", "city"),
        ]
    ),
    "check_accepted_values": f"with {TX},{EXTRACTED},{CUSTOMER_LOG} "
    + _union(
        [
            _accepted("transactions", "tx", "currency", S.CURRENCIES),
            _accepted("transactions", "tx", "merchant_category", S.RISKY_CATEGORIES),
            _accepted("customers", "customer_log", "risk_profile", S.RISK_PROFILES),
        ]
    ),
    "check_relationships": f"with {TX},{MERCHANTS} "
    + _union(
        [
            _refers("transactions", "tx", "merchant_id", "merchants", "merchant_id"),
            _refers("lineitem", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ]
    ),
    "checks_constraints": f"with {FACT},{ALERTS} " + _union(CONSTRAINTS),
    "fraud_metrics": f"""with {SILVER}
        select count(*) as total_transactions,
          count(*) filter (where is_fraud_suspect) as total_suspected_fraud,
          cast(coalesce(sum(cast(amount as decimal(12, 2))) filter (where is_fraud_suspect), 0)
            as double) as total_fraud_amount,
          case when count(*) > 0
            then round(count(*) filter (where is_fraud_suspect) * 100 / count(*), 2)
            else 0.0 end as fraud_rate_percentage
        from silver""",
    "alerts_queue": f"""with {SILVER},{ALERTS}
        select * from alerts where status = 'PENDING'
        order by risk_score desc, event_time desc, transaction_id limit 50""",
    "alert_detail": f"""with {SILVER},{ALERTS}
        select * from alerts
        where transaction_id in (select transaction_id from tx where currency = 'USD')""",
    "risk_profile_history": f"""with {CUSTOMERS}
        select customer_id, full_name, email, risk_profile, valid_from, valid_to,
          valid_to is null as is_current
        from customers""",
    "customer_versions": f"""with {TX},{CUSTOMERS}
        select customer_id, full_name, email, risk_profile, valid_from, valid_to,
          valid_to is null as is_current,
          row_number() over (partition by customer_id order by valid_from desc) as version_rank
        from customers where customer_id in (select customer_id from tx where currency = 'USD')""",
    "scan_silver_days": f"""with {SILVER}
        select event_date, count(*) as tx_count,
          cast(sum(cast(amount as decimal(18, 2))) as double) as amount
        from silver where event_date >= '2024-01-10' and event_date < '2024-01-20'
        group by event_date""",
    "alerts_upsert_ignore": f"""with {SILVER},{ALERTS}
        select transaction_id, account_id, customer_id, amount, risk_score, risk_level,
          fraud_reason, 'PENDING' as status, cast(null as varchar) as operator_notes, event_time,
          timestamp '2024-02-01' as created_at, timestamp '2024-02-01' as updated_at
        from alerts
        where transaction_id not in
          (select transaction_id from silver where currency in ('USD', 'EUR'))""",
    "alerts_triage_apply": f"""with {SILVER},{ALERTS},{ACTIONS},
        latest as (
          select * from acts where status in ({_list(S.TRIAGE_STATUSES)})
          qualify row_number() over (partition by transaction_id order by acted_at desc) = 1)
        select a.* replace (coalesce(l.status, a.status) as status,
          l.operator_notes as operator_notes, coalesce(l.acted_at, a.updated_at) as updated_at)
        from alerts a left join latest l using (transaction_id)""",
    "triage_rejects": f"""with {TX},{ACTIONS}
        select transaction_id, status, operator_notes, acted_at from acts
        where status not in ({_list(S.TRIAGE_STATUSES)})""",
    "alerts_display": f"""with {SILVER},{ALERTS}
        select transaction_id, cast(round(risk_score * 100, 0) as integer) as score_percent,
          risk_level = 'CRITICAL' as is_critical, amount,
          substring(transaction_id, 1, 12) || '...' as short_id, customer_id, event_time,
          replace(replace(fraud_reason, ';', ' • '), '_', ' ') as reason_text
        from alerts""",
    "seed_csv_roundtrip": f"""with {EXTRACTED},{ACCOUNT_LOG}
        select * exclude (k, snapshot_at) from account_log where k = 2""",
    "stream_bronze_ingest": """
        select cast(user_id as varchar) as kafka_key, props as raw_payload,
          'transactions' as kafka_topic, cast(event_id % 4 as integer) as kafka_partition,
          event_id as kafka_offset, ts as kafka_timestamp,
          ts + interval 5 second as ingestion_timestamp,
          strftime(ts + interval 5 second, '%Y-%m-%d') as ingestion_date
        from events""",
    "stream_silver_score": f"""with {SILVER}
        select transaction_id, account_id, amount, currency, risk_score, is_fraud_suspect,
          fraud_reason, event_time, event_date
        from silver""",
    "stream_router_counts": f"""with {SILVER},{REPLAYED.format(source='validated')}
        select 'silver' as sink, count(*) as row_count from silver
        union all select 'alerts', count(*) from silver where is_fraud_suspect
        union all select 'dead_letters', count(*) from replayed
          where dlq_reason is not null""",
    "stream_dedup": f"""with {TX}
        select transaction_id, account_id, amount, event_time from tx""",
    "stream_velocity": f"""with {TX},
        bursts as (
          select account_id, time_bucket(interval 6 hour, event_time) as window_start,
            time_bucket(interval 6 hour, event_time) + interval 6 hour as window_end,
            count(transaction_id) as tx_count
          from tx group by 1, 2, 3 having count(*) >= 2)
        select * from bursts where window_end <=
          (select date_trunc('millisecond', max(event_time)) - interval 10 minute from tx)""",
    "stream_recovery": f"""with {TX}
        select transaction_id, account_id, amount, event_time from tx""",
    "stream_late_rows": f"""with {TX}
        select transaction_id, account_id, amount, event_time from tx
        where payment_method = 'PIX' and event_time <= (
          select date_trunc('millisecond', max(event_time)) - interval 10 minute from tx
          where payment_method <> 'PIX')""",
    "stream_late_sink": f"""with {TX},{_validated('tx', currency=True)},
        middle as (
          select min(event_time) + to_microseconds(
            (epoch_us(max(event_time)) - epoch_us(min(event_time))) // 2) as half from tx),
        parts as (
          select v.*, event_time < half and payment_method <> 'PIX' as early
          from validated v, middle where dlq_reason is null),
        passed as (
          select date_trunc('millisecond', max(event_time)) - interval 10 minute as bound
          from parts where early)
        select case when not early and event_time <= bound then 'late' else 'silver' end as sink,
          transaction_id, amount, payment_method, event_time, processed_at
        from parts, passed""",
    "stream_alert_upsert": f"""with {SILVER},{ALERTS}
        select transaction_id, account_id, customer_id, amount, risk_score, risk_level,
          fraud_reason, 'PENDING' as status, event_time,
          timestamp '2024-02-01' as created_at, timestamp '2024-02-01' as updated_at
        from alerts""",
    "stream_silver_score_batches": f"""with {TX},{_validated('tx', currency=True)},{SCORED},
        {VELOCITY.replace("(partition by account_id, event_day)", TRAILING_FRAME)}
        select transaction_id, account_id, amount, risk_score, risk_score >= 0.7 as is_fraud_suspect,
          case when risk_score >= 0.7 then '{S.REASON_CRITICAL}' end as fraud_reason,
          event_time, event_date
        from silver""",
    "stream_dead_letters": f"""with {TX},{_validated('tx', currency=True)},
        {REPLAYED.format(source='validated')}
        select kafka_offset, transaction_id, amount, currency, dlq_reason
        from replayed where dlq_reason is not null""",
    "stream_alert_restart": f"""with {SILVER},{ALERTS}
        select risk_level, count(*) as alert_count, count(*) as id_count,
          count(*) as transaction_count, true as ids_in_bounds
        from alerts where (alert_id - 1) % 7 <> 0 and (alert_id - 1) % 11 <> 0
        group by rollup (risk_level)""",
    "alerts_rejected": f"""with {SILVER},{ALERTS}
        select transaction_id,
          case when (alert_id - 1) % 7 <> 0 then customer_id end as customer_id,
          case when (alert_id - 1) % 7 = 0 then event_time end as event_time, risk_score
        from alerts where (alert_id - 1) % 7 = 0 or (alert_id - 1) % 11 = 0""",
}

_QUEUE = """status = 'PENDING'
        order by risk_score desc, event_time desc, transaction_id limit 50"""
ORACLE.update(
    {
        "stream_alert_restart_indexed": ORACLE["stream_alert_restart"],
        "fraud_metrics_kept": ORACLE["fraud_metrics"],
        "alerts_queue_kept": f"""select * from ({ORACLE["alerts_triage_apply"]}) where {_QUEUE}""",
        "check_unique_growing": f"with {TX},{REPLAYED.format(source='tx')} "
        + _union([_unique("transactions", "replayed", "transaction_id")]),
        "scd2_store_customer": FOLD_CUSTOMERS,
        "table_replace": """select seen, o_orderstatus, count(*) as order_count,
            cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
          from orders, (values ('before'), ('after')) as v(seen)
          where seen = 'before' or o_orderstatus <> 'O' group by 1, 2""",
    }
)
