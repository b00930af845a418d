import pytest

from riskloom import schemas as S
from riskloom.operators.checks import CheckFailed
from riskloom.plans import dataset as D
from riskloom.plans.gold import GoldRun, run_gold_batch
from riskloom.plans.registry import _write_seeds
from riskloom.session import settings, shared_folder, written
from riskloom.sinks import writers
from riskloom.sources import readers

from .conftest import rows_of


def test_two_gold_runs(spark, sf_dir, tmp_path):
    silver = D.silver(D.tx(spark, sf_dir)).drop("rule_hits")
    first = GoldRun(str(tmp_path), "d1", D.SNAPSHOTS[0], _write_seeds(spark, sf_dir, 0))
    with pytest.raises(CheckFailed, match="fact_transactions"):
        run_gold_batch(spark, first, silver)
    second = GoldRun(
        str(tmp_path), "d2", D.SNAPSHOTS[1], _write_seeds(spark, sf_dir, 1), "d1",
        database="gold_run",
    )
    for _ in range(2):  # a run started again gives the same tables
        run_gold_batch(spark, second, silver, stop_on_failure=False)
    history = readers.table(spark, second.path("dim_customer"))
    log = D.customer_log(spark, sf_dir).filter(
        f"snapshot_at in (timestamp '{D.SNAPSHOTS[0]}', timestamp '{D.SNAPSHOTS[1]}')"
    )
    from riskloom.operators.scd2 import scd2_from_log

    expected = scd2_from_log(
        log, "customer_id", S.CUSTOMER_TRACKED, "snapshot_at", "customer_sk"
    )
    assert rows_of(history.select(*expected.columns)) == rows_of(expected)
    fact = readers.table(spark, second.path("fact_transactions"))
    assert fact.count() == spark.table("gold_run.fact_transactions").count() == silver.count()


def test_seed_types(spark, tmp_path):
    path = tmp_path / "raw_accounts.csv"
    path.write_text(
        "account_id,customer_id,account_type,credit_limit,account_status\n"
        "ACC-1,CUST-1,CREDIT,1000.00,ACTIVE\n"
    )
    row = readers.seed(spark, str(path), S.RAW_ACCOUNTS).first()
    assert str(row.credit_limit) == "1000.00"


def test_table_in_a_named_database(spark):
    name = writers.save_table(spark.range(3), "t", " gold_test ", "other")
    assert name == "gold_test.t"
    writers.save_table(spark.range(5), "t", "gold_test")
    assert spark.table(name).count() == 5
    assert writers.database_for(None, "other") == "other"


def test_topic_options():
    options = readers.topic_options("host:1", "transactions", maxOffsetsPerTrigger="10")
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "10"


def test_jdbc_options():
    assert readers.jdbc_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t"}
    options = readers.jdbc_options("jdbc:x", "t", "kafka_offset", 0, 100, 8, user="u")
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "kafka_offset"


def test_delta_batches_are_known_by_path_and_id():
    assert writers.delta_batch("/t", 7) == {"txnAppId": "riskloom:/t", "txnVersion": "8"}


def test_shared_folder_and_settings(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = written(spark.range(4), "ids")
    assert kept.count() == 4
    assert kept.inputFiles()[0].startswith(f"file://{shared_folder(spark)}")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "riskloom.test": "x"}):
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false"
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
    assert spark.conf.get("riskloom.test", None) is None


def test_a_day_filter_prunes_folders(spark, sf_dir):
    from riskloom.plans.registry import QUERIES

    plan = QUERIES["scan_silver_days"](spark, sf_dir)._jdf.queryExecution().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters: [" in line]
    assert any("event_date" in line.split("PartitionFilters: [")[1].split("]")[0] for line in filters)
