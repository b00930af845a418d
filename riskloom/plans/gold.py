"""The daily batch: seeds, snapshots, models, checks, in that order."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import schemas as S
from riskloom.operators import checks
from riskloom.operators.dims import dim_date, dim_merchant
from riskloom.operators.fact import build_fact
from riskloom.operators.scd2 import conflicting_keys, first_versions, scd2_apply
from riskloom.sinks.versions import HistoryStore
from riskloom.sinks.writers import save_table
from riskloom.sources.readers import seed, table


@dataclass(frozen=True)
class GoldRun:
    """One run: reads the seeds and the previous run's history, writes ``base/run``.

    Each run has folders of its own, so a failed run is simply started again, and
    no table is replaced while something reads it. With a ``database`` its tables
    point to the latest run. With a folder ``histories`` the versioned dimensions are kept
    there in a ``HistoryStore``, which never writes closed versions again; ``previous`` is
    then not needed, and the catalog has no table of theirs.
    """

    base: str
    run: str
    snapshot_at: datetime | str
    seeds: str
    previous: str | None = None
    fmt: str = "parquet"
    close_missing: bool = False
    database: str | None = None
    histories: str | None = None

    def path(self, name: str, run: str | None = None) -> str:
        return f"{self.base}/{run or self.run}/{name}"


SNAPSHOT_KEYS = [
    ("raw_customers", S.RAW_CUSTOMERS, "customer_id"),
    ("raw_accounts", S.RAW_ACCOUNTS, "account_id"),
]

HISTORIES = {"dim_customer": S.DIM_CUSTOMER, "dim_account": S.DIM_ACCOUNT}


def run_gold_batch(
    spark: SparkSession,
    job: GoldRun,
    silver: DataFrame,
    loaded_at: Column | None = None,
    stop_on_failure: bool = True,
) -> DataFrame:
    """Run the batch; returns the check results with a row count per table, and with the
    number of keys whose extract rows differ."""

    def save(name: str, df: DataFrame) -> DataFrame:
        if job.database:
            save_table(df, name, job.database, fmt=job.fmt, path=job.path(name))
        else:
            df.write.format(job.fmt).mode("overwrite").save(job.path(name))
        return table(spark, job.path(name), job.fmt, df.schema)

    customers = _snapshot(
        spark, job, "dim_customer", S.RAW_CUSTOMERS, "customer_id", "customer_sk",
        S.CUSTOMER_TRACKED, save,
    )
    accounts = _snapshot(
        spark, job, "dim_account", S.RAW_ACCOUNTS, "account_id", "account_sk",
        S.ACCOUNT_TRACKED, save,
    )
    seeded = seed(spark, f"{job.seeds}/raw_merchants", S.RAW_MERCHANTS)
    merchants = save("dim_merchant", dim_merchant(save("raw_merchants", seeded)))
    dates = save("dim_date", dim_date(spark))
    fact = save(
        "fact_transactions", build_fact(silver, customers, accounts, merchants, dates, loaded_at)
    )

    declared = [
        ("dim_customer", customers, checks.customer_checks()),
        ("dim_account", accounts, checks.account_checks()),
        ("dim_merchant", merchants, checks.merchant_checks()),
        ("dim_date", dates, checks.date_checks()),
        ("fact_transactions", fact, checks.fact_checks(merchants, dates)),
    ]
    results = save(
        "check_results",
        reduce(DataFrame.unionByName, [checks.run_checks(df, t, c) for t, df, c in declared]),
    )
    if stop_on_failure:
        checks.require(results)
    counts = [_row_count(df, t) for t, df, _ in declared]
    counts += [_conflicts(spark, job, *c) for c in SNAPSHOT_KEYS]
    return reduce(DataFrame.unionByName, [results, *counts])


def _snapshot(spark, job, name, schema, key, sk, tracked, save) -> DataFrame:
    raw = name.replace("dim_", "raw_") + "s"
    extract = save(raw, seed(spark, f"{job.seeds}/{raw}", schema))
    if job.histories:
        store = HistoryStore(
            spark, f"{job.histories}/{name}", HISTORIES[name], key, tuple(tracked), sk,
            job.close_missing,
        )
        return store.apply(extract, job.snapshot_at, job.run)
    if job.previous is None:
        return save(name, first_versions(extract, key, sk, job.snapshot_at))
    history = table(spark, job.path(name, job.previous), job.fmt)
    return save(
        name, scd2_apply(history, extract, key, tracked, sk, job.snapshot_at, job.close_missing)
    )


def _conflicts(spark, job, raw: str, schema, key: str) -> DataFrame:
    """Keys of an extract with rows that differ; one of these was taken."""
    extract = table(spark, job.path(raw), job.fmt, schema)
    return conflicting_keys(extract, key).select(
        F.lit(raw).alias("table_name"),
        F.lit("conflicting_keys").alias("check_name"),
        F.lit(key).alias("column_name"),
        F.col("failures").alias("violations"),
        (F.col("failures") == 0).alias("passed"),
    )


def _row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("table_name"),
        F.lit("row_count").alias("check_name"),
        F.lit("").alias("column_name"),
        "violations",
        F.lit(True).alias("passed"),
    )
