"""Session settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Hours, days and date keys are all read in UTC. Where every partition of a join's
# small side is seen to be under the given size, a hash join saves sorting the large one.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

# A stream turns adaptive execution off to keep its state partitions; the static
# batch a foreachBatch function gets has no state and wants it back.
ADAPTIVE_CONF = {n: v for n, v in RUNTIME_CONF.items() if n.startswith("spark.sql.adaptive")}

# Spark deletes the shuffle files of an action when it ends; a plan that runs once needs them
# no longer. A plan that does run again makes them anew.
FREED_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Partitions of a new checkpoint's state; by default those of shuffles.
STATE_PARTITIONS = "spark.riskloom.statePartitions"
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Session for a job; master, packages and credentials come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set runtime settings for a while, then put the earlier ones back."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def state_settings(spark: SparkSession) -> dict[str, str]:
    """Settings to start a stateful stream with.

    State is kept in RocksDB, outside the JVM heap. Each state partition is a store of
    its own and stays for the life of the checkpoint, so their number is a setting and
    does not follow the cores that happen to be there at the first start.
    """
    wanted = spark.conf.get(STATE_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    return {**STATE_STORE_CONF, "spark.sql.shuffle.partitions": wanted}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else built."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


@lru_cache(maxsize=1)
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="riskloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only a local session may go without it; a machine-local folder on a cluster
    would lose its files with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_base()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own for each call; earlier results stay readable."""
    return f"{shared_folder(spark)}/riskloom/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives executor loss, and gives later joins true sizes. What was
    shuffled for it is deleted.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with settings(spark, FREED_CONF):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
