"""The keys of a growing table, kept so that a look-up reads only where they can be.

New keys lie in a small folder for each batch, which is read whole. ``compact`` moves them
into hash buckets. A look-up reads the new ones and the buckets of the keys it is asked
for; all other files are pruned by their folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.schemas import struct_of
from riskloom.sinks.versions import VersionLog, new_folder
from riskloom.sinks.writers import batch_key, running_stream, save_partitioned

BUCKETS = 1024


@dataclass(frozen=True)
class KeyStore:
    """Keys with their number of rows in each batch. ``keys`` are the key columns' fields.

    A batch that is repeated counts once, also when it was compacted in between.
    """

    spark: SparkSession
    path: str
    keys: T.StructType
    buckets: int = BUCKETS

    @property
    def names(self) -> list[str]:
        return self.keys.fieldNames()

    @property
    def log(self) -> VersionLog:
        return VersionLog(self.spark, f"{self.path}/log")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.names), F.lit(self.buckets)).cast("int")

    def exists(self) -> bool:
        return bool(self.log.lines())

    def create(self, rows: DataFrame | None = None) -> None:
        """Start with the keys of ``rows``, which have a ``batch_id``; none by default."""
        if rows is None:
            rows = self.spark.createDataFrame([], T.StructType([*self.keys.fields, _BATCH]))
        counts = rows.dropna(subset=self.names).groupBy(*self.names, "batch_id").agg(
            F.count(F.lit(1)).alias("row_count")
        )
        self._add_run(counts)

    def add(self, rows: DataFrame, batch_id: int, stream: str | None = None) -> None:
        """Add a batch's keys; NULL keys are left out. A repeat replaces the batch."""
        counts = self.counted(rows).coalesce(1)
        counts.write.mode("overwrite").parquet(
            f"{self._recent()}/batch_id={self.batch(batch_id, stream)}"
        )

    def counted(self, rows: DataFrame) -> DataFrame:
        return (
            rows.dropna(subset=self.names)
            .groupBy(*self.names)
            .agg(F.count(F.lit(1)).alias("row_count"))
        )

    def batch(self, batch_id: int, stream: str | None = None) -> int:
        return batch_key(running_stream(self.spark) if stream is None else stream, batch_id)

    def look_up(self, keys: DataFrame, without_batch: int | None = None) -> DataFrame:
        """Rows of each of ``keys`` that is stored, in all batches but one, with ``row_count``.

        The buckets asked for come to the driver: at most ``buckets`` numbers.
        """
        asked = keys.select(*self.names).dropna().distinct()
        touched = [r[0] for r in asked.select(self.bucket()).distinct().collect()]
        stored = self._recent_rows().unionByName(
            self._compacted().filter(F.col("bucket").isin(touched)).drop("bucket")
        )
        if without_batch is not None:
            stored = stored.filter(F.col("batch_id") != without_batch)
        wanted = stored.join(asked, self.names, "left_semi")
        return _summed(wanted, self.names)

    def totals(self) -> DataFrame:
        """All keys with their number of rows."""
        rows = self._recent_rows().unionByName(self._compacted().drop("bucket"))
        return _summed(rows, self.names)

    def compact(self) -> None:
        """Move the batches' folders into the buckets, between two batches of the writer."""
        self._add_run(self._recent_rows())

    def merge_runs(self) -> None:
        """Rewrite all as one run: bucket by bucket, with one file or few in each."""
        rows = self._compacted().drop("bucket").unionByName(self._recent_rows())
        once = rows.groupBy(*self.names, "batch_id").agg(F.max("row_count").alias("row_count"))
        self._add_run(once, "whole")

    def _add_run(self, counts: DataFrame, label: str = "") -> None:
        folder = new_folder()
        rows = counts.withColumn("bucket", self.bucket())
        save_partitioned(rows, f"{self.path}/buckets/{folder}", partition_by=["bucket"])
        self.log.publish(folder, label)

    def _runs(self) -> list:
        """Lines from the last whole rewrite on."""
        lines = self.log.lines()
        whole = [n for n, line in enumerate(lines) if line.label == "whole"]
        return lines[whole[-1] :] if whole else lines

    def _recent(self) -> str:
        # each compaction opens a new folder for the batches that follow it
        lines = self.log.lines()
        if not lines:
            raise ValueError(f"{self.path}: create the store first")
        return f"{self.path}/recent/{lines[-1].folder}"

    def _recent_rows(self) -> DataFrame:
        schema = self._stored()
        path = self._recent()
        # an empty batch makes the folder readable from the start
        self.spark.createDataFrame([], self._stored(batch=False)).write.mode("ignore").parquet(
            f"{path}/batch_id=-1"
        )
        return self.spark.read.schema(schema).parquet(path).select(*schema.fieldNames())

    def _compacted(self) -> DataFrame:
        schema = T.StructType([*self._stored().fields, *struct_of("run string, bucket int").fields])
        base = f"{self.path}/buckets"
        rows = self.spark.read.schema(schema).option("basePath", base)
        return rows.parquet(*[f"{base}/{line.folder}" for line in self._runs()]).drop("run")

    def _stored(self, batch: bool = True) -> T.StructType:
        count = T.StructField("row_count", T.LongType())
        return T.StructType([*self.keys.fields, *([_BATCH] if batch else []), count])


_BATCH = T.StructField("batch_id", T.LongType())


def _summed(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    # a repeated batch may lie both in a bucket and among the new ones
    once = rows.groupBy(*names, "batch_id").agg(F.max("row_count").alias("row_count"))
    return once.groupBy(*names).agg(F.sum("row_count").alias("row_count"))


@dataclass(frozen=True)
class GrowingUnique:
    """The unique check of a table that grows by batches: a batch reads its own rows and
    the buckets of its keys, and the number of keys found twice is kept for each batch."""

    store: KeyStore

    @property
    def path(self) -> str:
        return f"{self.store.path}/found"

    def add(self, rows: DataFrame, batch_id: int, stream: str | None = None) -> None:
        """Check a batch. Batches come in order; only the last one may be repeated."""
        store, names = self.store, self.store.names
        if not store.exists():
            store.create()
        own = store.counted(rows).persist()
        try:
            before = store.look_up(own, store.batch(batch_id, stream)).withColumnRenamed(
                "row_count", "earlier"
            )
            both = own.join(before, names, "left").fillna(0, ["earlier"])
            new = both.filter((F.col("earlier") <= 1) & (F.col("earlier") + F.col("row_count") > 1))
            new.agg(F.count(F.lit(1)).alias("violations")).coalesce(1).write.mode(
                "overwrite"
            ).parquet(f"{self.path}/batch_id={store.batch(batch_id, stream)}")
            store.add(rows, batch_id, stream)
        finally:
            own.unpersist()

    def result(self, table: str) -> DataFrame:
        """The line that ``checks.run_checks`` gives for the whole table."""
        found = self.store.spark.read.schema(
            struct_of("violations bigint, batch_id bigint")
        ).parquet(self.path)
        total = found.agg(F.coalesce(F.sum("violations"), F.lit(0)).alias("violations"))
        return total.select(
            F.lit(table).alias("table_name"),
            F.lit("unique").alias("check_name"),
            F.lit(", ".join(self.store.names)).alias("column_name"),
            "violations",
            (F.col("violations") == 0).alias("passed"),
        )
