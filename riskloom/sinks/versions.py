"""Tables whose readers see a whole version or the one before it, never a half-written one.

Rows go to a folder of their own. Then one line, a single small file that appears by a
rename, says which folder holds the version. A run that fails leaves a folder without a
line, which no reader looks at. One writer at a time, as with any overwrite.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.scd2 import changed_versions, first_versions
from riskloom.schemas import struct_of

LINE = struct_of("version bigint, folder string, label string")


@dataclass(frozen=True)
class VersionLog:
    """The lines of one table: one for each run, so they are few."""

    spark: SparkSession
    path: str

    def lines(self) -> list:
        """Published versions, oldest first."""
        try:
            rows = self.spark.read.schema(LINE).json(self.path).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(rows, key=lambda line: line.version)

    def publish(self, folder: str, label: str = "") -> int:
        lines = self.lines()
        version = lines[-1].version + 1 if lines else 0
        line = self.spark.createDataFrame([(version, folder, label)], LINE)
        line.coalesce(1).write.mode("append").json(self.path)
        return version


def new_folder() -> str:
    return f"run=r{uuid.uuid4().hex}"


@dataclass(frozen=True)
class VersionedTable:
    """Create or replace, all at once for readers. ``label`` names the run that wrote."""

    spark: SparkSession
    path: str
    fmt: str = "parquet"

    @property
    def log(self) -> VersionLog:
        return VersionLog(self.spark, f"{self.path}/log")

    def replace(self, rows: DataFrame, label: str = "", partition_by: Sequence[str] = ()) -> int:
        """Write ``rows`` as the next version; they may be read from this very table."""
        folder = new_folder()
        writer = rows.write.format(self.fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{self.path}/data/{folder}")
        return self.log.publish(folder, label)

    def read(self, version: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The last version, or an earlier one. What it reads stays as it is."""
        lines = [e for e in self.log.lines() if version is None or e.version == version]
        if not lines:
            raise ValueError(f"{self.path} has no version {'yet' if version is None else version}")
        reader = self.spark.read.format(self.fmt)
        if schema:
            reader = reader.schema(schema)
        return reader.load(f"{self.path}/data/{lines[-1].folder}")


@dataclass(frozen=True)
class HistoryStore:
    """A versioned dimension parted into open and closed versions.

    A run joins the open ones with the extract, and writes the new open part and the
    versions it closes. Those that earlier runs closed are never read or written again: a
    run's work follows the number of keys, not the length of their history. A run that is
    started again replaces its own output, as long as no other followed.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    tracked: tuple[str, ...]
    sk: str
    close_missing: bool = False

    @property
    def log(self) -> VersionLog:
        return VersionLog(self.spark, f"{self.path}/log")

    def _runs(self) -> list:
        """The line that holds for each run, oldest first."""
        last = {line.label: line for line in self.log.lines()}
        return sorted(last.values(), key=lambda line: line.version)

    def apply(self, extract: DataFrame, at, run: str) -> DataFrame:
        """The history after ``extract``, with the run's output published."""
        runs = self._runs()
        if run in [line.label for line in runs[:-1]]:
            raise ValueError(f"other runs followed {run!r}")
        before = [line for line in runs if line.label != run]
        if before:
            rows = changed_versions(
                self._part(before[-1:], "open"), extract, self.key, self.tracked, self.sk, at,
                self.close_missing,
            )
        else:
            rows = first_versions(extract, self.key, self.sk, at)
        folder = new_folder()
        part = F.when(F.col("valid_to").isNull(), F.lit("open")).otherwise(F.lit("closed"))
        rows.select(*self.schema.fieldNames(), part.alias("part")).write.partitionBy(
            "part"
        ).parquet(f"{self.path}/data/{folder}")
        self.log.publish(folder, run)
        return self.history()

    def current(self, run: str | None = None) -> DataFrame:
        """Open versions after ``run``, else after the last one: one folder is read."""
        return self._part(self._until(run)[-1:], "open")

    def history(self, run: str | None = None) -> DataFrame:
        """All versions as they were after ``run``, else after the last one."""
        runs = self._until(run)
        return self._part(runs, "closed").unionByName(self._part(runs[-1:], "open"))

    def _until(self, run: str | None) -> list:
        runs = self._runs()
        if run is None:
            return runs
        for number, line in enumerate(runs):
            if line.label == run:
                return runs[: number + 1]
        raise ValueError(f"no run {run!r}")

    def _part(self, lines: list, part: str) -> DataFrame:
        if not lines:
            return self.spark.createDataFrame([], self.schema)
        base = f"{self.path}/data"
        schema = T.StructType([*self.schema.fields, *struct_of("run string, part string").fields])
        rows = self.spark.read.schema(schema).option("basePath", base)
        return (
            rows.parquet(*[f"{base}/{line.folder}" for line in lines])
            .filter(F.col("part") == part)
            .select(*self.schema.fieldNames())
        )
