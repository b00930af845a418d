"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of a text: runs of anything but space, tab, line ends, vertical tab, form feed.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(column: str, n: int) -> Column:
    """crc32 of an id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def fresh(columns: list[str], name: str) -> str:
    """``name``, or a longer one that is not among ``columns`` (names ignore case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in short batches, so that few texts are held as objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def encoded(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; bytes split and lower-case by ASCII alone."""
    return encoded(text).lower().split()


def dumped(made: dict[str, np.ndarray]) -> bytes:
    """Arrays by name as compressed bytes."""
    sink = pa.BufferOutputStream()
    columns = [pa.LargeListArray.from_arrays([0, len(a)], a) for a in made.values()]
    schema = pa.schema(zip(made, (c.type for c in columns), strict=True))
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(pa.record_batch(columns, names=list(made)))
    return sink.getvalue().to_pybytes()


def loaded(data: pa.Buffer) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(data).read_next_batch()
    return {c: table[c].values.to_numpy() for c in table.schema.names}
