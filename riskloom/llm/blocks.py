"""Documents in blocks, for looking up what a block needs in a table of any size.

A table over all words or n-grams can't be sent to every task, and a row for each of their
occurrences can't be shuffled. So documents are hashed to blocks of a few megabytes; each
block asks for its distinct keys once, a join answers, and texts and answers of a block
meet in one task. Blocks hold whole documents and spread copies and hot sources evenly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, text_of

BLOCK_BYTES = 10_000_000
LEAST_BLOCKS = 64


def blocked(docs: DataFrame, *columns: str) -> tuple[DataFrame, int]:
    """(block, text, and ``columns``), dealt out by block; and the number of blocks.

    The number of blocks follows the bytes of all texts. Rows without an id are spread by
    their text.
    """
    size = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    blocks = max(LEAST_BLOCKS, size // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("doc_id", text_of()), F.lit(blocks)).cast("int")
    rows = docs.select(block.alias("block"), text_of().alias("text"), *columns)
    return rows.repartition(blocks, "block"), blocks


def asked(
    rows: DataFrame, parts: int, keys: Callable[[str], Iterable], key_type: str, arrow: pa.DataType
) -> DataFrame:
    """Distinct (block, key) over the texts of ``rows``, dealt out by key; ``keys`` gives those
    of a text."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[int, set] = {}
        for batch in slices(batches):
            for block, text in zip(batch["block"].to_pylist(), batch["text"], strict=True):
                wanted.setdefault(block, set()).update(keys(text.as_py()))
        for block, found in wanted.items():
            column = pa.array(list(found), arrow)
            yield pa.record_batch(
                [pa.array([block] * len(column), pa.int32()), column], names=["block", "key"]
            )

    # all columns go in, so that both uses of ``rows`` read one exchange
    found = rows.mapInArrow(ask, f"block int, key {key_type}")
    return found.repartition(parts, "key")


def answered(
    rows: DataFrame, answers: DataFrame, score: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``score`` of each block's rows and answers (block, key, ...)."""
    return (
        rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema=schema)
    )
