"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Items are placed largest first, each into the shard where the dot product of its vector
with the shard's residual capacity is highest. An item is a group of equal texts, if any
of its shares of the totals exceeds 1 / (shards * FINE); a block of all lighter groups
with the same hash otherwise; or a piece of a group that is larger than a shard. So there
are at most a few times shards * FINE items, however many rows there are, and that many
sums come to the driver; rows learn their shard from joins.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import text_of, word_count
from riskloom.session import written

SHARDS, FINE = 24, 512
OVERHEAD = 8
# Rows of one shard that are numbered together.
NUMBERED = 50_000
_SUMS = ("size", "n_tokens", "n_rows")


def place(shares: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item; rows of ``shares`` are its shares of the totals, largest first."""
    vectors = shares * shards
    residual = np.ones((shards, shares.shape[1]))
    out = np.zeros(len(shares), np.int64)
    for k, vector in enumerate(vectors):
        out[k] = best = int(np.argmax(residual @ vector))
        residual[best] -= vector
    return out


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``: sizes come out near equal. Rows of equal texts share a shard,
    unless they are larger than one; then their pieces go by doc_id. Null texts are a group
    and have no bytes. Slots count from 0 in each shard, in an order that only depends on
    the rows; repeated rows get slots of their own. Other columns are not carried; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    rows = written(
        docs.select(
            "doc_id",
            (F.octet_length(text_of()) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text_of().cast("binary")).alias("text_crc32"),
            word_count().alias("n_tokens"),
            F.xxhash64(F.col("text").isNull(), text_of()).alias("group"),
        ),
        "sized",
    )
    sums = [F.sum("size").alias("size"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_rows")]
    total = rows.agg(*sums).first()
    if not total["n_rows"]:
        return _numbered(rows.withColumn("shard", F.lit(0)), 1)
    share = F.greatest(*[F.col(c) / F.lit(float(max(total[c], 1))) for c in _SUMS])
    heavy = written(
        rows.groupBy("group")
        .agg(*sums)
        .withColumn("share", share)
        .where(F.col("share") > 1 / (shards * FINE))
        .select(
            "group",
            F.when(F.col("share") > 1 / shards, F.ceil(F.col("share") * 2 * shards))
            .otherwise(1)
            .cast("int")
            .alias("pieces"),
        ),
        "heavy",
    )
    # three sums, each with at most shards * FINE groups over the threshold
    items = rows.join(F.broadcast(heavy), "group", "left").select(
        *rows.columns,
        F.when(F.col("pieces").isNull(), F.lit(-1)).otherwise(
            F.pmod(F.xxhash64("doc_id"), F.col("pieces"))
        ).cast("int").alias("piece"),
        F.when(F.col("pieces").isNull(), F.pmod("group", F.lit(shards * FINE)))
        .otherwise(F.col("group"))
        .alias("item"),
    )
    sized = (
        items.groupBy("item", "piece")
        .agg(*sums)
        .withColumn("share", share)
        .orderBy(F.desc("share"), "item", "piece")
        .toArrow()
    )
    shares = np.stack([sized[c].to_numpy() / max(total[c], 1) for c in _SUMS], 1)
    chosen = sized.select(["item", "piece"]).append_column(
        "shard", [place(shares, shards).astype(np.int32)]
    )
    placed = items.join(F.broadcast(spark.createDataFrame(chosen)), ["item", "piece"])
    return _numbered(placed, max(1, total["n_rows"] // (shards * NUMBERED)))


def _numbered(rows: DataFrame, chunks: int) -> DataFrame:
    """Slots: the rows of a shard in chunks by a hash of doc_id; where a chunk starts comes
    from the counts of those before it, so no shard is sorted as a whole."""
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit("slot")), F.lit(chunks)))
    counts = rows.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "shard", "chunk", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("shard", "chunk").orderBy("doc_id", "group", "size")
    return (
        rows.withColumn("at", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "chunk"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("start") + F.col("at")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
