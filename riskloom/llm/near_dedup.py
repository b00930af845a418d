"""MinHash near-duplicate detection with sequential Bayesian verification.

Texts with the same shingle set are one class from the start. Signatures of the classes
are cut into bands; classes that share a band are candidates. Their signatures are then
compared batch by batch: after each batch the posterior probability that the similarity
reaches the threshold, given the matches so far, is bounded below by a chosen miss
probability, and pairs under the bound are dropped. Survivors are verified exactly on
their full shingle sets.

Candidates never come as all pairs of a band's members. First each member is paired with
the smallest member alone, and what that links is contracted. In ``TURNS`` further rounds
each band that still holds different components draws one more leader, which is paired
with members of other components and then leaves the band, and links are contracted
again. What is still apart is paired across components alone: in full in bands of a few
members, and by the rarest shingles in larger ones, as their members share a passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, slices, words
from riskloom.llm.components import components
from riskloom.session import written

WIDTH = 5
# Documents are linked if 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BATCH = 16
MISS = 1e-6
# Rounds of drawn leaders, one at least; the result is the same for any number of them.
TURNS = 1
# Bands with up to so many members left are paired in full, others by rarest shingles.
SMALL = 8
# Word hashes a worker remembers; only speed depends on it.
CACHED = 300_000
# Shingles hashed at once.
CHUNK = 4096

_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def shingles(text: str | None, known: dict[bytes, int] | None = None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; none for a text without words.

    A text of fewer than ``WIDTH`` words has its whole sequence as one shingle.
    """
    parts = words(text)
    if not parts:
        return np.empty(0, np.uint64)
    known = _Hashes() if known is None else known
    h = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    width = min(WIDTH, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = (out ^ h[k : k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


@lru_cache(maxsize=1)
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(2024)
    a = rng.integers(1, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    return a, rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def signature(sets: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the shingles."""
    a, b = _multipliers()
    x = (sets ^ (sets >> np.uint64(32))).astype(np.uint32)
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(x), CHUNK):
        h = np.bitwise_xor.outer(x[start : start + CHUNK], b)
        h *= a
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        np.minimum(low, h.min(0), out=low)
    return low


def described(text: Column) -> Column:
    """Struct of the shingle count, a 128-bit digest of the set, and the signature.

    Digest and signature are null where there are no words.
    """

    @F.arrow_udf("n_shingles long, digest binary, signature binary")
    def sets(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Hashes()
        for array in texts:
            sizes, digests, signs = [], [], []
            for value in array:
                if len(known) > CACHED:
                    known.clear()
                s = shingles(value.as_py(), known)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                signs.append(signature(s).tobytes() if len(s) else None)
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())],
                names=["n_shingles", "digest", "signature"],
            )

    return sets(text)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band, node) rows: a 64-bit key of each band of a signature."""
    for batch in slices(batches, 4096):
        if not batch.num_rows:
            continue
        signs = np.frombuffer(b"".join(batch["signature"].to_pylist()), np.uint32)
        rows = signs.reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
        for k in range(ROWS):
            key = (key ^ rows[:, :, k]) * _MIX
            key ^= key >> np.uint64(31)
        node = np.repeat(batch["node"].to_numpy(), BANDS)
        yield pa.record_batch([key.reshape(-1).view(np.int64), node], names=["band", "node"])


@lru_cache(maxsize=1)
def least_matches() -> list[tuple[int, int]]:
    """(values compared, fewest matches that are not pruned) after each batch.

    With a uniform prior the chance of a similarity of at least t after m matches in n is
    the sum over j <= m of C(n + 1, j) t^j (1 - t)^(n + 1 - j); under ``MISS`` the pair goes.
    """
    t, out = PERCENT / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < MISS:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def matches(left: Column, right: Column) -> Column:
    """Matching signature values of a pair, or null once the posterior bound drops it."""

    @F.arrow_udf("int")
    def compared(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in pairs:
            x, y = (
                np.frombuffer(b"".join(v.to_pylist()), np.uint32).reshape(-1, HASHES)
                for v in (a, b)
            )
            alive = np.arange(len(x))
            count = np.zeros(len(x), np.int64)
            for n, least in least_matches():
                same = x[alive, n - BATCH : n] == y[alive, n - BATCH : n]
                count[alive] += same.sum(1)
                alive = alive[count[alive] >= least]
            dropped = np.ones(len(x), bool)
            dropped[alive] = False
            yield pa.array(count.astype(np.int32), pa.int32(), mask=dropped)

    return compared(left, right)


def linked(left: Column, right: Column) -> Column:
    """Whether two texts' full shingle sets reach the threshold; false without words."""

    @F.arrow_udf("boolean")
    def verified(pairs: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known = _Hashes()
        for a, b in pairs:
            out = []
            last, x = None, None
            for s, t in zip(a, b, strict=True):
                if len(known) > CACHED:
                    known.clear()
                s = s.as_py()
                if x is None or s != last:
                    last, x = s, shingles(s, known)
                y = shingles(t.as_py(), known)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.array(out, pa.bool_())

    return verified(left, right)


def _survivors(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) that the posterior bound does not drop, with their matches."""
    sign = classes.select("node", "signature")
    return (
        pairs.distinct()
        .join(sign.toDF("a", "left"), "a")
        .join(sign.toDF("b", "right"), "b")
        .select("a", "b", matches(F.col("left"), F.col("right")).alias("same"))
        .where("same is not null")
    )


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    return (
        pairs.select("a", "b")
        .join(texts.toDF("a", "left"), "a")
        .join(texts.toDF("b", "right"), "b")
        .where(linked(F.col("left"), F.col("right")))
        .select("a", "b")
    )


def _round(members: DataFrame, label: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """One leader for each band whose members lie in different components.

    Returns its pairs with members of other components, and the members of these bands
    without the leaders, whose pairs have all been made. The leader is drawn by a hash, so
    each turn and band has another.
    """
    labelled = members.join(label, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("component")
    )
    drawn = F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "component"))
    mixed = (
        labelled.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), drawn.alias("lead"))
        .where("low < high")
        .select("band", F.col("lead.node").alias("lead"), F.col("lead.component").alias("of"))
    )
    rest = written(labelled.join(mixed, "band").where("node <> lead"), "members")
    pairs = rest.where("component <> of").select(
        F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")
    )
    return pairs, rest.select("band", "node")


def _across(members: DataFrame, label: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs of members of one band that lie in different components.

    Bands of up to ``SMALL`` members are paired directly. Members of larger ones, which
    share much without being near, are joined by their rarest shingles: two sets that reach
    the threshold share one among those that either can do without.
    """
    here = members.join(label, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("component")
    )
    size = here.groupBy("band").agg(F.count("*").alias("size"))
    here = here.join(size, "band")
    one = here.where(F.col("size") <= SMALL).select("band", "node", "component")
    two = one.toDF("band", "other", "other_component")
    direct = (
        one.join(two, "band")
        .where("component < other_component")
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    )
    crowded = here.where(F.col("size") > SMALL).select("node", "component").distinct()
    return direct.unionByName(_by_rarest(crowded, texts))


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component, variant, n, shingle) rows."""
    known = _Hashes()
    for batch in slices(batches, 128):
        sets = [shingles(t.as_py(), known) for t in batch["text"]]
        if len(known) > CACHED:
            known.clear()
        if not (sizes := [len(s) for s in sets]):
            continue
        columns = [np.repeat(batch[c].to_numpy(), sizes) for c in ("node", "component", "variant")]
        columns.append(np.repeat(np.array(sizes, np.int64), sizes))
        columns.append(np.concatenate(sets).view(np.int64))
        yield pa.record_batch(columns, names=["node", "component", "variant", "n", "shingle"])


def _by_rarest(crowded: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs across components of ``crowded`` (node, component) that share a shingle among
    the rarest of either.

    Of sets with x <= y elements at the threshold t, y >= t x has to share one of its
    y - ceil(t y) + 1 rarest with one of the x - ceil(2 t / (1 + t) x) + 1 rarest of x; the
    order is by the number of sets here that hold the shingle. Where the first shared one
    stands bounds how many can follow, which leaves out sets that share a long passage
    behind rare shingles of their own. Repeated rows of a node count once; texts of one node
    that differ are sets of their own.
    """
    rows = written(
        texts.join(crowded, "node")
        .select("node", "component", F.xxhash64("text").alias("variant"), "text")
        .dropDuplicates(["node", "component", "variant"])
        .mapInArrow(_exploded, "node long, component long, variant long, n long, shingle long"),
        "shingles",
    )
    held = rows.groupBy("shingle").agg(F.count("*").alias("held"))
    rank = F.row_number().over(Window.partitionBy("node", "variant").orderBy("held", "shingle"))
    probe = F.expr(f"n - ceil({PERCENT} * n / 100) + 1")
    index = F.expr(f"n - ceil(2 * {PERCENT} * n / (100 + {PERCENT})) + 1")
    prefix = written(
        rows.join(held, "shingle")
        .withColumn("rank", rank)
        .where(F.col("rank") <= probe)
        .select("node", "component", "n", "shingle", "rank", (F.col("rank") <= index).alias("indexed")),
        "rarest",
    )
    short = prefix.where("indexed").select(
        "shingle",
        F.col("node").alias("x"),
        F.col("n").alias("m"),
        F.col("rank").alias("at"),
        F.col("component").alias("of"),
    )
    return (
        prefix.join(short, "shingle")
        .where(f"component <> of and (m < n or m = n and x < node) and 100 * m >= {PERCENT} * n")
        .where(f"{100 + PERCENT} * (1 + least(m - at, n - rank)) >= {PERCENT} * (m + n)")
        .select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b"))
    )


def duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that links lead to, kept says that it is the row's
    own. Texts without words are linked with nothing. Rows of one doc_id are taken as one
    document. Rows without a doc_id link nothing, have no component and are kept. Repeated
    rows give repeated rows; other columns are not carried; an empty table gives no rows.
    """
    text = F.col("text").cast("string")
    sets = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), described(text).alias("s")).select(
            "doc_id", "s.*"
        ),
        "sets",
    )
    nodes = sets.where("digest is not null and doc_id is not null")
    membership = written(
        nodes.groupBy("digest", "n_shingles").agg(F.min("doc_id").alias("node")), "classes"
    )
    classes = written(
        nodes.select(F.col("doc_id").alias("node"), "digest", "signature")
        .join(membership.select("node", "digest"), ["node", "digest"])
        .dropDuplicates(["node", "digest"]),
        "signatures",
    )
    least = F.min("node")
    shared = classes.mapInArrow(_bands, "band long, node long")
    bands = shared.groupBy("band").agg(least.alias("least"), F.max("node").alias("most"))
    bands = written(shared.join(bands.where("least < most"), "band").select("band", "least", "node"), "bands")
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("node"), text.alias("text"))
        .join(membership.select("node"), "node", "left_semi")
    )
    stars = bands.where("node > least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    stars = written(_survivors(stars, classes), "stars")
    # one link for each class first: that with the most matches, else with the smallest node
    best = stars.groupBy("b").agg(F.max(F.struct("same", (-F.col("a")).alias("a"))).alias("best"))
    best = best.select((-F.col("best.a")).alias("a"), "b")
    links = [written(_verified(best, texts), "first")]
    label = written(components(links[0]), "label")
    rest = _apart(stars, label).join(best, ["a", "b"], "left_anti")
    members = bands.where("node > least").select("band", "node")
    for turn in range(TURNS):
        pairs, members = _round(members, label, turn)
        drawn = _survivors(pairs, classes).select("a", "b")
        links.append(written(_verified(drawn.unionByName(rest).distinct(), texts), "linked"))
        rest = rest.limit(0)
        label = written(components(reduce(DataFrame.unionByName, links)), "label")
    across = written(_survivors(_across(members, label, texts), classes), "across")
    links.append(written(_verified(across, texts), "last"))
    ids = nodes.join(membership, ["digest", "n_shingles"]).select(
        F.col("doc_id").alias("a"), F.col("node").alias("b")
    )
    links.append(ids.where("a <> b").distinct())
    label = written(components(reduce(DataFrame.unionByName, links)), "label")
    return (
        sets.join(label.toDF("doc_id", "component"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    )


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    return (
        pairs.select("a", "b")
        .join(label.toDF("a", "x"), "a", "left")
        .join(label.toDF("b", "y"), "b", "left")
        .where(F.coalesce("x", "a") != F.coalesce("y", "b"))
        .select("a", "b")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, of the documents that stay: one of each component.

    Repeated rows of a document that stays give one row.
    """
    flag = fresh(docs.columns, "kept_id")
    stay = duplicates(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias(flag))
    known = docs.where("doc_id is not null")
    kept = known.join(stay, known["doc_id"] == F.col(flag), "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null"))
