"""N-gram Jaccard join by R-trees over count vectors.

The shingles of a text are hashed to ``GROUPS`` groups; the counts of its groups are a point.
Two sets share at most the sum of their points' coordinate minima, and so do all sets under
two tree nodes whose corners are the coordinate maxima. Pairs of nodes, then of points, that
can't reach the threshold are left out; the rest is verified on full shingle sets.

One tree over all texts would compare most texts of like length, as their points lie within
the distance allowed. So the points are dealt out first, losing no link: linked sets differ
in at most a quarter of the smaller one's shingles. Hashed to more cells than that, they
agree in whole cells. Each text names its fullest cells, one more than can differ, by their
contents; linked texts name a common one. Every bucket of texts that name a cell has a
tree of its own.

Buckets never come as all pairs. First every member is compared with the bucket's smallest
id alone, and linked texts get a common label. Then trees are built for buckets that still
hold different labels, and subtrees under one label aren't compared. Texts that are nearly
linked share many cells; a pair is left to the first of them that the lowest names of both
texts tell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import bitmap
from riskloom.llm.common import slices, words
from riskloom.llm.components import components
from riskloom.session import written

WIDTH = 5
# Documents are linked if 100 * intersection >= PERCENT * union.
PERCENT = 80
# Coordinates of a point.
GROUPS = 256
# Points of a tree's leaf, and members of a bucket that one task compares.
LEAF, TILE = 32, 4096
# Lowest cell names of a text that a bucket knows; more of them leave fewer pairs to two buckets.
LEAST = 32
# Sizes of one class are cut into the same cells; the largest is so many times the smallest.
CLASS = 2
# Word hashes a worker remembers; only speed depends on it.
CACHED = 300_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(29)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * _MIX
    return x ^ (x >> _BACK)


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
        out = _mixed(out ^ h[k : k + n])
    return np.unique(out)


def point(sets: np.ndarray) -> np.ndarray:
    """Shingles in each group, in 8 bits; the highest number stands for any larger one."""
    counts = np.bincount((sets >> np.uint64(7)).astype(np.int64) % GROUPS, minlength=GROUPS)
    return np.minimum(counts, 0xFF).astype(np.uint8)


def _differing(n: int, percent: int) -> int:
    """Shingles that may be in one set alone, if one of the two sets has ``n``.

    The smaller set holds the intersection: union <= 100 / percent * smaller.
    """
    return n * (100 - percent) // percent


def cells(sets: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """64-bit names of the cells that a set is dealt out by.

    A set takes part in the class of its size, and in the class before if a linked one can
    be there. Sets too small to differ need none: they link with equal sets only.
    """
    n = len(sets)
    most = _differing(n, percent)
    if not most:
        return np.empty(0, np.uint64)
    low = 1
    while low * CLASS <= n:
        low *= CLASS
    classes = [low]
    if low > 1 and -(-n * percent // 100) < low:
        classes.append(low // CLASS)
    out = []
    for base in classes:
        number = _differing(base * CLASS, percent) * 6 // 5 + 8
        at = (_mixed(sets ^ np.uint64(base)) % np.uint64(number)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(at[order]) > 0]))
        count = np.diff(np.append(first, n))
        name = np.add.reduceat(_mixed(sets[order] + np.uint64(number)), first)
        name = _mixed(_mixed(name ^ np.uint64(base)) + at[order][first].astype(np.uint64))
        out.append(name[np.lexsort((name, -count))[: most + 1]])
        if len(first) <= most:
            # all cells may differ; a linked set has as few, as both have the same empty ones
            out.append(_mixed(np.array([base], np.uint64)))
    return np.concatenate(out)


DESCRIBED = "id long, n_shingles long, digest binary, point binary, cells array<long>"


def _described(percent: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in slices(batches):
            if len(known) > CACHED:
                known.clear()
            sizes, digests, points, names = [], [], [], []
            for text in batch["text"]:
                s = shingles(text.as_py(), known)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                points.append(point(s).tobytes() if len(s) else None)
                names.append(cells(s, percent).view(np.int64) if len(s) else [])
            yield pa.record_batch(
                [
                    batch["id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(points, pa.binary()),
                    pa.array(names, pa.list_(pa.int64())),
                ],
                names=["id", "n_shingles", "digest", "point", "cells"],
            )

    return describe


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Hashes()
    for batch in slices(batches):
        if len(known) > CACHED:
            known.clear()
        found = [shingles(text.as_py(), known).tobytes() for text in batch["text"]]
        yield pa.record_batch([batch["id"], pa.array(found, pa.binary())], names=["id", "shingles"])


def _points_of(column: pa.Array) -> np.ndarray:
    """Points as rows; sizes of any set with a group of 255 or more are below the highest."""
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, GROUPS)
    rows = rows.astype(np.int32)
    rows[rows == 0xFF] = 1 << 22
    return rows


def _enough(shared: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``total`` shingles in both are linked if they share so many."""
    return (100 + percent) * shared >= percent * total


def _possible(percent: int):
    """Pairs whose points allow a link."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            if batch.num_rows:
                shared = np.minimum(_points_of(batch["point_a"]), _points_of(batch["point_b"])).sum(1)
                total = batch["n_a"].to_numpy() + batch["n_b"].to_numpy()
                yield batch.select(["a", "b"]).filter(pa.array(_enough(shared, total, percent)))

    return check


def _linked(percent: int):
    """Pairs whose full sets are linked."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            linked = []
            for left, right in zip(batch["set_a"], batch["set_b"], strict=True):
                x = np.frombuffer(left.as_buffer(), np.uint64)
                y = np.frombuffer(right.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(bool(_enough(shared, len(x) + len(y), percent)))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return check


class Tree:
    """R-tree over points, packed by halving along the widest coordinate or size.

    Nodes are numbered from the root; a node has the range of its points in ``order``, the
    highest value of each coordinate, the smallest set size, and the one label of all its
    points (-1 if they differ).
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        self.points, self.sizes, self.labels = points, sizes, labels
        self.order = np.arange(len(points))
        self.start, self.stop, self.left, self.right = [], [], [], []
        self.high, self.least, self.label = [], [], []
        self._node(0, len(points))

    def _node(self, start: int, stop: int) -> int:
        rows = self.order[start:stop]
        at = len(self.start)
        self.start.append(start)
        self.stop.append(stop)
        self.high.append(self.points[rows].max(0))
        self.least.append(int(self.sizes[rows].min()))
        labels = self.labels[rows]
        self.label.append(int(labels[0]) if (labels == labels[0]).all() else -1)
        self.left.append(-1)
        self.right.append(-1)
        if stop - start > LEAF and self.label[at] == -1:
            counts = np.bincount(labels)
            if counts.max() * 2 >= len(rows):
                # a label with half of the points is worth a subtree of its own
                by = labels == counts.argmax()
                middle = start + int((~by).sum())
            else:
                wide = np.concatenate([self.points[rows], self.sizes[rows, None]], 1)
                by = wide[:, np.argmax(wide.max(0) - wide.min(0))]
                middle = (start + stop) // 2
            self.order[start:stop] = rows[np.argsort(by, kind="stable")]
            self.left[at] = self._node(start, middle)
            self.right[at] = self._node(middle, stop)
        return at

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of points with different labels that may be linked; each pair once."""
        todo = [(0, 0)]
        while todo:
            u, v = todo.pop()
            if self.label[u] == self.label[v] != -1:
                continue
            if u != v:
                shared = int(np.minimum(self.high[u], self.high[v]).sum())
                if not _enough(shared, self.least[u] + self.least[v], percent):
                    continue
            if self.left[u] == -1 and self.left[v] == -1:
                yield from self._leaves(u, v, percent)
            elif u == v:
                x, y = self.left[u], self.right[u]
                todo += [(x, x), (x, y), (y, y)]
            elif self.left[v] == -1 or (
                self.left[u] != -1 and self.stop[u] - self.start[u] > self.stop[v] - self.start[v]
            ):
                todo += [(self.left[u], v), (self.right[u], v)]
            else:
                todo += [(u, self.left[v]), (u, self.right[v])]

    def _leaves(self, u: int, v: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of two nodes' points; a node of one label may hold many."""
        for i in range(self.start[u], self.stop[u], LEAF):
            a = self.order[i : min(i + LEAF, self.stop[u])]
            for j in range(self.start[v], self.stop[v], LEAF):
                if u == v and j < i:
                    continue
                b = self.order[j : min(j + LEAF, self.stop[v])]
                shared = np.minimum(self.points[a][:, None], self.points[b][None]).sum(2)
                total = self.sizes[a][:, None] + self.sizes[b][None]
                good = _enough(shared, total, percent) & (self.labels[a][:, None] != self.labels[b][None])
                x, y = np.nonzero(np.triu(good, 1) if u == v and i == j else good)
                if len(x):
                    yield a[x], b[y]


def _rows_of(column: pa.Array) -> np.ndarray:
    """Lists of up to ``LEAST`` names as rows, filled up with the highest number."""
    out = np.full((len(column), LEAST), np.iinfo(np.int64).max)
    size = column.value_lengths().to_numpy()
    out[np.arange(LEAST) < size[:, None]] = column.flatten().to_numpy()
    return out


def _met_before(cell: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether two texts (a row of names each) share a name below ``cell``.

    Both are in that name's bucket, which compares them unless its smallest id is one of them:
    then they have been compared already.
    """
    met = np.zeros(len(x), bool)
    for k in range(LEAST):
        met |= (x[:, k] < cell) & (x[:, k, None] == y).any(1)
    return met


def _compared(percent: int):
    """Pairs of a bucket, or of two parts of one, that may be linked and met in no lower bucket."""

    def compare(rows: pa.Table) -> pa.Table:
        ids = rows["id"].to_numpy()
        sizes = rows["n"].to_numpy()
        _, labels = np.unique(rows["label"].to_numpy(), return_inverse=True)
        part = rows["part"].to_numpy()
        tree = Tree(_points_of(rows["point"].combine_chunks()), sizes, labels)
        cell, low, high = (rows[c][0].as_py() for c in ("cell", "low", "high"))
        least = _rows_of(rows["least"].combine_chunks())
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for x, y in tree.pairs(percent):
            # pairs inside a part belong to the group of that part alone
            own = (part[x] != part[y]) | (low == high)
            own &= ~_met_before(cell, least[x], least[y])
            left.append(ids[x[own]])
            right.append(ids[y[own]])
        a, b = np.concatenate(left), np.concatenate(right)
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    return compare


def _renamed(df: DataFrame, suffix: str, key: str) -> DataFrame:
    return df.select(*[F.col(c).alias(key if c == "id" else f"{c}_{suffix}") for c in df.columns])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = [batch["cell"].to_numpy().view(np.uint64) for batch in batches]
    if found:
        yield from bitmap.blocks(np.concatenate(found))


def _named_again(bits: Broadcast):
    """(id, cell) of the cells whose bit is set."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            cells_ = batch["cells"].flatten()
            id_ = batch["id"].take(pc.list_parent_indices(batch["cells"]))
            again = bitmap.marked(bits.value, cells_.to_numpy().view(np.uint64))
            yield pa.record_batch([id_, cells_], names=["id", "cell"]).filter(pa.array(again))

    return named


class _Join:
    def __init__(self, rows: DataFrame, percent: int):
        self.rows, self.percent = rows, percent
        self.described = written(rows.mapInArrow(_described(percent), DESCRIBED), "described")
        filled = self.described.where("n_shingles > 0 and id is not null")
        # texts with equal sets are one from here on: the smallest id stands for them
        self.same = written(filled.groupBy("digest").agg(F.min("id").alias("id")), "same")
        self.points = written(
            filled.join(self.same, ["digest", "id"], "left_semi")
            .select(
                "id",
                F.col("n_shingles").alias("n"),
                "point",
                F.slice(F.array_sort(F.array_distinct("cells")), 1, LEAST).alias("least"),
            )
            .distinct(),
            "points",
        )

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are linked: by their points, then by their full sets."""
        p = self.percent
        points = self.points.drop("least")
        near = written(
            pairs.distinct()
            .join(_renamed(points, "a", "a"), "a")
            .join(_renamed(points, "b", "b"), "b")
            .mapInArrow(_possible(p), "a long, b long")
            .distinct(),
            "near",
        )
        ids = near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).distinct()
        sets = written(
            self.rows.join(ids, "id", "left_semi")
            .mapInArrow(_sets, "id long, shingles binary")
            .where("octet_length(shingles) > 0")
            .distinct(),
            "sets",
        )
        return written(
            near.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
            .mapInArrow(_linked(p), "a long, b long")
            .distinct(),
            "linked",
        )

    def links(self) -> DataFrame:
        """Links (a, b) that connect whatever is connected; not all links of a component."""
        named = self.described.where("id is not null").select("id", F.explode("cells").alias("cell"))
        buckets = written(
            named.groupBy("cell")
            .agg(F.min("id").alias("lead"), F.max("id").alias("last"))
            .where("lead < last")
            .select("cell", "lead"),
            "buckets",
        )
        # most cells are named once; the others are few enough to be dealt out again
        bits = buckets.sparkSession.sparkContext.broadcast(
            bitmap.gathered(buckets.mapInArrow(_marks, "block int, bits binary"))
        )
        members = written(
            self.described.where("id is not null")
            .select("id", "cells")
            .mapInArrow(_named_again(bits), "id long, cell long")
            .join(self.same.select("id"), "id", "left_semi")
            .join(buckets, "cell")
            .where("id > lead")
            .distinct(),
            "members",
        )
        links = self.linked(members.select(F.col("id").alias("a"), F.col("lead").alias("b")))
        label = components(links).select(F.col("node").alias("id"), F.col("component").alias("label"))
        labelled = members.join(label, "id", "left").select(
            "cell", "id", F.coalesce("label", "id").alias("label")
        )
        # the smallest id has been compared with all others of its bucket
        mixed = (
            labelled.groupBy("cell")
            .agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("size"))
            .where("x < y")
            .select("cell", F.expr(f"cast(ceil(size / {TILE}) as int)").alias("parts"))
        )
        rest = labelled.join(mixed, "cell").join(self.points, "id")
        # a crowded bucket is cut into parts, and each two parts are compared in a task
        rest = rest.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).select(
            "*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
        )
        more = (
            rest.withColumn("low", F.least("part", "other"))
            .withColumn("high", F.greatest("part", "other"))
            # comparing takes longer than the rows' size tells
            .repartition(int(self.rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cell", "low", "high")
            .groupBy("cell", "low", "high")
            .applyInArrow(_compared(self.percent), "a long, b long")
        )
        return links.unionByName(self.linked(more.where("a > b")))


def join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: size of its set of ``WIDTH``-word
    shingles, and the smallest doc_id reachable by links, its own included.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets. Null
    texts and texts without words have no set and are linked with nothing; nor are rows
    without a doc_id, whose component is null. Each row of a repeated doc_id has the component of its own
    text; all texts of the id carry its links. Equal sets are known by a 128-bit digest.
    Texts count whole, however long; other columns are not carried; an empty table gives
    no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    both = _Join(rows, percent)
    label = components(both.links()).select(F.col("node").alias("first"), "component")
    first = both.same.select("digest", F.col("id").alias("first"))
    return (
        both.described.select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("digest")).alias("digest"))
        .join(first, "digest", "left")
        .join(label, "first", "left")
        .select(
            F.col("id").alias("doc_id"),
            "n_shingles",
            F.coalesce("component", "first", "id").alias("component_id"),
        )
    )
