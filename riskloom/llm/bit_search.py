"""Ranked lexical search over bit-sliced Bloom signatures.

Documents are cut into blocks of like sizes. A block is a matrix of bits: a column for each
document, and rows that terms are hashed to. The ``HASHES`` rows of a term, and-ed, give a
bitmap of the documents that may hold it: never too few of them. A term that occurs
repeatedly is entered once for each of ``STEPS`` it reaches, so the same matrix bounds
occurrences from above. Weighted sums of a query's bitmaps are upper bounds of the scores.

The search takes three steps. The documents of the highest bounds are scored exactly; the
last of the k best of them is a floor for each query. Then every document whose bound
isn't under the floor is kept, and the kept ones are scored exactly on their whole texts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import encoded, slices, text_of
from riskloom.session import written

K = 50
# Rows of a term in a block's matrix, and bits for each entry of its fullest document.
HASHES, BITS_PER_KEY = 4, 16
# A term is entered once for each of these numbers of occurrences it reaches.
STEPS = (1, 2, 3, 5, 9, 17, 33)
# Documents of a block, cells of its matrix, and entries a task holds before it cuts blocks.
BLOCK, CELLS, ENTRIES = 4096, 1 << 24, 2_000_000
# Documents of a block that are tried for the floor, for each query.
TRIED = 8
# Queries that go through a block together, and terms of queries sent to all tasks at once.
GROUP, TERMS_SENT = 512, 1_000_000
# Terms that are looked up together.
TERMS_AT_ONCE = 512
# Ids that are sent to all tasks; more are joined by a shuffle.
BROADCAST_IDS = 500_000
# Term hashes, and rows of term counts, a task holds; only speed depends on them.
CACHED = 400_000

# Terms are runs of ASCII letters, digits and all characters beyond ASCII; A-Z in lower case.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LAST = 1 << 62  # id of a row without one: after all others


def terms(text: str | None) -> list[bytes]:
    return encoded(text).translate(_TABLE).split(b" ")


def term_counts(text: str | None) -> Counter:
    found = Counter(terms(text))
    del found[b""]
    return found


def _code(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term)


class _Codes(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = out = _code(term)
        return out


def _entries(codes: np.ndarray, step: int) -> np.ndarray:
    """Hashes of terms that reach a step of occurrences."""
    x = (codes ^ np.uint64(step)) * _MIX
    x ^= x >> np.uint64(29)
    return x * _MIX


def _rows(entries: np.ndarray, height: int) -> np.ndarray:
    """The matrix rows of each entry."""
    low, high = entries & np.uint64(0xFFFFFFFF), entries >> np.uint64(32) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)[:, None]
    return ((low + steps * high) % np.uint64(height)).astype(np.int64)


# One document: id, terms with repeats, and the entries of its signature.
_Doc = tuple[int | None, int, np.ndarray]


def _block(docs: list[_Doc]) -> dict:
    width = -(-len(docs) // 8) * 8
    height = max(64, BITS_PER_KEY * max(len(d[2]) for d in docs))
    cells = np.zeros((height, width), np.uint8)
    column = np.repeat(np.arange(len(docs)), [len(d[2]) for d in docs])
    for row in _rows(np.concatenate([d[2] for d in docs]), height):
        cells[row, column] = 1
    return {
        "ids": [d[0] for d in docs],
        "sizes": [d[1] for d in docs],
        "height": height,
        "bits": np.packbits(cells, axis=1).tobytes(),
    }


def _blocks(docs: list[_Doc]) -> Iterator[dict]:
    """Blocks of documents of like sizes; a very long document has few beside it."""
    docs.sort(key=lambda d: -len(d[2]))
    start = 0
    while start < len(docs):
        height = max(64, BITS_PER_KEY * len(docs[start][2]))
        stop = start + max(8, min(BLOCK, CELLS // height // 8 * 8))
        yield _block(docs[start:stop])
        start = stop


# A block (ids, sizes, height, bits), or the number of a task's documents that hold a term.
INDEX = "ids array<long>, sizes array<long>, height int, bits binary, term binary, df long"


def _index_rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = [
        ("ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("height", pa.int32()),
        ("bits", pa.binary()),
        ("term", pa.binary()),
        ("df", pa.int64()),
    ]
    return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def _frequencies(held: Counter) -> Iterator[pa.RecordBatch]:
    names, numbers = list(held), list(held.values())
    for start in range(0, len(names), 100_000):
        part = names[start : start + 100_000]
        none = [pa.nulls(len(part), t) for t in (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary())]
        yield pa.record_batch(
            [*none, pa.array(part, pa.binary()), pa.array(numbers[start : start + 100_000], pa.int64())],
            names=["ids", "sizes", "height", "bits", "term", "df"],
        )


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs: list[_Doc] = []
    entries = 0
    codes, held = _Codes(), Counter()
    for batch in slices(batches, 256):
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
            found = term_counts(text.as_py())
            if not found:
                continue
            held.update(found.keys())
            code = np.fromiter(map(codes.__getitem__, found), np.uint64, len(found))
            times = np.fromiter(found.values(), np.int64, len(found))
            parts = [_entries(code[times >= step], step) for step in STEPS]
            docs.append((doc_id, int(times.sum()), np.concatenate(parts)))
            entries += len(docs[-1][2])
            if len(codes) > CACHED:
                codes.clear()
            if len(held) > CACHED:
                yield from _frequencies(held)
                held = Counter()
            if entries > ENTRIES:
                for block in _blocks(docs):
                    yield _index_rows([block])
                docs, entries = [], 0
    for block in _blocks(docs):
        yield _index_rows([block])
    yield from _frequencies(held)


def index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text): blocks, and term frequencies by task."""
    return written(docs.mapInArrow(_indexed, INDEX), "signatures")


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for item, text in zip(batch["item_id"].to_pylist(), batch["text"], strict=True):
            found = list(term_counts(text.as_py()))
            if found:
                yield pa.record_batch(
                    [pa.array([item] * len(found), pa.int64()), pa.array(found, pa.binary())],
                    names=["item_id", "term"],
                )


def weight(n: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n`` documents hold."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _weighted(n: int):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = [weight(n, df) for df in batch["df"].to_pylist()]
            yield pa.record_batch(
                [batch["item_id"], batch["term"], pa.array(value, pa.int64())],
                names=["item_id", "term", "weight"],
            )

    return weigh


def length_norm(size: np.ndarray | int, n: int, words: int) -> np.ndarray | int:
    """A document's length in percent of the mean, half of it fixed."""
    return 50 + 50 * size * n // words


class Bounds:
    """Upper bounds of a block's scores."""

    def __init__(self, ids: list, sizes: list[int], height: int, bits: bytes, n: int, words: int):
        self.ids = np.array([_LAST if i is None else i for i in ids], np.int64)
        self.height = height
        self.bits = np.frombuffer(bits, np.uint8).reshape(height, -1)
        # exact 64-bit numbers up to any table size: sizes are bounded by a text
        m = np.array([length_norm(s, n, words) for s in sizes], np.int64)
        highest = [step - 1 for step in STEPS[1:]]
        caps = [10**9 * tf // (1000 * tf + 20 * m) for tf in highest]
        caps.append(np.full(len(m), 10**6, np.int64))  # the limit for many occurrences
        self.steps = [caps[0], *(b - a for a, b in zip(caps, caps[1:], strict=False))]

    def _held(self, entries: np.ndarray) -> np.ndarray:
        """Bitmaps of the documents that may hold each entry."""
        rows = _rows(entries, self.height)
        found = self.bits[rows[0]]
        for row in rows[1:]:
            found &= self.bits[row]
        return found

    def of_terms(self, terms_: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents that may hold each term, one term after the other, with the most that a
        unit of weight gives there; and where each term begins."""
        codes = np.fromiter(map(_code, terms_), np.uint64, len(terms_))
        found = self._held(_entries(codes, STEPS[0]))
        term, held = np.nonzero(np.unpackbits(found, axis=1, count=len(self.ids)))
        most = self.steps[0][held]
        rows = np.arange(len(terms_))
        for step, more in zip(STEPS[1:], self.steps[1:], strict=True):
            found = found & self._held(_entries(codes[rows], step))
            some = found.any(1)
            if not some.any():
                break
            found, rows = found[some], rows[some]
            at, doc = np.nonzero(np.unpackbits(found, axis=1, count=len(self.ids)))
            place = np.searchsorted(term * len(self.ids) + held, rows[at] * len(self.ids) + doc)
            most[place] += more[doc]
        return held, most, np.searchsorted(term, np.arange(len(terms_) + 1))

    def of_queries(self, queries: list[dict]) -> Iterator[tuple[dict, np.ndarray]]:
        """(query, bound of each document) of all queries; a term is looked up once."""
        names = sorted({name for query in queries for name in query["terms"]})
        known: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        for start in range(0, len(names), TERMS_AT_ONCE):
            some = names[start : start + TERMS_AT_ONCE]
            held, most, edges = self.of_terms(some)
            for name, a, b in zip(some, edges, edges[1:], strict=False):
                known[name] = held[a:b], most[a:b]
        for query in queries:
            total = np.zeros(len(self.ids), np.int64)
            for name, w in zip(query["terms"], query["weights"], strict=True):
                held, most = known[name]
                total[held] += w * most
            yield query, total


def _bounded(n: int, words: int, choose):
    """(item_id, doc_id, bound) of the documents that ``choose`` takes from a query's bounds,
    for each row: a block with its queries."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.select(["ids", "sizes", "height"]).to_pylist()[0]
            block = Bounds(row["ids"], row["sizes"], row["height"], batch["bits"][0].as_py(), n, words)
            for query, bound in block.of_queries(batch["queries"][0].as_py()):
                item, taken = query["item_id"], choose(block.ids, bound, query["floor"])
                if len(taken):
                    ids = block.ids[taken]
                    yield pa.record_batch(
                        [
                            pa.array([item] * len(taken), pa.int64()),
                            pa.array(ids, pa.int64(), mask=ids == _LAST),
                            pa.array(bound[taken], pa.int64()),
                        ],
                        names=["item_id", "doc_id", "bound"],
                    )

    return bounded


def _highest(tried: int):
    def choose(ids: np.ndarray, bound: np.ndarray, floor: None) -> np.ndarray:
        best = np.lexsort((ids, -bound))[:tried]
        return best[bound[best] > 0]

    return choose


def _not_excluded(ids: np.ndarray, bound: np.ndarray, floor: dict | None) -> np.ndarray:
    """Documents that may come before the floor's, or be it."""
    if floor is None:
        return np.flatnonzero(bound > 0)
    last = _LAST if floor["doc_id"] is None else floor["doc_id"]
    return np.flatnonzero((bound > floor["score"]) | ((bound == floor["score"]) & (ids <= last)))


def score(found: Counter, names: list[bytes], weights: list[int], n: int, words: int) -> int:
    """Exact score of a document with the given term counts."""
    m = length_norm(sum(found.values()), n, words)
    total = 0
    for name, w in zip(names, weights, strict=True):
        if tf := found.get(name):
            total += w * (10**9 * tf // (1000 * tf + 20 * m))
    return total


def _rescored(n: int, words: int):
    """(item_id, doc_id, score) of rows (doc_id, text, asked), ``asked`` being queries."""

    def rescore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            items, ids, scores = [], [], []
            for k in range(batch.num_rows):
                found = term_counts(batch["text"][k].as_py())
                doc_id = batch["doc_id"][k].as_py()
                for q in batch["asked"][k].as_py():
                    items.append(q["item_id"])
                    ids.append(doc_id)
                    scores.append(score(found, q["terms"], q["weights"], n, words))
            yield pa.record_batch(
                [pa.array(items, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                names=["item_id", "doc_id", "score"],
            )

    return rescore


def _scored(rows: DataFrame, pairs: DataFrame, queries: DataFrame, n: int, words: int) -> DataFrame:
    """Exact scores of the given (item_id, doc_id) pairs, on whole texts."""
    found = pairs.select("doc_id", F.col("item_id").alias("found_item"))
    asked = written(
        found.join(queries, F.col("found_item").eqNullSafe(F.col("item_id")))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("item_id", "terms", "weights")).alias("asked")),
        "pairs",
    )
    ids = asked.select(F.col("doc_id").alias("id"))
    if ids.count() <= BROADCAST_IDS:
        # few ids: only their texts are dealt out
        rows = rows.join(F.broadcast(ids), rows["doc_id"].eqNullSafe(F.col("id")), "left_semi")
    asked = asked.withColumnRenamed("doc_id", "id")
    return (
        rows.join(asked, rows["doc_id"].eqNullSafe(F.col("id")))
        .select("doc_id", "text", "asked")
        .mapInArrow(_rescored(n, words), "item_id long, doc_id long, score long")
        .where("score > 0")
    )


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, by score and
    then smaller doc_id.

    Each row of ``docs`` is a document of its own, also where an id repeats; rows without an
    id come after all others of their score. Rows of one item (null is one too) are one
    query. Null and empty texts have no terms: such documents don't count, such items have
    no rows, as have all if either table is empty. Texts count whole, however long; other
    columns are not carried.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    stored = index(rows)
    blocks = stored.where("height is not null").drop("term", "df")
    stats = blocks.agg(
        F.sum(F.size("ids")).alias("n"),
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("words"),
    ).first()
    n, words = stats["n"] or 0, stats["words"] or 1
    held = stored.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
    asked = (
        items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
        .mapInArrow(_query_terms, "item_id long, term binary")
        .distinct()
    )
    # terms that no document holds add nothing
    queries = written(
        asked.join(held, "term")
        .select("item_id", "term", "df")
        .mapInArrow(_weighted(n), "item_id long, term binary, weight long")
        .groupBy("item_id")
        .agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("t"))
        .select("item_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")),
        "queries",
    )
    size = queries.agg(F.count("*").alias("n"), F.sum(F.size("terms")).alias("terms")).first()
    groups = max(1, -(-size["n"] // GROUP))
    rounds = max(1, -(-(size["terms"] or 0) // TERMS_SENT))
    part = F.pmod(F.xxhash64("item_id"), F.lit(groups)).cast("int").alias("part")
    every_part = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part")

    def bounds(floored: DataFrame, choose) -> DataFrame:
        """What ``choose`` takes of every block for every query with its floor.

        All queries that fit the bound are sent to the blocks; more go in further rounds.
        """
        each = F.struct("item_id", "terms", "weights", "floor")
        found = []
        for turn in range(rounds):
            own = floored.where(F.pmod(F.xxhash64("item_id", F.lit(7)), F.lit(rounds)) == turn)
            grouped = own.groupBy(part).agg(F.collect_list(each).alias("queries"))
            found.append(
                blocks.select("*", every_part)
                .join(F.broadcast(grouped), "part")
                .drop("part")
                .mapInArrow(_bounded(n, words, choose), "item_id long, doc_id long, bound long")
            )
        return reduce(DataFrame.unionByName, found)

    none = F.lit(None).cast("struct<score: long, doc_id: long>").alias("floor")
    tried = bounds(queries.select("*", none), _highest(TRIED))
    order = Window.partitionBy("item_id").orderBy(F.desc("bound"), F.asc_nulls_last("doc_id"))
    tried = (
        tried.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= 2 * k)
        .select("item_id", "doc_id")
        .distinct()
    )
    floors = (
        _best(_scored(rows, tried, queries, n, words), k)
        .where(F.col("rank") == k)
        .select(F.col("item_id").alias("of_item"), F.struct("score", "doc_id").alias("floor"))
    )
    floored = queries.join(floors, F.col("item_id").eqNullSafe(F.col("of_item")), "left")
    kept = bounds(floored, _not_excluded)
    final = _scored(rows, kept.select("item_id", "doc_id").distinct(), queries, n, words)
    return _best(final, k).select("item_id", "rank", "doc_id", "score")
