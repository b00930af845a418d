"""Exact BM25 top-k search with block-max pruning, per shard, merged exactly.

Statistics are global: document frequencies, number and mean length of documents. A shard is
a run of documents with an inverted index, written once as one row. A task that reads it
keeps the postings of the rarer words, and of the common ones a column each with the highest
score in each block of ``WINDOW`` documents. For a query the postings of its rarer words are
summed, and the block maxima of its common words bound what these add in a block. The best
documents of the best blocks are scored first; blocks whose bound is below the k-th best score
found are skipped. A shard returns its k best exactly, so the k best of all shards are those of
the whole table.

Every shard meets every query. Queries run in groups of a bounded size, one after the other:
a group is sent to all tasks, which read the shards, so neither texts nor queries are shuffled
for it and no index is built again. A few shards are searched first; what is below their k-th
best score need not leave the others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import dumped, loaded, slices, text_of, words
from riskloom.session import settings, written

K = 10
K1, B = 1.2, 0.75
# Every id divisible by this is a query.
EVERY = 50
WINDOW = 8
ROOM = 1 - 1e-9
# Common words are in more than an eighth of all documents. At most so many of them, the most
# frequent, have columns, and so many cells in a shard; only speed depends on it.
COMMON, MOST_COMMON, COMMON_CELLS = 8, 4096, 4_000_000
# Bytes of text in a shard, of a query's term, and of the terms in one group of queries.
SHARD_BYTES, TERM_BYTES, LEAST_GROUP = 30_000_000, 12, 24_000_000
LEAST_SHARDS = 16
# Queries whose common words are bounded at once.
TOGETHER = 64
# A row of the index is as large as a shard's text: it has a file of its own and is made and
# sent to Python in pieces of about so many bytes, a batch each.
PIECE = 4_000_000
ONE_TO_A_FILE = {
    "spark.sql.files.maxRecordsPerFile": "1",
    # pieces are compressed as they are made
    "spark.sql.parquet.compression.codec": "uncompressed",
}
ONE_TO_A_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}


def terms_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of a text's distinct words, ascending, and how often each occurs."""
    parts = words(text)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    return np.unique(hashes.view(np.int64), return_counts=True)


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 256):
        sets = [terms_of(t.as_py())[0] for t in batch["text"]]
        yield pa.record_batch(
            [
                pa.array(np.repeat(batch["doc_id"].to_numpy(), [len(s) for s in sets]), pa.int64()),
                pa.array(np.concatenate([*sets, np.empty(0, np.int64)]), pa.int64()),
            ],
            names=["doc_id", "term"],
        )


def _postings(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[dict[str, np.ndarray]]:
    """Distinct terms, ascending, and the postings of each (how many, documents, occurrences):
    a piece for each of equal ranges of terms."""
    parts = 1 + sum(len(t) for t, _ in found) * 8 // PIECE
    bounds = [(i << 64) // parts - (1 << 63) for i in range(1, parts)]
    cuts = [[0, *np.searchsorted(t, np.array(bounds, np.int64)).tolist(), len(t)] for t, _ in found]
    for i in range(parts):
        spans = [slice(c[i], c[i + 1]) for c in cuts]
        term = np.concatenate([np.empty(0, np.int64), *(t[s] for (t, _), s in zip(found, spans, strict=True))])
        order = np.argsort(term, kind="stable")
        terms, sizes = np.unique(term[order], return_counts=True)
        doc = np.repeat(np.arange(len(found), dtype=np.int32), [c[i + 1] - c[i] for c in cuts])
        tf = [np.empty(0, np.int32), *(n[s] for (_, n), s in zip(found, spans, strict=True))]
        tf = np.concatenate(tf).astype(np.int32)
        yield {"terms": terms, "sizes": sizes.astype(np.int32), "docs": doc[order], "tf": tf[order]}


def _in_pieces(rows: DataFrame, *columns: str) -> DataFrame:
    """A row for each piece of ``columns``, those of one row together and in order; the first
    has ``floors``."""
    sizes = F.array(*map(F.size, columns)).alias("sizes")
    rows = rows.select("floors", sizes, F.posexplode(F.concat(*columns)).alias("at", "piece"))
    return rows.withColumn("floors", F.when(F.col("at") == 0, F.col("floors")))


def _loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, dict[str, np.ndarray]]]:
    """Pieces, and the arrays of each."""
    for batch in slices(batches, 1):
        yield batch, loaded(batch["piece"][0].as_buffer())


INDEX = "n long, words long, pieces array<binary>"


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each run of documents; those without an id come last in it."""
    held, size = [], 0

    def record() -> pa.RecordBatch:
        # blocks of like documents have tight bounds; their order changes nothing else
        held.sort(key=lambda d: d[:3])
        found = [d[4] for d in held]
        lengths = np.array([int(n.sum()) for _, n in found], np.int64)
        ids = np.array([d[3] for d in held if d[3] is not None], np.int64)
        pieces = [dumped({"ids": ids, "lengths": lengths}), *map(dumped, _postings(found))]
        row = [[len(held)], [int(lengths.sum())], pa.array([pieces], pa.list_(pa.binary()))]
        return pa.record_batch(row, names=["n", "words", "pieces"])

    for batch in slices(batches, 64):
        rows = zip(batch["doc_id"].to_pylist(), batch["lang"].to_pylist(), batch["text"], strict=True)
        for doc_id, lang, text in rows:
            text = text.as_py()
            terms, n = terms_of(text)
            held.append((doc_id is None, lang or "", len(text), doc_id, (terms, n.astype(np.int32))))
            size += len(text)
        if size > SHARD_BYTES:
            yield record()
            held, size = [], 0
    if held:
        yield record()


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, made in _loaded(batches):
        if "terms" in made:
            terms, sizes = made["terms"], made["sizes"].astype(np.int64)
            for at in range(0, len(terms), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.record_batch([terms[part], sizes[part]], names=["term", "n"])


class Index:
    """Inverted index of a shard: postings of the words outside ``common`` by term, and a
    column for each common word with its highest score in each block of documents.

    Documents have places in which those of one block stand ``blocks`` apart.
    """

    def __init__(self, texts: list[str], mean_words: float, common: np.ndarray):
        found = [terms_of(t) for t in texts]
        lengths = np.array([int(n.sum()) for _, n in found], np.int64)
        self._take(lengths, len(texts), _postings(found), mean_words, common)

    @classmethod
    def read(
        cls, head: dict[str, np.ndarray], parts: Iterator[dict], mean_words: float, common: np.ndarray
    ) -> Index:
        """Of a row of the written index, without the documents that have no id."""
        index = cls.__new__(cls)
        index._take(head["lengths"], len(head["ids"]), parts, mean_words, common)
        return index

    def _take(
        self, lengths: np.ndarray, n_docs: int, parts: Iterator[dict], mean_words: float, common: np.ndarray
    ):
        self.n_docs, self.blocks, self.common = n_docs, -(-n_docs // WINDOW), common
        norm = K1 * (1 - B + B * lengths / max(mean_words, 1e-9))
        self.columns = np.zeros((self.blocks * WINDOW, len(common)))
        kept = []
        for part in parts:
            terms, sizes, doc, tf = (part[c] for c in ("terms", "sizes", "docs", "tf"))
            if n_docs < len(lengths):
                known = doc < n_docs
                term = np.repeat(np.arange(len(sizes)), sizes)[known]
                doc, tf, sizes = doc[known], tf[known], np.bincount(term, minlength=len(sizes))
            # what a posting adds for an idf of 1
            impact = tf * (K1 + 1)
            impact /= norm[doc] + tf
            place = (doc % WINDOW).astype(np.int64)
            place *= self.blocks
            place += doc // WINDOW
            column, often = _places(common, terms)
            here = np.repeat(often, sizes)
            self.columns[place[here], np.repeat(column[often], sizes[often])] = impact[here]
            here = ~here
            kept.append((place[here], impact[here], terms[~often], sizes[~often]))
        self.most = self.columns.reshape(WINDOW, self.blocks, len(common)).max(0)
        self.place, self.impact, self.terms, self.sizes = map(np.concatenate, zip(*kept, strict=True))
        self.edges = np.append(0, np.cumsum(self.sizes, dtype=np.int64))

    def search(self, terms: np.ndarray, idf: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that can be among the k best, and their scores; all of the k best (with
        equals of the last) are there."""
        return next(self.searches(terms, idf, [np.arange(len(terms))], np.zeros(1), k))

    def searches(
        self, terms: np.ndarray, idf: np.ndarray, queries: list[np.ndarray], floors: np.ndarray, k: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``search`` for each query, whose terms are given by their places in ``terms``; what
        scores below its floor can be left out."""
        at, here = _places(self.terms, terms)
        start, end = (np.where(here, self.edges[at + i], 0) if len(self.terms) else 0 * at for i in (0, 1))
        weights = np.zeros(len(self.terms))
        weights[at[here]] = idf[here]
        gain = self.impact * np.repeat(weights, self.sizes)
        column, often = _places(self.common, terms)
        for first in range(0, len(queries), TOGETHER):
            some = queries[first : first + TOGETHER]
            share = np.zeros((len(some), len(self.common)))
            for row, query in zip(share, some, strict=True):
                found = query[often[query]]
                row[column[found]] = idf[found]
            bounds = share @ self.most.T
            least = floors[first : first + TOGETHER].tolist()
            for query, row, bound, floor in zip(some, share, bounds, least, strict=True):
                if not self.n_docs:
                    yield np.empty(0, np.int64), np.empty(0)
                    continue
                found = query[end[query] > start[query]]
                spans = list(map(slice, start[found].tolist(), end[found].tolist()))
                rare = self._summed(spans, gain)
                columns = column[query[often[query]]]
                yield self._best(rare, row, bound, columns, floor, k)

    def _summed(self, spans: list[slice], gain: np.ndarray) -> np.ndarray:
        if not spans:
            return np.zeros(self.blocks * WINDOW)
        place = np.concatenate([self.place[s] for s in spans])
        return np.bincount(place, np.concatenate([gain[s] for s in spans]), self.blocks * WINDOW)

    def _best(
        self,
        rare: np.ndarray,
        weights: np.ndarray,
        common: np.ndarray,
        columns: np.ndarray,
        floor: float,
        k: int,
    ) -> tuple[np.ndarray, np.ndarray]:
        bound = rare.reshape(WINDOW, self.blocks) + common
        most = bound.max(0)

        def scored(places: np.ndarray) -> np.ndarray:
            return rare[places] + self.columns[places] @ weights

        if not floor:
            # the best of each of the best blocks
            n = min(max(WINDOW, 2 * k), self.blocks)
            blocks = np.argpartition(most, self.blocks - n)[self.blocks - n :]
            floor = _last_of(scored(bound[:, blocks].argmax(0) * self.blocks + blocks), k)
        # bounds and scores sum in different orders, so a bound has some room
        floor *= ROOM
        blocks = np.flatnonzero((most >= floor) & (most > 0))
        part = bound[:, blocks]
        row, at = np.nonzero((part >= floor) & (part > 0))
        chosen = row * self.blocks + blocks[at]
        score = scored(chosen)
        chosen = chosen[(score > 0) & (score >= max(floor, _last_of(score, k) * ROOM))]
        # one order of summing, so that equal documents of all shards have equal scores
        shares = np.ascontiguousarray(self.columns[np.ix_(chosen, columns)]) * weights[columns]
        return chosen % self.blocks * WINDOW + chosen // self.blocks, rare[chosen] + shares.sum(1)


def _last_of(scores: np.ndarray, k: int) -> float:
    """The k-th best score, 0 if there are fewer."""
    return float(np.partition(scores, -k)[-k]) if len(scores) >= k else 0.0


def _places(known: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each term in the ascending ``known``, and whether it is there."""
    if not len(known):
        return np.zeros(len(terms), np.int64), np.zeros(len(terms), bool)
    at = np.searchsorted(known, terms)
    at[at == len(known)] = 0
    return at, known[at] == terms


def _packed(queries: pa.Table) -> pa.Table:
    """Queries in one piece: their distinct terms, ascending, and each query's places in these
    in the order of its terms."""
    terms, held = queries["terms"].combine_chunks(), queries["held"].combine_chunks()
    asked, first, at = np.unique(terms.values.to_numpy(), return_index=True, return_inverse=True)
    made = {
        "query_ids": queries["query_id"].to_numpy(),
        "counts": np.diff(terms.offsets.to_numpy()),
        "asked": asked,
        "held": held.values.to_numpy()[first],
        "at": at.astype(np.int32),
    }
    return pa.table([queries["pack"][:1].combine_chunks(), pa.array([dumped(made)])], names=["pack", "asked"])


def _searched(k: int, n: int, mean_words: float, common: np.ndarray):
    def found(index: Index, ids: np.ndarray, pack: dict[str, np.ndarray], floors: dict) -> pa.RecordBatch:
        idf = np.log1p((n - pack["held"] + 0.5) / (pack["held"] + 0.5))
        edges = np.append(0, np.cumsum(pack["counts"]))
        queries = [pack["at"][a:b] for a, b in pairwise(edges.tolist())]
        least = np.array([floors.get(i, 0.0) for i in pack["query_ids"].tolist()])
        docs, scores, sizes = [], [], []
        for doc, score in index.searches(pack["asked"], idf, queries, least, k):
            best = np.lexsort((ids[doc], -score))[:k]
            docs.append(ids[doc[best]])
            scores.append(score[best])
            sizes.append(len(best))
        return pa.record_batch(
            [np.repeat(pack["query_ids"], sizes), np.concatenate(docs), np.concatenate(scores)],
            names=["query_id", "doc_id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(batches)
        for batch, first in pieces:
            sizes, floors = batch["sizes"][0].as_py(), dict(batch["floors"][0].as_py() or ())
            got = [first, *(next(pieces)[1] for _ in range(sizes[0]))]
            *packs, head = got
            parts = (next(pieces)[1] for _ in range(sizes[1] - 1))
            index = Index.read(head, parts, mean_words, common)
            for pack in packs:
                yield found(index, head["ids"], pack, floors)

    return run


def search(docs: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents for every row whose doc_id is
    divisible by ``every``, all distinct words of its text being the query.

    Ranks follow the score, then the smaller doc_id; only documents that share a word with
    the query come. Rows of one doc_id are ranked each; of repeated query rows one runs.
    Rows without a doc_id are neither queries nor results but count in the statistics; a
    query without words has no results; other columns are not carried; an empty table gives
    no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string"), text_of().alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # small parts of the table make one shard
    dealt = rows.coalesce(max(LEAST_SHARDS, size // SHARD_BYTES))
    with settings(spark, ONE_TO_A_FILE):
        index = written(dealt.mapInArrow(_indexed, INDEX), "index")
    with settings(spark, ONE_TO_A_BATCH):
        stats = index.agg(F.sum("n").alias("n"), F.sum("words").alias("words"), F.collect_list("words").alias("each"))
        stats = stats.first()
        held = written(
            _in_pieces(index.withColumn("floors", F.lit(None).cast("map<long,double>")), "pieces")
            .mapInArrow(_document_counts, "term long, n long")
            .groupBy("term")
            .agg(F.sum("n").alias("n")),
            "held",
        )
    n, shards = stats["n"] or 0, len(stats["each"])
    often = held.where(F.col("n") * COMMON > n).orderBy(F.desc("n"), "term")
    often = often.limit(min(MOST_COMMON, COMMON_CELLS * shards // max(n, 1))).toArrow()
    common = np.sort(often["term"].to_numpy())
    asked = rows.where(F.col("doc_id") % every == 0).select("doc_id", "text")
    asked = asked.mapInArrow(_query_terms, "doc_id long, term long").distinct()
    queries = written(
        asked.join(held, "term")
        .groupBy(F.col("doc_id").alias("query_id"))
        # by frequency, so that the sums of all shards have one order
        .agg(F.sort_array(F.collect_list(F.struct("n", "term"))).alias("t"))
        .select("query_id", F.col("t.term").alias("terms"), F.col("t.n").alias("held")),
        "queries",
    )
    size = queries.agg(F.sum(TERM_BYTES * F.size("terms"))).first()[0] or 0
    groups = max(1, -(-size // LEAST_GROUP))
    packs = groups * -(-LEAST_GROUP // PIECE)
    pack = F.pmod(F.xxhash64("query_id"), F.lit(packs)).alias("pack")
    packed = queries.select("*", pack).groupBy("pack").applyInArrow(_packed, "pack long, asked binary")
    packed = written(packed, "packed")
    run = _searched(k, n, (stats["words"] or 0) / max(n, 1), common)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")

    # the first shards, as many as the square root of all, are the largest
    first = sorted(stats["each"], reverse=True)[math.isqrt(shards) : math.isqrt(shards) + 1]
    is_first = F.col("words") > F.lit(first[0] if first else -1)

    def best(group: int) -> DataFrame:
        asked = F.broadcast(packed.where(F.col("pack") % groups == group).agg(F.collect_list("asked").alias("asked")))

        def searched(some: DataFrame, floors: DataFrame) -> DataFrame:
            rows = _in_pieces(some.crossJoin(asked).crossJoin(floors), "asked", "pieces")
            return rows.mapInArrow(run, "query_id long, doc_id long, score double")

        def ranked(found: DataFrame) -> DataFrame:
            rows = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            return rows.select("query_id", "rank", "doc_id", "score")

        none = spark.range(1).select(F.lit(None).cast("map<long,double>").alias("floors"))
        head = written(ranked(searched(index.where(is_first), none)), "first")
        last = head.where(F.col("rank") == k).agg(F.collect_list(F.struct("query_id", "score")).alias("last"))
        floors = F.broadcast(last.select(F.map_from_entries("last").alias("floors")))
        rest = searched(index.where(~is_first), floors)
        return written(ranked(rest.unionAll(head.select("query_id", "doc_id", "score"))), "found")

    with settings(spark, ONE_TO_A_BATCH):
        return reduce(DataFrame.unionAll, map(best, range(groups)))
