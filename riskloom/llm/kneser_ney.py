"""Quality by an interpolated modified Kneser-Ney model of word n-grams.

The model is trained on trusted text: documents that labels call good, but for one part in
``FOLDS``. The n-grams of all documents go to shards by the last unit of their context, so a
shard counts its part of the model and scores with it; very common units are split over shards
by the unit before, and then get their counts of the second order from a table, as all shards do
those of the first order. Texts are cut in ``ROUNDS``, each for a part of the shards, and what a
round has shuffled is deleted before the next. Each document gets its perplexity. A document is
kept if its perplexity is at most the threshold of its language, a quantile of the trusted
documents of that language that were left out of training. Units can be bytes as well.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import dumped, encoded, fold, loaded, slices, text_of, words
from riskloom.session import written

QUANTILE = 0.995
# Trusted documents whose id's crc32 modulo 10 is 0 set the thresholds.
FOLDS, HELD_OUT = 10, 0
# Ids that may be broadcast; more of them are joined by a shuffle.
BROADCAST_IDS = 1_000_000
# N-grams a task holds before it deals them out.
HELD = 2_000_000
# Parts in which the n-grams are scored one after the other; bytes of text to a shard.
ROUNDS, SHARD_BYTES, LEAST_SHARDS = 4, 10_000_000, 64
# Units are counted in one part of so many of the ids to find the common ones; only the balance
# of the shards depends on it.
SAMPLE = 10

@dataclass(frozen=True)
class Units:
    """What n-grams are made of; ``base`` is the number of units, None if it is counted."""

    order: int
    of_bytes: bool
    base: int | None

    @property
    def columns(self) -> list[str]:
        return [f"g{k}" for k in range(1, self.order + 1)]

    def grams(self, texts: Iterable[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
        """Columns of the n-grams that end at each unit of the texts, and the units of each."""
        if self.of_bytes:
            parts = [encoded(t) for t in texts]
            units = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
        else:
            parts = [words(t) for t in texts]
            hashes = map(xxhash.xxh3_64_intdigest, chain.from_iterable(parts))
            units = np.fromiter(hashes, np.uint64, sum(map(len, parts))).view(np.int64)
        sizes, before = np.array([len(p) for p in parts], np.int64), self.order - 1
        # a text begins with units of its own
        place = np.arange(len(units)) + np.repeat(before * np.arange(len(parts)), sizes)
        data = np.full(len(units) + before * len(parts), 2, np.int64)
        data[place + before] = units
        return [data[place + k] for k in range(self.order)], sizes

    def keys(self, columns: list[np.ndarray]) -> np.ndarray:
        """One number for each n-gram: its bytes, or a hash."""
        out = columns[0].view(np.uint64) if not self.of_bytes else columns[0]
        for c in columns[1:]:
            if self.of_bytes:
                out = (out << 8) | c
            else:
                out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + c.view(np.uint64)
        return out if self.of_bytes else out.view(np.int64)


BYTES = Units(4, True, 256)
WORDS = Units(3, False, None)


def _mixed(column: np.ndarray) -> np.ndarray:
    return ((column.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


@dataclass(frozen=True)
class Deal:
    """Which n-grams go to which shard; ``common`` units, ascending, have several each."""

    units: Units
    shards: int
    common: np.ndarray
    parts: np.ndarray

    def is_common(self, column: np.ndarray) -> np.ndarray:
        return np.isin(column, self.common)

    def shard(self, columns: list[np.ndarray]) -> np.ndarray:
        last, before = columns[-2], columns[-3]
        out = _mixed(last)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, last), len(self.common) - 1)
            out += _mixed(before) % np.where(self.common[at] == last, self.parts[at], 1)
        return out % self.shards

    def cut(self, turn: int | None):
        """(shard, data) of the texts' n-grams, of all shards or those of a round."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, docs, size = [], [], 0

            def record() -> pa.RecordBatch:
                shard, doc, *columns = map(np.concatenate, zip(*held, strict=True))
                # equal contexts stand together and pack well
                taken = np.argsort((shard << 31) | _mixed(columns[-2]))
                shard = shard[taken]
                which, start = np.unique(shard, return_index=True)
                keys, trained = np.array([d[0] for d in docs], np.int64), np.array([d[1] for d in docs], np.int8)
                out = []
                for a, b in pairwise([*start.tolist(), len(shard)]):
                    found, index = np.unique(doc[taken[a:b]], return_inverse=True)
                    known, places = np.unique([c[taken[a:b]] for c in columns], return_inverse=True)
                    places = places.reshape(len(columns), -1).astype(np.uint16 if len(known) < 1 << 16 else np.int32)
                    made = dict(zip(self.units.columns, places, strict=True))
                    made |= {"known": known, "doc": index.astype(np.int32)}
                    out.append(dumped(made | {"keys": keys[found], "trained": trained[found]}))
                return pa.record_batch([which.astype(np.int32), pa.array(out, pa.binary())], names=["shard", "data"])

            for batch in slices(batches, 64):
                columns, sizes = self.units.grams(t.as_py() for t in batch["text"])
                shard = self.shard(columns)
                taken = slice(None) if turn is None else np.flatnonzero(shard % ROUNDS == turn)
                doc = np.repeat(np.arange(len(docs), len(docs) + len(sizes), dtype=np.int32), sizes)
                held.append([x[taken] for x in (shard, doc, *columns)])
                docs += zip(batch["key"].to_pylist(), batch["trained"].to_pylist(), strict=True)
                size += len(held[-1][0])
                if size > HELD:
                    yield record()
                    held, docs, size = [], [], 0
            if size:
                yield record()

        return run


def _joined(units: Units, table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Columns of a shard's n-grams, the document of each, and the documents' keys and whether
    they are learned from."""
    parts = [loaded(d.as_buffer()) for d in table["data"]]
    offsets = np.cumsum([0, *(len(p["keys"]) for p in parts)])
    columns = [np.concatenate([p["known"][p[c]] for p in parts]) for c in units.columns]
    doc = np.concatenate([p["doc"] + o for p, o in zip(parts, offsets, strict=False)])
    return columns, doc, *(np.concatenate([p[c] for p in parts]) for c in ("keys", "trained"))


def _levels(units: Units, columns: list[np.ndarray], seen: np.ndarray):
    """From the highest order to 2: columns of the distinct n-grams, their counts among the
    ``seen``, and the place of each n-gram of the order above. Below the highest order the count
    of a gram is the number of distinct units before it."""
    for _ in range(units.order - 1):
        _, first, place = np.unique(units.keys(columns), return_index=True, return_inverse=True)
        n = np.bincount(place, seen, len(first)).astype(np.int64)
        columns = [c[first] for c in columns]
        yield columns, n, place
        columns, seen = columns[1:], n > 0


def _trained(deal: Deal):
    """(kind, a, b, n): units with the number of common or other units before them (u, a);
    n-grams of a common unit with their counts of the second order (g, a, b); how many n-grams
    of an order have a count of up to 4 (c, a, b)."""

    def run(table: pa.Table) -> pa.Table:
        columns, doc, _, trained = _joined(deal.units, table)
        out = []
        for order, (grams, n, _) in zip(
            range(deal.units.order, 1, -1), _levels(deal.units, columns, trained[doc]), strict=True
        ):
            if order == 2:
                common = deal.is_common(grams[0])
                out.append(("g", grams[0][common], grams[1][common], n[common]))
                found, times = np.unique(grams[1][~common], return_counts=True)
                out.append(("u", found, np.zeros(len(found), np.int64), times))
                n = n[~common]
            counts = np.bincount(np.minimum(n, 5), minlength=6)[1:5]
            out.append(("c", np.full(4, order), np.arange(1, 5), counts))
        kind = pa.array(np.repeat([k for k, *_ in out], [len(x[1]) for x in out]), pa.string())
        return pa.table([kind, *map(np.concatenate, list(zip(*out, strict=True))[1:])], names=["kind", "a", "b", "n"])

    return run


def _discounts(n: dict[int, int]) -> list[float]:
    """Discounts of counts 0, 1, 2 and 3 or more, from the counts of counts."""
    n1, n2 = n.get(1, 0), n.get(2, 0)
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    out = [0.0]
    for k in (1, 2, 3):
        here, above = n.get(k, 0), n.get(k + 1, 0)
        out.append(min(max(k - (k + 1) * y * above / here, 0.0), float(k)) if here else 0.5)
    return out


def _likelihoods(deal: Deal, discounts: dict[int, list[float]], total: int, below: float, base: int):
    """(key, log_likelihood, n_units) of each document in a shard; ``total`` and ``below`` are
    those of the first order, which interpolates with equal shares of ``base`` units."""
    units = deal.units

    def run(table: pa.Table, lower: pa.Table) -> pa.Table:
        columns, doc, keys, trained = _joined(units, table)
        tables = list(_levels(units, columns, trained[doc]))[::-1]
        second = lower["second"].to_numpy()
        last, unit, count = (lower[c].to_numpy() for c in ("last", "unit", "n"))
        # the first order
        found, place = np.unique(tables[0][0][1], return_inverse=True)
        n = _looked_up(unit[~second], count[~second], found)
        p = np.full(len(found), 1 / base)
        if total:
            p = (n - np.array(discounts[1])[np.minimum(n, 3)]) / total + below * p
        for order, (grams, n, next_place) in enumerate(tables, 2):
            off = np.array(discounts[order])
            contexts, context = np.unique(units.keys(grams[:-1]), return_inverse=True)
            if order == 2:
                common = deal.is_common(grams[0])
                n = np.where(common, 0, n)
            totals = np.bincount(context, n, len(contexts))
            left = np.bincount(context, off[np.minimum(n, 3)], len(contexts))
            if order == 2 and common.any():
                # what all shards of a common unit have counted
                pairs = units.keys([last[second], unit[second]])
                n = n + np.where(common, _looked_up(pairs, count[second], units.keys(grams)), 0)
                at = np.minimum(np.searchsorted(contexts, last[second]), len(contexts) - 1)
                here = contexts[at] == last[second]
                more = count[second][here]
                totals += np.bincount(at[here], more, len(contexts))
                left += np.bincount(at[here], off[np.minimum(more, 3)], len(contexts))
            p = p[place]
            all_of = totals[context]
            seen = all_of > 0
            mine = (n - off[np.minimum(n, 3)] + left[context] * p)[seen] / all_of[seen]
            p[seen] = mine
            place = next_place
        logp = np.log(p)[place]
        which, doc_of = np.unique(keys, return_inverse=True)
        doc = doc_of[doc]
        sums, sizes = np.bincount(doc, logp, len(which)), np.bincount(doc, minlength=len(which))
        return pa.table([which, sums, sizes.astype(np.int64)], names=["key", "log_likelihood", "n_units"])

    return run


def _looked_up(keys: np.ndarray, n: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The number of each key, 0 for one that is not there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, n[at], 0)


def _wanted(units: Units):
    """Distinct (shard, unit) of the n-grams' last units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for shard, data in zip(batch["shard"].to_pylist(), batch["data"], strict=True):
                made = loaded(data.as_buffer())
                found.setdefault(shard, []).append(made["known"][np.unique(made[units.columns[-1]])])
        for shard, sets in found.items():
            unit = np.unique(np.concatenate(sets))
            yield pa.record_batch([np.full(len(unit), shard, np.int32), unit], names=["shard", "unit"])

    return run


def _unit_counts(units: Units):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns, _ = units.grams(t.as_py() for t in batch["text"])
            found, n = np.unique(columns[-1], return_counts=True)
            yield pa.record_batch([found, n], names=["unit", "n"])

    return run


def _deal(texts: DataFrame, sample: DataFrame, units: Units) -> Deal:
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-max(LEAST_SHARDS, size // SHARD_BYTES) // ROUNDS) * ROUNDS
    counts = written(
        sample.select("text").mapInArrow(_unit_counts(units), "unit long, n long").groupBy("unit").agg(F.sum("n").alias("n")),
        "units",
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    # what is more than half a shard
    common = counts.where(F.col("n") * shards * 2 > total).orderBy("unit").toArrow()
    parts = -(-common["n"].to_numpy() * 4 * shards // max(total, 1))
    return Deal(units, shards, common["unit"].to_numpy(), parts)


def perplexities(texts: DataFrame, sample: DataFrame, units: Units) -> DataFrame:
    """(key, perplexity) of ``texts`` (key, text, trained) with units; equal keys are one."""
    deal = _deal(texts, sample, units)
    cuts = "shard int, data binary"
    counted = written(
        texts.where("trained")
        .mapInArrow(deal.cut(None), cuts)
        .repartition(deal.shards, "shard")
        .groupBy("shard")
        .applyInArrow(_trained(deal), "kind string, a long, b long, n long"),
        "counted",
    )
    second = written(
        counted.where("kind = 'g'").groupBy(F.col("a").alias("last"), F.col("b").alias("unit")).agg(F.sum("n").alias("n")),
        "second",
    )
    before = second.groupBy("unit").agg(F.count("*").alias("n"))
    before = before.unionAll(counted.where("kind = 'u'").select(F.col("a").alias("unit"), "n"))
    first = written(before.groupBy("unit").agg(F.sum("n").alias("n")), "first")
    few = [(2, second), (1, first)]
    counts = [t.where("n < 5").groupBy(F.lit(k).alias("a"), F.col("n").alias("b")).agg(F.count("*").alias("n")) for k, t in few]
    counts = counts[0].unionAll(counts[1]).unionAll(counted.where("kind = 'c'").select("a", "b", "n"))
    of: dict[int, dict[int, int]] = {k: {} for k in range(1, units.order + 1)}
    for r in counts.groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        of[r.a][r.b] = r.n
    discounts = {k: _discounts(n) for k, n in of.items()}
    held = first.agg(F.count("*").alias("units"), F.sum("n").alias("total")).first()
    total = held["total"] or 0
    once, twice = of[1].get(1, 0), of[1].get(2, 0)
    left = np.dot(discounts[1][1:], [once, twice, held["units"] - once - twice])
    base = units.base or held["units"] + 1
    run = _likelihoods(deal, discounts, total, float(left) / max(total, 1), base)
    # all shards of a common unit
    spark = texts.sparkSession
    shards = [
        (unit, (_mixed(np.array([unit]))[0] + i) % deal.shards)
        for unit, n in zip(deal.common.tolist(), deal.parts.tolist(), strict=True)
        for i in range(min(n, deal.shards))
    ]
    shards = spark.createDataFrame([(u, int(s)) for u, s in shards], "last long, shard int")
    spread = second.join(F.broadcast(shards), "last")

    def scored(turn: int) -> DataFrame:
        cut = texts.mapInArrow(deal.cut(turn), cuts).repartition(deal.shards // ROUNDS, "shard")
        wanted = cut.mapInArrow(_wanted(units), "shard int, unit long").join(first, "unit")
        lower = wanted.select("shard", F.lit(False).alias("second"), F.lit(0).cast("long").alias("last"), "unit", "n")
        more = spread.where(F.col("shard") % ROUNDS == turn).select("shard", F.lit(True).alias("second"), "last", "unit", "n")
        found = cut.groupBy("shard").cogroup(lower.unionAll(more).groupBy("shard"))
        found = found.applyInArrow(run, "key long, log_likelihood double, n_units long")
        return written(found.groupBy("key").agg(F.sum("log_likelihood").alias("l"), F.sum("n_units").alias("n")), "scored")

    parts = reduce(DataFrame.unionAll, map(scored, range(ROUNDS)))
    sums = parts.groupBy("key").agg(F.sum("l").alias("l"), F.sum("n").alias("n"))
    return sums.where("n > 0").select("key", F.exp(-F.col("l") / F.col("n")).alias("perplexity"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that labels call good and never bad; broadcast where there are few enough."""
    ids = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("least"))
        .where("least = 1")
        .select("doc_id", F.lit(True).alias("trusted"))
    )
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def judged(docs: DataFrame, labels: DataFrame, units: Units = BYTES) -> DataFrame:
    """Per row: doc_id, lang, n_bytes, perplexity, threshold, kept.

    The perplexity is that of a unit. Texts without units have none and are not kept. Trusted
    documents of one part of the ids are not learned from and set the thresholds. Languages
    without any of them, and rows without a language, go by all of them; if there are none at
    all, the trusted documents that were learned from serve, and without any of these every
    text with units is kept. Repeated rows give repeated rows; other columns are not carried;
    an empty table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string"), "text"
    ).join(trusted_ids(labels), "doc_id", "left")
    rows = rows.withColumn("trusted", F.col("trusted").isNotNull())
    rows = rows.withColumn("trained", F.col("trusted") & (fold("doc_id", FOLDS) != HELD_OUT))
    rows = rows.withColumn("key", F.xxhash64("doc_id", text_of()))
    texts = rows.where("text is not null").select("key", F.col("text").cast("string"), "trained")
    sample = rows.where((fold("doc_id", SAMPLE) == 0) & F.col("text").isNotNull())
    found = perplexities(texts, sample, units)
    kept = rows.select("key", "doc_id", "lang", "trusted", "trained", F.octet_length(text_of()).cast("long").alias("n_bytes"))
    scored = written(kept.join(found, "key", "left").drop("key"), "perplexities")
    limit = F.percentile_approx("perplexity", QUANTILE, 10_000).alias("threshold")
    good = scored.where("trusted and perplexity is not null")
    left_out = good.where("not trained")
    if not left_out.isEmpty():
        good = left_out
    by_lang = good.where("lang is not null").groupBy("lang").agg(limit)
    overall = good.agg(limit).first()["threshold"]
    return (
        scored.join(by_lang, "lang", "left")
        .withColumn("threshold", F.coalesce("threshold", F.lit(overall).cast("double")))
        .select(
            "doc_id",
            "lang",
            "n_bytes",
            "perplexity",
            "threshold",
            F.when(F.col("perplexity").isNull(), False)
            .otherwise(F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
            .alias("kept"),
        )
    )
