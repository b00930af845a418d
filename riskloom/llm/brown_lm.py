"""Brown class-based bigram language model, fitted by exchange clustering.

Units are the words that occur at least ``LEAST`` times in the training documents, the end
mark, and for all other words ``SHAPES`` groups by their last two bytes. Exchange moves every
unit to the class under which its neighbours' classes are likeliest. It starts among the
words with a share of at least 1 / ``CORE`` of the tokens, until no move helps; all other
words begin with the class of their shape and then all units move in ``ALL_ROUNDS`` rounds.
Counts of neighbours are a table dealt out by unit, which the classes of a part of the units
meet in joins; tasks are sent the class table alone. The probability of a token is that of
its class after the class before it, of its unit in the class, and of a rare word in its
group; what is unseen shares the discounted mass of its group, as one type.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.blocks import answered, asked, blocked
from riskloom.llm.common import fold, slices, words
from riskloom.session import FREED_CONF, settings, written

FOLDS, HELD_OUT = 7, 2
# Occurrences from which a word is a unit of its own, however large the corpus.
LEAST = 5
# At most so many words are clustered first, among themselves and the shapes.
CORE = 1 << 14
SHAPES = 256
CLASSES, ROUNDS, ALL_ROUNDS = 64, 8, 2
# Unit of the end mark, after those of the shapes; words follow.
END = SHAPES
# Training tokens for each part that units are dealt to.
PART_TOKENS = 2_000_000
DISCOUNT, TRUST = 0.75, 0.98
# Counts a task holds before it passes them on.
HELD = 400_000
# Rows hold a text or many packed counts each: few of them are read or sent to Python at once.
BATCHES = {
    "spark.sql.parquet.columnarReaderBatchSize": "256",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
}

# Those of packed counts are the largest: a batch of a thousand was all that a task read.
PACKED_BATCHES = {
    "spark.sql.parquet.columnarReaderBatchSize": "32",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "32",
}


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        out = pa.record_batch(
            [pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())],
            names=["key", "n"],
        )
        count.clear()
        return out

    for batch in slices(batches, 64):
        for text in batch["text"]:
            count.update(words(text.as_py()))
        if len(count) > HELD:
            yield flushed()
    yield flushed()


class _Units(dict):
    """Unit of a word in the first clustering: its own, or after the end mark the one of its
    shape."""

    def __init__(self, frequent: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(frequent))
        self.first = len(frequent) + 1

    def __missing__(self, word: bytes) -> int:
        return self.first + crc32(word[-2:]) % SHAPES


def _pair_counts(frequent: list[bytes]):
    units, end = None, len(frequent)
    total = end + 1 + SHAPES

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal units
        units = units or _Units(frequent)
        codes, held, size = [], [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            keys, n = np.unique(np.concatenate(codes), return_counts=True)
            for k, m in held:
                keys = np.concatenate([keys, k])
                n = np.concatenate([n, m])
            keys, place = np.unique(keys, return_inverse=True)
            return keys, np.bincount(place, n).astype(np.int64)

        def record(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([keys // total, keys % total, n], names=["u", "v", "n"])

        for batch in slices(batches, 64):
            for text in batch["text"]:
                parts = words(text.as_py())
                ids = np.empty(len(parts) + 2, np.int64)
                ids[0] = ids[-1] = end
                ids[1:-1] = np.fromiter(map(units.__getitem__, parts), np.int64, len(parts))
                codes.append(ids[:-1] * total + ids[1:])
                size += len(ids)
            if size > 4 * HELD:
                held[:] = [summed()]
                codes, size = [], 0
                if len(held[0][0]) > 2 * HELD:
                    yield record(*held.pop())
        if codes:
            yield record(*summed())
        elif held:
            yield record(*held[0])

    return counted


def _toward(counts: np.ndarray, classes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best class of each unit by its counts of left and right classes, and what it gains."""
    row = table.sum(1)
    after = np.log(table + 0.5) - np.log(row + 0.5 * CLASSES)[:, None]
    left, right = counts[:, :CLASSES], counts[:, CLASSES:]
    score = left @ after + right @ after.T - counts.sum(1)[:, None] / 2 * np.log(row + 1)
    to, at = score.argmax(1), np.arange(len(counts))
    return to, score[at, to] - score[at, classes]


def _by_turns(unit: np.ndarray, gain: np.ndarray, turn: int) -> np.ndarray:
    return (gain > 0) & ((turn == 0) | ((unit * 2654435761 >> 7) % 2 == turn % 2))


def _context(classes: np.ndarray, of: str):
    """Per-unit counts of neighbouring classes, summed inside a partition that holds all
    rows of its units; then ``of`` gives either class pairs or the best class of each unit."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        k = CLASSES
        units, counts = np.zeros(0, np.int64), np.zeros((0, 2 * k))
        for batch in batches:
            u, side, v, n = (batch[c].to_numpy() for c in ("u", "side", "v", "n"))
            found, place = np.unique(u, return_inverse=True)
            cells = place * (2 * k) + side * k + classes[v]
            part = np.bincount(cells, n, minlength=len(found) * 2 * k).reshape(-1, 2 * k)
            both, place = np.unique(np.concatenate([units, found]), return_inverse=True)
            merged = np.zeros((len(both), 2 * k))
            merged[place[: len(units)]] += counts
            merged[place[len(units) :]] += part
            units, counts = both, merged
        return units, counts

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, counts = gathered(batches)
        total = np.zeros((CLASSES, CLASSES))
        np.add.at(total, classes[units], counts[:, CLASSES:])
        a, b = np.nonzero(total)
        yield pa.record_batch([a, b, total[a, b].astype(np.int64)], names=["a", "b", "n"])

    def best(table: np.ndarray):
        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            units, counts = gathered(batches)
            to, gain = _toward(counts, classes[units], table)
            yield pa.record_batch([units, to.astype(np.int64), gain], names=["u", "to", "gain"])

        return moved

    return pairs if of == "pairs" else best


def _likelihood(table: np.ndarray) -> float:
    """Class part of the log likelihood of a class bigram model."""

    def h(x: np.ndarray) -> float:
        x = x[x > 0]
        return float((x * np.log(x)).sum())

    return h(table) - h(table.sum(0)) - h(table.sum(1))


def exchange(pairs: DataFrame, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit, and class bigram counts.

    The most frequent units start in classes of their own, others in turn. In each
    round tasks propose the best class of their units; half of the units, by turns, move, so
    that neighbours don't swap for ever. The best clustering met is kept. The driver holds a
    number for each unit and pair of classes, which parameters bound.
    """
    order = np.argsort(-counts, kind="stable")
    classes = np.empty(len(counts), np.int64)
    classes[order] = np.arange(len(counts)) % CLASSES
    both = pairs.selectExpr("u", "1 as side", "v", "n").unionByName(
        pairs.selectExpr("v as u", "0 as side", "u as v", "n")
    )
    parts = max(1, min(64, pairs.sparkSession.sparkContext.defaultParallelism * 2))
    both = written(
        both.select("u", F.col("side").cast("long").alias("side"), "v", "n").repartition(parts, "u"),
        "neighbours",
    ).repartition(parts, "u")

    def tabled(classes: np.ndarray) -> np.ndarray:
        rows = both.mapInArrow(_context(classes, "pairs"), "a long, b long, n long")
        found = rows.groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
        table = np.zeros((CLASSES, CLASSES))
        table[found["a"].to_numpy(), found["b"].to_numpy()] = found["n"].to_numpy()
        return table

    table = tabled(classes)
    best, best_table, reached = classes, table, _likelihood(table)
    for turn in range(ROUNDS):
        moves = both.mapInArrow(
            _context(classes, "best")(table), "u long, to long, gain double"
        ).toArrow()
        unit, to = moves["u"].to_numpy(), moves["to"].to_numpy()
        free = _by_turns(unit, moves["gain"].to_numpy(), turn)
        if not free.any() and turn > 1:
            break
        classes = classes.copy()
        classes[unit[free]] = to[free]
        table = tabled(classes)
        if (value := _likelihood(table)) > reached:
            best, best_table, reached = classes, table, value
    return best, best_table


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of one length by their bytes' places, so that codecs meet runs of zeros."""
    return b"".join(c.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns)


def _unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(data, np.uint8).reshape(columns, 4, -1)
    return [np.ascontiguousarray(p.T).view("<u4").ravel().astype(np.int64) for p in planes]


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def _dealt(part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The packed rows of each part; inside one they keep their order."""
    order = np.argsort(part, kind="stable")
    part, columns = part[order], [c[order] for c in columns]
    found, starts = np.unique(part, return_index=True)
    for p, a, b in zip(found.tolist(), starts, [*starts[1:], len(part)], strict=True):
        yield p, _packed(*(c[a:b] for c in columns))


def _neighbours(parts: int):
    """Neighbour counts in packed rows (neighbour's place in its part, unit, n), dealt by the
    neighbour; side 1 has those that follow the unit."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, size = [], 0

        def records() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(codes), return_counts=True)
            u, v = keys >> 32, keys & 0xFFFFFFFF
            rows = [(p, 1, d) for p, d in _dealt(v % parts, v // parts, u, n)]
            rows += [(p, 0, d) for p, d in _dealt(u % parts, u // parts, v, n)]
            part, side, data = zip(*rows, strict=True)
            return pa.record_batch(
                [pa.array(part, pa.int32()), pa.array(side, pa.int32()), pa.array(data, pa.binary())],
                names=["part", "side", "data"],
            )

        for batch in slices(batches, 64):
            for data in batch["units"]:
                ids = np.concatenate([[END], np.frombuffer(data.as_py(), "<u4").astype(np.int64)])
                codes.append(ids[:-1] << 32 | ids[1:])
                size += len(ids)
            if size > HELD:
                yield records()
                codes, size = [], 0
        if codes:
            yield records()

    return counted


def _by_class(parts: int):
    """Counts of neighbours' classes in packed rows (unit's place, side and class, n), dealt by
    the unit."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0

        def records() -> pa.RecordBatch:
            key, n = _summed(np.concatenate(keys), np.concatenate(counts))
            unit, cell = key // (2 * CLASSES), key % (2 * CLASSES)
            part, data = zip(*_dealt(unit % parts, unit // parts, cell, n), strict=True)
            return pa.record_batch(
                [pa.array(part, pa.int32()), pa.array(data, pa.binary())], names=["part", "data"]
            )

        for batch in batches:
            for side, data, classes in zip(batch["side"], batch["data"], batch["classes"], strict=True):
                near, unit, n = _unpacked(data.as_py(), 3)
                cell = side.as_py() * CLASSES + np.frombuffer(classes.as_py(), np.uint8)[near]
                keys.append(unit * (2 * CLASSES) + cell)
                counts.append(n)
                size += len(n)
                if size > HELD:
                    yield records()
                    keys, counts, size = [], [], 0
        if keys:
            yield records()

    return counted


def _gathered(context: pa.Table, state: pa.Table) -> pa.Table:
    """State of a part with the counts of its units by side and class of neighbour."""
    if not state.num_rows:
        return pa.table({"part": [], "classes": [], "size": [], "counts": []}, _STATE)
    width = 2 * CLASSES
    cells = len(state["classes"][0].as_py()) * width
    total = np.zeros(cells)
    for data in context["data"]:
        unit, cell, n = _unpacked(data.as_py(), 3)
        total[unit * width + cell] += n  # a row has each of them once
    at = np.flatnonzero(total)
    return state.append_column("counts", [pa.array([_packed(at, total[at])], pa.binary())]).cast(_STATE)


_STATE = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("classes", "size", "counts"))])


def _states(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple]:
    """Part, units, classes, sizes, and counts by side and class, of each row."""
    for batch in batches:
        for row in range(batch.num_rows):
            part = batch["part"][row].as_py()
            classes = np.frombuffer(batch["classes"][row].as_py(), np.uint8).astype(np.int64)
            size = np.frombuffer(batch["size"][row].as_py(), "<i8")
            counts = np.zeros(len(classes) * 2 * CLASSES)
            at, n = _unpacked(batch["counts"][row].as_py(), 2)
            counts[at] = n
            unit = np.arange(len(classes)) * parts + part
            yield part, unit, classes, size, counts.reshape(-1, 2 * CLASSES)


def _state_of(units: DataFrame, parts: int) -> DataFrame:
    """(part, classes, size) of ``units`` (unit, class, n): arrays by a unit's place in its part."""

    def packed(rows: pa.Table) -> pa.Table:
        unit = rows["unit"].to_numpy()
        classes = np.zeros(unit.max() // parts + 1, np.uint8)
        size = np.zeros(len(classes), "<i8")
        classes[unit // parts] = rows["class"].to_numpy()
        size[unit // parts] = rows["n"].to_numpy()
        return pa.table(
            {
                "part": pa.array([unit[0] % parts], pa.int32()),
                "classes": pa.array([classes.tobytes()], pa.binary()),
                "size": pa.array([size.tobytes()], pa.binary()),
            }
        )

    schema = "part int, classes binary, size binary"
    return written(units.groupBy(F.col("unit") % parts).applyInArrow(packed, schema), "classes")


def exchange_all(pairs: DataFrame, state: DataFrame, parts: int) -> tuple[DataFrame, np.ndarray]:
    """State and class bigram counts after moves of all units, the likeliest met.

    ``pairs`` are rows of ``_neighbours``. The driver and the tasks hold the table of
    classes, and tasks the units of a part.
    """

    def met(state: DataFrame) -> tuple[DataFrame, np.ndarray]:
        context = (
            pairs.join(state.select("part", "classes"), "part")
            .select("side", "data", "classes")
            .mapInArrow(_by_class(parts), "part int, data binary")
        )
        full = written(
            context.groupBy("part")
            .cogroup(state.groupBy("part"))
            .applyInArrow(_gathered, "part int, classes binary, size binary, counts binary"),
            "contexts",
        )

        def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((CLASSES, CLASSES))
            for _, _, classes, _, counts in _states(batches, parts):
                np.add.at(total, classes, counts[:, CLASSES:])
            a, b = np.nonzero(total)
            yield pa.record_batch([a, b, total[a, b].astype(np.int64)], names=["a", "b", "n"])

        rows = full.mapInArrow(tables, "a long, b long, n long")
        found = rows.groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
        table = np.zeros((CLASSES, CLASSES))
        table[found["a"].to_numpy(), found["b"].to_numpy()] = found["n"].to_numpy()
        return full, table

    def moved(full: DataFrame, table: np.ndarray, turn: int) -> DataFrame:
        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, unit, classes, size, counts in _states(batches, parts):
                to, gain = _toward(counts, classes, table)
                classes = np.where(_by_turns(unit, gain, turn), to, classes).astype(np.uint8)
                yield pa.record_batch(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([classes.tobytes()], pa.binary()),
                        pa.array([size.tobytes()], pa.binary()),
                    ],
                    names=["part", "classes", "size"],
                )

        return written(full.mapInArrow(move, "part int, classes binary, size binary"), "classes")

    full, table = met(state)
    best, best_table, reached = state, table, _likelihood(table)
    for turn in range(ALL_ROUNDS):
        state = moved(full, table, turn)
        full, table = met(state)
        if (value := _likelihood(table)) > reached:
            best, best_table, reached = state, table, value
    return best, best_table


def _shape() -> Column:
    """Group of a word by its last two bytes, as ``_Units`` has it."""
    return (F.crc32(F.substring("key", -2, 2)) % SHAPES).cast("int")


@dataclass
class Totals:
    """Sizes of the training documents; tokens and types of the rare words of each shape."""

    n_docs: int
    tokens: int
    types: int
    shape_tokens: np.ndarray
    shape_types: np.ndarray


def totals(vocabulary: DataFrame, n_docs: int) -> Totals:
    """Totals of training documents whose word counts are ``vocabulary`` (key, n)."""
    total = vocabulary.agg(F.sum("n").alias("n"), F.count("*").alias("types")).first()
    rare = (
        vocabulary.where(F.col("n") < LEAST)
        .groupBy(_shape().alias("shape"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("types"))
        .toArrow()
    )
    shape_tokens, shape_types = np.zeros(SHAPES), np.zeros(SHAPES)
    shape_tokens[rare["shape"].to_numpy()] = rare["n"].to_numpy()
    shape_types[rare["shape"].to_numpy()] = rare["types"].to_numpy()
    tokens, types = int(total["n"] or 0) + n_docs, int(total["types"]) + (n_docs > 0)
    return Totals(n_docs, tokens, types, shape_tokens, shape_types)


def lexicon(vocabulary: DataFrame, parts: int) -> DataFrame:
    """(key, n, unit) of all words of ``vocabulary``."""
    part = F.pmod(F.xxhash64("key"), F.lit(parts))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("n"), "key"))
    own = vocabulary.where(F.col("n") >= LEAST).withColumn("part", part)
    own = own.select("key", "n", (END + 1 + (rank - 1).cast("long") * parts + F.col("part")).alias("unit"))
    rest = vocabulary.where(F.col("n") < LEAST).select("key", "n", _shape().cast("long").alias("unit"))
    return written(own.unionByName(rest), "units")


def first_classes(docs: DataFrame, words_of: DataFrame, total: Totals) -> DataFrame:
    """(unit, class, n) of all units, after exchange among the most frequent words and the
    shapes of all others."""
    core = F.col("n") * CORE >= total.tokens
    own = F.col("unit") > END
    chosen = words_of.where(core & own).orderBy(F.desc("n"), "key").toArrow()
    frequent, counts = chosen["key"].to_pylist(), chosen["n"].to_numpy()
    rest = (
        words_of.where(~(core & own)).groupBy(_shape().alias("shape")).agg(F.sum("n").alias("n")).toArrow()
    )
    size = np.concatenate([counts, [total.n_docs], np.zeros(SHAPES)]).astype(np.float64)
    size[len(frequent) + 1 + rest["shape"].to_numpy()] = rest["n"].to_numpy()
    pairs = written(
        docs.select("text")
        .mapInArrow(_pair_counts(frequent), "u long, v long, n long")
        .groupBy("u", "v")
        .agg(F.sum("n").alias("n")),
        "pairs",
    )
    classes, _ = exchange(pairs, size)
    spark = words_of.sparkSession
    end = len(frequent)
    shapes = classes[end + 1 :].tolist()
    fixed = spark.createDataFrame(
        [(s, c, int(total.shape_tokens[s])) for s, c in enumerate(shapes)]
        + [(END, int(classes[end]), total.n_docs)],
        "unit long, class int, n long",
    )
    found = spark.createDataFrame(
        list(zip(chosen["unit"].to_pylist(), classes[:end].tolist(), strict=True)),
        "unit long, first int",
    )
    of_shape = F.element_at(F.array(*map(F.lit, shapes)), _shape() + 1)
    own_words = words_of.where(own).join(F.broadcast(found), "unit", "left")
    return own_words.select("unit", F.coalesce("first", of_shape).cast("int").alias("class"), "n").unionByName(
        fixed
    )


def _encoder(total: Totals):
    """Function from a block's texts and the words they hold (key, n, unit) to what classes
    don't change, and the texts as units."""

    def encode(block: pa.Table, found: pa.Table) -> pa.Table:
        n, unit = found["n"].fill_null(0).to_numpy(), found["unit"].to_numpy()
        shape = np.minimum(unit, SHAPES - 1)
        size, kinds = total.shape_tokens[shape], total.shape_types[shape]
        mass = np.where(n > 0, n - DISCOUNT, DISCOUNT * kinds)
        rare = (unit < END) & (size > 0)
        own = np.where(rare, np.log10(np.where(rare, mass, 1) / np.maximum(size, 1)), 0.0)
        unit, n = np.append(unit, END), np.append(n, total.n_docs)
        own = np.append(own, 0.0)
        base = np.log10(n + 1.0) - np.log10(total.tokens + total.types + 1)
        place = {w: i for i, w in enumerate(found["key"].to_pylist())}
        results = []
        for text in block["text"]:
            parts = words(text.as_py())
            ids = np.empty(len(parts) + 1, np.int64)
            ids[:-1] = np.fromiter(map(place.__getitem__, parts), np.int64, len(parts))
            ids[-1] = len(unit) - 1
            results.append(
                (
                    len(ids),
                    int((n[ids] > 0).sum()),
                    float(base[ids].sum()),
                    float(own[ids].sum()),
                    unit[ids].astype("<u4").tobytes(),
                )
            )
        columns = list(zip(*results, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
        out = block.select(["block", "doc_id", "held_out"])
        for name, column, kind in zip(_ENCODED, columns, kinds, strict=True):
            out = out.append_column(name, pa.array(column, kind))
        return out

    return encode


_ENCODED = ("n_tokens", "n_known", "base_score", "own", "units")
_ENCODED_SCHEMA = "block int, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, own double, units binary"


def _asked_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (block, unit)."""
    wanted: dict[int, np.ndarray] = {}
    for batch in slices(batches):
        held: dict[int, list] = {}
        for block, data in zip(batch["block"].to_pylist(), batch["units"], strict=True):
            held.setdefault(block, []).append(np.frombuffer(data.as_py(), "<u4"))
        for block, ids in held.items():
            wanted[block] = np.unique(np.concatenate([wanted.get(block, ids[0][:0]), *ids]))
    for block, ids in wanted.items():
        yield pa.record_batch(
            [pa.array([block] * len(ids), pa.int32()), ids.astype(np.int64)], names=["block", "unit"]
        )


def _listed(parts: int):
    """(unit, class, n) rows of states."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, classes, size in zip(batch["part"], batch["classes"], batch["size"], strict=True):
                classes = np.frombuffer(classes.as_py(), np.uint8).astype(np.int32)
                unit = np.arange(len(classes)) * parts + part.as_py()
                size = np.frombuffer(size.as_py(), "<i8")
                used = (size > 0) | (unit <= END)  # numbers that no word has are left out
                yield pa.record_batch([unit[used], classes[used], size[used]], names=["unit", "class", "n"])

    return listed


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose id's crc32 modulo 7 is not 2 are learned from. A null text counts as empty:
    its only token is the end. Repeated rows are learned from and scored each; other
    columns are not carried; an empty table gives no rows, and without training rows both
    scores are 0.
    """
    with settings(docs.sparkSession, {**FREED_CONF, **BATCHES}):
        return _scored(docs)


def _scored(docs: DataFrame) -> DataFrame:
    held_out = fold("doc_id", FOLDS) == HELD_OUT
    train = docs.where(~held_out).select(F.col("text").cast("string").alias("text"))
    vocabulary = written(
        train.mapInArrow(_word_counts, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n")),
        "words",
    )
    total = totals(vocabulary, train.count())
    # odd, so that units of one shape or rank spread
    parts = max(16, total.tokens // PART_TOKENS) | 1
    words_of = lexicon(vocabulary, parts)
    state = _state_of(first_classes(train, words_of, total), parts)
    rows, blocks = blocked(
        docs.withColumn("held_out", held_out).withColumn("doc_id", F.col("doc_id").cast("long")),
        "doc_id",
        "held_out",
    )
    need = asked(rows, blocks, lambda t: set(words(t)), "binary", pa.binary())
    answers = need.join(words_of, "key", "left").select(
        "block", "key", "n", F.coalesce("unit", _shape().cast("long")).alias("unit")
    )
    encoded = written(answered(rows, answers, _encoder(total), _ENCODED_SCHEMA), "encoded")
    pairs = written(
        encoded.where(~F.col("held_out")).select("units").mapInArrow(
            _neighbours(parts), "part int, side int, data binary"
        ),
        "neighbours",
    )
    with settings(docs.sparkSession, PACKED_BATCHES):
        state, table = exchange_all(pairs, state, parts)
    units = state.mapInArrow(_listed(parts), "unit long, class int, n long")
    of = units.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("members")).toArrow()
    per_class, members = np.zeros(CLASSES), np.zeros(CLASSES)
    per_class[of["class"].to_numpy()] = of["n"].to_numpy()
    members[of["class"].to_numpy()] = of["members"].to_numpy()
    alone = (per_class + 0.5) / (per_class.sum() + 0.5 * CLASSES)
    row = table.sum(1, keepdims=True)
    after = np.log10(np.where(row > 0, TRUST * table / np.maximum(row, 1) + (1 - TRUST) * alone, alone))
    spread = np.log10(per_class + 0.5 * members + (members == 0))

    def score(block: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found["unit"].to_numpy())
        unit, cls, n = (found[c].to_numpy()[order] for c in ("unit", "class", "n"))
        emit = np.log10(n + 0.5) - spread[cls]
        first = cls[np.searchsorted(unit, END)] if len(unit) else 0
        scores = []
        for data, own in zip(block["units"], block["own"].to_pylist(), strict=True):
            at = np.searchsorted(unit, np.frombuffer(data.as_py(), "<u4"))
            path = np.concatenate([[first], cls[at]])
            scores.append(float(emit[at].sum() + after[path[:-1], path[1:]].sum()) + own)
        trained = total.tokens > 0
        out = block.select(["doc_id", "held_out", "n_tokens", "n_known"])
        out = out.append_column("train_tokens", pa.array([total.tokens] * len(scores), pa.int64()))
        base = block["base_score"] if trained else pa.array([0.0] * len(scores), pa.float64())
        out = out.append_column("base_score", base)
        return out.append_column("score", pa.array([s * trained for s in scores], pa.float64()))

    wanted = encoded.select("block", "units").mapInArrow(_asked_units, "block int, unit long")
    return answered(encoded, wanted.join(units, "unit"), score, SCHEMA)
