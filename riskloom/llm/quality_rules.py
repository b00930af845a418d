"""Quality rules: counted base rules, and logistic regression on hashed n-grams.

The regression reads hashed words and hashed four-byte n-grams of the whole text, each
kind as relative frequencies. It is fitted on a bounded sample of labelled rows
(``FIT_PER_CLASS`` of each class), its scores are calibrated to probabilities on a part
of the sample that was not fitted on, and documents are scored in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import labelled
from riskloom.llm.common import encoded

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
# Labelled rows of each class that the regression is fitted on, at most.
FIT_PER_CLASS = 1000
CALIBRATE_PART = 4
# Fixed threshold on the calibrated probability of good quality.
KEEP_FROM = 0.5
BITS = 18
SLOTS = 1 << BITS
# Bytes of one text that are hashed at once.
CHUNK = 1 << 21
ID_BITS = 18
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


def repeated_words(parts: list[bytes], ids: _Ids) -> int:
    """Words inside three-word windows that occur at least twice in ``parts``."""
    n = len(parts)
    if n < 4:
        return 0
    if n > 1 << ID_BITS:
        ids = _Ids()
    elif len(ids) + n > 1 << ID_BITS:
        ids.clear()
    x = np.fromiter(map(ids.__getitem__, parts), np.int64, n)
    if n > 1 << ID_BITS:  # ids may need more bits than three of them have room for
        pairs = np.unique(x[:-1] * len(ids) + x[1:], return_inverse=True)[1].astype(np.int64)
        window = pairs[:-1] * len(ids) + x[2:]
    else:
        window = (x[:-2] << (2 * ID_BITS)) | (x[1:-1] << ID_BITS) | x[2:]
    ordered = np.sort(window)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    _, which, counts = np.unique(window, return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : shift + n - 2] |= twice
    return int(inside.sum())


def counts(text: str, ids: _Ids) -> tuple[int, int, int, int, int]:
    """The five base counts of one text, in the order of ``COUNTS``."""
    parts = encoded(text).split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(parts),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(parts, ids),
    )


def hashed(data: bytes) -> Iterator[tuple[np.ndarray, int]]:
    """Slots of words and of four-byte n-grams, piece by piece, with the kind (0 or 1)."""
    parts = data.split()
    for start in range(0, len(parts), CHUNK // 8):
        some = parts[start : start + CHUNK // 8]
        yield np.fromiter(map(crc32, some), np.uint32, len(some)) & np.uint32(SLOTS - 1), 0
    for start in range(0, len(data) - 3, CHUNK):
        b = np.frombuffer(data, np.uint8, min(CHUNK + 3, len(data) - start), start)
        b = b.astype(np.uint32)
        four = b[:-3] | (b[1:-2] << np.uint32(8)) | (b[2:-1] << np.uint32(16))
        four |= b[3:] << np.uint32(24)
        yield (four * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS), 1


def linear(text: str | None, weights: np.ndarray) -> float:
    """Sum over both kinds of the mean weight of the text's slots."""
    total, seen = [0.0, 0.0], [0, 0]
    for slot, kind in hashed(encoded(text)):
        total[kind] += float(weights[kind][slot].sum(dtype=np.float64))
        seen[kind] += len(slot)
    return sum(t / n for t, n in zip(total, seen, strict=True) if n)


@dataclass
class Model:
    """``weights`` by kind and slot; slope and offset of the calibration."""

    weights: np.ndarray
    slope: float
    offset: float

    def probability(self, text: str | None) -> float:
        score = np.array([linear(text, self.weights)])
        return float(labelled.probability(score, self.slope, self.offset)[0])


def train(rows: list[tuple[str, int]], rounds: int = 150, rate: float = 0.5) -> Model:
    """Model of labelled texts; every ``CALIBRATE_PART``-th row only calibrates."""
    held = np.arange(len(rows)) % CALIBRATE_PART == CALIBRATE_PART - 1
    weights = np.zeros((2, SLOTS), np.float32)
    fitted = [r for r, h in zip(rows, held, strict=True) if not h]
    if len({label for _, label in fitted}) == 2:
        weights = _fit(fitted, rounds, rate)
    rest = [r for r, h in zip(rows, held, strict=True) if h]
    scores = np.array([linear(t, weights) for t, _ in rest])
    slope, offset = labelled.calibrate(scores, np.array([y for _, y in rest]))
    return Model(weights, slope, offset)


def _fit(rows: list[tuple[str, int]], rounds: int, rate: float) -> np.ndarray:
    """Full-batch logistic regression with per-weight step sizes and equal class weights."""
    slots, values, owner = [], [], []
    for i, (text, _) in enumerate(rows):
        count = np.zeros(0)
        parts: list[list[np.ndarray]] = [[], []]
        for slot, kind in hashed(encoded(text)):
            parts[kind].append(slot)
        for kind in (0, 1):
            if parts[kind]:
                slot, count = np.unique(np.concatenate(parts[kind]), return_counts=True)
                slots.append(slot.astype(np.int32) + kind * SLOTS)
                values.append((count / count.sum()).astype(np.float32))
                owner.append(np.full(len(slot), i, np.int32))
    if not slots:
        return np.zeros((2, SLOTS), np.float32)
    slot, value, row = map(np.concatenate, (slots, values, owner))
    used, slot = np.unique(slot, return_inverse=True)
    y = np.array([label for _, label in rows], np.float64)
    each = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w, past = np.zeros(len(used)), np.full(len(used), 1e-12)
    for _ in range(rounds):
        z = np.bincount(row, w[slot] * value, minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * each
        slope = np.bincount(slot, error[row] * value, minlength=len(used)) + 1e-9 * w
        past += slope * slope
        w -= rate * slope / np.sqrt(past)
    weights = np.zeros(2 * SLOTS, np.float32)
    weights[used] = w
    return weights.reshape(2, SLOTS)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = FIT_PER_CLASS) -> Model:
    """Model of ``labels.quality`` (1 good, 0 bad). Without labelled rows all is kept."""
    rows = labelled.sample(docs, labels, "quality", (per_class, per_class))
    return train(rows) if rows else Model(np.zeros((2, SLOTS), np.float32), 0.0, 20.0)


def measure(text: Column, model: Model) -> Column:
    """Struct of the base counts and ``good``, the calibrated probability of good quality.

    A null text counts as empty: all counts are 0.
    """

    @F.arrow_udf(f"{COUNTS}, good double")
    def measured(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids = _Ids()
        names = [c.split()[0] for c in COUNTS.split(", ")]
        for array in texts:
            rows, good = [], []
            for value in array:
                text = value.as_py() or ""
                rows.append(counts(text, ids))
                good.append(model.probability(text))
            columns = np.array(rows, np.int64).reshape(-1, 5)
            arrays = [pa.array(columns[:, k]) for k in range(5)]
            yield pa.StructArray.from_arrays(
                [*arrays, pa.array(good, pa.float64())], names=[*names, "good"]
            )

    return measured(text)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, base counts, base_failed, calibrated probability and verdict.

    Repeated rows give repeated rows, other columns are not carried, null and empty texts
    have no words and so fail; an empty table gives no rows.
    """
    m = docs.select("doc_id", measure(F.col("text").cast("string"), model).alias("m"))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return (
        m.select("doc_id", "m.*")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("good") >= KEEP_FROM))
    )


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs``, all columns, that neither the base rules nor the model reject."""
    m = measure(F.col("text").cast("string"), model)
    flag = F.struct(m.alias("m"))["m"]
    return docs.where(
        ~base_failed(flag["n_words"], flag["n_repeat_words"]) & (flag["good"] >= KEEP_FROM)
    )
