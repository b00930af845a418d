"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two units (words between boundary marks) counts the three-letter
subsequences they share, each occurrence weighted by ``DECAY`` to its gaps, up to ``SPAN``
letters apart; so ``i.d.i.o.t`` is still near ``idiot``. Each unit is divided by the length
of its occurrences. Landmarks are typical words of either class; the machine is linear in
the Nyström features of a unit against them. Sentences are bags of units and take the
label of their document; only the units that tell toxic documents apart stand for a
toxic sentence (multiple instances), chosen anew after a first fit.

As the kernel is a sum over subsequences, landmarks and machine fold into one weight per
subsequence: a unit's margin is a sum of looked-up weights, the same number that the
kernel against every landmark would give. A document scores as its worst unit.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import labelled
from riskloom.llm.common import fold

DECAY, SPAN = 0.6, 5
GAPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN) if a + b <= SPAN - 1]
BITS = 20
SLOTS = 1 << BITS
TOXIC_FROM = 0.7
# Bounds of training: labelled rows of either class, landmarks, and clean units.
FIT_TOXIC, FIT_CLEAN, LANDMARKS, FIT_UNITS = 800, 2000, 384, 8_000
CALIBRATE_PART = 4
# Rows of a matrix that are worked on at once, to bound the driver's memory.
ROWS_AT_ONCE = 512
# Units a worker remembers; only speed depends on it.
CACHED = 200_000
# Margin of a text without units, below that of any unit.
NO_UNIT = -4.0

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_SPELLED = re.compile(r"(?:(?<=\s)|^)\S(?:\s+\S){2,}(?=\s|$)")
_EDGES = ".,;:!?\"'()[]{}«»“”…|-*_"


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s and not s.isspace()]


def units(sentence: str) -> list[str]:
    """Words in lower case without punctuation at their edges, and runs of three or more
    single letters (``i d i o t``) joined to a word."""
    lower = sentence.lower()
    found = [w.strip(_EDGES) for w in lower.split()]
    for run in _SPELLED.findall(lower):
        found.append("".join(run.split()))
    return [w for w in found if w]


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words between marks, one after the other, and whose each is."""
    data = "".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass")
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return np.frombuffer(data, np.uint32), np.repeat(np.arange(len(words)), sizes)


def occurrences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Subsequence slots, the word of each, and their weight; one item for each gap pattern."""
    c, owner = _letters(words)
    for a, b in GAPS:
        n = len(c) - a - b
        if n <= 0:
            continue
        inside = owner[:n] == owner[a + b :]
        slot = c[:n] * np.uint32(0x9E3779B1) ^ (c[a : a + n] * np.uint32(0x85EBCA6B) + np.uint32(7))
        slot = (slot ^ (slot >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        slot = (slot + c[a + b :]) * np.uint32(0x27D4EB2F)
        slot = (slot ^ (slot >> np.uint32(15))) * np.uint32(0x9E3779B1)
        yield (slot >> np.uint32(32 - BITS))[inside], owner[:n][inside], DECAY ** (a + b - 2)


def lengths(words: list[str]) -> np.ndarray:
    """Root of the summed squared weights of each word's occurrences."""
    size = np.fromiter(map(len, words), np.float64, len(words)) + 2
    total = sum(
        np.maximum(size - a - b, 0) * DECAY ** (2 * (a + b - 2)) for a, b in GAPS
    )
    return np.sqrt(np.maximum(total, 1e-9))


@dataclass
class Model:
    """``weights`` by subsequence slot, bias, and the calibration of document margins."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words))
        for slot, owner, weight in occurrences(words):
            out += weight * np.bincount(owner, self.weights[slot], minlength=len(words))
        return out / lengths(words) + self.bias


class Scorer:
    """Scores texts one after the other, remembering the margins of units."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def margins(self, texts: list[str | None]) -> tuple[list[float], list[str | None]]:
        """For each text the margin of its worst unit, and that unit."""
        found = [
            {u for s in sentences(t) for u in units(s)} if t and not t.isspace() else set()
            for t in texts
        ]
        known = self.known
        if len(known) > CACHED:
            known.clear()
        new = list(set().union(*found).difference(known)) if found else []
        for start in range(0, len(new), 50_000):
            some = new[start : start + 50_000]
            known.update(zip(some, self.model.margins(some).tolist(), strict=True))
        worst, unit = [], []
        for bag in found:
            # of equal margins the smallest unit, so that repeated runs agree
            top = max(map(known.__getitem__, bag), default=NO_UNIT)
            worst.append(top)
            unit.append(min((u for u in bag if known[u] == top), default=None))
        return worst, unit

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, list[str | None]]:
        margin, unit = self.margins(texts)
        m = self.model
        return labelled.probability(np.array(margin, np.float64), m.slope, m.offset), unit


def _machine(x: np.ndarray, y: np.ndarray, each: np.ndarray, penalty: float) -> np.ndarray:
    """Linear support vector machine with squared hinge loss; the last weight is the bias.

    Newton's method on the active rows: exact for this loss once the active set settles.
    """
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        active = np.flatnonzero(y * (x @ w) < 1)
        curve, toward = ridge.copy(), np.zeros(len(w))
        for start in range(0, len(active), ROWS_AT_ONCE):
            rows = active[start : start + ROWS_AT_ONCE]
            part = x[rows].astype(np.float64)
            weighed = part * each[rows][:, None]
            curve += weighed.T @ part
            toward += weighed.T @ y[rows]
        solved = np.linalg.solve(curve, toward)
        if np.abs(solved - w).max() < 1e-6:
            break
        w = solved
    return w


def _fit(
    positive: list[str],
    negative: list[str],
    landmarks: list[str],
    share: np.ndarray,
    penalty: float = 1e-6,
) -> tuple[np.ndarray, float]:
    """Weight of each subsequence slot, and bias, from units of both classes.

    ``share`` weighs the positive units; both classes weigh the same in all.
    """
    words = positive + negative
    parts = [(s, o, np.full(len(s), g)) for s, o, g in occurrences(landmarks)]
    slot, owner, weight = (np.concatenate(p) for p in zip(*parts, strict=True))
    used, column = np.unique(slot, return_inverse=True)
    z = np.zeros((len(landmarks), len(used)), np.float64)
    np.add.at(z, (owner, column), weight)
    z /= lengths(landmarks)[:, None]
    place = np.full(SLOTS, len(used), np.int64)
    place[used] = np.arange(len(used))
    wide = np.vstack([z.T, np.zeros((1, len(landmarks)))]).astype(np.float32)
    kernel = np.zeros((len(words), len(landmarks)), np.float32)
    for start in range(0, len(words), ROWS_AT_ONCE):
        some = words[start : start + ROWS_AT_ONCE]
        dense = np.zeros((len(some), len(used) + 1), np.float32)
        for s, o, g in occurrences(some):
            np.add.at(dense, (o, place[s]), np.float32(g))
        kernel[start : start + ROWS_AT_ONCE] = dense @ wide / lengths(some)[:, None]
    values, vectors = np.linalg.eigh(z @ z.T)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
    each = np.concatenate([0.5 * share / share.sum(), np.full(len(negative), 0.5 / len(negative))])
    w = _machine(kernel @ root.astype(np.float32), y, each, penalty)
    table = np.zeros(SLOTS, np.float32)
    table[used] = z.T @ (root @ w[:-1])
    return table, float(w[-1])


def _copies(bags: list[set[str]], bands: int = 6, rows: int = 3) -> np.ndarray:
    """Marks bags that share a band of minimum hashes with an earlier one: near copies."""
    rng = np.random.default_rng(11)
    a = rng.integers(1, 1 << 31, bands * rows, dtype=np.uint64) | np.uint64(1)
    seen: set[tuple] = set()
    out = np.zeros(len(bags), bool)
    for k, bag in enumerate(bags):
        if bag:
            x = np.fromiter((crc32(u.encode("utf-8", "surrogatepass")) for u in bag), np.uint64)
            low = ((x[:, None] * a) & np.uint64(0xFFFFFFFF)).min(0).reshape(bands, rows)
            keys = [(i, *band) for i, band in enumerate(low.tolist())]
            out[k] = not seen.isdisjoint(keys)
            seen.update(keys)
    return out


def _witnesses(bags: list[set[str]], labels: np.ndarray) -> tuple[list[str], Counter]:
    """Units that tell toxic bags apart, most telling first; and units of the clean bags.

    A unit counts if chance would bring about its likelihood ratio in less than about one
    of all units; in samples too small for that, the most telling ones are taken.
    """
    toxic, clean = Counter(), Counter()
    copies = _copies(bags)
    for bag, label, copy in zip(bags, labels, copies, strict=True):
        if not (label and copy):
            (toxic if label else clean).update(bag)
    n, m = max(int((labels.astype(bool) & ~copies).sum()), 1), max(int((1 - labels).sum()), 1)

    def telling(unit: str) -> float:
        a, b = toxic[unit], clean[unit]
        share = (a + b) / (n + m)
        return a * np.log(a / n / share) + (b * np.log(b / m / share) if b else 0.0)

    scores = {u: telling(u) for u, a in toxic.items() if a > 1 and a * m > 4 * clean[u] * n}
    ranked = sorted(scores, key=lambda u: (-scores[u], u))
    sure = [u for u in ranked if scores[u] > np.log(len(toxic) + 1) + 1]
    return sure or ranked[:8], clean


_FILLERS = ".-*_ "


def _variants(word: str) -> list[str]:
    """The word with characters put between all letters, or between two of them, or a
    letter doubled."""
    out = [word]
    if len(word) > 3:
        out += [f.join(word) for f in _FILLERS[:4]]
        for k in range(1, len(word)):
            out.append(word[:k] + _FILLERS[k % 4] + word[k:])
            out.append(word[:k] + word[k - 1] + word[k:])
    return out


def _hardest(model: Model, words: list[str], most: int, at_once: int = 50_000) -> list[str]:
    """The words of the highest margins, highest first; equal ones keep their order."""
    margin, place = np.zeros(0), np.zeros(0, np.int64)
    for start in range(0, len(words), at_once):
        some = words[start : start + at_once]
        margin = np.concatenate([margin, model.margins(some)])
        place = np.concatenate([place, np.arange(start, start + len(some))])
        top = np.argsort(-margin, kind="stable")[:most]
        margin, place = margin[top], place[top]
    return [words[i] for i in place]


def train(rows: list[tuple[str, int]], landmarks: int = LANDMARKS) -> Model:
    """Model of labelled texts (1 toxic); every ``CALIBRATE_PART``-th row only calibrates.

    Without both classes no text is toxic. Near copies among toxic rows count once.
    """
    empty = Model(np.zeros(SLOTS, np.float32), 0.0, 0.0, -10.0)
    same: dict[str, str] = {}
    bags = [{same.setdefault(u, u) for s in sentences(t) for u in units(s)} for t, _ in rows]
    del same
    labels = np.array([y for _, y in rows], np.int64)
    held = np.arange(len(rows)) % CALIBRATE_PART == CALIBRATE_PART - 1
    fit_bags = [b for b, h in zip(bags, held, strict=True) if not h]
    y = labels[~held]
    if not y.any() or y.all():
        return empty
    ranked, clean = _witnesses(fit_bags, y)
    if not ranked or not clean:
        return empty
    listed = set(ranked)
    positive = [v for u in ranked for v in _variants(u) if v in listed or not clean[v]]
    share = np.array([1.0 if u in listed else 0.1 for u in positive])
    # ties by the word, as the order of sets differs between runs
    frequent = sorted(clean, key=lambda u: (-clean[u], u))[: FIT_UNITS // 4]
    rng = np.random.default_rng(7)
    others = sorted(set(clean).difference(frequent))
    drawn = [others[i] for i in rng.permutation(len(others))[: FIT_UNITS - len(frequent)]]
    negative = frequent + drawn
    half = landmarks // 2
    model = empty
    for _ in range(3):
        spelled = [f.join(u) for f in _FILLERS[:4] for u in ranked[: half // 8] if len(u) > 3]
        chosen = ranked[:half] + spelled + negative[: half // 2]
        chosen += drawn[: max(landmarks - len(chosen), half // 4)]
        weights, bias = _fit(positive, negative, list(dict.fromkeys(chosen)), share)
        model = Model(weights, bias, 1.0, 0.0)
        # anew: the clean words nearest to insults join the landmarks
        hard = _hardest(model, others, FIT_UNITS // 4)
        negative = list(dict.fromkeys(hard + negative))
    scorer = Scorer(model)
    rest = [t for (t, _), h in zip(rows, held, strict=True) if h]
    margin, _ = scorer.margins(rest)
    model.slope, model.offset = labelled.calibrate(np.array(margin), labels[held])
    return model


def fit(docs: DataFrame, labels: DataFrame, bounds: tuple[int, int] = (FIT_CLEAN, FIT_TOXIC)) -> Model:
    """Model of ``labels.toxic`` from rows whose id's crc32 modulo 3 is not 1."""
    rows = labelled.sample(docs, labels, "toxic", bounds, fold("doc_id", 3) != 1)
    return train(rows)


def toxicity(text: Column, model: Model) -> Column:
    """Struct of ``score`` (0 to 1) and ``unit``, the unit it comes from (null if none).

    Null and empty texts have no units and get the lowest score.
    """

    @F.arrow_udf("score double, unit string")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for array in texts:
            scores, found = [], []
            for start in range(0, len(array), 256):
                score, unit = scorer.scores(array.slice(start, 256).to_pylist())
                scores.append(score)
                found += unit
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.StructArray.from_arrays(
                [pa.array(score, pa.float64()), pa.array(found, pa.string())],
                names=["score", "unit"],
            )

    return scored(text)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, and the unit that decides.

    Repeated rows give repeated rows and other columns are not carried; an empty table
    gives no rows. A null id counts as empty text for ``held_out``.
    """
    return (
        docs.select("doc_id", toxicity(F.col("text").cast("string"), model).alias("t"))
        .select(
            "doc_id",
            (fold("doc_id", 3) == 1).alias("held_out"),
            F.col("t.score").alias("score"),
            (F.col("t.score") >= TOXIC_FROM).cast("int").alias("predicted"),
            F.col("t.unit").alias("unit"),
        )
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs``, all columns, that score below the threshold."""
    return docs.where(toxicity(F.col("text").cast("string"), model)["score"] < TOXIC_FROM)
