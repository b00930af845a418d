"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of byte pieces. Each neighbouring pair whose joint bytes
are in the vocabulary waits in the bucket of its merge rank; a hierarchical bitmap over
the ranks finds the lowest non-empty bucket by find-first-set. Entries whose pair has
changed meanwhile are skipped. So a pre-token of n bytes takes O(n) queue steps, however
long it is. The new pre-tokens of some texts share one list and queue.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import text_of

ENCODED = "ids binary, n_tokens long"
# Bits of a bitmap word, as a power of two.
SHIFT = 8
MASK = (1 << SHIFT) - 1
# Encoded pre-tokens in one generation of a worker's memory; only speed depends on it.
CACHED = 200_000
# Length of texts, and of new pre-tokens, that are taken at once.
TURN_CHARS, LINE_BYTES = 250_000, 16_000
# Marks in a list of ids: the place between two pre-tokens, and a byte merged into another.
EDGE, GONE = 0xFFFFFFFF, -1
# Bytes that no UTF-8 text has.
NEVER_UTF8 = (0xFF, 0xFE, 0xFD, 0xFC, 0xFB, 0xFA, 0xF9, 0xF8, 0xF7, 0xF6, 0xF5, 0xC1, 0xC0)


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


class RankQueue:
    """Positions by merge rank under a two-level bitmap of the ranks that have any.

    ``low`` has a word of ``1 << SHIFT`` bits for each run of ranks; a word over these, held
    by the merge itself, has a bit for each that isn't zero. The lowest set bit of either is
    found by ``x & -x``.
    """

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> SHIFT) + 1)
        self.buckets: dict[int, list[int]] = {}


class Ranks:
    """A vocabulary by bytes; the ranks of single bytes and pairs of bytes also as arrays.

    ``edge`` is a byte that UTF-8 never has and no longer token holds, or None.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.of = ranks
        self.one = np.full(256, -1, np.int64)
        self.two = np.full(1 << 16, -1, np.int64)
        for token, rank in ranks.items():
            if len(token) == 1:
                self.one[token[0]] = rank
            elif len(token) == 2:
                self.two[token[0] << 8 | token[1]] = rank
        joined = set().union(*(t for t in ranks if len(t) > 1))
        self.edge = next((b for b in NEVER_UTF8 if b not in joined), None)

    def queue(self) -> RankQueue:
        return RankQueue(max(self.of.values(), default=0) + 1)


def merge(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """Ids of one pre-token, of any bytes. ``queue`` is empty before and after."""
    return _merged(piece, Ranks(ranks), queue, None)


def merge_all(pieces: list[bytes], ranks: Ranks, queue: RankQueue) -> list[bytes]:
    """Ids of UTF-8 pre-tokens, each four bytes, from one linked list and queue.

    An edge byte stands between the pieces; as no pair with one is in the vocabulary, pieces
    never touch, and what is merged first in one has no effect on another.
    """
    if ranks.edge is None:
        return [np.array(_merged(p, ranks, queue, None), "<u4").tobytes() for p in pieces]
    line = bytes([ranks.edge]).join(pieces)
    ids = np.array(_merged(line, ranks, queue, ranks.edge), "<u4")
    ends = [*np.flatnonzero(ids == EDGE).tolist(), len(ids)]
    starts = [0, *(e + 1 for e in ends)]
    packed = ids.tobytes()
    return [packed[4 * a : 4 * e] for a, e in zip(starts, ends, strict=False)]


def _merged(line: bytes, ranks: Ranks, queue: RankQueue, edge: int | None) -> list[int]:
    """Ids after all merges, and ``EDGE`` for each ``edge`` byte.

    A merge may bring about a pair of a lower rank beside it. That pair goes first in its
    piece, so the rest of the bucket up to the next edge waits again.
    """
    n = len(line)
    data = np.frombuffer(line, np.uint8)
    own = ranks.one[data]
    if edge is not None:
        own[data == edge] = EDGE
    if own.min(initial=0) < 0:
        raise KeyError("a byte is not in the vocabulary")
    first = ranks.two[data[:-1].astype(np.int64) << 8 | data[1:]]
    order = np.argsort(first, kind="stable")
    order = order[np.searchsorted(first[order], 0) :]
    found, at = np.unique(first[order], return_index=True)
    get, low, buckets, top = ranks.of.get, queue.low, queue.buckets, 0
    places, bounds = order.tolist(), [*at.tolist(), len(order)]
    for k, rank in enumerate(found.tolist()):
        buckets[rank] = places[bounds[k] : bounds[k + 1]]
        low[rank >> SHIFT] |= 1 << (rank & MASK)
        top |= 1 << (rank >> SHIFT)
    own, waiting = own.tolist(), [*first.tolist(), -1]
    after, before = list(range(1, n + 2)), list(range(-1, n))
    while top:
        word = (top & -top).bit_length() - 1
        bits = low[word]
        bit = bits & -bits
        rank = (word << SHIFT) + bit.bit_length() - 1
        low[word] = bits = bits ^ bit
        if not bits:
            top &= top - 1
        positions = buckets.pop(rank)
        if len(positions) > 1:
            positions.sort()
        hold, held = 0, []
        for i in positions:
            if waiting[i] != rank:
                continue
            if i < hold:
                held.append(i)
                continue
            gone = after[i]
            after[i] = end = after[gone]
            own[i], own[gone] = rank, GONE
            waiting[gone] = waiting[i] = -1
            pushed = rank
            if end < n:
                before[end] = i
                new = get(line[i : after[end]], -1)
                if new >= 0:
                    waiting[i] = new
                    if new in buckets:
                        buckets[new].append(i)
                    else:
                        buckets[new] = [i]
                        low[new >> SHIFT] |= 1 << (new & MASK)
                        top |= 1 << (new >> SHIFT)
                    if new < pushed:
                        pushed = new
            left = before[i]
            if left >= 0:
                waiting[left] = new = get(line[left:end], -1)
                if new >= 0:
                    if new in buckets:
                        buckets[new].append(left)
                    else:
                        buckets[new] = [left]
                        low[new >> SHIFT] |= 1 << (new & MASK)
                        top |= 1 << (new >> SHIFT)
                    if new < pushed:
                        pushed = new
            if pushed < rank:
                hold = -1 if edge is None else line.find(edge, end)
                if hold < 0:
                    hold = n
        if held:
            buckets[rank] = held
            low[rank >> SHIFT] |= 1 << (rank & MASK)
            top |= 1 << (rank >> SHIFT)
    return [x for x in own if x >= 0]


class Encoder:
    """Texts to ids as little-endian 32-bit integers, remembering pre-tokens.

    Of two generations of pre-tokens the older one goes when the younger one is full, so
    that frequent ones stay.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find = Ranks(ranks), regex.compile(pattern).findall
        self.young: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.queue = self.ranks.queue()

    def encode(self, texts: list[str]) -> list[bytes]:
        found = [self.find(t) for t in texts]
        self._learn(set().union(*found).difference(self.young))
        known = self.young.__getitem__
        out = [b"".join(map(known, tokens)) for tokens in found]
        if len(self.young) >= CACHED:
            self.older, self.young = self.young, {}
        return out

    def _learn(self, tokens: set[str]) -> None:
        get, young, older = self.ranks.of.get, self.young, self.older
        new, pieces, size = [], [], 0
        for token in tokens:
            if (out := older.get(token)) is not None:
                young[token] = out
                continue
            piece = token.encode("utf-8")
            if (whole := get(piece)) is not None:
                young[token] = whole.to_bytes(4, "little")
                continue
            new.append(token)
            pieces.append(piece)
            size += len(piece)
            if size > LINE_BYTES:
                young.update(zip(new, merge_all(pieces, self.ranks, self.queue), strict=True))
                new, pieces, size = [], [], 0
        if new:
            young.update(zip(new, merge_all(pieces, self.ranks, self.queue), strict=True))

    def encode_in_turn(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text; a bounded length of text is taken at once."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size > TURN_CHARS:
                yield from self.encode(some)
                some, size = [], 0
        yield from self.encode(some)


@lru_cache(maxsize=4)
def kept_encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a worker, which keeps its pre-tokens from task to task."""
    return Encoder(load_ranks(path), pattern)


def encoder(ranks: dict[bytes, int], pattern: str) -> Callable[[str], bytes]:
    """Function from a text to its ids, four bytes each."""
    coder = Encoder(ranks, pattern)
    return lambda text: coder.encode([text])[0]


def encode(text: Column, path: str, pattern: str) -> Column:
    """Struct of ``ids`` (little-endian unsigned 32-bit integers) and ``n_tokens``.

    ``path`` is a rank file that every machine has; each match of ``pattern`` is encoded
    by itself and there are no special tokens. Null and empty texts have no ids.
    """

    @F.arrow_udf(ENCODED)
    def ids(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = kept_encoder(path, pattern)
        for array in texts:
            out = list(coder.encode_in_turn(t.as_py() or "" for t in array))
            yield pa.StructArray.from_arrays(
                [pa.array(out, pa.binary()), pa.array([len(x) >> 2 for x in out], pa.int64())],
                names=["ids", "n_tokens"],
            )

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """Bytes of the tokens in ``ids``; null for null. An unknown id is an error."""

    @F.arrow_udf("binary")
    def text(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = {i: t for t, i in load_ranks(path).items()}.__getitem__
        for array in arrays:
            yield pa.array(
                [
                    None if x is None else b"".join(map(tokens, memoryview(x).cast("I").tolist()))
                    for x in (v.as_py() for v in array)
                ],
                pa.binary(),
            )

    return text(ids)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row of ``docs``: doc_id, token count, digests of the ids and of what they decode to.

    Repeated rows give repeated rows; other columns are not carried; a null text counts as
    empty (no tokens, digests of no bytes); an empty table gives no rows.
    """
    coded = docs.select("doc_id", encode(text_of(), path, pattern).alias("coded"))
    both = coded.select(
        "doc_id", "coded.n_tokens", "coded.ids", decode(F.col("coded.ids"), path).alias("decoded")
    )
    return both.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
