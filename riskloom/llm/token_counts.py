"""Token counts with the whole-token shortcut, for a BPE vocabulary with word ends.

Offline, every vocabulary string that can be a whole pre-token is merged alone; those that
come out as one token are proven. A pre-token of the proven set counts one without merging;
only the rest are merged.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import text_of

LIMIT = 2048
# Counts of merged pre-tokens a worker remembers, and their longest length; only speed
# depends on it.
CACHED, CACHED_CHARS = 300_000, 64
# White space of the library's regular expressions.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others for
    the code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Vocabulary:
    """Merges, special strings and pre-token pattern of a tokenizer file.

    The file has a normalizer of NFC, white space and lower case, a splitting pattern whose
    matches are kept, byte letters, and merges with a suffix at word ends.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as lines:
            data = json.load(lines)
        model = data["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        self.strings = list(model["vocab"])
        self.special = sorted((t["content"] for t in data["added_tokens"]), key=len, reverse=True)
        self.letters = _byte_letters()
        split = next(p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"].replace(r"[^\s", f"[^{_SPACE}")
        self.find = regex.compile(pattern).findall

    def symbols(self, token: str) -> list[str]:
        out = [self.letters[b] for b in token.encode("utf-8")]
        out[-1] += self.suffix
        return out

    def merged(self, parts: list[str]) -> int:
        """Tokens left after all merges, lowest rank first, leftmost of equal ones."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.ranks.get
        heap = [
            (rank, i) for i in range(n - 1) if (rank := get((parts[i], parts[i + 1]))) is not None
        ]
        heapq.heapify(heap)
        alive = [True] * n
        left = n
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or get((parts[i], parts[j])) != rank:
                continue
            parts[i] += parts[j]
            alive[j] = False
            left -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (new := get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (new, i))
            if (h := before[i]) >= 0 and (new := get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (new, h))
        return left


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def proven(path: str) -> frozenset[str]:
    """Pre-tokens that are a vocabulary string and come out as one token by merging alone."""
    vocabulary = load(path)
    byte_of = {letter: b for b, letter in enumerate(vocabulary.letters)}
    cut, whole = len(vocabulary.suffix), set()
    for string in vocabulary.strings:
        if not string.endswith(vocabulary.suffix) or len(string) == cut:
            continue
        try:
            token = bytes(byte_of[c] for c in string[: len(string) - cut]).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if vocabulary.merged(vocabulary.symbols(token)) == 1:
            whole.add(token)
    return frozenset(whole)


class _Counts(dict):
    """Pre-token to its token count, filled by merging when asked."""

    def __init__(self, vocabulary: Vocabulary, whole: frozenset[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.vocabulary, self.whole = vocabulary, whole

    def __missing__(self, token: str) -> int:
        count = self.vocabulary.merged(self.vocabulary.symbols(token))
        if len(token) <= CACHED_CHARS:
            if len(self) >= CACHED + len(self.whole):
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[token] = count
        return count


def counter(vocabulary: Vocabulary, whole: frozenset[str]) -> Callable[[str], int]:
    """Function from a text to its token count; special strings count one each."""
    known = _Counts(vocabulary, whole).__getitem__
    special = regex.compile("|".join(map(regex.escape, vocabulary.special)) or r"(?!)")
    hints = [s[:2] for s in vocabulary.special]

    def count(text: str) -> int:
        pieces = special.split(text) if any(h in text for h in hints) else [text]
        total = len(pieces) - 1
        for piece in pieces:
            # lower case letter by letter, as the library does: no final sigma
            plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
            total += sum(map(known, vocabulary.find(plain)))
        return total

    return count


def token_count(text: Column, path: str) -> Column:
    """Tokens of a text, without added ones; 0 for null and empty texts.

    The proven strings are at most the vocabulary and travel with the function.
    """
    whole = proven(path)

    @F.arrow_udf("long")
    def counted(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = counter(load(path), whole)
        for array in texts:
            yield pa.array([count(t.as_py() or "") for t in array], pa.int64())

    return counted(text)


def counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as empty; repeated rows give repeated rows; other columns are not
    carried; an empty table gives no rows.
    """
    return docs.select(
        "doc_id",
        F.octet_length(text_of()).cast("long").alias("n_bytes"),
        token_count(text_of(), path).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
