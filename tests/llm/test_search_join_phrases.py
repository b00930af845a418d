"""Bit-sliced search, Jaccard join and collocations against brute force and SQL."""

import math
import re
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry_point
from riskloom.llm import bit_search, collocations, jaccard_join

DOCS = "doc_id long, text string, lang string, part int, cell long, term string, bits int"
ITEMS = "item_id long, text string, weights int"
LONG = "long words, " * 40_000 + "x" * 30_000
ODD = [
    (1, None, "en"),
    (2, "", None),
    (3, " \t\n.,;", "en"),
    (4, LONG, "en"),
    (5, "The cat sat on the mat and ate", "en"),
    (5, "The cat sat on the mat and ate", "en"),
    (6, "the cat sat on the mat and ate", "de"),
    (7, "the cat", "en"),
    (8, "THE CAT", None),
    (None, "the cat sat on a mat", "en"),
    (9, "straße ÄÖ naïve x1 0\x00b\x1fc", ""),
]


def _docs(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "t", 3) for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return _docs(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return _docs(spark, [])


def _corpus(seed, n=160):
    """Texts with copies, near copies, chains of them, and a passage that many share."""
    rng = np.random.default_rng(seed)
    names = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(names, 40))
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.35 and texts:
            words = texts[rng.integers(len(texts))].split()
            for _ in range(rng.integers(0, 4)):
                if words:
                    words[rng.integers(len(words))] = str(rng.choice(names))
            texts.append(" ".join(words))
        else:
            words = list(rng.choice(names, rng.integers(1, 120)))
            texts.append(" ".join(words + passage if kind > 0.7 else words))
    return [(i, t, "en" if i % 3 else None) for i, t in enumerate(texts)]


# --- search ---------------------------------------------------------------------------


def _terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def _ranked(docs, items, k):
    found = [(r[0], Counter(_terms(r[1]))) for r in docs]
    found = [(d, c) for d, c in found if c]
    n, words = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item in {i for i, _ in items}:
        asked = {t for i, text in items if i == item for t in _terms(text)} & set(df)
        scored = []
        for d, c in found:
            m = 100 - 50 + 50 * sum(c.values()) * n // words
            s = 0
            for t in asked:
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                s += w * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if s > 0:
                scored.append((-s, d is None, d or 0, d, s))
        scored.sort(key=lambda x: x[:3])
        out += [(item, i + 1, d, s) for i, (*_, d, s) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_search_of_odd_rows(spark, odd, empty):
    items = [
        (1, "the CAT sat"), (2, None), (3, "..."), (4, "nowhere"), (5, "long x1 ÄÖ b"),
        (1, "mat mat"), (None, "cat"), (6, LONG),
    ]
    asked = spark.createDataFrame([(*i, 7) for i in items], ITEMS)
    found = bit_search.search(odd, asked, 4)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert _rows(found) == _ranked(ODD, items, 4)
    assert bit_search.search(empty, asked).collect() == []
    assert bit_search.search(odd, spark.createDataFrame([], ITEMS)).collect() == []


def test_search_with_small_blocks(spark, monkeypatch):
    rows = _corpus(5, 300)
    rows += [(1000 + i, rows[7][1], "en") for i in range(40)]  # ties beyond the last rank
    items = [(i, " ".join(rows[i * 9][1].split()[:12])) for i in range(30)]
    expected = _ranked(rows, items, 10)
    # queries in groups; the floor comes from one document of each block
    monkeypatch.setattr(bit_search, "GROUP", 7)
    monkeypatch.setattr(bit_search, "TRIED", 1)
    docs = _docs(spark, rows).repartition(5)
    asked = spark.createDataFrame([(*i, 7) for i in items], ITEMS)
    assert _rows(bit_search.search(docs, asked, 10)) == expected
    # ids by a shuffle
    monkeypatch.setattr(bit_search, "BROADCAST_IDS", 0)
    assert _rows(bit_search.search(docs, asked, 10)) == expected


def test_bounds_hold_and_exclude():
    rows = _corpus(6, 400)
    docs = []
    for doc_id, text, _ in rows:
        found = bit_search.term_counts(text)
        code = np.array([bit_search._code(t) for t in found], np.uint64)
        times = np.array(list(found.values()))
        parts = [bit_search._entries(code[times >= s], s) for s in bit_search.STEPS]
        docs.append((doc_id, int(times.sum()), np.concatenate(parts)))
    n, words = len(docs), sum(d[1] for d in docs)
    names = sorted(bit_search.term_counts(rows[3][1]))
    query = {"terms": names, "weights": [100 + i for i in range(len(names))]}
    over, bounds, texts = 0, 0, {r[0]: r[1] for r in rows}
    for block in bit_search._blocks(list(docs)):
        b = bit_search.Bounds(block["ids"], block["sizes"], block["height"], block["bits"], n, words)
        ((_, bound),) = b.of_queries([query])
        for doc_id, most in zip(block["ids"], bound.tolist()):
            exact = bit_search.score(
                bit_search.term_counts(texts[doc_id]), names, query["weights"], n, words
            )
            assert most >= exact
            over, bounds = over + most - exact, bounds + exact
    assert over < 0.1 * bounds


# --- join -----------------------------------------------------------------------------


def _sets(rows):
    out = []
    for doc_id, text, *_ in rows:
        w = (text or "").encode().lower().split()
        if len(w) < 5:
            out.append((doc_id, {tuple(w)} if w else set()))
        else:
            out.append((doc_id, {tuple(w[i : i + 5]) for i in range(len(w) - 4)}))
    return out


def _joined(rows, percent=80):
    sets = [(d, s) for d, s in _sets(rows)]
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations([s for s in sets if s[0] is not None and s[1]], 2):
        if 100 * len(x & y) >= percent * len(x | y):
            u, v = sorted((find(a), find(b)))
            parent[v] = u
    return sorted(
        ((d, len(s), None if d is None else find(d)) for d, s in sets), key=repr
    )


def test_join_of_odd_rows(odd, empty):
    found = jaccard_join.join(odd)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert _rows(found) == _joined(ODD)
    assert jaccard_join.join(empty).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_join_as_all_pairs(spark, seed):
    rows = _corpus(seed, 300)
    expected = _joined(rows)
    assert len({c for *_, c in expected}) < 290
    assert _rows(jaccard_join.join(_docs(spark, rows))) == expected


def test_join_of_crowded_buckets(spark, monkeypatch):
    # a chain: each text differs from the last by a few words, so few are linked to the first
    rng = np.random.default_rng(4)
    words = [f"a{i}" for i in range(60)]
    rows = []
    for i in range(120):
        rows.append((i * 7 % 120, " ".join(words), "en"))
        if i % 6 != 5:
            words[rng.integers(60)] = f"b{i}"
        else:
            words[10:40] = [f"c{i}{j}" for j in range(30)]
    expected = _joined(rows)
    monkeypatch.setattr(jaccard_join, "TILE", 8)
    monkeypatch.setattr(jaccard_join, "LEAF", 4)
    assert _rows(jaccard_join.join(_docs(spark, rows))) == expected


def test_linked_sets_name_a_common_cell():
    rng = np.random.default_rng(8)
    for _ in range(3000):
        n = int(rng.integers(4, 300))
        sets = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        differing = jaccard_join._differing(len(sets), 80)
        gone = int(rng.integers(0, differing + 1))
        other = np.unique(
            np.concatenate([sets[gone:], rng.integers(0, 1 << 63, differing - gone, dtype=np.uint64)])
        )
        shared = len(np.intersect1d(sets, other))
        if 100 * shared >= 80 * (len(sets) + len(other) - shared):
            assert set(jaccard_join.cells(sets)) & set(jaccard_join.cells(other)) or (
                np.array_equal(sets, other)
            )


def test_tree_loses_no_pair():
    rng = np.random.default_rng(9)
    points = rng.poisson(2, (300, jaccard_join.GROUPS)).astype(np.int32)
    for i in range(0, 300, 3):  # near points among them
        points[i] = points[i // 30]
        points[i, rng.integers(jaccard_join.GROUPS, size=4)] += 1
    sizes, labels = points.sum(1), rng.integers(0, 40, 300)
    tree = jaccard_join.Tree(points, sizes, labels)
    found = [tuple(sorted(p)) for a, b in tree.pairs(80) for p in zip(a.tolist(), b.tolist())]
    expected = {
        (i, j)
        for i, j in combinations(range(300), 2)
        if labels[i] != labels[j]
        and 180 * np.minimum(points[i], points[j]).sum() >= 80 * (sizes[i] + sizes[j])
    }
    assert len(found) == len(set(found)) and set(found) == expected and expected


def test_pairs_of_many_buckets_come_from_one():
    # a few texts of which each two share most shingles, but are not linked
    rng = np.random.default_rng(10)
    common = rng.integers(0, 1 << 63, 1700, dtype=np.uint64)
    sets = [np.unique(np.append(common, rng.integers(0, 1 << 63, 300, dtype=np.uint64))) for _ in range(8)]
    names = [np.unique(jaccard_join.cells(s).view(np.int64)) for s in sets]
    found, buckets = Counter(), Counter()
    for cell in np.unique(np.concatenate(names)):
        ids = [i for i, n in enumerate(names) if cell in n]
        for pair in combinations(ids, 2):
            buckets[pair] += 1
        n = len(ids)
        bucket = {
            "id": pa.array(ids, pa.int64()),
            "n": pa.array([len(sets[i]) for i in ids], pa.int64()),
            "label": pa.array(ids, pa.int64()),
            "point": pa.array([jaccard_join.point(sets[i]).tobytes() for i in ids], pa.binary()),
            "least": pa.array([names[i][:32].tolist() for i in ids], pa.list_(pa.int64())),
            **{c: pa.array([0] * n, pa.int32()) for c in ("part", "low", "high")},
            "cell": pa.array([cell] * n, pa.int64()),
        }
        pairs = jaccard_join._compared(80)(pa.table(bucket))
        found.update(zip(pairs["b"].to_pylist(), pairs["a"].to_pylist(), strict=True))
    assert set(found) == set(combinations(range(8), 2)) and min(buckets.values()) > 20
    assert found.total() <= 2 * len(found)


# --- collocations ---------------------------------------------------------------------


def _phrases(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        kept = []
        for p, a in counts.items():
            if len(p) == 1 or a < least:
                continue
            cuts = [
                (10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                for k in range(1, len(p))
            ]
            score, _, left, right = min(cuts)
            around = [
                b for q, b in counts.items() if len(q) == 3 > len(p) and p in (q[:2], q[1:]) and b >= least
            ]
            if not any(100 * b >= 50 * a for b in around):
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        kept.sort()
        out += [
            (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
            for i, (s, a, p, left, right) in enumerate(kept[:top])
        ]
    return sorted(out, key=repr)


def test_collocations_of_odd_rows(odd, empty):
    found = collocations.collocations(odd, least=2)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert _rows(found) == _phrases(ODD, 2, 2000)
    assert collocations.collocations(empty).collect() == []


@pytest.mark.parametrize("at_once", [1000, 400_000])
def test_collocations_as_counted(spark, monkeypatch, at_once):
    monkeypatch.setattr(collocations, "WORDS_AT_ONCE", at_once)
    monkeypatch.setattr(collocations, "MASS", at_once)
    rng = np.random.default_rng(3)
    names = [f"w{i}" for i in range(12)] + ["Sea", "of", "the", "sun\t"]
    ends = [" ", " ", " ", "  ", ". ", ",", "\n", "\r\n", "\x0b", "\x0c"]
    rows = [
        (i, "".join(f"{rng.choice(names)}{rng.choice(ends)}" for _ in range(60)), ["en", None, "und"][i % 3])
        for i in range(120)
    ]
    docs = _docs(spark, rows).repartition(3)
    assert _rows(collocations.collocations(docs, top=50)) == _phrases(rows, 10, 50)


def test_summaries_keep_the_frequent():
    rng = np.random.default_rng(1)
    keys = (rng.zipf(1.3, 60_000) % 5000).astype(np.uint32)
    least = 40
    total = Counter(keys.tolist())
    parts = [collocations.Summary(len(keys) // least + 1) for _ in range(4)]
    for i in range(0, len(keys), 500):
        some, count = np.unique(keys[i : i + 500], return_counts=True)
        parts[i // 500 % 4].add(some, count)
    whole = collocations.Summary(len(keys) // least + 1)
    for part in parts:
        whole.add(part.keys, part.counts, part.lost)
    assert whole.lost < least and len(whole.keys) <= whole.capacity
    found = set(whole.frequent(least).tolist())
    assert {k for k, f in total.items() if f >= least} <= found
    for k, f in zip(whole.keys.tolist(), whole.counts.tolist()):
        assert f <= total[k] <= f + whole.lost


# --- queries --------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_bit_search", "op12_jaccard_join", "op13_collocations"])
def test_query_as_its_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.execute(f"create view {table} as select * from '{Path(sf_dir) / table}.parquet'")
    expected = duck.execute(entry_point.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    found = entry_point.queries()[name](spark, sf_dir)
    rows = _rows(found.select(columns))
    assert rows and rows == sorted(expected.fetchall(), key=repr)
