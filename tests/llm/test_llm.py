"""The training-data operators against libraries and brute force, and on odd tables."""

import hashlib
import random
import math
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from riskloom.llm import (
    bpe,
    brown_lm,
    components,
    kneser_ney,
    labelled,
    mixing,
    near_dedup,
    quality_rules,
    queries,
    sharding,
    token_counts,
    top_k,
    toxicity,
)
from riskloom.session import written

DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids int, M string"
LONG = "word " * 30_000 + "x" * 20_000
ODD = [
    (1, None, "en", "src1", 0, 1, "a"),
    (2, "", None, None, 0, 1, "a"),
    (3, " \t\n", "en", "other", 3, 1, "a"),
    (4, LONG, "en", "src2", 1, 1, "a"),
    (5, "the cat sat on the mat and ate", "en", "src1", 1, 1, "a"),
    (5, "the cat sat on the mat and ate", "en", "src1", 1, 1, "a"),
    (6, "the cat sat on the mat and ate", "de", "src1", 1, 1, "a"),
    (50, "the cat sat", "en", None, 1, 1, "a"),
    (None, "the cat sat on a mat", "en", "src1", 1, 1, "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def _words(text):
    return (text or "").encode().lower().split()


def test_encoding_as_the_library(spark, sf_dir, texts):
    path = public_tokenizers.path(queries.MULTI_BPE)
    ranks = bpe.load_ranks(path)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    own = bpe.encoder(ranks, public_tokenizers.PATTERN)
    for text in ["", "a" * 9000, "ab" * 4000 + "日本" * 99, " \n\n x", LONG]:
        assert own(text) == np.array(library.encode_ordinary(text), "<u4").tobytes()
    for row in queries.op6_byte_bpe(spark, sf_dir).collect():
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_lower_rank_interrupts_a_bucket():
    # merging a+b first makes a pair of a lower rank, which goes before the other a+b
    ranks = {b"a": 0, b"b": 1, b"c": 2, b"ab": 5, b"abab": 3, b"abc": 4}
    assert bpe.merge(b"ababc", ranks, bpe.RankQueue(9)) == [3, 2]


def test_bpe_keeps_pre_tokens_between_tasks(monkeypatch):
    path = public_tokenizers.path(queries.MULTI_BPE)
    texts = [f"zqxjk{i} wvbnm{i}" for i in range(50)]
    first = list(bpe.kept_encoder(path, public_tokenizers.PATTERN).encode_in_turn(texts))
    merged, merge_all = [], bpe.merge_all
    monkeypatch.setattr(bpe, "merge_all", lambda pieces, *rest: merged.extend(pieces) or merge_all(pieces, *rest))
    again = list(bpe.kept_encoder(path, public_tokenizers.PATTERN).encode_in_turn([*texts, "zqxjk vbnmq"]))
    assert again[:-1] == first and set(merged) <= {b"zqxjk", b" vbnmq"}


def _plain_bpe(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks.get(parts[i] + parts[i + 1]), i) for i in range(len(parts) - 1)]
        best = min((p for p in pairs if p[0] is not None), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def test_pieces_in_one_queue_merge_as_alone():
    rng = random.Random(5)

    def drawn(longest):
        return bytes(rng.choice(b"abc") for _ in range(rng.randint(1, longest)))

    for _ in range(300):
        tokens = sorted({t for t in (drawn(5) for _ in range(20)) if len(t) > 1})
        order = rng.sample(range(256 + len(tokens)), 256 + len(tokens))
        known = dict(zip([bytes([b]) for b in range(256)] + tokens, order, strict=True))
        ranks, pieces = bpe.Ranks(known), [drawn(14) for _ in range(9)]
        queue = ranks.queue()
        want = [np.array(_plain_bpe(p, known), "<u4").tobytes() for p in pieces]
        assert bpe.merge_all(pieces, ranks, queue) == want
        ranks.edge = None  # as with a vocabulary that uses every byte
        assert bpe.merge_all(pieces, ranks, queue) == want
        assert not queue.buckets and not any(queue.low)


def test_token_counts_as_the_library(spark, sf_dir, texts):
    path = public_tokenizers.path(queries.WORD_BPE)
    library = Tokenizer.from_file(path)
    count = token_counts.counter(token_counts.load(path), token_counts.proven(path))
    cases = ["", " \t", "<|startoftext|>ab<|endoftext|> <|endoftext", "ΑΣ ΟΔΟΣ Σ", "don't I'LL 'S"]
    cases += ["İstanbul ﬁ", "a\x1cb\x85c", "é ½² ١٢", "日本語😀", "x" * 3000]
    for text in cases:
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), text
    for row in queries.op9_token_counts(spark, sf_dir).collect():
        n = len(library.encode(texts[row.doc_id], add_special_tokens=False).ids)
        assert (row.n_tokens, row.over_limit) == (n, n > 2048)
        assert row.n_bytes == len(texts[row.doc_id].encode())


def _brute_components(texts):
    sets = {}
    for i, text in texts.items():
        w = _words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates_against_all_pairs(spark, sf_dir, texts):
    expected = _brute_components(texts)
    rows = queries.op2_near_dedup(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_that_share_a_passage(spark):
    rng = np.random.default_rng(5)
    passage = [f"p{k}" for k in range(60)]
    rows = {}
    for i in range(60):
        own = [f"w{i}x{k}" for k in range(int(rng.integers(4, 30)))]
        rows[i] = " ".join(passage + own)
    for i in range(60, 90):
        copy = rows[i - 60].split()
        copy[int(rng.integers(len(copy)))] = f"c{i}"
        rows[i] = " ".join(copy)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    found = near_dedup.duplicates(docs.repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == _brute_components(rows)


def test_repeated_rows_in_crowded_bands(spark):
    rng = np.random.default_rng(6)
    rows = {}
    for i in range(120):
        rows[i] = [f"p{k}" for k in range(90)] + [f"w{i}x{k}" for k in range(int(rng.integers(25, 60)))]
    found = []
    crowded = spark.createDataFrame([(i, i) for i in range(240)], "node long, component long")
    for i in range(120, 240):
        copy = list(rows[i - 120])
        copy[95 + i % 20] = f"c{i}"
        rows[i] = copy
    rows = {i: " ".join(w) for i, w in rows.items()}
    for repeats in (1, 12):
        texts = spark.createDataFrame(
            [(i, t) for i, t in rows.items() for _ in range(repeats)], "node long, text string"
        )
        found.append({(r.a, r.b) for r in near_dedup._by_rarest(crowded, texts).collect()})
    assert {(i, i + 120) for i in range(120)} <= found[0] and found[1] == found[0]


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(99, 98)], "a long, b long")
    found = {r.node: r.component for r in components.components(edges).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 98: 98, 99: 98}


def test_search_against_all_scores(spark, sf_dir, texts):
    docs = {i: Counter(_words(t)) for i, t in texts.items()}
    n, mean = len(docs), sum(c.total() for c in docs.values()) / len(docs)
    held = Counter(w for c in docs.values() for w in c)
    found = defaultdict(list)
    for row in queries.op3_top_k(spark, sf_dir).orderBy("query_id", "rank").collect():
        found[row.query_id].append(row)
    for query in (i for i in docs if i % 50 == 0):
        scores = {}
        for i, c in docs.items():
            norm = 1.2 * (0.25 + 0.75 * c.total() / mean)
            score = sum(
                math.log1p((n - held[w] + 0.5) / (held[w] + 0.5)) * c[w] * 2.2 / (c[w] + norm)
                for w in docs[query]
                if w in c
            )
            if score:
                scores[i] = score
        best = sorted(scores.values(), reverse=True)[:10]
        assert np.allclose([r.score for r in found[query]], best)
        assert all(math.isclose(scores[r.doc_id], r.score) for r in found[query])
        assert [r["rank"] for r in found[query]] == list(range(1, len(best) + 1))


def test_search_in_groups_of_queries(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.4)) % 900}" for _ in range(40)), "en") for i in range(600)]
    rows += [(i + 600, t, "de") for i, t, _ in rows[:40]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = [tuple(r) for r in top_k.search(docs).orderBy("query_id", "rank").collect()]
    names, write = [], top_k.written
    monkeypatch.setattr(top_k, "written", lambda df, name: names.append(name) or write(df, name))
    monkeypatch.setattr(top_k, "LEAST_GROUP", 1000)
    monkeypatch.setattr(top_k, "LEAST_SHARDS", 40)
    grouped = [tuple(r) for r in top_k.search(docs).orderBy("query_id", "rank").collect()]
    # a group's terms are no more for a shard than its share of the text
    assert names.count("found") > 1
    assert grouped == whole
    # equal texts score the same in any shard, and the smaller id comes first
    assert [r[2] for r in whole if r[0] == 0][:2] == [0, 600]
    assert len({r[3] for r in whole if r[0] == 0 and r[2] in (0, 600)}) == 1


def test_index_scores_few_documents():
    rng = random.Random(7)
    texts = [" ".join(f"{i // 500}w{int(rng.paretovariate(0.4)) % 5000}" for _ in range(60)) for i in range(2000)]
    found = [top_k.terms_of(t)[0] for t in texts]
    terms, held = np.unique(np.concatenate(found), return_counts=True)
    index = top_k.Index(texts, 60.0, terms[held > 250])
    rows = []

    class Columns(np.ndarray):
        def __getitem__(self, key):
            out = super().__getitem__(key)
            if not isinstance(key, tuple):
                rows.append(len(out))
            return out.view(np.ndarray)

    index.columns = index.columns.view(Columns)
    every = np.log1p((2000 - held + 0.5) / (held + 0.5))
    for query in range(0, 2000, 100):
        rows.clear()
        idf = every[np.searchsorted(terms, found[query])]
        docs, scores = index.search(found[query], idf, 10)
        assert docs[scores.argmax()] == query and 10 <= len(docs) < 20
        # blocks of documents without a word of the query are not read
        assert sum(rows) <= 500


def test_shards(spark, sf_dir, texts):
    rows = queries.op4_sharding(spark, sf_dir).toPandas()
    assert len(rows) == len(texts)
    by_shard = rows.groupby("shard")
    total = by_shard["size"].sum()
    largest = rows["size"].max()
    assert set(total.index) == set(range(24)) and total.max() - total.min() <= largest
    assert (by_shard["slot"].max() == by_shard["slot"].count() - 1).all()
    assert (by_shard["slot"].nunique() == by_shard["slot"].count()).all()
    for row in rows.itertuples():
        data = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32) == (len(data) + 8, zlib.crc32(data))


def test_hot_group_is_split(spark):
    rows = [(i, "same text here") for i in range(600)] + [(i, f"text {i}") for i in range(600, 1400)]
    found = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    sizes = found.groupby("shard")["size"].sum()
    assert sizes.max() < 1.25 * sizes.mean()


def test_base_rules(spark, sf_dir, texts):
    for row in queries.op7_quality_rules(spark, sf_dir).collect():
        text = texts[row.doc_id]
        w = text.encode().split()
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        repeated = {
            i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)
        }
        lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
        assert row.n_words == len(w)
        assert row.word_chars == sum(len(x.decode()) for x in w)
        assert row.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == len(repeated)
        assert row.base_failed == (len(w) < 50 or 2 * len(repeated) > len(w))
        assert not (row.kept and row.base_failed)


def test_repeated_words_of_many_ids():
    parts = [b"w%d" % (i % 140_000) for i in range(280_001)]
    assert quality_rules.repeated_words(parts, quality_rules._Ids()) == len(parts)


@pytest.fixture(scope="module")
def larger(sf_dir):
    return sf_dir.replace("sf0.001", "sf0.1")


def test_quality_on_rows_not_fitted(spark, larger):
    docs = spark.read.parquet(f"{larger}/documents.parquet")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    part = F.xxhash64("doc_id") % 2 == 0
    model = quality_rules.fit(docs, labels.where(part))
    rest = quality_rules.judged(docs.join(labels.where(~part), "doc_id"), model)
    seen = rest.where(~F.col("base_failed")).join(labels, "doc_id")
    right = seen.agg(F.avg(((F.col("good") >= 0.5) == (F.col("quality") == 1)).cast("int"))).first()
    assert right[0] > 0.97


def test_toxicity_on_held_out_rows(spark, larger):
    rows = queries.op1_toxicity(spark, larger).where("held_out")
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    pair = rows.join(labels, "doc_id").toPandas()
    order = pair.score.rank()
    pos = pair.toxic == 1
    auc = (order[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.85
    assert pair.predicted[~pos].mean() < 0.01
    assert ((pair.score >= 0) & (pair.score <= 1)).all()


def test_toxicity_tolerates_inserted_letters():
    rng = np.random.default_rng(3)
    letters = list("aeioubdfglmnprstv")
    names = ["".join(rng.choice(letters, rng.integers(3, 9))) for _ in range(9000)]
    rows = []
    for i in range(500):
        text = [str(w) for w in rng.choice(names, 30)] + ["garden", "river"]
        rows.append((" ".join([*text, "scoundrel"] if i % 4 == 0 else text), int(i % 4 == 0)))
    rows = [rows[i] for i in rng.permutation(len(rows))]
    scorer = toxicity.Scorer(toxicity.train(rows))
    score, unit = scorer.scores(["a scoundrel", "s.c.o.u.n.d.r.e.l", "scoun*drel", "garden river", "", None])
    assert (score[:3] > 0.5).all() and (score[3:] < 0.5).all()
    assert unit[0] == "scoundrel" and unit[4] is None


def test_all_clean_words_are_mined():
    weights = np.random.default_rng(2).normal(size=toxicity.SLOTS).astype(np.float32)
    model = toxicity.Model(weights, 0.0, 1.0, 0.0)
    names = [f"w{i:x}" for i in range(210_000)]
    order = np.argsort(-model.margins(names), kind="stable")[:100]
    assert toxicity._hardest(model, names, 100) == [names[i] for i in order]


def test_all_telling_words_are_learned(monkeypatch):
    rng = np.random.default_rng(9)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    names = ["".join(rng.choice(letters, 7)) for _ in range(1260)]
    bad, plain = names[:260], names[260:]
    rows = [(" ".join([w, *rng.choice(plain, 3)]), 1) for w in bad for _ in range(14)]
    rows += [(" ".join(rng.choice(plain, 12)), 0) for _ in range(9000)]
    seen, plain_fit = [], toxicity._fit

    def recorded(positive, *others):
        seen.append(set(positive))
        return plain_fit(positive, *others)

    monkeypatch.setattr(toxicity, "_fit", recorded)
    toxicity.train([rows[i] for i in rng.permutation(len(rows))])
    assert all(len(words.intersection(bad)) > 200 for words in seen)


def test_kernel_folds_to_the_same_margin():
    positive, negative = ["scoundrel", "scoundrels"], ["garden", "river", "green"]
    landmarks = ["scoundrel", "garden", "river"]
    table, bias = toxicity._fit(positive, negative, landmarks, np.ones(2))
    margins = toxicity.Model(table, bias, 1.0, 0.0).margins(positive + negative)
    assert (margins[:2] > 0.5).all() and (margins[2:] < -0.5).all()


def test_perplexity_by_brute_force(spark):
    trusted = ["abracadabra", "abrakadabra", "banana band"]
    docs = [(i, t, "en") for i, t in enumerate([*trusted, "zzz abra", ""])]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3)], "doc_id long, quality int, toxic int")
    rows = kneser_ney.judged(spark.createDataFrame(docs, "doc_id long, text string, lang string"), labels)
    found = {r.doc_id: r.perplexity for r in rows.collect()}
    counts = Counter()
    for t in trusted:
        data = b"\x02\x02\x02" + t.encode()
        counts.update(data[k : k + 4] for k in range(len(data) - 3))
    tables = [counts]
    for _ in range(3):
        tables.append(Counter(g[1:] for g in tables[-1]))
    tables = tables[::-1]

    def off(table):
        n = Counter(min(v, 5) for v in table.values())
        n = {k: sum(1 for v in table.values() if v == k) for k in range(1, 5)}
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
        return [
            min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.0), k) if n[k] else 0.5 for k in (1, 2, 3)
        ]

    def probability(gram):
        p = 1 / 256
        for order, table in enumerate(tables, 1):
            g, d = gram[4 - order :], off(table)
            seen = {x: c for x, c in table.items() if x[:-1] == g[:-1]}
            if total := sum(seen.values()):
                left = sum(d[min(c, 3) - 1] for c in seen.values())
                mine = table[g] - d[min(table[g], 3) - 1] if g in table else 0.0
                p = mine / total + left / total * p
        return p

    for i, t, _ in docs:
        data = b"\x02\x02\x02" + t.encode()
        logs = [math.log(probability(data[k : k + 4])) for k in range(len(t))]
        assert found[i] is None if not logs else math.isclose(found[i], math.exp(-sum(logs) / len(logs)))


def test_word_order_counts(spark):
    rng = np.random.default_rng(4)
    parts = [f"w{k}" for k in range(40)]
    after = {w: [str(x) for x in rng.choice(parts, 3, replace=False)] for w in parts}

    def chain():
        out = [parts[int(rng.integers(40))]]
        while len(out) < 60:
            out.append(after[out[-1]][int(rng.integers(3))])
        return out

    good = [chain() for _ in range(300)]
    mixed = [[str(w) for w in rng.permutation(chain())] for _ in range(30)]
    docs = [(i, " ".join(t), "en") for i, t in enumerate(good + mixed)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(270)], "doc_id long, quality int, toxic int")
    rows = kneser_ney.judged(
        spark.createDataFrame(docs, "doc_id long, text string, lang string"), labels, kneser_ney.WORDS
    ).collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert sum(kept[i] for i in range(270, 300)) > 24 and not any(kept[i] for i in range(300, 330))
    # thresholds come from trusted documents that were left out, as they are
    out = {i for i in range(270) if zlib.crc32(str(i).encode()) % 10 == 0}
    assert max(r.perplexity for r in rows if r.doc_id in out) == rows[0].threshold


def test_class_model_beats_the_base(spark, sf_dir, texts):
    rows = queries.op10_brown_lm(spark, sf_dir).toPandas()
    counts = Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*_words(t), None])
    total, kinds = counts.total(), len(counts)
    for r in rows.itertuples():
        tokens = [*_words(texts[r.doc_id]), None]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert (r.n_tokens, r.n_known) == (len(tokens), sum(w in counts for w in tokens))
        assert r.train_tokens == total
    held = rows[rows.held_out]
    assert held.score.sum() > held.base_score.sum()


def _shuffle_files(spark):
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(held.apply(i).getName().startswith("shuffle_") for i in range(held.size()))


def test_written_tables_leave_no_shuffle_files(spark):
    rows = spark.range(1000).withColumn("n", F.col("id") % 7)
    before = _shuffle_files(spark)
    found = written(rows.repartition(5, "n"), "test")
    left = _shuffle_files(spark)
    for _ in range(50):  # Spark deletes them beside its work
        if left <= before:
            break
        time.sleep(0.1)
        left = _shuffle_files(spark)
    assert left <= before and found.count() == 1000


def test_class_model_leaves_no_shuffle_files(spark):
    docs = spark.createDataFrame([(i, f"a b{i % 3} c{i % 5}") for i in range(60)], "doc_id long, text string")
    before = _shuffle_files(spark)
    found = brown_lm.scored(docs)
    left = _shuffle_files(spark)
    for _ in range(50):
        if left <= before:
            break
        time.sleep(0.1)
        left = _shuffle_files(spark)
    assert left <= before and found.count() == 60


def test_class_model_sums_to_one():
    units = brown_lm._Units([b"a", b"b"])
    size = np.concatenate([[5.0, 3.0, 2.0], np.zeros(brown_lm.SHAPES)])
    size[units[b"rare"]] = 4
    classes = np.arange(len(size)) % brown_lm.CLASSES
    emit = (size + 0.5) / (
        np.bincount(classes, size, brown_lm.CLASSES) + 0.5 * np.bincount(classes, minlength=brown_lm.CLASSES)
    )[classes]
    assert np.allclose(np.bincount(classes, emit, brown_lm.CLASSES), 1)


def test_words_below_any_share_get_classes_of_their_own(spark):
    # six words in 160,000 tokens, all of one suffix; what stands around them tells them apart
    rows = [(i, " ".join(["ga ma"] * 2000)) for i in range(40)]
    for i in range(40, 46):
        rows.append((i, "ga xzz ga xzz ga yzz yzz ma yzz ma yzz"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    parts = docs.select(F.explode(F.split("text", " ")).alias("key"))
    vocabulary = parts.groupBy(F.col("key").cast("binary").alias("key")).agg(F.count("*").alias("n"))
    total = brown_lm.totals(vocabulary, len(rows))
    words_of = brown_lm.lexicon(vocabulary, 17)
    unit = {bytes(r.key): r.unit for r in words_of.collect()}
    assert len({unit[w] for w in (b"xzz", b"yzz", b"ga", b"ma")}) == 4 and min(unit.values()) > brown_lm.END
    state = brown_lm._state_of(brown_lm.first_classes(docs, words_of, total), 17)
    texts = [[unit[w] for w in t.encode().split()] + [brown_lm.END] for _, t in rows]
    packed = [(bytearray(np.array(t, "<u4").tobytes()),) for t in texts]
    pairs = spark.createDataFrame(packed, "units binary").mapInArrow(
        brown_lm._neighbours(17), "part int, side int, data binary"
    )
    state, table = brown_lm.exchange_all(pairs, state, 17)
    of = {r.unit: r["class"] for r in state.mapInArrow(brown_lm._listed(17), "unit long, class int, n long").collect()}
    want = Counter((of[a], of[b]) for t in texts for a, b in zip([brown_lm.END, *t], t, strict=False))
    assert {(a, b): int(table[a, b]) for a, b in zip(*np.nonzero(table), strict=True)} == want
    assert of[unit[b"xzz"]] != of[unit[b"yzz"]]


def test_packed_counts_come_in_small_batches(spark, monkeypatch):
    seen, write = defaultdict(set), brown_lm.written
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def noted(df, label):
        seen[label].add(int(spark.conf.get(name)))
        return write(df, label)

    monkeypatch.setattr(brown_lm, "written", noted)
    rows = [(i, f"a b{i % 7} c d{i % 3} e") for i in range(60)]
    assert brown_lm.scored(spark.createDataFrame(rows, "doc_id long, text string")).count() == 60
    assert seen["contexts"] == {32} and seen["words"] == {1024}
    assert spark.conf.get(name) == before


def _comparable(rows):
    return sorted(map(repr, rows))


def test_mixing_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    rows = queries.op8_mixing(spark, sf_dir)
    expected = con.execute(queries.ORACLE["op8_mixing"])
    columns = [d[0] for d in expected.description]
    assert set(columns) == set(rows.columns)
    got = [tuple(r) for r in rows.select(*columns).collect()]
    assert got and _comparable(got) == _comparable(expected.fetchall())


def test_shortages_go_to_siblings_first(spark):
    target = mixing.Target(weights={}, budget_percent=50, max_epochs=1)
    leaves = [("d1", "en", "a", 100), ("d1", "en", "b", 1000), ("d2", "en", "c", 1100)]
    rows = mixing.budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long"), target)
    # a can't take its half of d1's 550, b takes the rest, d2 keeps its own
    assert {r.source: int(r.budget) for r in rows.collect()} == {"a": 100, "b": 450, "c": 550}


def test_odd_rows(odd, no_labels):
    n = len(ODD)
    path = public_tokenizers.path(queries.MULTI_BPE)
    assert bpe.digests(odd, path, public_tokenizers.PATTERN).count() == n
    assert token_counts.counts(odd, public_tokenizers.path(queries.WORD_BPE)).count() == n
    shards = sharding.sharded(odd).toPandas()
    assert len(shards) == n and shards["size"].min() == 8
    assert quality_rules.judged(odd, quality_rules.fit(odd, no_labels)).count() == n
    tox = toxicity.scored(odd, toxicity.fit(odd, no_labels)).collect()
    assert len(tox) == n and not any(r.predicted for r in tox)
    near = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.duplicates(odd).collect()}
    assert {(1, 1, True), (5, 5, True), (6, 5, False), (None, None, True)} <= near
    assert kneser_ney.judged(odd, no_labels).count() == n
    lm = brown_lm.scored(odd).collect()
    assert len(lm) == n and all(r.n_tokens >= 1 and r.score < 0 for r in lm)
    assert {r.query_id for r in top_k.search(odd).collect()} == {50}
    mixed = mixing.mix(odd)
    assert mixed.columns == [*odd.columns, "mix_epoch"] and mixed.where("doc_id < 4").isEmpty()
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 5").count() == 1


def test_empty_tables(empty, no_labels):
    path = public_tokenizers.path(queries.MULTI_BPE)
    assert bpe.digests(empty, path, public_tokenizers.PATTERN).isEmpty()
    assert token_counts.counts(empty, public_tokenizers.path(queries.WORD_BPE)).isEmpty()
    assert sharding.sharded(empty).isEmpty()
    assert quality_rules.judged(empty, quality_rules.fit(empty, no_labels)).isEmpty()
    assert toxicity.scored(empty, toxicity.fit(empty, no_labels)).isEmpty()
    assert near_dedup.duplicates(empty).isEmpty()
    assert kneser_ney.judged(empty, no_labels).isEmpty()
    assert brown_lm.scored(empty).isEmpty()
    assert top_k.search(empty).isEmpty()
    assert mixing.mix(empty).isEmpty()


def test_pipeline_against_its_operators(spark, sf_dir, texts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = toxicity.scored(docs, toxicity.fit(docs, labels)).where("predicted = 0")
    stage = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    assert stage.columns == docs.columns
    assert _comparable(stage.select("doc_id").collect()) == _comparable(clean.select("doc_id").collect())
    good = quality_rules.judged(docs, quality_rules.fit(docs, labels)).where("kept")
    stage = corpus_pipeline.keep_quality(spark, docs, sf_dir)
    assert _comparable(stage.select("doc_id").collect()) == _comparable(good.select("doc_id").collect())
    one = {c for _, c in _brute_components(texts).values()}
    stage = corpus_pipeline.keep_one_of_near(spark, docs, sf_dir)
    assert {r.doc_id for r in stage.select("doc_id").collect()} == one
    stage = corpus_pipeline.mix_sources(spark, docs, sf_dir)
    mixed = queries.op8_mixing(spark, sf_dir)
    assert stage.columns == docs.columns
    assert _comparable(stage.select("doc_id").collect()) == _comparable(mixed.select("doc_id").collect())
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_calibration_keeps_the_order():
    slope, offset = labelled.calibrate(np.array([-2.0, -1, 1, 2] * 9), np.array([0, 0, 1, 1] * 9))
    assert slope > 0 and abs(offset) < 1


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry_point.queries())
    assert {n for n in names if n.startswith("op") and n[2].isdigit()} == set(queries.QUERIES)
    numbers = [int(n[2 : n.index("_")]) for n in queries.QUERIES]
    assert numbers == list(range(1, 14)) and "pipeline" in names


def test_search_builds_each_index_once(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.4)) % 900}" for _ in range(40)), "en") for i in range(1000)]
    rows += [(None, t, "en") for _, t, _ in rows[:70]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    built, names, write = [], [], top_k.written
    monkeypatch.setattr(top_k, "written", lambda df, name: names.append(name) or built.append(write(df, name)) or built[-1])
    monkeypatch.setattr(top_k, "LEAST_GROUP", 2000)
    monkeypatch.setattr(top_k, "PIECE", 1000)
    found = defaultdict(list)
    for r in top_k.search(docs).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.doc_id, r.score))
    # several groups of queries read shards that were indexed once
    assert names.count("index") == 1 and names.count("found") > 1
    index = built[names.index("index")]
    assert index.count() == 8 and index.agg({"n": "sum"}).first()[0] == len(rows)
    bags = [Counter(t.encode().split()) for _, t, _ in rows]
    held, mean = Counter(w for c in bags for w in c), sum(c.total() for c in bags) / len(bags)
    for query in range(0, 1000, 50):
        scores = {}
        for i, c in enumerate(bags[:1000]):
            norm = 1.2 * (0.25 + 0.75 * c.total() / mean)
            idf = {w: math.log1p((len(bags) - held[w] + 0.5) / (held[w] + 0.5)) for w in bags[query]}
            scores[i] = sum(idf[w] * c[w] * 2.2 / (c[w] + norm) for w in bags[query] if w in c)
        best = sorted(scores.items(), key=lambda x: (-round(x[1], 9), x[0]))[:10]
        assert [i for i, _ in found[query]] == [i for i, _ in best]
        assert np.allclose([x for _, x in found[query]], [x for _, x in best])


def test_word_perplexity_by_brute_force_in_rounds(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(rng.randrange(60))) for _ in range(120)]
    docs = [(i, t, "en") for i, t in enumerate(texts)] + [(7, texts[7], "en"), (None, texts[8], None), (500, None, "en")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    names, write = [], kneser_ney.written
    monkeypatch.setattr(kneser_ney, "written", lambda df, name: names.append(name) or write(df, name))
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    rows = kneser_ney.judged(table, labels, kneser_ney.WORDS).collect()
    # n-grams are shuffled in parts, one after the other
    assert names.count("scored") == kneser_ney.ROUNDS > 1
    grams = Counter()
    for i, t, _ in docs:
        if i is not None and i < 60 and zlib.crc32(str(i).encode()) % 10:
            data = [None, None, *t.split()]
            grams.update(zip(data, data[1:], data[2:], strict=False))
    tables = [grams]
    for _ in range(2):
        tables.append(Counter(g[1:] for g in tables[-1]))
    tables, offs = tables[::-1], []
    for table in tables:
        n = Counter(table.values())
        y = n[1] / (n[1] + 2 * n[2])
        offs.append([0, *(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) if n[k] else 0.5 for k in (1, 2, 3))])

    def probability(gram):
        p = 1 / (len(tables[0]) + 1)
        for order, (table, d) in enumerate(zip(tables, offs, strict=True), 1):
            g = gram[3 - order :]
            seen = [c for x, c in table.items() if x[:-1] == g[:-1]]
            if seen:
                p = (table[g] - d[min(table[g], 3)] + sum(d[min(c, 3)] for c in seen) * p) / sum(seen)
        return p

    found = {r.doc_id: r.perplexity for r in rows}
    assert len(rows) == len(docs) and found[500] is None
    for i, t, _ in docs[::9] + docs[-3:-1]:
        data = [None, None, *t.split()]
        logs = [math.log(probability(g)) for g in zip(data, data[1:], data[2:], strict=False)]
        assert math.isclose(found[i], math.exp(-sum(logs) / len(logs)), rel_tol=1e-9) if logs else found[i] is None
