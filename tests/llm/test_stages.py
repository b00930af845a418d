"""The pipeline's stages on odd and empty tables, with columns named as the operators' own."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from riskloom.llm import labelled

from .test_llm import LONG

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
NAMES = ("key", "node", "block", "group", "shard", "t", "m", "M", "score", "draw", "label", "kept_id", "n", "rank")
GOOD = " ".join(f"word{i}" for i in range(120))
ROWS = [
    (1, None, "en", "src1", 0),
    (2, "", None, None, 0),
    (3, " \t\n", "en", "other", None),
    (4, LONG, "en", "src2", 1),
    (5, GOOD, "en", "src1", 1),
    (5, GOOD, "en", "src1", 1),
    (6, GOOD, "de", "src1", 1),
    (7, GOOD.replace("word7 ", "other "), None, None, 1),
    (None, GOOD + " end", "en", "src1", 1),
    (None, None, None, None, None),
]
FILTERS = ("toxicity", "quality_rules", "near_dedup", "mixing")


def _extended(rows):
    taken = {c.lower() for c in rows.columns}
    for name in NAMES:
        if name.lower() not in taken:
            taken.add(name.lower())
            rows = rows.withColumn(name, F.lit(1))
    return rows


@pytest.fixture(scope="module", params=["odd", "empty"])
def folder(request, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp(request.param))
    docs = _extended(spark.createDataFrame(ROWS if request.param == "odd" else [], DOCS))
    docs.write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return request.param, path


@pytest.mark.parametrize("name", FILTERS)
def test_stage(spark, folder, name):
    kind, path = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)[name](spark, docs, path)
    assert kept.columns == docs.columns
    rows = kept.select("doc_id", "text").collect()
    ids = sorted((r.doc_id for r in rows), key=lambda i: -1 if i is None else i)
    if kind == "empty":
        assert ids == []
    elif name == "toxicity":
        # without labels nothing is known to be toxic
        assert len(ids) == len(ROWS)
    elif name == "quality_rules":
        assert set(ids) <= {None, 5, 6, 7} and all(r.text for r in rows)
    elif name == "near_dedup":
        assert ids == [None, None, 1, 2, 3, 4, 5]
    else:
        given = {(r[0], r[1]) for r in ROWS}
        assert {(r.doc_id, r.text) for r in rows} <= given and all(r.text for r in rows)


def test_all_stages(spark, folder):
    kind, path = folder
    rows = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in rows} <= {None, 5, 6, 7}
    assert kind == "odd" or not rows
    for r in rows:
        assert r.n_tokens > 0 and len(r.ids_sha256) == len(r.decoded_sha256) == 64


def test_repeated_rows_of_a_labelled_id_count_once(spark):
    docs = spark.range(2000).selectExpr("id % 2 as doc_id", "'t' || id % 4 as text")
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (9, 1)], "doc_id long, toxic int")
    assert sorted(labelled.sample(docs, labels, "toxic", (5, 5))) == [("t0", 1), ("t1", 0)]
