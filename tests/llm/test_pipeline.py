import os
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from crawlmill.llm import catalog
from crawlmill.llm.guess_cost import public_words
from crawlmill.llm.secrets import all_spans, redacted
from tests.llm.test_simhash import brute_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are missing")


def brute(rows, good):
    """What the first four stages leave, in plain Python."""
    rows = [r for r in rows if good(r)]
    by_text = defaultdict(list)
    for r in rows:
        by_text[r["text"] or ""].append(r)
    rows = [max(group, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)) for group in by_text.values()]
    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    least = brute_components([plain_fingerprint(r["text"]) for r in rows], 3)
    rows = [r for i, r in enumerate(rows) if least[i] == i]
    words = public_words(public_tokenizers.path(catalog.WORDS_FILE))
    clean = lambda t: t and redacted(t, all_spans(t, words))
    return [r | {"text": clean(r["text"]), "n_chars": r["n_chars"] if r["text"] is None else len(clean(r["text"]))} for r in rows]


def staged(spark, docs, upto, folder):
    for name, stage in corpus_pipeline.STAGES[:upto]:
        before = docs.columns
        docs = stage(spark, docs, SF)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name != "best_fit_packing":
            assert docs.columns == before
    return docs


def key(row):
    return str(sorted(row.items(), key=str))


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    predicted = {r.doc_id: r.predicted for r in catalog.QUERIES["op3_quality"](spark, SF).collect()}
    expected = brute(rows, lambda r: predicted[r["doc_id"]] == 1)
    found = [r.asDict() for r in staged(spark, docs, 4, tmp_path).collect()]
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert len(expected) < len(rows)
    packed = corpus_pipeline.run(spark, SF).collect()
    words = defaultdict(int)
    for r in packed:
        words[r.doc_id] += r.n_words
    assert words == {r["doc_id"]: len([w for w in (r["text"] or "").split() if w]) for r in expected}


def test_odd_rows(spark, tmp_path):
    schema = T.StructType([*spark.read.parquet(f"{SF}/documents.parquet").schema.fields, T.StructField("score", T.StringType()), T.StructField("row", T.IntegerType())])
    good = "Of the hean thound and there was an oneder of the same, that in edst oning the reater thing. " * 3
    rows = [
        (1, good, "en", "a", len(good), "x", 1), (2, good, None, None, len(good), None, None), (2, good, None, None, len(good), None, None),
        (None, good + "More of the other", "en", "a", 5, "y", 2), (3, None, "en", "b", None, "z", 3), (4, "", "en", "b", 0, "z", 3),
        (5, good + " token = \"2abc3ff2ca8fb1e4c565a0eb63815530a948bdde\" and so on the rest of it", "en", "c", 0, "z", 4),
    ]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    scored = catalog.score_quality(docs.select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet")).collect()
    kept = {r.text for r in scored if r.predicted == 1}
    assert good in kept
    expected = brute([dict(zip(schema.names, r)) for r in rows], lambda r: r["text"] in kept)
    found = [r.asDict() for r in staged(spark, docs, 4, tmp_path).collect()]
    assert sorted(found, key=key) == sorted(expected, key=key)


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(F.lit(False))
    assert staged(spark, docs, 5, tmp_path).collect() == []


def test_stages_of_the_pipeline():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "secret_scans", "best_fit_packing"]
