import math
import random
import zlib

import pytest
import regex
from pyspark.sql import functions as F

from crawlmill.llm.quality import CUTOFF, STATISTICS, Rule, RuleEnsemble, fit, score_quality, training_rows, with_statistics

random.seed(11)
WORDS = ["".join(random.choices("abcdefghij", k=random.randint(2, 7))) for _ in range(400)]


def prose(n):
    return " ".join(random.choices(WORDS, k=n)) + "."


def junk(n):
    return " ".join(w.upper() + "%%%" for w in random.choices(WORDS[:20], k=n))


def plain_stats(text):
    text = text or ""
    keep = lambda pattern: len(regex.findall(pattern, text))
    words = [w for w in regex.split(r"[\t\n\x0b\f\r ]+", text) if w]
    lines = [line for line in text.split("\n") if line]
    letters, digits, blanks, marks = keep(r"\p{L}"), keep("[0-9]"), keep(r"[\t\n\x0b\f\r ]"), keep(r"[.,;:?'\"()-]")
    solid = len(text) - blanks
    share = lambda a, b: a / b if b else 0.0
    return {
        "log_words": math.log1p(len(words)), "word_length": share(solid, len(words)),
        "distinct_words": share(len(set(words)), len(words)), "distinct_lines": share(len(set(lines)), len(lines)),
        "letters": share(letters, solid), "upper": share(keep(r"\p{Lu}"), letters), "digits": share(digits, solid),
        "blanks": share(blanks, len(text)), "marks": share(marks, solid),
        "symbols": share(solid - letters - digits - marks, solid),
        "bare_marks": share(keep(r"(?<![^\t\n\x0b\f\r ])[^\p{L}\p{N}\t\n\x0b\f\r ]+(?![^\t\n\x0b\f\r ])"), len(words)),
        "long_words": share(sum(len(w) >= 20 for w in words), len(words)),
    }


TEXTS = [None, "", " \n ", "One", "Ä b | c -- 12,5 É!", "x\nx\ny\n\nx", "a" * 50 + " b", prose(30000), junk(40)]


def test_statistics(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(TEXTS)], "doc_id long, text string, counts string")
    for row in with_statistics(docs.drop("counts")).collect():
        assert row.stats.asDict() == pytest.approx(plain_stats(TEXTS[row.doc_id])), row.doc_id


def test_compiled_rules_equal_rules(spark):
    rules = {
        Rule(()).and_bound("upper", True, 0.5).and_bound("upper", True, 0.2).and_bound("letters", False, 0.1): 1.5,
        Rule((("log_words", False, 1.0),)): -2.25,
    }
    model = RuleEnsemble(0.5, rules)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for row in with_statistics(docs).withColumn("score", model.score()).collect():
        stats = plain_stats(TEXTS[row.doc_id])
        total = 0.5 + sum(w for r, w in rules.items() if r.holds(stats))
        assert row.score == pytest.approx(1 / (1 + math.exp(-total)))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, prose(random.randint(5, 80)) if i % 4 else junk(random.randint(5, 80)), "x", 0.0) for i in range(600)]
    rows += [(i, t, None, None) for i, t in enumerate(TEXTS, 1000)] + [(None, "null id", "y", 1.0), (1001, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stats string, score double")
    labels = [(i, int(i % 4 > 0)) for i in range(0, 600)] + [(None, 1), (3, None), (9999, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    scored = score_quality(docs, labels)
    assert scored.columns == ["doc_id", "text", "stats", "held_out", "score", "predicted"]
    rows = scored.collect()
    assert len(rows) == 600 + len(TEXTS) + 2
    for row in rows:
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= CUTOFF)
    tested = [r for r in rows if r.held_out and r.doc_id < 600]
    assert sum(r.predicted == int(r.doc_id % 4 > 0) for r in tested) / len(tested) > 0.97


def test_labels_of_the_held_out_fold_are_not_read(spark, corpus):
    docs, labels = corpus
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    models = [fit(training_rows(docs, given, "quality")) for given in (labels, turned)]
    assert models[0] == models[1] and models[0].weights
    assert {name for rule in models[0].weights for name, _, _ in rule.bounds} <= set(STATISTICS)


def test_sample_is_bounded(spark, corpus):
    assert 40 < training_rows(*corpus, "quality", sample=50).count() <= 50  # a label may have no document


def test_no_labels_one_class_and_no_rows(spark, corpus):
    docs, labels = corpus
    assert {r.score for r in score_quality(docs, labels.limit(0)).select("score").collect()} == {0.5}
    assert {r.predicted for r in score_quality(docs, labels.filter("quality = 0")).collect()} == {0}
    assert score_quality(docs.limit(0), labels).collect() == []
