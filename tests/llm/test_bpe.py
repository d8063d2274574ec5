import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from crawlmill.llm.bpe import decode, encode, words_of
from crawlmill.llm.catalog import BPE_FILE

PATH = public_tokenizers.path(BPE_FILE)
random.seed(9)
SIGNS = [" ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "a", "B", "é", "ß", "中", "9", "²", "'s", "'ll", "'S", "!", "…", "😀", "́", "_", "<|endoftext|>", "<|", "the ", "\x00", "​", "I'm"]
TEXTS = [
    None, "", " ", "Hello world", "  two  blanks \n\n end ", "<|endoftext|>", "a<|endoftext|>  b <|endoftext|>", "  <|endoftext|>",
    "don't we'll I'VE", "x" * 5000, "word " * 60000, "naïve café 中文 😀😀 ‍", "\r\n\r\n tab\t\ttab",
] + ["".join(random.choices(SIGNS, k=random.randint(1, 60))) for _ in range(300)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 7) for i, t in enumerate(TEXTS)] + [(None, "null id", "y", 8), (3, TEXTS[3], "x", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, chunk int").repartition(4)


@pytest.mark.parametrize("chunk_words", [2_000_000, 50, 1])
def test_ids_and_texts_equal_the_library(spark, docs, chunk_words):
    tokenizer = Tokenizer.from_file(PATH)
    encoded = encode(docs, PATH, chunk_words=chunk_words)
    counted = encoded.withColumn("n", F.size("ids"))
    back = decode(counted, PATH, carry=["ids", "n"], digests=True).collect()
    assert len(back) == len(TEXTS) + 2
    for row in back:
        text = "null id" if row.doc_id is None else TEXTS[row.doc_id] or ""
        assert row.ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, row.ids)).encode()).hexdigest()
        assert row.n == len(row.ids) and row.text == tokenizer.decode(row.ids, skip_special_tokens=False) == text
    assert sum(r.doc_id == 3 for r in back) == 2


def test_words_are_the_text(spark, docs):
    for row in docs.select("text", words_of(F.coalesce("text", F.lit("")), ["<|endoftext|>"]).alias("w")).collect():
        assert "".join(row.w) == (row.text or "")


def test_decoding_of_any_ids(spark):
    tokenizer = Tokenizer.from_file(PATH)
    lists = [[], None, [50256], [222, 104], [99999, 15496], [447, 447, 247], [random.randrange(50257) for _ in range(30000)]]
    rows = spark.createDataFrame(list(enumerate(lists)), "doc_id int, ids array<int>").repartition(2)
    for row in decode(rows, PATH).collect():
        known = [i for i in lists[row.doc_id] or [] if i < 50257]
        assert row.text == tokenizer.decode(known, skip_special_tokens=False)


def test_empty_table(spark, docs):
    assert decode(encode(docs.limit(0), PATH), PATH).collect() == []


def test_the_texts_are_shuffled_once(spark, docs):
    encoded = encode(docs, PATH)
    encoded.collect()
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
