"""Token counts against the library that the model belongs to."""

import random

import pytest
from pyspark.sql import functions as F

from treewatt.llm.token_counts import TokenCounter, op3_token_counts, production_model, token_counts

sentencepiece = pytest.importorskip("sentencepiece")
DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=production_model())


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(production_model())


def odd_texts(seed, count, longest=40):
    random_ = random.Random(seed)
    bits = list("abcdefghijklmnopqrstuvwxyzABC  \n\t012éßñ中文▁🙂.,-'")
    bits += ["the", "ing", "  ", " " * 17, "</s>", "<0x0A>", "tion", "=====", "aaaa", "\x85", "　"]
    return ["".join(random_.choices(bits, k=random_.randint(0, longest))) for _ in range(count)]


def test_equals_the_library(counter, library):
    texts = odd_texts(2, 6000) + odd_texts(3, 60, 3000)
    assert counter.count(texts) == [len(x) for x in library.encode(texts)]


@pytest.mark.parametrize("unit", ["a", " ", "=", "ab", "  a", "é", "中", "\n", "the", "-_"])
def test_long_runs(counter, library, unit):
    texts = [unit * n for n in (1, 2, 3, 15, 16, 17, 18, 31, 32, 33, 34, 700)]
    texts += ["x" + t for t in texts] + [t + "x" for t in texts]
    assert counter.count(texts) == [len(x) for x in library.encode(texts)]


def test_very_long_texts(counter, library):
    random_ = random.Random(8)
    texts = [" " * 200_000, "".join(random_.choices("abcdefgh", k=60_000)), "ok " * 200_000]
    assert counter.count(texts) == [len(x) for x in library.encode(texts)]


def test_query(spark, library, tmp_path):
    rows = list(enumerate([None, "", "one two  three", "word " * 5000, "é" * 10]))
    rows += [(None, "no id"), (1, "again")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_tokens", F.lit("x")).repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = op3_token_counts(spark, str(tmp_path)).collect()
    expected = [
        (i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in rows
    ]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert token_counts(docs.limit(0), production_model()).count() == 0
