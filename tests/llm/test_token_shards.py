"""Shards against the tokenizer library on whole texts, and the index on its own."""

import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from treewatt.llm import common
from treewatt.llm import token_shards as module
from treewatt.llm.perfect_hash import PerfectHash
from treewatt.llm.token_shards import (
    ChunkEncoder,
    Shard,
    op10_token_shards,
    production_tokenizer,
    read_documents,
    shard_path,
    token_shards,
)

tokenizers = pytest.importorskip("tokenizers")
DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(production_tokenizer())


def odd_texts(seed, count):
    random_ = random.Random(seed)
    bits = [" ", "  ", "\n", "\t", " \n", "\x1c", "\x85", " ", "　", "a", "word", "It's"]
    bits += ["'LL", "12", "½", "ñ", "é", "中文", "🙂", "<|endoftext|>", "...", "-", "​", "\r"]
    return ["".join(random_.choices(bits, k=random_.randint(0, 12))) for _ in range(count)]


def test_chunks_give_the_ids_of_whole_texts(library):
    texts = odd_texts(5, 4000) + ["a <|endoftext|> b", "<|endoftext|>", " <|endoftext|>x y"]
    made = ChunkEncoder(production_tokenizer(), 2).encode(texts)
    for text, body in zip(texts, made, strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(body, "<u2").tolist() == [*ids, 2], repr(text)


@pytest.mark.parametrize("count", [0, 1, 2, 1000, 20_000])
def test_perfect_hash(count):
    random_ = random.Random(count)
    keys = list({random_.randrange(-(2**63), 2**63) for _ in range(count)})
    hashed = PerfectHash.build(np.array(keys, np.int64))
    again, end = PerfectHash.from_bytes(b"xx" + hashed.to_bytes(), 2)
    assert end == 2 + len(hashed.to_bytes())
    assert sorted(again.slots(np.array(keys, np.int64)).tolist()) == list(range(len(keys)))
    others = np.arange(1000, dtype=np.int64)
    others = others[~np.isin(others, np.array(keys, np.int64))]
    assert (again.slots(others) == -1).all()


def expected_rows(library, rows):
    out, start = [], 0
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_round_trip(spark, library, tmp_path):
    texts = [*odd_texts(9, 200), None, "", "long word " * 30_000]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, op10_token_shards(spark, str(tmp_path)).collect()))
    assert got == expected_rows(library, sorted(rows))


def test_small_shards_repeats_and_rows_without_id(spark, library):
    rows = [(i, f"text {i} " * 9) for i in range(60)] + [(7, "text 7 " * 9)] * 30 + [(None, "x")] * 3
    docs = spark.createDataFrame(rows, DOCS).withColumn("key", F.lit(1)).withColumn("part", F.lit(2))
    keys, folder = token_shards(docs, production_tokenizer(), 2, shard_bytes=200)
    got = read_documents(keys, folder).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [tuple(r) for r in got] == expected_rows(library, ordered)
    assert keys.select("part", "roll").distinct().count() > 10
    one = keys.where("key = 20").first()
    shard = Shard(shard_path(folder, one.part, one.roll))
    assert shard.documents([20, 1_000_000])[1] == []


def test_empty_table(spark):
    keys, folder = token_shards(spark.createDataFrame([], DOCS), production_tokenizer(), 2)
    assert read_documents(keys, folder).count() == 0


def test_few_texts_are_taken_apart_at_once(monkeypatch):
    asked, given_back = [], []

    class Encoder:
        def encode(self, texts):
            asked.append(len(texts))
            return [t.encode() for t in texts]

    monkeypatch.setattr(module, "give_back_memory", lambda: given_back.append(len(asked)))
    rows = [(i, f"text {i}") for i in range(2050)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["key", "body"])
    got = list(module.encoded(Encoder(), batch))
    assert got == [(i, t.encode()) for i, t in rows]
    assert max(asked) <= 200 and given_back == [5, 10]


def test_what_a_worker_held_before_is_given_back(monkeypatch):
    given_back = []
    monkeypatch.setattr(common, "give_back_memory", lambda: given_back.append(True))
    monkeypatch.setattr(common, "_HELD", {})
    assert common.held_in_worker(("a",), lambda: 1) == 1 and not given_back
    assert common.held_in_worker(("a",), lambda: 2) == 1 and not given_back
    assert common.held_in_worker(("b",), lambda: 3) == 3 and given_back == [True]
