"""BPE by forced boundaries against the tokenizers library."""

import hashlib
import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from treewatt.llm.bpe import Encoder, Vocabulary, decode, encode, op13_bpe, production_model

tokenizers = pytest.importorskip("tokenizers")
DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(production_model())


@pytest.fixture(scope="module")
def encoder():
    return Encoder(production_model())


def odd_texts(seed, count, longest=40):
    random_ = random.Random(seed)
    bits = list("abcdefghijklmnopqrstuvwxyzABC  \n\t\r012éßñ中文▁🙂.,-'\x00\x1c\x1f\x85\xa0 　")
    bits += ["the", "ing", "  ", " " * 17, "<|endoftext|>", "<|endof", "tion", "=====", "aaaa", "'ll", "'s"]
    bits += ["́", "‍", "՘", "꟎", "\U0003fc36", "�", "ﷺ", "١٢", "ⅷ", "²"]
    return ["".join(random_.choices(bits, k=random_.randint(0, longest))) for _ in range(count)]


def check(encoder, library, texts):
    got = encoder.encode(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [g.tolist() for g in got] == want
    back = [library.decode(ids, skip_special_tokens=False) for ids in want]
    assert encoder.words.decoded(pa.array(want, pa.list_(pa.int32()))) == back


def test_equals_the_library(encoder, library):
    check(encoder, library, odd_texts(2, 6000) + odd_texts(3, 60, 3000))


def test_every_assigned_character_and_newer_ones(encoder, library):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    known = [c for c in chars if unicodedata.category(c) != "Cn"]
    newer = [c for c in chars if unicodedata.category(c) == "Cn" and ord(c) % 7 == 0]
    check(encoder, library, ["a".join(known[i : i + 400]) for i in range(0, len(known), 400)])
    check(encoder, library, ["1 ".join(newer[i : i + 2000]) for i in range(0, len(newer), 2000)])


@pytest.mark.parametrize("unit", ["a", " ", "=", "ab", "  a", "é", "中", "\n", "the", "-_", "\xf3"])
def test_long_runs(encoder, library, unit):
    texts = [unit * n for n in (1, 2, 3, 15, 16, 17, 23, 24, 25, 31, 32, 33, 700)]
    check(encoder, library, texts + ["x" + t for t in texts] + [t + "x" for t in texts])


def test_very_long_texts(encoder, library):
    random_ = random.Random(8)
    check(encoder, library, [" " * 100_000, "".join(random_.choices("abcdefgh", k=100_000)), "ok " * 100_000])


def test_no_token_holds_a_forced_pair_and_fragments_are_encoded_on_their_own(encoder):
    words: Vocabulary = encoder.words
    assert words.forced.any() and not words.forced.all()
    for token in words.ids:
        assert not any(words.forced[a, b] for a, b in zip(token, token[1:]))
    texts = [b"a b", "né中".encode(), b"plain", b"x\n y"]
    for text, parts in zip(texts, words.fragments(texts), strict=True):
        assert b"".join(parts) == text
        ends = {sum(map(len, parts[: i + 1])) for i in range(len(parts) - 1)}
        assert ends == {i + 1 for i in range(len(text) - 1) if words.forced[text[i], text[i + 1]]}
        (whole,) = words.encoded([text])
        assert b"".join(words.encoded(parts)) == whole


def test_short_and_long_fragments_are_merged_alike(encoder):
    random_ = random.Random(4)
    texts = [bytes(random_.choices(b"abeinorst ", k=random_.randint(1, 32))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.words.encoded(texts), strict=True):
        symbols = encoder.words.single[list(text)].tolist()
        assert np.frombuffer(ids, "<i4").tolist() == encoder.words._queue(symbols)


def test_foreign_ids_and_broken_bytes(encoder, library):
    ids = [70_000, -1, *library.encode("é").ids, library.encode("中").ids[0], 33]
    kept = [i for i in ids if 0 <= i < 50_257]
    rows = pa.array([None, ids, []], pa.list_(pa.int32()))
    text = library.decode(kept, skip_special_tokens=False)
    assert encoder.words.decoded(rows) == ["", text, ""]


def test_query(spark, library, tmp_path):
    rows = list(enumerate([None, "", "one two  three", "word " * 5000, "é" * 10, "a<|endoftext|>b"]))
    rows += [(None, "no id"), (1, "again"), (1, "again")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("ids", F.lit("x")).withColumn("keep", F.lit(1))
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    expected = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]
        expected.append((i, len(ids), *digests))
    got = op13_bpe(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))
    empty = decode(encode(docs.limit(0), production_model(), ["doc_id"]), production_model())
    assert empty.count() == 0


def test_other_models_are_refused(tmp_path):
    model = tokenizers.Tokenizer.from_file(production_model())
    model.normalizer = tokenizers.normalizers.Lowercase()
    model.save(str(tmp_path / "other.json"))
    with pytest.raises(ValueError, match="byte-level"):
        Encoder(str(tmp_path / "other.json"))
