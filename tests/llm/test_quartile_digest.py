"""Digests against a plain count, and neighbours over all partitions."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from treewatt.llm.quartile_digest import (
    BUCKETS,
    compared_with_next,
    difference,
    digest_codes,
    digest_string,
    op8_quartile_digest,
    parse_digest,
)

DOCS = "doc_id bigint, text string"
MASK = (1 << 32) - 1


def plain_codes(text):
    data, counts = text.encode(), [0] * BUCKETS
    for a, b, c in zip(data, data[1:], data[2:], strict=False):
        h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) & MASK
        h = (h ^ h >> 15) * 0x2C1B3C6D & MASK
        counts[h >> 22] += 1
    ordered = sorted(counts)
    limits = [ordered[len(ordered) * k // 4 - 1] for k in (1, 2, 3)]
    return round(8 * math.log2(len(data) + 1)), [sum(c > q for q in limits) for c in counts]


def some_text(random_, size):
    return "".join(random_.choices("abcdeäß 中\n", k=size))


def test_codes_and_strings():
    random_ = random.Random(4)
    for size in (0, 1, 2, 3, 50, 5000):
        text = some_text(random_, size)
        own = digest_codes(text)
        assert (own[0], own[1].tolist()) == plain_codes(text)
        again = parse_digest(digest_string(own))
        assert again[0] == own[0] and (again[1] == own[1]).all()
        assert difference(own, again) == 0.0
    long = "ab" * 1_500_000
    assert digest_codes(long)[1].tolist() == plain_codes(long)[1]


def test_likeness_tells_edits_from_others():
    random_ = random.Random(6)
    words = ["".join(random_.choices("abcdefgh", k=5)) for _ in range(500)]
    a, b = (" ".join(random_.choices(words, k=300)) for _ in range(2))
    edited = a[: 2 * len(a) // 3] + b[: len(a) // 3]
    near, far = (difference(digest_codes(a), digest_codes(x)) for x in (edited, b))
    assert near < far <= 1.0
    assert difference(digest_codes(""), digest_codes("x" * 10**6)) <= 1.0


@pytest.mark.parametrize("parts", [1, 7])
def test_next_over_partitions(spark, tmp_path, parts):
    random_ = random.Random(parts)
    rows = [(i * 3, some_text(random_, random_.randint(0, 60))) for i in range(80)]
    random_.shuffle(rows)
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, DOCS).repartition(parts).write.parquet(path)
    ordered = sorted(rows, reverse=True)
    expected = {}
    for (key, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        own, other, third_ = (digest_codes(t) for t in (text, edited, following))
        expected[key] = (
            key, len(text), hashlib.sha256(edited.encode()).hexdigest(), digest_string(own),
            digest_string(other), 1 - difference(own, other), 1 - difference(own, third_),
        )
    got = [tuple(r) for r in op8_quartile_digest(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(expected.values())


def test_nulls_repeats_single_row_and_empty_table(spark):
    rows = [(None, "none"), (4, None), (4, "same"), (4, "same"), (9, "")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("body", F.lit(1)).withColumn("part", F.lit(2))
    got = compared_with_next(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == [
        (False, 4, 0), (False, 4, 4), (False, 4, 4), (False, 9, 0), (True, 0, 4),
    ]
    alone = compared_with_next(docs.where("doc_id is null")).first()
    assert (alone.near_edited, alone.near_next) == (1 - difference(digest_codes("none"), digest_codes("nonn")), 1.0)
    assert compared_with_next(docs.limit(0)).count() == 0
