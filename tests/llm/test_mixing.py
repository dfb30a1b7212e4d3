"""Draws against the Poisson distribution function, shares, and odd rows."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from treewatt.llm import mixing
from treewatt.llm.mixing import mix_sources, op5_mix_sources, poisson_table

DOCS = "doc_id bigint, text string, source string"


def plain_copies(doc_id, text, rate, seed=17):
    """Numbers of the copies of a row."""
    name = f"text:{hashlib.md5((text or '').encode()).hexdigest()}" if doc_id is None else str(doc_id)
    parts = max(1, math.ceil(rate / 1000))
    rate, out = rate / parts, []
    for part in range(parts):
        which = f":{part}" if part else ""
        u = int(hashlib.md5(f"{seed}:{name}{which}".encode()).hexdigest()[:13], 16) / 2**52
        k, below = 0, math.exp(-rate)
        while below <= u and rate > 0:
            k += 1
            below += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
        out += [part * 2048 + i + 1 for i in range(k)]
    return out


def rates_of(rows, weights, epochs=1.0):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text or "") + 1
    total = sum(weights(s, n) for s, n in sizes.items())
    return {s: epochs * sum(sizes.values()) * weights(s, n) / total / n for s, n in sizes.items()}


@pytest.mark.parametrize("rate", [0.01, 0.7, 3.0, 90.0, 900.0])
def test_table_of_probabilities(spark, rate):
    table = spark.range(1).select(poisson_table(F.lit(rate)).alias("t")).first().t
    total = 0.0
    for k, p in enumerate(table):
        total += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
        assert p == pytest.approx(total, abs=1e-9)
    assert table[-1] == pytest.approx(1.0, abs=1e-9)


@pytest.fixture
def rows():
    sizes = {"hot": 600, "mid": 200, "low": 30, None: 20}
    out = []
    for source, count in sizes.items():
        out += [(len(out) + i, "x" * (i % 50), source) for i in range(count)]
    return out + [(None, "no id", "mid"), (7, None, "low"), (7, None, "low"), (8, "", "low")]


def test_query_draws(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, DOCS).withColumn("copy_no", F.lit("old")).repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rates = rates_of(rows, lambda s, n: n**0.5)
    expected = Counter()
    for doc_id, text, source in rows:
        for copy in plain_copies(doc_id, text, rates[source]):
            expected[doc_id, text, source, copy] += 1
    got = op5_mix_sources(spark, str(tmp_path))
    assert got.columns == ["doc_id", "text", "source", "copy_no"]
    assert Counter(map(tuple, got.collect())) == expected


def test_named_weights_give_the_shares(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    mixed = mix_sources(docs, {"hot": 1, "mid": 3}, epochs=40.0, number_copies=False)
    assert mixed.columns == docs.columns
    chars = Counter()
    for r in mixed.collect():
        chars[r.source] += len(r.text or "") + 1
    assert set(chars) == {"hot", "mid"}
    assert chars["mid"] / chars["hot"] == pytest.approx(3, rel=0.1)
    assert mix_sources(docs, {}).count() == 0
    assert mix_sources(docs.limit(0)).count() == 0


def test_order_is_a_shuffle(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    ids = [r.doc_id for r in mix_sources(docs, epochs=3.0).collect() if r.doc_id is not None]
    rising = sum(a <= b for a, b in zip(ids, ids[1:], strict=False))
    assert 0.4 < rising / len(ids) < 0.65


def test_tiny_source_beside_large_ones(spark):
    """A rate over 1000 is drawn in parts."""
    rows = [(i, "x" * 40_000, "large") for i in range(200)] + [(501, None, None), (502, "", None)]
    docs = spark.createDataFrame(rows, DOCS)
    rates = rates_of(rows, lambda s, n: n**0.5)
    assert rates[None] > 1_900
    got = Counter(
        (r.doc_id, r.copy_no) for r in mix_sources(docs).collect() if r.source is None
    )
    expected = Counter(
        (i, copy) for i, text in ((501, None), (502, "")) for copy in plain_copies(i, text, rates[None])
    )
    assert got == expected


def test_any_rate(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PARTS_AT_ONCE", 7)
    docs = spark.createDataFrame([(1, "x" * 9, "a"), (2, "y" * 99_999, "b")], DOCS)
    mixed = mix_sources(docs, {"a": 1.0}, epochs=20.0)
    rate = 20.0 * 100_010 / 10
    got = sorted(r.copy_no for r in mixed.collect())
    assert got == plain_copies(1, "x" * 9, rate)
    assert len(got) == pytest.approx(rate, rel=0.01) and len(set(got)) == len(got)


def test_rows_without_an_id_are_drawn_one_by_one(spark):
    rows = [(None, f"text number {i}", "unnamed") for i in range(400)]
    rows += [(i, f"text number {i}", "named") for i in range(400)]
    got = Counter(r.source for r in mix_sources(spark.createDataFrame(rows, DOCS)).collect())
    assert all(320 < got[s] < 480 for s in ("named", "unnamed"))
