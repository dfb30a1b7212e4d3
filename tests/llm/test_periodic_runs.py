"""Runs of words against trying every period at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from treewatt.llm import periodic_runs as module
from treewatt.llm.periodic_runs import Grammar, op12_periodic_runs, periodic_runs, runs_of

DOCS = "doc_id bigint, text string"


def brute(words, min_length=24, min_exponent=3):
    """Every maximal stretch of each period, judged with its smallest period."""
    found, n = {}, len(words)
    for period in range(1, n // min_exponent + 1):
        start = 0
        while start + period < n:
            end = start + period
            while end < n and words[end] == words[end - period]:
                end += 1
            length = end - start
            if length >= max(min_length, min_exponent * period):
                found.setdefault((start, length), period)
            start = max(start + 1, end - period + 1)
    return sorted((s, length, p) for (s, length), p in found.items())


def by_order(rows):
    return sorted(rows, key=lambda r: (r[0], r[2]))


def periodic(random_, letters, size):
    out = []
    while len(out) < size:
        unit = random_.choices(range(letters), k=random_.randint(1, 9))
        out += unit * random_.randint(1, 6) + random_.choices(range(letters), k=random_.randint(0, 5))
    return out[:size]


def common(words, i, j):
    n = 0
    while i + n < len(words) and j + n < len(words) and words[i + n] == words[j + n]:
        n += 1
    return n


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_extensions_of_the_grammar(letters):
    random_ = random.Random(letters)
    for size in (1, 2, 3, 17, 90):
        words = [100, *periodic(random_, letters, size), 101]
        grammar = Grammar.of(np.array(words))
        pairs = np.array([(i, j) for i in range(len(words)) for j in range(len(words)) if i != j])
        got = grammar.common(pairs[:, 0], pairs[:, 1])
        assert got.tolist() == [common(words, i, j) for i, j in pairs.tolist()]
        got = grammar.mirrored().common(pairs[:, 0], pairs[:, 1])
        assert got.tolist() == [common(words[::-1], i, j) for i, j in pairs.tolist()]


@pytest.mark.parametrize("limits", [(24, 3), (6, 3), (2, 2), (10, 2), (9, 4)])
def test_runs_of_many_texts(limits):
    random_ = random.Random(sum(limits))
    texts = [periodic(random_, random_.randint(1, 5), random_.choice([0, 1, 5, 23, 24, 80, 300])) for _ in range(60)]
    got = runs_of([np.array(t, np.int64) for t in texts], *limits)
    assert [list(map(tuple, g.tolist())) for g in got] == [by_order(brute(t, *limits)) for t in texts]


def test_candidates_in_parts(monkeypatch):
    monkeypatch.setattr(module, "CANDIDATES", 7)
    text = periodic(random.Random(5), 2, 400)
    (got,) = runs_of([np.array(text, np.int64)], 6, 3)
    assert list(map(tuple, got.tolist())) == by_order(brute(text, 6, 3))


def test_long_texts():
    one = np.zeros(200_000, np.int64)
    three = np.tile([0, 1, 2], 60_000)
    none = np.arange(300_000)
    got = runs_of([one, three, none])
    assert [g.tolist() for g in got] == [[[0, 200_000, 1]], [[0, 180_000, 3]], []]


def expected(doc_id, text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = by_order(brute(words))
    best = (None,) * 4
    if runs:
        s, length, p = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = (s, length, p, 1000 * length // p)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    return (doc_id, len(runs), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def test_query(spark, tmp_path):
    random_ = random.Random(9)
    rows = [(i, " ".join(f"w{x}" for x in periodic(random_, 3, random_.randint(0, 200)))) for i in range(300)]
    rows += [(i, " ".join(f"é{random_.randint(0, 400)}" for _ in range(random_.randint(0, 300)))) for i in range(300, 500)]
    rows += [(500, None), (501, ""), (502, " \n\t "), (None, "a " * 30), (7, "a\x0bb\x0c" * 30), (7, "a b " * 30)]
    rows += [(10**15 + i, "x y z\x85 " * 20) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("runs", F.lit("x")).withColumn("words", F.lit(1))
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = op12_periodic_runs(spark, str(tmp_path))
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    want = [expected(*row) for row in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert sum(w[1] > 0 for w in want) > 100
    assert periodic_runs(docs.limit(0), ["doc_id"]).count() == 0


def test_texts_of_the_operator(spark):
    docs = spark.createDataFrame([(1, "go " * 40 + "stop"), (2, "just a  line")], DOCS)
    got = {r.keep.doc_id: (r.collapsed, [tuple(x) for x in r.runs]) for r in periodic_runs(docs, ["doc_id"]).collect()}
    assert got == {1: ("go stop", [(0, 40, 1)]), 2: ("just a line", [])}
