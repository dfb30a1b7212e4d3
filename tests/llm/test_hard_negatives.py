"""Hard negatives against scores of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from treewatt.llm import hard_negatives as module
from treewatt.llm.hard_negatives import Best, Lists, hard_negatives, op11_hard_negatives, search_windows

ROWS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, anchor_of=lambda i: i % 100 == 0, low=30, high=90, n_pos=5, n_neg=10):
    """Rows are (id, whole numbers, label)."""
    out = []
    for anchor in {(i, tuple(v), label) for i, v, label in rows if anchor_of(i)}:
        i, v, label = anchor
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in rows if j != i
        )
        for s, j, _ in [x for x in scored if x[2] == label][:n_pos]:
            inside = [
                (-t, k)
                for t, k, other in scored
                if other != label and low * -s <= 100 * -t <= high * -s
            ]
            for rank, (t, k) in enumerate(inside[:n_neg]):
                out.append((i, j, rank + 1, k, -s, t))
    return sorted(out)


def whole(rows):
    """The rows of the query that take part, with its labels."""
    return [
        (i, [math.floor(256 * x) for x in np.array(v, np.float32).tolist()], (l + 1) % 10 if i % 7 == 0 else l)
        for i, v, l in rows
        if None not in (i, v, l) and all(x is not None and math.isfinite(x) for x in v)
    ]


def made(seed, count, dims=8, labels=3):
    random_ = random.Random(seed)
    rows = [(i, [random_.gauss(0, 0.3) for _ in range(dims)], random_.randrange(labels)) for i in range(count)]
    hot = [random_.gauss(0, 0.3) for _ in range(dims)]
    return [(i, hot if i % 3 == 1 or i in (200, 300) else v, l) for i, v, l in rows]


def got(df):
    return sorted(map(tuple, df.collect()))


def test_query(spark, tmp_path):
    rows = made(1, 700)
    rows += [(700, None, 1), (800, [0.1] * 8, None), (None, [0.1] * 8, 1), (900, [], 1)]
    rows += [(701, [0.2, None] + [0.1] * 6, 1), (702, [float("nan")] * 8, 1), (703, [float("inf")] * 8, 1)]
    rows += [(1000, [0.5, 0.2], 1), (1000, [0.5, 0.2], 1), (1000, [0.1, -0.4], 2), (-700, [0.3] * 8, 1)]
    rows += [(1100, [0.0] * 8, 0), (1200, [-0.4] * 8, 99), (1300, [0.0] * 8, 5), (1301, [0.0] * 8, 5)]
    frame = spark.createDataFrame(rows, ROWS).withColumn("anchor", F.lit("x")).withColumn("score", F.lit(1))
    frame.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    result = op11_hard_negatives(spark, str(tmp_path))
    assert result.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
    ]
    assert got(result) == brute(whole(rows))


def test_blocks_of_anchors_and_of_rows(spark, monkeypatch):
    rows = made(2, 900, dims=3, labels=5)
    frame = spark.createDataFrame(rows, ROWS).repartition(2)
    monkeypatch.setattr(module, "BLOCK_ROWS", 100)
    result = hard_negatives(frame, F.col("vec_id") % 20 == 0, anchor_bytes=200, scale=64, low=0, high=100)
    codes = [(i, [math.floor(64 * x) for x in np.array(v, np.float32).tolist()], l) for i, v, l in rows]
    assert got(result) == brute(codes, lambda i: i % 20 == 0, 0, 100)


def test_nothing_to_search(spark):
    empty = spark.createDataFrame([], ROWS)
    assert got(hard_negatives(empty, F.col("vec_id") % 100 == 0)) == []
    alone = spark.createDataFrame([(100, [1.0], 1), (200, [0.5], 2)], ROWS)
    assert got(hard_negatives(alone, F.col("vec_id") % 100 == 0)) == []
    one = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)], ROWS)
    assert got(hard_negatives(one, F.col("vec_id") == 0)) == [(0, 1, 1, 2, 65536, 32768)]


def test_large_scores(spark):
    rows = [(i, [float(2**20 + i), 2.0**20], i % 2) for i in range(40)]
    result = hard_negatives(spark.createDataFrame(rows, ROWS), F.col("vec_id") == 0, scale=2**10, high=100)
    codes = [(i, [int(x) * 2**10 for x in v], l) for i, v, l in rows]
    assert got(result) == brute(codes, lambda i: i == 0, 30, 100)
    rows[3] = (3, [3e38, 0.0], 1)
    with pytest.raises(ValueError, match="64 bits"):
        hard_negatives(spark.createDataFrame(rows, ROWS), F.col("vec_id") == 0)


def test_sorted_access_ends_early_and_bounds_the_rest():
    random_ = np.random.default_rng(3)
    vectors = np.floor(random_.normal(0, 40, (5000, 2)))
    lists = Lists(np.arange(5000), vectors, np.zeros(5000, np.int64))
    anchor = np.array([30.0, -20.0])
    scores, met = vectors @ anchor, np.zeros(5000, bool)
    rounds = list(lists.accesses(anchor))
    for rows, given, bound in rounds:
        assert (given == scores[rows]).all() and not met[rows].any()
        met[rows] = True
        assert scores[~met].max(initial=-np.inf) <= bound
    assert met.all()
    best, before = Best(10), len(rounds)
    seen = []
    reads = lists.accesses
    lists.accesses = lambda a: (seen.append(x) or x for x in reads(a))
    search_windows(lists, -1, 1, anchor, [(-(10**9), 10**9, best)])
    assert len(seen) < before
    order = np.lexsort((np.arange(5000), -scores))[:10]
    assert best.ids.tolist() == order.tolist()
