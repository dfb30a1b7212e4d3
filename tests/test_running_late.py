import random

from helpers import at, readings
from pyspark.sql import functions as F

from treewatt import RollupConfig
from treewatt.functions.running import (
    Running,
    hot_buckets,
    with_next,
    with_previous,
    with_running,
)
from treewatt.operators.late import accepted_with_stream_time, drop_late, with_late_flag
from treewatt.schemas import MEASUREMENT


def test_running_aggregates_across_chunks(spark):
    rng = random.Random(7)
    seqs = rng.sample(range(-200, 5000), 120)
    data = [(rng.choice("ab"), q, rng.choice([None, rng.randint(-9, 9)])) for q in seqs]
    df = spark.createDataFrame(data, "k string, q bigint, v int")
    out = with_running(
        df,
        ["k"],
        "q",
        [
            Running("total", "sum", "v"),
            Running("high", "max", "v"),
            Running("low_before", "min", "v", before=True),
        ],
        chunk_bits=(4, 4),
    )
    got = {(r.k, r.q): (r.total, r.high, r.low_before) for r in out.collect()}
    assert len(got) == len(data)
    for k, q, _ in data:
        upto = [v for k2, q2, v in data if k2 == k and q2 <= q and v is not None]
        before = [v for k2, q2, v in data if k2 == k and q2 < q and v is not None]
        expected = (
            sum(upto) if upto else None,
            max(upto, default=None),
            min(before, default=None),
        )
        assert got[k, q] == expected


def test_sparse_numbers_are_one_window_a_key(spark):
    rows = [(k, i * 2**30 + ord(k), i) for k in "abc" for i in range(40)]
    df = spark.createDataFrame(rows, "k string, q bigint, v bigint")
    out = with_running(df, ["k"], "q", [Running("total", "sum", "v")])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    assert {(r.k, r.v, r.total) for r in out.collect()} == {
        (k, i, i * (i + 1) // 2) for k, _, i in rows
    }


def test_chunks_are_as_wide_as_numbers_are_dense(spark):
    # A key with dense places among sparse ones is cut, others are not; a null one is as ever
    # apart in every stretch of 2^bits numbers.
    far = [i * 2**30 for i in range(100)]
    near = [50 * 2**30 + i for i in range(1, 100)]
    rows = [(None, q, 1) for q in far] + [("a", q, 1) for q in far + near]
    rows += [(k, 7, 1) for k in "bcdefg"]
    df = spark.createDataFrame(rows, "k string, q bigint, v bigint")
    found = {h.number: h.bits for h in hot_buckets(df, ["k"], "q", 4)}
    assert len(found) == 2 and max(found.values()) > 25
    wanted = [Running("n", "sum", "v"), Running("before", "max", "q", before=True)]
    out = with_running(df, ["k"], "q", wanted, chunk_bits=(4,)).collect()
    assert len(out) == len(rows)
    assert {(r.n, r.before) for r in out if r.k is None} == {(1, None)}
    for k, numbers in (("a", sorted(far + near)), ("b", [7])):
        got = sorted((r.q, r.n, r.before) for r in out if r.k == k)
        assert [(q, n) for q, n, _ in got] == [(q, i) for i, q in enumerate(numbers, 1)]
        assert [b for *_, b in got] == [None, *numbers[:-1]]
    alone = with_running(df.where("k = 'a'"), [], "q", wanted, chunk_bits=(4,)).collect()
    assert max(r.n for r in alone) == 199 and {r.before for r in alone} >= set(far[:-1])


def test_neighbours(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2**40, "y"), ("b", 5, "z")], "k string, q bigint, v string"
    )
    before = with_previous(df, ["k"], "q", ["v"], "prev").collect()
    assert {(r.k, r.q): r.prev and r.prev.v for r in before} == {
        ("a", 1): None, ("a", 2**40): "x", ("b", 5): None,
    }
    after = with_next(df, ["k"], "q", ["v"], "next").collect()
    assert {(r.k, r.q): r.next and r.next.v for r in after} == {
        ("a", 1): "y", ("a", 2**40): None, ("b", 5): None,
    }


def random_readings(seed, n=150):
    rng = random.Random(seed)
    times = [i * 0.7 + rng.choice([0, 0, 0, -rng.random() * 9]) for i in range(n)]
    return [(f"s{rng.randint(0, 5)}", max(t, 0), rng.randint(1, 99)) for t in times]


def brute_force_late(rows, period, grace):
    clock, late = float("-inf"), set()
    for seq, (_, second, _) in enumerate(rows):
        clock = max(clock, second)
        if (second // period + 1) * period + grace <= clock:
            late.add(seq)
    return late


def test_late_flag_against_brute_force(spark):
    rows = [(s, round(t, 3), v) for s, t, v in random_readings(3)]
    df = readings(spark, rows)
    for period, grace in [(2, 0), (2, 2), (5, 3), (2, 1.3)]:
        cfg = RollupConfig(round(period * 1000), round(grace * 1000))
        expected = brute_force_late(rows, period, grace)
        flagged = with_late_flag(df, cfg)
        assert {r.arrival_seq for r in flagged.where("late").collect()} == expected
        assert flagged.count() == len(rows)
    assert expected
    timed = {r.arrival_seq for r in accepted_with_stream_time(df, cfg).collect()}
    shuffled = RollupConfig(cfg.emit_period_ms, cfg.grace_period_ms, broadcast_rows=0)
    kept = {r.arrival_seq for r in drop_late(df, shuffled).collect()}
    assert timed == kept == set(range(len(rows))) - expected


def test_ordered_input_needs_no_join(spark):
    df = readings(spark, [("a", i, i) for i in range(20)])
    out = with_late_flag(df, RollupConfig(2000))
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.where("late").isEmpty()


def test_each_source_has_its_own_clock(spark):
    rows = [("a", at(9.0), 9000, 1.0, 0), ("b", at(1.0), 1000, 1.0, 1), ("b", at(5.0), 5000, 1.0, 2)]
    df = spark.createDataFrame(rows, MEASUREMENT).withColumn(
        "source_partition", F.when(F.col("identifier") == "a", 0).otherwise(1)
    )
    cfg = RollupConfig(2000)
    assert {r.arrival_seq for r in drop_late(df, cfg).collect()} == {0}
    assert {r.arrival_seq for r in drop_late(df, cfg, ("source_partition",)).collect()} == {0, 1, 2}
