import random

import pytest
from helpers import counts_and_sums, hierarchy, readings, windows_counts_sums
from pyspark.sql import functions as F
from scenarios import PAIR, TWO_LEVELS, UNBALANCED

from treewatt import RollupConfig, measure_order
from treewatt.operators.latest import latest_per_sensor, merge_streams, value_per_window
from treewatt.operators.rollup import (
    results_as_measurements,
    rollup_closure,
    rollup_multilevel,
    rollup_one_level,
)

CFG = RollupConfig(2000)


def parents_of(tree):
    up = {}
    for parent, children in tree.items():
        for child in children:
            up.setdefault(child, []).append(parent)
    return up


def brute_force(tree, rows, period=2):
    """(window, group, count, sum, newest ms) from the definition."""
    last = {}
    for seq, (sensor, second, watts, *payload) in enumerate(rows):
        key = (second // period * period, sensor)
        offer = ((payload or [second])[0], seq, watts)
        last[key] = max(last.get(key, offer), offer)
    out = []
    for window in sorted({w for w, _ in last}):
        def value(node, window=window):
            own = last.get((window, node))
            rolled = rollup(node)
            if rolled and (own is None or rolled[2] >= own[0]):
                return rolled[1], rolled[2]
            return (own[2], own[0]) if own else None

        def rollup(node):
            values = [v for v in map(value, tree.get(node, [])) if v]
            if not values:
                return None
            return len(values), sum(v for v, _ in values), max(t for _, t in values)

        for group in tree:
            result = rollup(group)
            if result:
                out.append((float(window), group, result[0], float(result[1]), result[2] * 1000))
    return sorted(out)


def full(results):
    return sorted(
        (r.window_start.timestamp(), r.identifier, r["count"], r.sum_w, r.timestamp_ms)
        for r in results.collect()
    )


def random_rows(nodes, seed, n=80):
    rng = random.Random(seed)
    return [
        (rng.choice(nodes), rng.randint(0, 15), rng.randint(1, 500), rng.randint(0, 8))
        for _ in range(n)
    ]


def leaves(tree):
    return sorted({c for children in tree.values() for c in children} - set(tree))


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_levels_equal_closure_equal_definition(spark, broadcast_rows):
    rows = random_rows(leaves(UNBALANCED), seed=11)
    tree = hierarchy(spark, UNBALANCED, broadcast_rows=broadcast_rows)
    df = readings(spark, rows)
    expected = brute_force(UNBALANCED, rows)
    assert full(rollup_multilevel(df, tree, CFG)) == expected
    assert full(rollup_closure(df, tree, CFG)) == expected


def test_groups_that_report_themselves(spark):
    nodes = sorted({*UNBALANCED, *leaves(UNBALANCED)})
    rows = random_rows(nodes, seed=5, n=140)
    tree = hierarchy(spark, UNBALANCED)
    assert full(rollup_multilevel(readings(spark, rows), tree, CFG)) == brute_force(UNBALANCED, rows)
    with pytest.raises(Exception, match="a group reports itself"):
        rollup_closure(readings(spark, rows), tree, CFG).collect()


def test_several_parents(spark):
    graph = {"root": ["left", "right"], "left": ["a", "hub"], "right": ["hub"], "hub": ["b", "c"]}
    rows = random_rows(["a", "b", "c"], seed=2, n=60)
    tree = hierarchy(spark, graph)
    expected = brute_force(graph, rows)
    assert full(rollup_multilevel(readings(spark, rows), tree, CFG)) == expected
    assert full(rollup_closure(readings(spark, rows), tree, CFG)) == expected


def test_arrival_order_does_not_matter_with_distinct_payload_times(spark):
    rng = random.Random(1)
    rows = [(rng.choice(leaves(TWO_LEVELS)), i * 0.25, rng.randint(1, 99)) for i in range(40)]
    shuffled = rng.sample(rows, len(rows))
    tree = hierarchy(spark, TWO_LEVELS)
    assert full(rollup_multilevel(readings(spark, rows), tree, CFG)) == full(
        rollup_multilevel(readings(spark, shuffled), tree, CFG)
    )


def test_root_and_unknown_sensors_have_no_effect(spark):
    rows = [("root", 0, 999), ("stranger", 0, 999), ("child1", 1, 7)]
    out = rollup_multilevel(readings(spark, rows), hierarchy(spark, PAIR), CFG)
    assert counts_and_sums(out) == [("root", 1, 7.0)]


def test_later_arrival_wins_a_tie(spark):
    df = readings(spark, [("a", 0, 1, 5), ("a", 1, 2, 5), ("a", 1.5, 3, 4)])
    row = value_per_window(df, CFG).first()
    assert (row.value_w, row.payload_ts_ms, row.event_time.timestamp()) == (2.0, 5000, 1.5)


def test_latest_by_arrival_not_by_time(spark):
    df = readings(spark, [("a", 5, 1), ("a", 1, 2), ("b", 3, 3)])
    assert sorted((r.identifier, r.value_w) for r in latest_per_sensor(df).collect()) == [
        ("a", 2.0),
        ("b", 3.0),
    ]


@pytest.mark.parametrize(
    ("how", "expected"), [("last", 5), ("avg", 4), ("max", 5), ("min", 3), ("sum", 8)]
)
def test_child_aggregates(spark, how, expected):
    cfg = RollupConfig(2000, child_agg=how, sum_scale=3)
    tree = hierarchy(spark, PAIR)
    df = readings(spark, [("child1", 0, 3), ("child1", 1, 5), ("child2", 0, 10)])
    row = rollup_one_level(df, tree.edges, tree.edge_rows, cfg).first()
    assert (row["count"], row.sum_w, row.average_w) == (2, expected + 10, (expected + 10) / 2)


def test_result_shape(spark):
    tree = hierarchy(spark, PAIR)
    df = readings(spark, [("child1", 0.5, 3.25), ("child2", 1, 1.5, 0.75)])
    row = rollup_multilevel(df, tree, CFG).first()
    assert row.asDict() | {"event_time": row.event_time.timestamp()} == {
        "window_start": row.window_start,
        "window_end": row.window_end,
        "identifier": "root",
        "timestamp_ms": 750,
        "count": 2,
        "sum_w": 4.75,
        "average_w": 2.375,
        "event_time": 1.0,
    }
    assert (row.window_end - row.window_start).total_seconds() == 2
    bare = rollup_multilevel(df, tree, RollupConfig(2000, drop_window=True))
    assert "window_start" not in bare.columns and "window_end" not in bare.columns


def test_silent_children_are_missing(spark):
    df = readings(spark, [("child1", 0, 5), ("child2", 1, 6), ("child2", 3, 7)])
    out = rollup_multilevel(df, hierarchy(spark, PAIR), CFG)
    assert windows_counts_sums(out) == [(0.0, "root", 2, 11.0), (2.0, "root", 1, 7.0)]


def test_results_feed_back_as_readings(spark):
    tree = hierarchy(spark, PAIR)
    df = readings(spark, [("child1", 0, 5), ("child2", 1, 6)])
    back = results_as_measurements(rollup_multilevel(df, tree, CFG))
    assert [(r.identifier, r.value_w, r.payload_ts_ms) for r in back.collect()] == [
        ("root", 11.0, 1000)
    ]
    assert merge_streams(df, back).count() == 3


def test_a_hot_sensor_is_reduced_before_the_shuffle(spark):
    tree = hierarchy(spark, PAIR)
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "child2").otherwise("child1").alias("identifier"),
        F.timestamp_micros(F.col("id") * 100).alias("event_time"),
        F.col("id").alias("payload_ts_ms"),
        F.lit(1.0).alias("value_w"),
        F.col("id").alias("arrival_seq"),
    )
    out = rollup_multilevel(hot, tree, CFG)
    assert counts_and_sums(out) == [("root", 2, 2.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_max_by" in plan


def test_order_within_bounds(spark):
    rows = random_rows(leaves(UNBALANCED), seed=4)
    df, tree = readings(spark, rows), hierarchy(spark, UNBALANCED)
    cfg = measure_order(df, CFG)
    assert cfg.order_bounds[1] == (0, len(rows) - 1)
    assert full(rollup_multilevel(df, tree, cfg)) == brute_force(UNBALANCED, rows)
    with pytest.raises(Exception, match="outside order_bounds"):
        rollup_multilevel(readings(spark, [*rows, ("sensor-1-1", 0, 1, 99)]), tree, cfg).collect()
    wide = readings(spark, [("a", 0, 1)]).selectExpr(
        "*", "explode(array(0L, 1L << 40)) AS far"
    ).selectExpr("identifier", "event_time", "far AS payload_ts_ms", "value_w", "far AS arrival_seq")
    assert measure_order(wide, CFG) is CFG
