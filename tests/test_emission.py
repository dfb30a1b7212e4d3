"""Changelog and throttling against a plain sequential run."""

import random
from fractions import Fraction

import pytest
from helpers import hierarchy, readings
from scenarios import PAIR, TWO_LEVELS, UNBALANCED
from test_rollup import leaves, parents_of

from treewatt import RollupConfig
from treewatt.operators.changelog import aggregate_changelog, changelog_by_height
from treewatt.operators.late import accepted_with_stream_time
from treewatt.plans.batch import build_batch


def simulate(tree, rows, period, grace):
    """Updates and throttled results, one reading after the other."""
    up = parents_of(tree)
    clock = float("-inf")
    last, newest, entries = {}, {}, {}
    updates, released = [], []

    def release():
        for key in [k for k, (due, _, _) in entries.items() if due <= clock]:
            due, opened, state = entries.pop(key)
            released.append((*key, opened, *state))

    def value(window, node):
        if node in tree:
            state = rollup(window, node)
            return state and (state[1], state[2])
        offer = last.get((window, node))
        return offer and (offer[2], offer[0])

    def rollup(window, node):
        values = [v for v in (value(window, c) for c in tree[node]) if v]
        if values:
            return len(values), float(sum(v for v, _ in values)), max(t for _, t in values)

    for seq, (sensor, second, watts, payload) in enumerate(rows):
        clock = max(clock, second)
        release()
        window = float(second // period * period)
        if window + period + grace <= clock:
            continue
        offer = (payload, seq, watts)
        last[window, sensor] = max(last.get((window, sensor), offer), offer)
        (parent,) = up[sensor]
        while parent:
            key = (window, parent)
            newest[key] = max(newest.get(key, second), second)
            state = rollup(window, parent)
            updates.append((seq, *key, *state))
            due, opened, _ = entries.get(key, (newest[key] + period, newest[key], None))
            entries[key] = (due, opened, state)
            release()
            parent = up[parent][0] if parent in up else None
    return sorted(updates), sorted(released)


def disordered(tree, seed, n=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        second = max(0.0, round(i * 0.3 - rng.choice([0, 0, rng.random() * 4]), 1))
        rows.append((rng.choice(leaves(tree)), second, rng.randint(1, 99), rng.randint(0, 9)))
    return rows


@pytest.mark.parametrize(
    ("tree", "grace", "seed"), [(TWO_LEVELS, 2, 1), (UNBALANCED, 4, 2)], ids=["two", "deep"]
)
def test_against_sequential_run(spark, tree, grace, seed):
    cfg = RollupConfig(2000, grace * 1000, sum_scale=3)
    rows = disordered(tree, seed)
    updates, released = simulate(tree, rows, 2, grace)
    prepared, df = hierarchy(spark, tree), readings(spark, rows)
    log = build_batch(df, prepared, cfg, "changelog")
    got = sorted(
        (r.arrival_seq, r.window_start.timestamp(), r.identifier, r["count"], r.sum_w,
         r.timestamp_ms / 1000)
        for r in log.collect()
    )
    assert got == updates
    out = build_batch(df, prepared, cfg, "throttled")
    got = sorted(
        (r.window_start.timestamp(), r.identifier, r.entry_time.timestamp(), r["count"], r.sum_w,
         r.timestamp_ms / 1000)
        for r in out.collect()
    )
    assert got == released
    assert len(got) > len({row[:2] for row in got}), "the case should contain corrections"


def test_level_by_level_equals_closure(spark):
    cfg = RollupConfig(2000, 2000, broadcast_rows=0, sum_scale=3)
    df = accepted_with_stream_time(readings(spark, disordered(UNBALANCED, 9)), cfg).cache()
    tree = hierarchy(spark, UNBALANCED, broadcast_rows=0)
    columns = ["arrival_seq", "identifier", "count", "sum_w", "timestamp_ms", "event_time"]
    closure = aggregate_changelog(df, tree, cfg).select(*columns).collect()
    levels = changelog_by_height(df, tree, cfg).select(*columns).collect()
    assert sorted(closure) == sorted(levels)


def test_a_group_report_replaces_its_children_until_they_are_newer(spark):
    tree = hierarchy(spark, TWO_LEVELS)
    rows = [("sensor-1-1", 0, 10), ("sensor-1", 0.5, 99), ("sensor-1-2", 0.2, 5), ("sensor-1-1", 1, 20)]
    cfg = RollupConfig(2000, 0, sum_scale=3)
    log = build_batch(readings(spark, rows), tree, cfg, "changelog", groups_report=True)
    got = sorted((r.arrival_seq, r.identifier, r["count"], r.sum_w) for r in log.collect())
    assert got == [
        (0, "root", 1, 10.0),
        (0, "sensor-1", 1, 10.0),
        (1, "root", 1, 99.0),
        (2, "root", 1, 99.0),
        (2, "sensor-1", 2, 15.0),
        (3, "root", 1, 25.0),
        (3, "sensor-1", 2, 25.0),
    ]
    with pytest.raises(Exception, match="a group reports itself"):
        build_batch(readings(spark, rows), tree, cfg, "changelog").collect()


def test_many_corrections_take_few_rounds(spark, monkeypatch):
    """200 entries one after the other in one group, each opened by a correction."""
    from treewatt.operators import throttle as module

    tables = []
    write = module.write_table
    monkeypatch.setattr(module, "write_table", lambda df, label: tables.append(label) or write(df, label))
    rows = []
    for i in range(200):
        # The first moves the clock past the last entry's due time, the second comes late.
        rows += [("child2", i + 1000.5, 1), ("child1", i + 1, i)]
    cfg = RollupConfig(1_000_000, 2_000_000, sum_scale=0)
    tree = hierarchy(spark, PAIR)
    out = build_batch(readings(spark, rows), tree, cfg, "throttled").where("unix_seconds(window_start) = 0")
    got = sorted((r.entry_time.timestamp(), r["count"]) for r in out.collect())
    assert len(got) > 150
    assert tables.count("marked") - 1 <= 10


def test_changelog_sums_are_exact_and_keep_the_last_result(spark):
    tree = hierarchy(spark, PAIR)
    rows = [("child1", 0.1, 1e12), ("child2", 0.2, 5), ("child1", 0.3, 1), ("child2", 0.4, 0.001)]
    cfg = RollupConfig(2000, sum_scale=3)
    log = build_batch(readings(spark, rows), tree, cfg, "changelog").orderBy("arrival_seq").collect()
    final = build_batch(readings(spark, rows), tree, cfg, "final").first()
    assert log[-1].sum_w == final.sum_w == 1.001
    coarse = RollupConfig(2000, sum_scale=2)
    with pytest.raises(Exception, match="more decimals"):
        build_batch(readings(spark, rows), tree, coarse, "final").collect()


def test_changelog_of_any_doubles(spark):
    tree, cfg = hierarchy(spark, PAIR), RollupConfig(2000)
    rows = [("child1", 0.1, 1e17), ("child2", 0.2, 5), ("child1", 0.3, 1)]
    log = build_batch(readings(spark, rows), tree, cfg, "changelog").orderBy("arrival_seq").collect()
    assert [r.sum_w for r in log] == [1e17, 1e17 + 5, 6.0]
    assert build_batch(readings(spark, rows), tree, cfg, "final").first().sum_w == 6.0
    random_ = random.Random(6)
    odd = [0.1, -0.3, 5e-324, -1e300, 1.7e308, 2.0**-1060, 0.0, 3e-200]
    rows = [
        (random_.choice(["child1", "child2"]), 0.001 * i, random_.choice(odd) * random_.choice([1, -1]))
        for i in range(60)
    ]
    log = build_batch(readings(spark, rows), tree, cfg, "changelog").orderBy("arrival_seq").collect()
    last = {}
    for (child, _, watts), got in zip(rows, log, strict=True):
        last[child] = Fraction(watts)
        assert got.sum_w == pytest.approx(float(sum(last.values())), rel=1e-15, abs=0)
    with pytest.raises(ValueError, match="finite"):
        build_batch(readings(spark, [("child1", 0, float("inf"))]), tree, cfg, "changelog")
    none = build_batch(readings(spark, rows).limit(0), tree, cfg, "changelog")
    assert none.count() == 0


CHILD_VALUE = {"max": max, "min": min, "sum": sum, "avg": lambda v: round(sum(v) / len(v), 3)}


@pytest.mark.parametrize("how", list(CHILD_VALUE))
@pytest.mark.parametrize("scale", [3, None])
def test_changelog_of_other_child_values(spark, how, scale):
    random_ = random.Random(how)
    rows = [
        (random_.choice(["a1", "a2", "b1"]), 0.05 * i, random_.randint(-40, 99)) for i in range(70)
    ]
    tree = {"root": ["a", "b"], "a": ["a1", "a2"], "b": ["b1"]}
    cfg = RollupConfig(2000, sum_scale=scale, child_agg=how)
    log = build_batch(readings(spark, rows), hierarchy(spark, tree), cfg, "changelog")
    got = {(r.arrival_seq, r.identifier): (r["count"], r.sum_w) for r in log.collect()}
    seen = {}
    for seq, (sensor, second, watts) in enumerate(rows):
        seen.setdefault((second // 2, sensor), []).append(watts)
        now = {s: CHILD_VALUE[how](v) for (w, s), v in seen.items() if w == second // 2}
        mine = [v for s, v in now.items() if s[0] == sensor[0]]
        count, total = got[seq, sensor[0]]
        assert count == len(mine) and total == pytest.approx(sum(mine), abs=0.01)
        assert got[seq, "root"][1] == pytest.approx(sum(now.values()), abs=0.01)


def test_refusals_of_what_goes_by_height(spark):
    tree, rows = hierarchy(spark, PAIR), readings(spark, [("child1", 0.1, 1)])
    for cfg in (RollupConfig(2000), RollupConfig(2000, sum_scale=3, child_agg="max")):
        with pytest.raises(ValueError, match="sum_scale|child_agg"):
            build_batch(rows, tree, cfg, "changelog", groups_report=True)


@pytest.mark.parametrize("emission", ["changelog", "throttled"])
def test_emissions_without_windows(spark, emission):
    rows = [("child1", 0.1, 1), ("child2", 2.2, 5), ("child1", 9.3, 1)]
    cfg = RollupConfig(2000, drop_window=True, sum_scale=3)
    out = build_batch(readings(spark, rows), hierarchy(spark, PAIR), cfg, emission)
    assert "window_start" not in out.columns and out.count() >= 2


def test_equal_numbers_of_two_sources_stay_apart(spark):
    """Sources with numbers of their own: a row each, and each source has its own clock."""
    rows = [("child1", 0.1, 1), ("child2", 0.2, 5)]
    df = readings(spark, rows).selectExpr("*", "cast(arrival_seq as int) as source")
    df = df.withColumn("arrival_seq", df.arrival_seq * 0 + 7)
    log = build_batch(
        df, hierarchy(spark, PAIR), RollupConfig(2000, sum_scale=3), "changelog", by=("source",)
    )
    assert sorted((r.arrival_seq, r["count"], r.sum_w) for r in log.collect()) == [
        (14, 1, 1.0), (15, 2, 6.0),
    ]
