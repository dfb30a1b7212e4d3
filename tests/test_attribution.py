import pytest
from helpers import at, hierarchy, readings, registry_events, windows_counts_sums

from treewatt import RollupConfig
from treewatt.operators import attribution
from treewatt.operators.attribution import (
    contributions_over_time,
    fan_out,
    join_current_parents,
    join_parents_as_of,
    reattribute_on_change,
)
from treewatt.operators.registry import (
    current_parents,
    diff_history,
    flatten_registry,
    versioned_edges,
)
from treewatt.plans.batch import hierarchy_from_events, rollup_changing_membership

HALLS = {"root": ["east", "west"], "east": ["a", "b"], "west": ["c"]}
A_MOVED = {"root": ["east", "west"], "east": ["b"], "west": ["a", "c"]}
A_GONE = {"root": ["east", "west"], "east": ["b"], "west": ["c"]}

ROWS = [("a", 0, 10), ("b", 0.5, 1), ("c", 1, 100), ("a", 4.2, 20), ("b", 4.5, 2), ("a", 5.5, 30)]


def changes(spark, *history):
    return diff_history(flatten_registry(registry_events(spark, list(history)))).cache()


def test_current_parents_join_drops_root_and_strangers(spark):
    parents = current_parents(changes(spark, (0, HALLS)))
    df = readings(spark, [("a", 0, 1), ("root", 0, 2), ("stranger", 0, 3)])
    out = fan_out(join_current_parents(df, parents, 5, 100))
    assert [(r.identifier, r.parent) for r in out.collect()] == [("a", "east")]


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_as_of_join(spark, broadcast_rows):
    versions = versioned_edges(changes(spark, (0, HALLS), (5, A_MOVED)))
    out = join_parents_as_of(readings(spark, ROWS), versions, 7, broadcast_rows)
    got = {(r.arrival_seq, tuple(r.parents)) for r in out.collect()}
    assert got == {
        (0, ("east",)), (1, ("east",)), (2, ("west",)),
        (3, ("east",)), (4, ("east",)), (5, ("west",)),
    }


def test_last_reading_goes_to_new_parents(spark):
    history = changes(spark, (0, HALLS), (5, A_MOVED), (6, HALLS), (9, A_MOVED))
    out = reattribute_on_change(readings(spark, ROWS), history, 9, 100)
    got = sorted(
        (r.change_time.timestamp(), r.identifier, r.parents, r.value_w)
        for r in out.collect()
        if r.identifier == "a"
    )
    # Nothing arrived between 6 and 9 s: the reading of 5.5 s is carried on.
    assert got == [
        (0.0, "a", ["east"], 10.0),
        (5.0, "a", ["west"], 20.0),
        (6.0, "a", ["east"], 30.0),
        (9.0, "a", ["west"], 30.0),
    ]


def test_a_change_is_late_for_earlier_windows(spark):
    rows = ROWS[:5]
    history = changes(spark, (0, HALLS), (5, A_MOVED))
    groups = hierarchy(spark, {"root": ["east", "west"]})
    out = rollup_changing_membership(
        readings(spark, rows), history, 7, groups, RollupConfig(2000, 2000)
    )
    assert windows_counts_sums(out) == [
        (0.0, "east", 2, 11.0),
        (0.0, "root", 2, 111.0),
        (0.0, "west", 1, 100.0),
        (4.0, "east", 1, 2.0),
        (4.0, "root", 2, 22.0),
        (4.0, "west", 1, 20.0),
    ]


def test_removal_retracts_or_not(spark):
    history = changes(spark, (0, HALLS), (5, A_GONE))
    df = readings(spark, ROWS[:5])
    retract = contributions_over_time(df, history, 7, RollupConfig(2000))
    pairs = {(r.identifier, r.parent, r.value_w) for r in retract.collect()}
    assert ("a", "east", 20.0) not in pairs and ("a", "east", 10.0) in pairs
    ignore = contributions_over_time(df, history, 7, RollupConfig(2000, on_removal="ignore"))
    assert ("a", "east", 20.0) in {(r.identifier, r.parent, r.value_w) for r in ignore.collect()}


def test_sensors_and_groups_under_one_parent(spark):
    mixed = {"root": ["hall", "a"], "hall": ["b"]}
    history = changes(spark, (0, mixed)).where("child IN ('a', 'b')")
    groups = hierarchy(spark, {"root": ["hall"]})
    df = readings(spark, [("a", 0, 1), ("b", 1, 2)])
    out = rollup_changing_membership(df, history, 2, groups, RollupConfig(2000))
    assert windows_counts_sums(out) == [(0.0, "hall", 1, 2.0), (0.0, "root", 2, 3.0)]


def test_hierarchy_after_all_events(spark):
    events = registry_events(spark, [(0, HALLS), (5, A_MOVED), (7, HALLS, "SENSOR_MOVED")])
    tree = hierarchy_from_events(events, RollupConfig())
    assert {(r.child, r.parent) for r in tree.edges.collect()} == {
        (child, parent) for parent, children in A_MOVED.items() for child in children
    }


@pytest.mark.parametrize("second", [5, 4.2])
def test_kept_parents_get_no_reading_twice(spark, second):
    """Sums under {x, y} -> {x, z}; also with a reading at the time of the change."""
    rows = [
        ("a", "upsert", None, ["x", "y"], 0, at(0)),
        ("a", "upsert", ["x", "y"], ["x", "z"], 1, at(second)),
    ]
    history = spark.createDataFrame(
        rows,
        "child string, op string, old_parents array<string>, parents array<string>, "
        "arrival_seq bigint, event_time timestamp",
    )
    df = readings(spark, [("a", 4.1, 10), ("a", second, 7)])
    cfg = RollupConfig(2000, child_agg="sum", sum_scale=3)
    out = rollup_changing_membership(df, history, 2, None, cfg)
    assert windows_counts_sums(out) == [(4.0, "x", 1, 17.0), (4.0, "z", 1, 17.0)]


def many_changes(spark, count, sensors=("a", "b")):
    """Each sensor moves every second, some of them twice at the same time."""
    rows = []
    for sensor in sensors:
        old = None
        for i in range(count):
            new = [f"g{(i * 7) % 5}"]
            if old != new:
                rows.append((sensor, "upsert", old, new, i, at(i - (i % 10 == 3))))
                old = new
    return spark.createDataFrame(
        rows,
        "child string, op string, old_parents array<string>, parents array<string>, "
        "arrival_seq bigint, event_time timestamp",
    )


@pytest.mark.parametrize("once", [True, False])
def test_scan_and_join_find_the_same_versions(spark, monkeypatch, once):
    history = many_changes(spark, 30).unionByName(many_changes(spark, 3, ("c",))).cache()
    df = readings(spark, [(s, t / 4, t) for t in range(-4, 140) for s in "abcd"])
    found = {}
    for limit in (1_000, 5, 0):
        monkeypatch.setattr(attribution, "MANY_VERSIONS", limit)
        parents = join_parents_as_of(df, versioned_edges(history), 70, 100)
        again = reattribute_on_change(df, history, 70, 100, once)
        found[limit] = [sorted(map(str, map(tuple, x.select(*sorted(x.columns)).collect()))) for x in (parents, again)]
    assert found[1_000][0] and found[1_000][1]
    assert found[1_000] == found[5] == found[0]


def test_rows_grow_with_readings_and_versions_not_with_both(spark, monkeypatch):
    made = []
    write = attribution.write_table

    def counted(df, label):
        table = write(df, label)
        made.append((label, table.count()))
        return table

    monkeypatch.setattr(attribution, "write_table", counted)
    versions = versioned_edges(many_changes(spark, 10_000, ("a",)))
    df = readings(spark, [("a", t + 0.5, t) for t in range(10_000)])
    out = join_parents_as_of(df, versions, 10_000, 100_000)
    # Moves of the seconds that end in 3 count from a second earlier.
    got = {round(r.value_w): r.parents for r in out.collect()}
    assert len(got) == 10_000
    for t in (0, 1, 2, 3, 4, 9_982, 9_983, 9_999):
        assert got[t] == [f"g{((t + 1 if t % 10 == 2 else t) * 7) % 5}"]
    assert max(rows for _, rows in made) <= 20_000
    assert [label for label, _ in made] == ["busy", "timeline"]
