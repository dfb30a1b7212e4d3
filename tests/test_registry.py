import json

import pytest
from helpers import at, edges, registry_events
from pyspark.sql import functions as F
from scenarios import PAIR, UNBALANCED

from treewatt import RollupConfig, hierarchy_from_events
from treewatt.functions.tables import write_table
from treewatt.operators import registry
from treewatt.operators.registry import (
    current_parents,
    diff_history,
    duplicate_identifiers,
    flatten_registry,
    membership_retractions,
    parent_sets,
    refuse_duplicates,
    snapshot_events,
    versioned_edges,
)
from treewatt.streaming.registry_feed import RegistryFeed


def test_only_snapshot_events_pass(spark):
    events = registry_events(
        spark, [(0, PAIR), (1, PAIR, "SENSOR_REGISTRY_STATUS"), (2, PAIR, "SENSOR_MOVED")]
    )
    assert sorted(r.arrival_seq for r in snapshot_events(events).collect()) == [0, 1]


def test_flatten_unbalanced_tree(spark):
    rows = flatten_registry(registry_events(spark, [(3, UNBALANCED)])).collect()
    assert {(r.child, r.parent) for r in rows} == {
        (child, parent) for parent, children in UNBALANCED.items() for child in children
    }
    assert {r.child: r.level for r in rows}["sensor-2-1-2"] == 3
    assert {r.event_time.timestamp() for r in rows} == {3.0}


def test_flatten_with_other_field_names(spark):
    doc = json.dumps({"id": "top", "parts": [{"id": "a", "parts": []}, {"id": "b"}]})
    events = spark.createDataFrame(
        [("SENSOR_REGISTRY_CHANGED", doc, at(0), 0)],
        "event_type string, payload string, event_time timestamp, arrival_seq bigint",
    )
    rows = flatten_registry(events, identifier_field="id", children_field="parts").collect()
    assert sorted((r.child, r.parent) for r in rows) == [("a", "top"), ("b", "top")]


def test_deep_registry_and_session_left_alone(spark):
    names = ("spark.sql.cteRecursionRowLimit", "spark.sql.cteRecursionLevelLimit")
    before = [spark.conf.get(name) for name in names]
    chain = {f"n{i}": [f"n{i + 1}"] for i in range(150)} | {"root": ["n0"]}
    events = registry_events(spark, [(0, chain)])
    assert flatten_registry(events).count() == 151
    assert [spark.conf.get(name) for name in names] == before


def test_duplicates_are_refused_by_the_pipelines(spark, tmp_path):
    events = registry_events(spark, [(0, {"root": ["a", "g"], "g": ["a"]})])
    with pytest.raises(ValueError, match="duplicate identifier: a"):
        hierarchy_from_events(events, RollupConfig())
    with pytest.raises(ValueError, match="duplicate identifier: a"):
        RegistryFeed(str(tmp_path))(events, 0)


def test_emptied_registry_deletes_all(spark, tmp_path):
    events = registry_events(spark, [(0, PAIR), (5, {"root": []}), (9, {"root": ["child2"]})])
    history = diff_history(flatten_registry(events), events)
    expected = [
        ("child1", "delete", 1), ("child1", "upsert", 0),
        ("child2", "delete", 1), ("child2", "upsert", 0), ("child2", "upsert", 2),
    ]
    assert sorted((r.child, r.op, r.arrival_seq) for r in history.collect()) == expected
    assert [r.child for r in current_parents(history).collect()] == ["child2"]
    feed = RegistryFeed(str(tmp_path))
    for number in range(3):
        feed(events.where(f"arrival_seq = {number}"), number)
        known = {r.child for r in feed.memberships(spark, number).collect()}
        assert known == [{"child1", "child2"}, set(), {"child2"}][number]
    assert sorted((r.child, r.op, r.arrival_seq) for r in feed.changes(spark).collect()) == expected
    assert feed.hierarchy(spark, 2).edge_rows == feed.hierarchy(spark).edge_rows == 1


def test_duplicate_identifiers(spark):
    tree = edges(spark, {"root": ["a", "b"], "b": ["a"]})
    assert [tuple(r) for r in duplicate_identifiers(tree).collect()] == [("a", 2)]
    with pytest.raises(Exception, match="duplicate identifier: a"):
        refuse_duplicates(tree).collect()
    fine = refuse_duplicates(edges(spark, PAIR)).collect()
    assert sorted((r.child, r.parents) for r in fine) == [
        ("child1", ["root"]),
        ("child2", ["root"]),
    ]


def test_several_parents_are_kept(spark):
    sets = parent_sets(edges(spark, {"root": ["a", "b"], "b": ["a"]})).collect()
    assert {r.child: r.parents for r in sets} == {"a": ["b", "root"], "b": ["root"]}


def test_history_of_changes(spark):
    moved = {"root": ["child2", "hall"], "hall": ["child1"]}
    history = [(0, PAIR), (4, PAIR), (6, moved), (8, {"root": ["child2"]}), (9, PAIR)]
    changes = diff_history(flatten_registry(registry_events(spark, history))).cache()
    got = sorted(
        (r.arrival_seq, r.child, r.op, r.old_parents, r.parents, r.event_time.timestamp())
        for r in changes.collect()
    )
    assert got == [
        (0, "child1", "upsert", None, ["root"], 0.0),
        (0, "child2", "upsert", None, ["root"], 0.0),
        (2, "child1", "upsert", ["root"], ["hall"], 6.0),
        (2, "hall", "upsert", None, ["root"], 6.0),
        (3, "child1", "delete", ["hall"], None, 8.0),
        (3, "hall", "delete", ["root"], None, 8.0),
        (4, "child1", "upsert", None, ["root"], 9.0),
    ]
    now = {r.child: r.parents for r in current_parents(changes).collect()}
    assert now == {"child1": ["root"], "child2": ["root"]}
    versions = sorted(
        (r.child, r.parents, r.valid_from.timestamp(), r.valid_to and r.valid_to.timestamp())
        for r in versioned_edges(changes).collect()
    )
    assert versions == [
        ("child1", ["hall"], 6.0, 8.0),
        ("child1", ["root"], 0.0, 6.0),
        ("child1", ["root"], 9.0, None),
        ("child2", ["root"], 0.0, None),
        ("hall", ["root"], 6.0, 8.0),
    ]
    gone = sorted((r.child, r.parent, r.op) for r in membership_retractions(changes).collect())
    assert gone == [
        ("child1", "hall", "delete"),
        ("child1", "root", "delete"),
        ("hall", "root", "delete"),
    ]


def test_long_documents_are_cut_before_they_become_variants(spark, monkeypatch):
    wide = {"root": [f"hall{i}" for i in range(9)] + ["lone"]} | {
        f"hall{i}": [f"sensor-{i}-{k}" for k in range(i)] for i in range(9)
    }
    odd = '{"identifier": 7, "children": [{"identifier": 5}, null, {"children": []}, 3, [1]]}'
    events = registry_events(spark, [(0, wide), (1, UNBALANCED), (2, {"root": []})]).unionByName(
        spark.createDataFrame(
            [("SENSOR_REGISTRY_CHANGED", odd, at(9), 9), ("SENSOR_REGISTRY_CHANGED", None, at(9), 10)],
            "event_type string, payload string, event_time timestamp, arrival_seq bigint",
        )
    )

    def rows():
        return sorted(map(repr, flatten_registry(events).collect()))

    whole = rows()
    assert len(whole) == 46 + len({c for cs in UNBALANCED.values() for c in cs}) + 5
    for size in (20, 120, 400):
        monkeypatch.setattr(registry, "_PIECE_BYTES", size)
        assert rows() == whole
    broken = '{"identifier": "a", "children": {"identifier": "' + 400 * "b" + '"}}'
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        flatten_registry(events.where("arrival_seq = 0").withColumn("payload", F.lit(broken)))


def test_long_documents_are_not_walked_over_the_driver(spark, monkeypatch):
    name = "spark.sql.cteRecursionAnchorRowsLimitToConvertToLocalRelation"
    before, seen = spark.conf.get(name), []

    def spied(df, label):
        seen.append(df.sparkSession.conf.get(name))
        return write_table(df, label)

    monkeypatch.setattr(registry, "write_table", spied)
    flatten_registry(registry_events(spark, [(0, PAIR)]))
    long = {"root": [f"{400 * 'x'}{i}" for i in range(700)]}
    assert flatten_registry(registry_events(spark, [(0, long)])).count() == 700
    assert seen == [before, "0"]
    assert spark.conf.get(name) == before
