import json

import pytest
from helpers import at, hierarchy, readings, registry_events
from scenarios import PAIR, nested

from treewatt import RollupConfig
from treewatt.operators.rollup import rollup_multilevel
from treewatt.plans.batch import hierarchy_from_events
from treewatt.schemas import MEASUREMENT, RESULT
from treewatt.sources.readers import (
    read_measurements,
    read_registry_events,
    readings_from_bus,
    registry_events_from_bus,
)
from treewatt.streaming.registry_feed import RegistryFeed
from treewatt.sources.writers import latest_per_window, stream_batches, to_bus, write_results

BUS = "key binary, value binary, partition int, offset bigint, timestamp timestamp"


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_measurement_files(spark, tmp_path, fmt):
    df = readings(spark, [("a", 0.25, 1.5), ("b", 1, 2)])
    df.write.format(fmt).save(str(tmp_path / fmt))
    back = read_measurements(spark, fmt, str(tmp_path / fmt))
    assert back.schema == MEASUREMENT
    assert sorted(back.collect()) == sorted(df.collect())


def test_registry_event_files(spark, tmp_path):
    events = registry_events(spark, [(0, PAIR)])
    events.write.json(str(tmp_path / "events"))
    back = read_registry_events(spark, "json", str(tmp_path / "events"))
    assert back.collect() == events.collect()


def test_missing_arguments(spark):
    with pytest.raises(ValueError, match="path"):
        read_measurements(spark, "parquet")
    with pytest.raises(ValueError, match="options"):
        read_measurements(spark, "kafka")
    with pytest.raises(ValueError, match="payload_format"):
        readings_from_bus(spark.createDataFrame([], BUS), "xml")


def test_bus_rows(spark):
    body = json.dumps({"identifier": "a", "timestamp": 1500, "valueInW": 2.5}).encode()
    raw = spark.createDataFrame([(b"a", body, 3, 7, at(2))], BUS)
    row = readings_from_bus(raw).first()
    assert (row.identifier, row.payload_ts_ms, row.value_w) == ("a", 1500, 2.5)
    assert (row.event_time.timestamp(), row.arrival_seq, row.source_partition) == (2.0, 7, 3)
    raw = spark.createDataFrame([(b"SENSOR_REGISTRY_STATUS", b"{}", 0, 1, at(2))], BUS)
    assert registry_events_from_bus(raw).first().event_type == "SENSOR_REGISTRY_STATUS"


def results(spark, rows):
    return rollup_multilevel(readings(spark, rows), hierarchy(spark, PAIR), RollupConfig(2000))


def test_results_have_the_public_schema(spark):
    out = results(spark, [("child1", 0, 1)])
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in RESULT]


def test_writing_again_replaces_only_the_days_written(spark, tmp_path):
    path, day = str(tmp_path / "out"), 86_400
    write_results(results(spark, [("child1", 0, 1), ("child1", day, 5)]), path)
    for _ in range(2):
        write_results(results(spark, [("child1", day, 6)]), path)
    rows = sorted((r.window_start.timestamp(), r.sum_w) for r in spark.read.parquet(path).collect())
    assert rows == [(0.0, 1.0), (float(day), 6.0)]


def test_writing_one_window_keeps_the_others_of_its_day(spark, tmp_path):
    path = str(tmp_path / "out")
    write_results(results(spark, [("child1", 0, 1), ("child1", 3, 2)]), path)
    write_results(results(spark, [("child1", 3, 7), ("child1", 9, 8)]), path)
    rows = sorted((r.window_start.timestamp(), r.sum_w) for r in spark.read.parquet(path).collect())
    assert rows == [(0.0, 1.0), (2.0, 7.0), (8.0, 8.0)]


def test_bus_messages(spark):
    row = to_bus(results(spark, [("child1", 0, 4), ("child2", 1, 2)])).first()
    assert row.key == "root"
    assert json.loads(row.value) == {
        "identifier": "root", "timestamp": 1000, "count": 2, "sumInW": 6.0, "averageInW": 3.0,
    }


def test_streamed_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    readings(spark, [("a", 0, 1), ("b", 1, 2)]).write.parquet(source)
    stream = read_measurements(spark, "parquet", source, streaming=True)
    writer = stream_batches(stream, out, str(tmp_path / "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_newest_correction_per_window(spark):
    rows = spark.createDataFrame(
        [(at(0), "root", 1.0, 1), (at(0), "root", 2.0, 2), (at(2), "root", 3.0, 1)],
        "window_start timestamp, identifier string, sum_w double, version int",
    )
    out = latest_per_window(rows, "version")
    assert sorted((r.window_start.timestamp(), r.sum_w) for r in out.collect()) == [
        (0.0, 2.0),
        (2.0, 3.0),
    ]


def versioned(spark, rows):
    """Rows are (window second, group, watts, arrival)."""
    return spark.createDataFrame(
        [(at(s), g, float(w), a) for s, g, w, a in rows],
        "window_start timestamp, identifier string, sum_w double, arrival_seq bigint",
    )


def test_corrections_keep_the_newest_version(spark, tmp_path):
    path, day = str(tmp_path / "out"), 86_400
    write_results(versioned(spark, [(0, "root", 1, 5), (0, "root", 2, 9), (day, "root", 3, 7)]), path)
    write_results(versioned(spark, [(0, "root", 8, 6), (0, "a", 4, 1), (day, "root", 5, 8)]), path)
    write_results(versioned(spark, [(0, "root", 2.5, 9)]), path)
    rows = {(r.window_start.timestamp(), r.identifier, r.sum_w) for r in spark.read.parquet(path).collect()}
    assert rows == {(0.0, "root", 2.5), (0.0, "a", 4.0), (float(day), "root", 5.0)}


def test_two_results_of_a_key_need_a_version(spark, tmp_path):
    rows = versioned(spark, [(0, "root", 1, 5), (0, "root", 2, 9)])
    with pytest.raises(ValueError, match="several results"):
        write_results(rows.drop("arrival_seq"), str(tmp_path / "out"))
    with pytest.raises(ValueError, match="key columns"):
        write_results(rows.drop("window_start"), str(tmp_path / "out"))
    write_results(rows.withColumnRenamed("arrival_seq", "round"), str(tmp_path / "out"), version="round")
    assert [r.sum_w for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [2.0]


def test_registry_events_of_several_partitions(spark, tmp_path):
    """Equal offsets of two partitions are two snapshots, which take turns."""
    def event(kind, tree, partition, offset):
        return (kind.encode(), json.dumps(nested(tree)).encode(), partition, offset, at(offset))

    moved = {"root": ["child2", "group"], "group": ["child1"]}
    raw = spark.createDataFrame(
        [
            event("SENSOR_REGISTRY_CHANGED", PAIR, 0, 7),
            event("SENSOR_REGISTRY_STATUS", moved, 1, 7),
            event("SENSOR_REGISTRY_CHANGED", PAIR, 0, 3),
        ],
        BUS,
    )
    events = registry_events_from_bus(raw)
    tree = hierarchy_from_events(events, RollupConfig())
    pairs = {(r.child, r.parent) for r in tree.edges.collect()}
    assert pairs == {("child2", "root"), ("group", "root"), ("child1", "group")}
    feed = RegistryFeed(str(tmp_path / "state"))
    feed(events.where("arrival_seq = 3"), 0)
    feed(events.where("arrival_seq = 7"), 1)
    assert {(r.child, r.parent) for r in feed.hierarchy(spark).edges.collect()} == pairs
