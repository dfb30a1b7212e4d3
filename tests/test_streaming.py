"""Streaming runs: files as micro-batches, in the order they are written."""

import pytest
from helpers import (
    counts_and_sums,
    edges,
    hierarchy,
    readings,
    registry_events,
    windows_counts_sums,
)
from scenarios import GRACE_MS, PAIR, SCENARIOS, WINDOW_MS

from treewatt import RollupConfig
from treewatt.plans.batch import build_batch
from treewatt.schemas import MEASUREMENT, REGISTRY_EVENT
from treewatt.streaming.incremental import IncrementalRollup, incremental_writer
from treewatt.streaming.registry_feed import RegistryFeed, registry_writer
from treewatt.streaming.windows import final_results

CFG = RollupConfig(emit_period_ms=WINDOW_MS, grace_period_ms=GRACE_MS, sum_scale=3)


def write_batches(df, folder, sizes):
    """One file per batch, in arrival order."""
    start = 0
    for size in sizes:
        part = df.where(f"arrival_seq >= {start} AND arrival_seq < {start + size}")
        part.coalesce(1).write.mode("append").parquet(folder)
        start += size


def stream(spark, folder, schema=MEASUREMENT):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None


def incremental(spark, tmp_path, case, sizes, emission):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_batches(readings(spark, case.readings), source, sizes)
    rollup = IncrementalRollup(
        hierarchy(spark, case.tree), CFG, str(tmp_path / "state"), out, emission
    )
    run(incremental_writer(stream(spark, source), rollup, str(tmp_path / "checkpoint")))
    return spark.read.parquet(out)


@pytest.mark.parametrize(
    ("index", "sizes"), [(3, [2, 1, 2]), (6, [4, 3])], ids=str
)
def test_throttled_in_micro_batches(spark, tmp_path, index, sizes):
    case = SCENARIOS[index]
    out = incremental(spark, tmp_path, case, sizes, "throttled")
    assert counts_and_sums(out) == sorted(case.expected)


def test_changelog_in_micro_batches_equals_replay(spark, tmp_path):
    case = SCENARIOS[4]
    out = incremental(spark, tmp_path, case, [3, 2, 1], "changelog")
    replay = build_batch(
        readings(spark, case.readings), hierarchy(spark, case.tree), CFG, "changelog"
    )
    columns = ["arrival_seq", "identifier", "count", "sum_w", "timestamp_ms", "event_time"]
    assert sorted(out.select(*columns).collect()) == sorted(replay.select(*columns).collect())


@pytest.mark.parametrize("how", ["max", "avg"])
def test_other_child_values_in_micro_batches(spark, tmp_path, how):
    """Final results and the changelog equal those of stored input."""
    rows = [("child1", 0.1 * i, (7 * i) % 11) for i in range(14)] + [("child2", 1.5, 4), ("child2", 9, 1)]
    cfg = RollupConfig(WINDOW_MS, GRACE_MS, sum_scale=3, child_agg=how)
    tree = hierarchy(spark, PAIR)
    source = str(tmp_path / "in")
    write_batches(readings(spark, rows), source, [5, 4, 6, 1])
    for emission in ("final", "changelog"):
        out = str(tmp_path / emission)
        step = IncrementalRollup(tree, cfg, str(tmp_path / f"{emission}-state"), out, emission)
        run(incremental_writer(stream(spark, source), step, str(tmp_path / f"{emission}-checkpoint")))
        whole = build_batch(readings(spark, rows), tree, cfg, emission)
        if emission == "final":
            whole = whole.where("window_end < timestamp'1970-01-01 00:00:07Z'")
        key = lambda r: (str(r.window_start), r.identifier, r["count"], r.sum_w, r.timestamp_ms)
        assert sorted(map(key, spark.read.parquet(out).collect())) == sorted(map(key, whole.collect()))


def test_final_drops_exactly_the_late_reading(spark, tmp_path):
    out = incremental(spark, tmp_path, SCENARIOS[4], [2, 1, 1, 2], "final")
    # Stream time ends at 7 s: windows ending at 2 and 4 s are closed, 6 s is not.
    assert windows_counts_sums(out) == [(0.0, "root", 2, 150.0), (2.0, "root", 1, 123.0)]


def test_built_in_windows(spark, tmp_path):
    case = SCENARIOS[6]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    later = [*case.readings, ("sensor-1-1", 9, 0)]
    write_batches(readings(spark, later), source, [len(later)])
    results = final_results(stream(spark, source), hierarchy(spark, case.tree), CFG)
    run(
        results.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .outputMode("append")
    )
    got = windows_counts_sums(spark.read.parquet(out))
    assert [row[1:] for row in got if row[0] == 0.0] == sorted(case.expected)
    assert [row[1:] for row in got if row[0] == 2.0] == [("root", 1, 999), ("sensor-1", 1, 999)]


def test_registry_feed(spark, tmp_path):
    source = str(tmp_path / "in")
    moved = {"root": ["child2", "group"], "group": ["child1"]}
    events = registry_events(
        spark, [(0, PAIR), (5, PAIR, "SENSOR_REGISTRY_STATUS"), (7, moved, "OTHER"), (9, moved)]
    )
    write_batches(events, source, [1, 2, 1])
    feed = RegistryFeed(str(tmp_path / "state"))
    run(
        registry_writer(
            stream(spark, source, REGISTRY_EVENT), feed, str(tmp_path / "checkpoint")
        )
    )
    rows = sorted(
        (r.arrival_seq, r.child, r.op, r.old_parents, r.parents)
        for r in feed.changes(spark).collect()
    )
    assert rows == [
        (0, "child1", "upsert", None, ["root"]),
        (0, "child2", "upsert", None, ["root"]),
        (3, "child1", "upsert", ["root"], ["group"]),
        (3, "group", "upsert", None, ["root"]),
    ]
    now = {(r.child, r.parent) for r in feed.hierarchy(spark).edges.collect()}
    assert now == {(r.child, r.parent) for r in edges(spark, moved).collect()}
