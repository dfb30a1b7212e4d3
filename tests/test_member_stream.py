"""The stream of readings and registry events, and the tables that it carries."""

import json
import os

import pytest
from helpers import at, readings
from pyspark.sql import functions as F
from scenarios import nested

from treewatt import RollupConfig
from treewatt.functions.running import with_running
from treewatt.operators import members, registry
from treewatt.plans.batch import rollup_members
from treewatt.schemas import REGISTRY_EVENT
from treewatt.streaming.members import MemberRollup, member_rows
from treewatt.streaming.state import KeyedTable

CFG = RollupConfig(emit_period_ms=10_000, grace_period_ms=2_000, sum_scale=1)
FIRST = {"root": ["r1", "r2"], "r1": ["g"], "r2": ["h"], "g": ["a", "b"], "h": ["c"]}
SECOND = {"root": ["r1", "r2"], "r2": ["h", "g"], "g": ["a"], "h": ["c", "b"]}
THIRD = {"root": ["r1"], "r1": ["g"], "g": ["a", "b", "c"]}


def inputs(spark, steps):
    """Steps are (second, sensor, value) or (second, tree)."""
    values = [(seq, s) for seq, s in enumerate(steps) if len(s) == 3]
    trees = [(seq, s) for seq, s in enumerate(steps) if len(s) == 2]
    data = readings(spark, [(n, t, v) for _, (t, n, v) in values])
    numbers = spark.createDataFrame(
        [(i, seq) for i, (seq, _) in enumerate(values)], "arrival_seq bigint, seq bigint"
    )
    data = data.join(numbers, "arrival_seq").drop("arrival_seq").withColumnRenamed("seq", "arrival_seq")
    events = [
        ("SENSOR_REGISTRY_CHANGED", json.dumps(nested(tree)), at(t), seq) for seq, (t, tree) in trees
    ]
    return data, spark.createDataFrame(events, REGISTRY_EVENT)


STEPS = [
    (0, "a", 5), (1, FIRST), (2, "a", 6), (3, "b", 1), (4, "c", 9), (5, SECOND), (6, "b", 2),
    (9, "a", 7), (12, "a", 8), (11, "c", 3), (13, THIRD), (14, "b", 4), (21, "c", 5), (26, "a", 1),
    (40, "b", 9),
]


def told(rows):
    return sorted(
        (r.window_start.isoformat(), r.identifier, r["count"], r.sum_w, r.timestamp_ms) for r in rows.collect()
    )


@pytest.mark.parametrize("emission", ["throttled", "final"])
def test_any_cut_gives_the_rows_of_stored_input(spark, tmp_path, emission):
    data, events = inputs(spark, STEPS)
    rows = member_rows(data, events).cache()
    out = str(tmp_path / "out")
    published = []
    step = MemberRollup(
        CFG, str(tmp_path / "state"), out, emission, lambda df, n: published.append((n, df.count()))
    )
    cuts = [0, 4, 9, len(STEPS)]
    for batch_id, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        part = rows.where(F.col("arrival_seq").between(a, b - 1))
        step(part, batch_id)
        if batch_id == 1:  # a batch that is run again gives the same
            step(part, batch_id)
    whole = rollup_members(data, events, CFG, emission)
    if emission == "final":
        whole = whole.where(F.unix_micros("window_end") <= 38_000_000)
    got = spark.read.parquet(out).drop("batch_id")
    assert told(got) == told(whole) and got.count() > 5
    assert [n for n, _ in published] == [0, 1, 1, 2]
    assert sum(dict(published).values()) == got.count()


def test_folders_do_not_grow_and_untouched_rows_stay(spark, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "k bigint, v bigint", ("k",), buckets=4, compact_every=3)
    expected, counts = {}, []
    for batch_id in range(14):
        changed = [(batch_id % 5, batch_id, False), (100 + batch_id, 1, False), (99 + batch_id, 0, True)]
        table.save(spark.createDataFrame(changed, "k bigint, v bigint, removed boolean"), batch_id)
        table.expire(spark, batch_id)
        expected |= {k: v for k, v, gone in changed if not gone}
        for k, _, gone in changed:
            if gone:
                expected.pop(k, None)
        counts.append(len(os.listdir(tmp_path / "t")))
        state = table.at(spark, batch_id)
        if batch_id in (0, 4, 9, 13):
            assert {r.k: r.v for r in state.whole().collect()} == expected
            asked = spark.createDataFrame([(3,), (100 + batch_id,), (7777,)], "k bigint")
            got = {r.k: r.v for r in state.of(asked).collect()}
            assert got == {k: v for k, v in expected.items() if k in (3, 100 + batch_id)}
    assert max(counts) <= 5 and counts[-1] <= 5
    assert table.at(spark, -1).whole().count() == 0


def test_a_batch_reads_and_writes_what_it_touches(spark, tmp_path):
    """Rows written by a small batch do not depend on how much is open."""
    written = []
    for sensors in (5, 80):
        names = [f"s{i}" for i in range(sensors)]
        folder = str(tmp_path / str(sensors))
        step = MemberRollup(CFG, f"{folder}/state", f"{folder}/out", "changelog")
        steps = [(0, {"root": ["g"], "g": names}), *[(1, n, 1) for n in names], (2, "s3", 7)]
        rows = member_rows(*inputs(spark, steps)).cache()
        step(rows.where(F.col("arrival_seq") <= sensors), 0)
        step(rows.where(F.col("arrival_seq") > sensors), 1)
        written.append(
            {t: spark.read.parquet(f"{folder}/state/{t}/batch-1").count() for t in ("last", "pairs", "groups")}
        )
        last = spark.read.parquet(f"{folder}/out/batch_id=1")
        assert {(r.identifier, r["count"], r.sum_w) for r in last.collect()} == {
            ("g", sensors, sensors + 6.0), ("root", 1, sensors + 6.0),
        }
    assert written[0] == written[1] == {"last": 3, "pairs": 2, "groups": 2}


def test_a_batch_leaves_out_what_nothing_later_asks_for(spark, tmp_path, monkeypatch):
    """Updates after the last change of their node are not scanned with the changes, pairs of
    closed windows are not kept, and a lone snapshot is compared with what is known alone."""
    scanned = []

    def recorded(df, keys, order, wanted, **options):
        if any(w.name == "version" for w in wanted):
            scanned.append(df.where("update IS NOT NULL AND arrival_seq IS NOT NULL").count())
        return with_running(df, keys, order, wanted, **options)

    monkeypatch.setattr(members, "with_running", recorded)
    monkeypatch.setattr(registry, "diff_history", None)
    steps = [(0, FIRST), (1, "a", 5), (2, "b", 6), (21, "a", 7), (22, "c", 8)]
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    MemberRollup(CFG, state, out, "changelog")(member_rows(*inputs(spark, steps)), 0)
    assert scanned and sum(scanned) == 0
    windows = spark.read.parquet(f"{state}/pairs/batch-0").select(F.unix_seconds("window_start"))
    assert [r[0] for r in windows.collect()] == [20] * 6
    roots = spark.read.parquet(out).where("identifier = 'root'")
    assert sorted((r["count"], r.sum_w) for r in roots.collect()) == [
        (1, 5.0), (1, 7.0), (1, 11.0), (2, 15.0),
    ]
