"""Memberships that change at any level, against a replay of one arrival after the other."""

import random

import pytest
from helpers import at, readings

from treewatt import RollupConfig
from treewatt.functions.running import with_running
from treewatt.functions.tables import sized, write_table
from treewatt.operators import members
from treewatt.operators.members import follow_members, no_state, results_of

CFG = RollupConfig(emit_period_ms=10_000, grace_period_ms=4_000, sum_scale=1)
CHANGES = (
    "child string, old_parents array<string>, parents array<string>, arrival_seq bigint, "
    "event_time timestamp"
)
WINDOW, GRACE = 10, 4


class Replay:
    """The rules of the module, one arrival at a time."""

    def __init__(self, heights, retract=True):
        self.heights, self.retract = heights, retract
        self.parents, self.last, self.pairs, self.groups, self.log = {}, {}, {}, {}, []
        self.clock = None

    def _window(self, time):
        return time // WINDOW * WINDOW

    def arrive(self, seq, time, reading=None, changes=()):
        self.clock = time if self.clock is None else max(self.clock, time)
        updates = {}
        if reading:
            node, value = reading
            updates[node] = [(self._window(time), time, value, time, False)]
        moved = {node: parents for node, parents in changes}
        for height in range(max(self.heights.values())):
            touched = {}
            for node in sorted(n for n in {*moved, *updates} if self.heights[n] == height):
                if node in moved:
                    self._change(node, moved[node], time, touched)
                for update in updates.get(node, ()):
                    for parent in self.parents.get(node, ()):
                        self._put(node, parent, seq, update, touched)
                if node in updates:
                    self.last[node] = max(updates[node])
            for parent_height in range(height + 1, max(self.heights.values()) + 1):
                for key in [k for k in touched if self.heights[k[1]] == parent_height]:
                    self.touched.setdefault(parent_height, {}).setdefault(key, []).extend(touched[key])
            for (window, group), steps in sorted(self.touched.pop(height + 1, {}).items()):
                state = self.groups.setdefault((window, group), [0, 0, None, None])
                for joins, delta, payload, record in steps:
                    state[0] += joins
                    state[1] += delta
                    if payload is not None:
                        state[2] = payload if state[2] is None else max(state[2], payload)
                    state[3] = record if state[3] is None else max(state[3], record)
                n, total, newest, record = state
                self.log.append((seq, window, group, n, total / 10, newest * 1000, record, self.clock))
                updates.setdefault(group, []).append((window, newest, total, record, n == 0))
        for group in [g for g in updates if self.heights[g] == max(self.heights.values())]:
            self.last[group] = max(updates[group])

    touched = {}

    def _open(self, window):
        return window + WINDOW + GRACE > self.clock

    def _change(self, node, parents, time, touched):
        old, last = self.parents.get(node, set()), self.last.get(node)
        record = max(time, last[3]) if last else time
        window = self._window(record)
        if last and not last[4]:
            for parent in parents:
                self._put(node, parent, None, (window, last[1], last[2], record, False), touched)
        if self.retract:
            for parent in old - set(parents):
                self._put(node, parent, None, (window, None, None, record, True), touched)
        self.parents[node] = set(parents)

    def _put(self, node, parent, seq, update, touched):
        window, payload, value, record, gone = update
        if not self._open(window):
            return
        old = self.pairs.get((window, node, parent))
        steps = touched.setdefault((window, parent), [])
        if gone:
            if old is None:
                if not steps:
                    del touched[window, parent]
                return
            del self.pairs[window, node, parent]
            steps.append((-1, -old[1], None, record))
        elif old is None or payload >= old[0]:
            self.pairs[window, node, parent] = (payload, value)
            steps.append((int(old is None), value - (old[1] if old else 0), payload, record))
        else:
            steps.append((0, 0, payload, record))


def history(seed, arrivals=120, change_every=9):
    """Readings and moves of three levels below a root, some out of order."""
    random_ = random.Random(seed)
    sensors = [f"s{i}" for i in range(8)]
    lower, upper = [f"g{i}" for i in range(4)], [f"r{i}" for i in range(3)]
    heights = {**dict.fromkeys(sensors, 0), **dict.fromkeys(lower, 1), **dict.fromkeys(upper, 2), "root": 3}
    above = {0: lower, 1: upper, 2: ["root"]}
    known, rows = {}, []
    time = 0
    for seq in range(arrivals):
        time += random_.choice([0, 0, 1, 2])
        now = max(0, time - random_.choice([0, 0, 0, 3, 9, 20]))
        if seq % change_every == 4:
            moves = []
            for node in sensors + lower + upper:
                old = known.get(node, set())
                if not old and random_.random() < 0.5 or old and random_.random() < 0.2:
                    count = random_.choice([0, 1, 1, 1, 2]) if old else 1
                    new = set(random_.sample(above[heights[node]], min(count, len(above[heights[node]]))))
                    if new != old:
                        moves.append((node, old, new))
                        known[node] = new
            if moves:
                rows.append((seq, now, None, moves))
        else:
            rows.append((seq, now, (random_.choice(sensors), random_.randint(-50, 99)), ()))
    return heights, rows


def frames(spark, rows):
    data = [(i, t, v / 10) for _, t, r, _ in rows if r for i, v in [r]]
    seqs = [q for q, _, r, _ in rows if r]
    values = readings(spark, data or [("nobody", 0, 0.0)])
    pairs = spark.createDataFrame(list(enumerate(seqs)), "arrival_seq bigint, seq bigint")
    values = values.join(pairs, "arrival_seq").drop("arrival_seq").withColumnRenamed("seq", "arrival_seq")
    moves = [
        (n, sorted(old) or None, sorted(new) or None, seq, at(t))
        for seq, t, _, changes in rows
        for n, old, new in changes
    ]
    return values, spark.createDataFrame(moves, CHANGES)


def told(log):
    return sorted(
        (r.arrival_seq, int(r.window_start.timestamp()), r.identifier, r["count"], round(r.sum_w, 6),
         r.timestamp_ms, int(r.event_time.timestamp()), int(r.stream_time.timestamp()))
        for r in log.collect()
    )


@pytest.mark.parametrize(("seed", "mode"), [(1, "retract"), (3, "ignore")])
def test_equals_the_replay_and_any_cut_of_it(spark, seed, mode):
    cfg = RollupConfig(emit_period_ms=10_000, grace_period_ms=4_000, sum_scale=1, on_removal=mode)
    heights, rows = history(seed)
    replay = Replay(heights, mode == "retract")
    replay.touched = {}
    for seq, time, reading, changes in rows:
        replay.arrive(seq, time, reading, [(n, new) for n, _, new in changes])
    log, state = follow_members(*frames(spark, rows), no_state(spark), cfg)
    assert told(log) == sorted(replay.log)
    results = {(int(r.window_start.timestamp()), r.identifier): (r["count"], round(r.sum_w, 6)) for r in results_of(state.groups, cfg).collect()}
    assert results == {k: (v[0], v[1] / 10) for k, v in replay.groups.items() if v[0]}
    if seed == 1:
        carried, parts = no_state(spark), []
        for part in (rows[:40], rows[40:47], rows[47:]):
            log, changed = follow_members(*frames(spark, part), carried, cfg)
            parts += told(log)
            carried = carried.after(changed)
        assert sorted(parts) == sorted(replay.log)


def small(spark, steps, cfg=CFG):
    """Steps are (second, sensor, value) or (second, {node: parents})."""
    known, rows = {}, []
    for seq, step in enumerate(steps):
        if len(step) == 3:
            rows.append((seq, step[0], (step[1], step[2] * 10), ()))
        else:
            moves = [(n, known.get(n, set()), set(p)) for n, p in step[1].items()]
            known |= {n: set(p) for n, p in step[1].items()}
            rows.append((seq, step[0], None, moves))
    log, state = follow_members(*frames(spark, rows), no_state(spark), cfg)
    return [(seq, w, g, n, total) for seq, w, g, n, total, *_ in told(log)], state


def test_a_reading_from_before_its_sensor_was_known_counts_once_it_is(spark):
    log, _ = small(spark, [(1, "a", 5), (12, {"a": ["g"]}), (13, "a", 7)])
    assert log == [(1, 10, "g", 1, 5.0), (2, 10, "g", 1, 7.0)]


def test_a_group_takes_its_last_result_along(spark):
    log, _ = small(
        spark,
        [(0, {"a": ["g"], "b": ["g"], "g": ["r"], "r": ["root"], "h": ["r2"], "r2": ["root"]}),
         (1, "a", 5), (2, "b", 6), (3, {"g": ["r2"]}), (4, "a", 8)],
    )
    assert log == [
        (1, 0, "g", 1, 5.0), (1, 0, "r", 1, 5.0), (1, 0, "root", 1, 5.0),
        (2, 0, "g", 2, 11.0), (2, 0, "r", 1, 11.0), (2, 0, "root", 1, 11.0),
        (3, 0, "r", 0, 0.0), (3, 0, "r2", 1, 11.0), (3, 0, "root", 1, 11.0),
        (4, 0, "g", 2, 14.0), (4, 0, "r2", 1, 14.0), (4, 0, "root", 1, 14.0),
    ]


def test_refusals(spark):
    with pytest.raises(Exception, match="reports itself"):
        small(spark, [(0, {"a": ["g"], "g": ["root"]}), (1, "g", 5)])[0]
    with pytest.raises(ValueError, match="cycle"):
        small(spark, [(0, {"a": ["b"]}), (1, {"a": [], "b": ["a"]})])
    with pytest.raises(ValueError, match="sum_scale"):
        small(spark, [(0, {"a": ["b"]})], RollupConfig())


def test_nothing_known(spark):
    log, state = small(spark, [(1, "a", 5), (2, "b", 6)])
    assert log == [] and state.last.count() == 2


def test_only_nodes_that_something_moves_are_scanned(spark, monkeypatch):
    """Changes of nodes without an update before them stay out of the scan; few groups are
    broadcast however many sensors there are; upper heights write no step twice."""
    scanned, broadcast, labels = [], [], []

    def recorded(df, keys, order, wanted, **options):
        if "change" in df.columns:
            scanned.append(sorted(r.node for r in df.where("change IS NOT NULL").collect()))
        return with_running(df, keys, order, wanted, **options)

    def counted(df, rows, limit):
        if {"node", "parents", "since"} <= set(df.columns):
            broadcast.append((rows, rows <= limit))
        return sized(df, rows, limit)

    def labelled(df, label):
        labels.append(label)
        return write_table(df, label)

    monkeypatch.setattr(members, "with_running", recorded)
    monkeypatch.setattr(members, "sized", counted)
    monkeypatch.setattr(members, "write_table", labelled)
    edges = {"a": "g", "b": "g", "g": "r", "h": "r2", "r": "root", "r2": "root"} | {
        f"s{i}": "g" for i in range(9)
    }
    rows = [
        (0, 0, None, [(n, set(), {p}) for n, p in edges.items()]),
        (1, 1, ("a", 50), []),
        (2, 2, ("b", 60), []),
        (3, 3, None, [("a", {"g"}, {"h"}), ("s0", {"g"}, {"h"})]),
        (4, 4, ("a", 70), []),
    ]
    cfg = RollupConfig(emit_period_ms=10_000, sum_scale=1, broadcast_rows=8)
    log, state = follow_members(*frames(spark, rows), no_state(spark), cfg, last_call=True)
    assert scanned == [["a", "a"], [], []]
    assert broadcast == [(15, False), (2, True), (2, True), (0, True), (2, True), (0, True)]
    assert labels.count("deltas") == 3 and labels.count("results") == 2
    assert "scanned" not in labels and "fresh" not in labels
    wanted = {(1, "g", 1, 5.0), (2, "g", 2, 11.0), (3, "g", 1, 6.0), (3, "h", 1, 5.0), (4, "h", 1, 7.0)}
    told = {(r.arrival_seq, r.identifier, r["count"], r.sum_w) for r in log.collect()}
    assert {t for t in told if t[1] in ("g", "h")} == wanted
    assert (4, "root", 2, 13.0) in told
