"""The hand-checked scenarios through every batch emission."""

import pytest
from helpers import counts_and_sums, hierarchy, readings, registry_events
from scenarios import GRACE_MS, SCENARIOS, WINDOW_MS

from treewatt import RollupConfig
from treewatt.plans.batch import build_batch, hierarchy_from_events

CFG = RollupConfig(emit_period_ms=WINDOW_MS, grace_period_ms=GRACE_MS, sum_scale=3)

# What each scenario's last window holds, which throttling has not released yet.
OPEN_AT_END = {
    "one level": [("root", 1, 123)],
    "latest value counts": [("root", 1, 123)],
    "latest value counts, out of order": [("root", 1, 123)],
    "correction within grace": [("root", 1, 123)],
    "too late after grace": [("root", 1, 123)],
    "two levels": [("sensor-2", 1, 123), ("root", 1, 123)],
    "unbalanced": [("sensor-1", 1, 999), ("root", 1, 999)],
}


@pytest.mark.parametrize("case", SCENARIOS, ids=lambda s: s.name)
def test_throttled(spark, case):
    out = build_batch(readings(spark, case.readings), hierarchy(spark, case.tree), CFG, "throttled")
    assert counts_and_sums(out) == sorted(case.expected)


@pytest.mark.parametrize("emission", ["final", "closure"])
@pytest.mark.parametrize("case", SCENARIOS, ids=lambda s: s.name)
def test_final(spark, case, emission):
    out = build_batch(readings(spark, case.readings), hierarchy(spark, case.tree), CFG, emission)
    expected = [*case.expected, *OPEN_AT_END[case.name]]
    if case.name == "correction within grace":
        expected.remove(("root", 2, 150))
    assert counts_and_sums(out) == sorted(expected)


def test_hierarchy_from_registry_document(spark):
    case = SCENARIOS[-1]
    tree = hierarchy_from_events(registry_events(spark, [(0, case.tree)]), CFG)
    out = build_batch(readings(spark, case.readings), tree, CFG, "throttled")
    assert counts_and_sums(out) == sorted(case.expected)
    assert tree.height == 3
