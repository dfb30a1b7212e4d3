"""Building small inputs and reading small results."""

import datetime as dt
import json

from scenarios import nested

from treewatt.operators.hierarchy import build_hierarchy
from treewatt.schemas import MEASUREMENT, REGISTRY_EVENT

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return EPOCH + dt.timedelta(seconds=seconds)


def readings(spark, rows):
    """Rows are (sensor, second, watts[, payload second]) in arrival order."""
    data = []
    for seq, (sensor, second, watts, *payload) in enumerate(rows):
        payload_ms = round((payload[0] if payload else second) * 1000)
        data.append((sensor, at(second), payload_ms, float(watts), seq))
    return spark.createDataFrame(data, MEASUREMENT)


def edges(spark, tree):
    pairs = [(child, parent) for parent, children in tree.items() for child in children]
    return spark.createDataFrame(pairs, "child string, parent string")


def hierarchy(spark, tree, **options):
    return build_hierarchy(edges(spark, tree), **options)


def registry_events(spark, snapshots):
    """Snapshots are (second, tree) or (second, tree, event type)."""
    rows = []
    for seq, (second, tree, *kind) in enumerate(snapshots):
        event_type = kind[0] if kind else "SENSOR_REGISTRY_CHANGED"
        rows.append((event_type, json.dumps(nested(tree)), at(second), seq))
    return spark.createDataFrame(rows, REGISTRY_EVENT)


def counts_and_sums(results):
    """Sorted (group, count, sum) of a result."""
    return sorted((r["identifier"], r["count"], r["sum_w"]) for r in results.collect())


def windows_counts_sums(results):
    """Sorted (window start in s, group, count, sum) of a result."""
    return sorted(
        (r["window_start"].timestamp(), r["identifier"], r["count"], r["sum_w"])
        for r in results.selectExpr(
            "window_start", "identifier", "count", "sum_w"
        ).collect()
    )
