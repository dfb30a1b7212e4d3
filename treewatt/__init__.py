"""Rolls sensor readings up a changing hierarchy, per tumbling window, on Spark."""

from treewatt.config import RollupConfig
from treewatt.functions.columns import measure_order
from treewatt.operators.hierarchy import Hierarchy, build_hierarchy
from treewatt.plans.batch import build_batch, hierarchy_from_events, rollup_changing_membership

__all__ = [
    "Hierarchy",
    "RollupConfig",
    "build_batch",
    "build_hierarchy",
    "hierarchy_from_events",
    "measure_order",
    "rollup_changing_membership",
]
