"""Small hand-checked scenarios: a tree, readings in arrival order, expected rows.

Windows and grace are two seconds. Each reading is (sensor, second, watts); event time
and payload time are the same. Expected rows are (group, count, sum) as emitted with
throttling, in any order.
"""

from dataclasses import dataclass

WINDOW_MS = 2000
GRACE_MS = 2000

PAIR = {"root": ["child1", "child2"]}
TWO_LEVELS = {
    "root": ["sensor-1", "sensor-2"],
    "sensor-1": ["sensor-1-1", "sensor-1-2"],
    "sensor-2": ["sensor-2-1", "sensor-2-2"],
}
UNBALANCED = {
    "root": ["sensor-1", "sensor-2"],
    "sensor-1": ["sensor-1-1", "sensor-1-2"],
    "sensor-2": ["sensor-2-1", "sensor-2-2"],
    "sensor-2-1": ["sensor-2-1-1", "sensor-2-1-2"],
    "sensor-2-2": ["sensor-2-2-1", "sensor-2-2-2"],
}


@dataclass(frozen=True)
class Scenario:
    name: str
    tree: dict
    readings: list
    expected: list


# Inputs and results every implementation has to agree on.
SCENARIOS = [
    Scenario(
        "one level",
        PAIR,
        [("child1", 0, 100), ("child2", 1, 100), ("child2", 2, 123)],
        [("root", 2, 200)],
    ),
    Scenario(
        "latest value counts",
        PAIR,
        [("child1", 0.5, 50), ("child2", 1, 100), ("child1", 1.5, 400), ("child2", 3, 123)],
        [("root", 2, 500)],
    ),
    Scenario(
        "latest value counts, out of order",
        PAIR,
        [("child2", 1, 100), ("child1", 1.5, 400), ("child1", 0.5, 50), ("child2", 3, 123)],
        [("root", 2, 500)],
    ),
    Scenario(
        "correction within grace",
        PAIR,
        [
            ("child1", 0.5, 50),
            ("child2", 1, 100),
            ("child2", 3, 123),
            ("child1", 1.5, 400),
            ("child2", 5, 123),
        ],
        [("root", 2, 150), ("root", 2, 500), ("root", 1, 123)],
    ),
    Scenario(
        "too late after grace",
        PAIR,
        [
            ("child1", 0.5, 50),
            ("child2", 1, 100),
            ("child2", 3, 123),
            ("child2", 5, 123),
            ("child1", 1.5, 400),
            ("child2", 7, 123),
        ],
        [("root", 2, 150), ("root", 1, 123), ("root", 1, 123)],
    ),
    Scenario(
        "two levels",
        TWO_LEVELS,
        [
            ("sensor-1-1", 0, 100),
            ("sensor-2-1", 0, 100),
            ("sensor-1-2", 1, 100),
            ("sensor-2-2", 1, 100),
            ("sensor-2-2", 2, 123),
        ],
        [("root", 2, 400), ("sensor-1", 2, 200), ("sensor-2", 2, 200)],
    ),
    Scenario(
        "unbalanced",
        UNBALANCED,
        [
            ("sensor-1-1", 0, 100),
            ("sensor-2-1-1", 0, 10),
            ("sensor-2-2-1", 0, 20),
            ("sensor-1-2", 0, 200),
            ("sensor-2-1-2", 1, 1),
            ("sensor-2-2-2", 1, 2),
            ("sensor-1-1", 2, 999),
        ],
        [
            ("root", 2, 333),
            ("sensor-1", 2, 300),
            ("sensor-2", 2, 33),
            ("sensor-2-1", 2, 11),
            ("sensor-2-2", 2, 22),
        ],
    ),
]


def nested(tree, node="root"):
    """The tree as the nested objects of a registry document."""
    if node not in tree:
        return {"identifier": node}
    return {"identifier": node, "children": [nested(tree, c) for c in tree[node]]}
