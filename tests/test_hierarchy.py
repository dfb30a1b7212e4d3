import pytest
from helpers import edges, hierarchy
from scenarios import UNBALANCED

from treewatt.operators.hierarchy import build_hierarchy

DIAMOND = {"root": ["left", "right"], "left": ["hub"], "right": ["hub", "b"], "hub": ["a"]}


def test_closure_of_an_unbalanced_tree(spark):
    tree = hierarchy(spark, UNBALANCED)
    rows = {(r.leaf, r.ancestor): r for r in tree.closure.collect()}
    deep = rows["sensor-2-1-1", "root"]
    assert (deep.via_child, deep.depth, deep.paths, deep.inner) == ("sensor-2", 3, 1, False)
    assert rows["sensor-2-1", "root"].inner
    assert (tree.height, tree.edge_rows, tree.closure_rows) == (3, 10, 2 * 1 + 4 * 2 + 4 * 3)
    heights = {r.child: r.height for r in tree.nodes.collect()}
    assert heights["sensor-2"] == 2 and heights["sensor-1"] == 1 and heights["sensor-1-1"] == 0


def test_stated_depth_gives_the_same_closure(spark):
    found = hierarchy(spark, UNBALANCED)
    stated = build_hierarchy(edges(spark, UNBALANCED), depth=3, broadcast_rows=0)
    assert sorted(found.closure.collect()) == sorted(stated.closure.collect())
    with pytest.raises(ValueError, match="deeper"):
        build_hierarchy(edges(spark, UNBALANCED), depth=2)


def test_paths_of_a_diamond(spark):
    rows = hierarchy(spark, DIAMOND).closure.collect()
    to_root = {(r.leaf, r.via_child): (r.depth, r.paths) for r in rows if r.ancestor == "root"}
    assert to_root["a", "left"] == (3, 1)
    assert to_root["a", "right"] == (3, 1)
    wide = {"root": ["x"], "x": ["p", "q"], "p": ["a"], "q": ["a"]}
    rows = hierarchy(spark, wide).closure.collect()
    assert [(r.via_child, r.paths) for r in rows if (r.leaf, r.ancestor) == ("a", "root")] == [
        ("x", 2)
    ]


def test_a_cycle_raises(spark):
    with pytest.raises(ValueError, match="cycle"):
        build_hierarchy(edges(spark, {"a": ["b"], "b": ["a"], "c": ["x"], "d": ["c"]}))
