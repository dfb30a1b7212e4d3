import pytest

from treewatt import RollupConfig
from treewatt.config import require
from treewatt.streaming.incremental import IncrementalRollup


@pytest.mark.parametrize(
    "wrong",
    [
        {"emit_period_ms": None},
        {"emit_period_ms": 0},
        {"grace_period_ms": -1},
        {"grace_period_ms": None},
        {"child_agg": "median"},
        {"on_removal": "keep"},
        {"sum_scale": 12},
        {"broadcast_rows": -1},
        {"order_bounds": ((5, 1), (0, 1))},
        {"order_bounds": ((0, 2**40), (0, 2**40))},
    ],
)
def test_wrong_parameters_are_refused(wrong):
    with pytest.raises(ValueError):
        RollupConfig(**wrong)


def test_defaults():
    cfg = RollupConfig()
    assert (cfg.emit_period_ms, cfg.grace_period_ms, cfg.child_agg) == (5000, 0, "last")


def test_required_arguments():
    with pytest.raises(ValueError, match="output, state"):
        require(state=None, cfg=1, output=None)
    with pytest.raises(ValueError, match="state"):
        IncrementalRollup(lambda: None, RollupConfig(), None, "out")
    with pytest.raises(ValueError, match="emission"):
        IncrementalRollup(lambda: None, RollupConfig(), "state", "out", "sometimes")
