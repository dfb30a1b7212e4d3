"""Pipeline parameters, checked once when they are stated."""

from __future__ import annotations

from dataclasses import dataclass

CHILD_AGGREGATES = ("last", "avg", "max", "min", "sum")
REMOVAL_MODES = ("retract", "ignore")


@dataclass(frozen=True)
class RollupConfig:
    """How readings are windowed, combined and emitted.

    emit_period_ms    length of the tumbling window and the throttle period
    grace_period_ms   how long after its end a window still accepts readings
    child_agg         how several readings of one sensor in one window combine
    on_removal        what happens to readings already counted for a group when
                      their sensor leaves it: "retract" or "ignore"
    drop_window       leave window bounds out of the results
    sum_scale         decimals kept in sums. When set, sums are computed on whole
                      numbers, so a re-run task gives the same bits whatever the
                      order of its input; None sums doubles directly.
    order_bounds      ((lowest, highest payload_ts_ms), (lowest, highest arrival_seq))
                      of the input, see ``measure_order``. When set, the order "payload
                      time, then arrival" is a bigint instead of a decimal, which halves
                      the cost of last values; a reading outside the bounds raises.
    broadcast_rows    largest dimension table (by counted rows) that is broadcast;
                      beyond it joins shuffle and AQE splits skewed keys
    """

    emit_period_ms: int = 5000
    grace_period_ms: int = 0
    child_agg: str = "last"
    on_removal: str = "retract"
    drop_window: bool = False
    sum_scale: int | None = None
    order_bounds: tuple[tuple[int, int], tuple[int, int]] | None = None
    broadcast_rows: int = 1_000_000

    def __post_init__(self) -> None:
        if self.emit_period_ms is None or self.grace_period_ms is None:
            raise ValueError("emit_period_ms and grace_period_ms are required")
        if self.emit_period_ms <= 0:
            raise ValueError("emit_period_ms must be positive")
        if self.grace_period_ms < 0:
            raise ValueError("grace_period_ms must not be negative")
        if self.child_agg not in CHILD_AGGREGATES:
            raise ValueError(f"child_agg must be one of {CHILD_AGGREGATES}")
        if self.on_removal not in REMOVAL_MODES:
            raise ValueError(f"on_removal must be one of {REMOVAL_MODES}")
        if self.sum_scale is not None and not 0 <= self.sum_scale <= 9:
            raise ValueError("sum_scale must be between 0 and 9")
        if self.order_bounds is not None:
            (low_ts, high_ts), (low_seq, high_seq) = self.order_bounds
            if low_ts > high_ts or low_seq > high_seq:
                raise ValueError("order_bounds must be (lowest, highest) pairs")
            if self.order_bits() > 63:
                raise ValueError("order_bounds do not fit into a bigint")
        if self.broadcast_rows < 0:
            raise ValueError("broadcast_rows must not be negative")

    def order_bits(self) -> int:
        """Bits that payload time and arrival take within the bounds."""
        return sum((high - low).bit_length() for low, high in self.order_bounds)


def require(**named: object) -> None:
    """Raise ValueError for every argument left at None."""
    missing = sorted(name for name, value in named.items() if value is None)
    if missing:
        raise ValueError(f"missing required arguments: {', '.join(missing)}")
