"""Sums that can be added to and subtracted from without rounding.

A value becomes one or more whole numbers, its parts. Their sums are bigints, so neither the
order of additions nor a value that is taken out again leaves a trace; only the total is
rounded, once, when it is shown.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treewatt.config import RollupConfig
from treewatt.functions.columns import from_summable, summable

# Bits of a part: 2^33 values fit into the bigint that sums them.
_BITS = 30


@dataclass(frozen=True)
class ScaledParts:
    """One part: whole units of 10^-scale; values with more decimals raise."""

    cfg: RollupConfig
    count: int = 1

    def split(self, value: Column) -> list[Column]:
        return [summable(value, self.cfg)]

    def average(self, totals: list[Column], count: Column) -> list[Column]:
        """The average in parts, rounded to the scale."""
        value = from_summable(totals[0], self.cfg) / count
        return [summable(value, self.cfg, averaged=True)]

    def total(self, totals: list[Column]) -> Column:
        """What result_columns takes as the total."""
        return totals[0]


@dataclass(frozen=True)
class BinaryParts:
    """Any doubles between two powers of two: ``count`` parts of 30 bits, the lowest of them in
    units of 2^lowest."""

    lowest: int
    count: int

    def split(self, value: Column) -> list[Column]:
        scales = [2.0 ** (self.lowest + _BITS * i) for i in range(self.count)]
        none = F.array().cast("array<bigint>")
        start = F.struct(value.cast("double").alias("rest"), none.alias("parts"))

        def cut(state: Column, scale: Column) -> Column:
            part = F.when(state["rest"] < 0, F.ceil(state["rest"] / scale)).otherwise(
                F.floor(state["rest"] / scale)
            )
            rest = state["rest"] - part.cast("double") * scale
            parts = F.concat(F.array(part.cast("bigint")), state["parts"])
            return F.struct(rest.alias("rest"), parts.alias("parts"))

        highest_first = F.array(*[F.lit(s) for s in reversed(scales)])
        parts = F.aggregate(highest_first, start, cut, lambda s: s["parts"])
        return [F.get(parts, F.lit(i)) for i in range(self.count)]

    def average(self, totals: list[Column], count: Column) -> list[Column]:
        return self.split(self.total(totals) / count)

    def total(self, totals: list[Column]) -> Column:
        """The double next to the sum: parts are brought to one form first, so equal sums
        give equal doubles."""
        *lower, top = totals
        start = F.struct(
            F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("parts")
        )

        def carried(state: Column, part: Column) -> Column:
            whole = part + state["carry"]
            low = F.pmod(whole, F.lit(1 << _BITS))
            return F.struct(
                F.shiftright(whole, _BITS).alias("carry"),
                F.concat(F.array(low), state["parts"]).alias("parts"),
            )

        *scales, highest = (2.0 ** (self.lowest + _BITS * i) for i in range(self.count))
        none = F.array().cast("array<bigint>")
        form = F.aggregate(F.array(*lower) if lower else none, start, carried)
        low_parts = F.zip_with(
            form["parts"],
            F.array(*map(F.lit, reversed(scales))) if scales else F.array().cast("array<double>"),
            lambda part, scale: part.cast("double") * scale,
        )
        first = (top + form["carry"]).cast("double") * highest
        return F.aggregate(low_parts, first, lambda value, part: value + part)


def parts_for(values: DataFrame, column: str, cfg: RollupConfig) -> ScaledParts | BinaryParts:
    """Parts that hold every value of a column; without a scale that takes one aggregate over
    the powers of two met. A value that is not finite raises."""
    if cfg.sum_scale is not None:
        return ScaledParts(cfg)
    size = F.abs(F.col(column))
    low, high = values.agg(F.min(F.when(size > 0, size)), F.max(size)).first()
    if low is None:
        return BinaryParts(0, 1)
    if not math.isfinite(high):
        raise ValueError("sums need finite values")
    # A double has 53 bits, the lowest power of two is that of the smallest double.
    lowest = max(math.frexp(low)[1] - 53, -1074)
    bits = math.frexp(high)[1] - lowest
    return BinaryParts(lowest, -(-bits // _BITS))
