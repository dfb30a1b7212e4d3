"""Running aggregates over one unbounded ordered group, without a hot task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treewatt.functions.tables import sized, write_table

# Hashes of keys are counted by so many numbers.
_BUCKETS = 1 << 13
# Totals of chunks are broadcast up to so many rows.
_CARRIED_ROWS = 100_000


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``kind`` (sum, max or min) of ``column`` so far.

    ``before`` leaves the current row out.
    """

    name: str
    kind: str
    column: str
    before: bool = False


@dataclass(frozen=True)
class HotBucket:
    """Keys whose hash has this number are cut into chunks of 2^bits consecutive numbers."""

    number: int
    bits: int


_AGGREGATE = {"sum": F.sum, "max": F.max, "min": F.min}


def _combine(kind: str, left: Column, right: Column) -> Column:
    if kind == "sum":
        return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(left + right)
    # greatest/least skip nulls; structs are not accepted there, so compare.
    pick_left = left >= right if kind == "max" else left <= right
    return F.when(left.isNull(), right).when(right.isNull(), left).when(pick_left, left).otherwise(right)


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    wanted: Sequence[Running],
    chunk_bits: Sequence[int] = (18,),
    hot: list[HotBucket] | None = None,
) -> DataFrame:
    """Add running aggregates along ``order`` within ``keys``.

    ``order`` is a bigint that is unique within ``keys``. Keys of at most 2^bits rows are one
    window each. A larger key is cut into chunks of consecutive numbers, as wide as its numbers
    are dense, and never narrower than 2^bits numbers, so that a chunk has at most 2^bits rows;
    each chunk is scanned by itself and then raised by what came before it. The chunk totals
    are scanned the same way, with the remaining entries of ``chunk_bits``.

    ``df`` is read twice, the first time now: hand in a scan or a written table, not a long
    plan. ``hot`` is what ``hot_buckets`` has found for the same keys, or for fewer of them and
    nothing found; then it is not read now.

    Rows with a null among their keys see what lies in the same 2^bits numbers, no further.
    """
    if not keys:
        return _running(df, keys, order, wanted, chunk_bits, hot)
    apart = f"_apart_of_{order}"
    unknown = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    parted = df.withColumn(apart, F.when(unknown, F.shiftright(F.col(order), chunk_bits[0])))
    return _running(parted, [*keys, apart], order, wanted, chunk_bits, hot).drop(apart)


def _running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    wanted: Sequence[Running],
    chunk_bits: Sequence[int],
    hot: list[HotBucket] | None,
) -> DataFrame:
    if hot is None:
        hot = hot_buckets(df, keys, order, chunk_bits[0])
    if not hot:
        return _scanned(df, keys, order, wanted)

    chunk, bits = f"_chunk_of_{order}", f"_bits_of_{order}"
    cut = _with_chunks(df, keys, order, hot, chunk, bits)
    totals_of = {(r.kind, r.column): f"_total_{i}_of_{order}" for i, r in enumerate(wanted)}
    totals = write_table(
        cut.where(F.col(bits).isNotNull())
        .groupBy(*keys, chunk)
        .agg(*[_AGGREGATE[kind](column).alias(total) for (kind, column), total in totals_of.items()]),
        "totals",
    )
    prefix = [
        Running(f"_before{total}", kind, total, before=True)
        for (kind, _), total in totals_of.items()
    ]
    names = {c: f"_key_{i}_of_{order}" for i, c in enumerate([*keys, chunk])}
    rest = chunk_bits[1:] or chunk_bits
    carried = _running(totals, keys, chunk, prefix, rest, None).select(
        *[F.col(c).alias(n) for c, n in names.items()], *[r.name for r in prefix]
    )
    carried = write_table(carried, "before")
    inside = _scanned(cut, [*keys, chunk], order, wanted)
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    # The chunk of cold keys has no totals; a chunk without a number has nothing before it.
    here = F.col(bits).isNotNull() & F.col(chunk).isNotNull()
    condition = reduce(Column.__and__, same, here)
    joined = inside.join(sized(carried, carried.count(), _CARRIED_ROWS), condition, "left")
    combined = [
        _combine(
            r.kind, F.col(f"_before{totals_of[r.kind, r.column]}"), F.col(r.name)
        ).alias(r.name)
        for r in wanted
    ]
    return joined.select(*df.columns, *combined)


def _scanned(
    df: DataFrame, keys: Sequence[str], order: str, wanted: Sequence[Running]
) -> DataFrame:
    so_far = Window.partitionBy(*keys).orderBy(order)
    columns = []
    for r in wanted:
        frame = so_far.rowsBetween(Window.unboundedPreceding, -1 if r.before else 0)
        columns.append(_AGGREGATE[r.kind](r.column).over(frame).alias(r.name))
    return df.select("*", *columns)


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS)).cast("int") if keys else F.lit(0)


def hot_buckets(
    df: DataFrame, keys: Sequence[str], order: str, bits: int = 18
) -> list[HotBucket]:
    """Where keys of more than 2^bits rows are, and how wide their chunks may be.

    Rows are counted by the hash of their keys, which one partial aggregate does; a bucket with
    more rows than a key may have is taken to have such keys. There are fewer of them than rows
    divided by 2^bits, and at most _BUCKETS.
    """
    limit = 1 << bits
    bucket = _bucket(keys).alias("_bucket")
    counted = df.groupBy(bucket).agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("low"), F.max(order).alias("high")
    )
    hot = {}
    for r in counted.where(F.col("n") > limit).collect():
        span = 0 if r.low is None else r.high - r.low + 1
        hot[r["_bucket"]] = max(bits, (span * limit // (2 * r.n)).bit_length() - 1)
    wide = {number for number, b in hot.items() if b > bits}
    while wide:  # numbers may be denser in places: chunks with too many rows there are halved
        asked = [HotBucket(number, hot[number]) for number in wide]
        cut = _with_chunks(df, keys, order, asked, "_chunk", "_bits").where("_bits IS NOT NULL")
        full = (
            cut.groupBy(bucket, "_chunk")
            .count()
            .where(F.col("count") > limit)
            .groupBy("_bucket")
            .agg(F.max("count").alias("n"))
        )
        worst = {r["_bucket"]: r.n for r in full.collect()}
        for number, n in worst.items():
            hot[number] = max(bits, hot[number] - (n // limit).bit_length())
        wide = {number for number in worst if hot[number] > bits}
    return [HotBucket(number, b) for number, b in sorted(hot.items())]


def _with_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    hot: Sequence[HotBucket],
    chunk: str,
    bits: str,
) -> DataFrame:
    """Adds the width of the chunks of a row's bucket, null if it is not hot, and its chunk."""
    if not keys:
        widths = df.withColumn(bits, F.lit(hot[0].bits))
    else:
        number = f"_bucket{bits}"
        rows = df.sparkSession.createDataFrame(
            [(h.number, h.bits) for h in hot], f"{number} int, {bits} int"
        )
        widths = df.join(F.broadcast(rows), _bucket(keys) == F.col(number), "left").drop(number)
    cut = F.call_function("shiftright", F.col(order), F.col(bits))
    return widths.withColumn(
        chunk, F.when(F.col(bits).isNotNull(), cut).otherwise(F.lit(0).cast("bigint"))
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], name: str
) -> DataFrame:
    """Add struct ``name`` with ``columns`` of the row before, null on the first row.

    Like ``lag`` over a window per key, but split into chunks as ``with_running`` is.
    """
    row = F.struct(order, *columns)
    return with_running(
        df.withColumn("_row", row), keys, order, [Running(name, "max", "_row", before=True)]
    ).drop("_row")


def with_next(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], name: str
) -> DataFrame:
    """Add struct ``name`` with ``columns`` of the row after, null on the last row."""
    backwards = f"_back_{order}"
    row = F.struct(order, *columns)
    return with_running(
        df.withColumn("_row", row).withColumn(backwards, -F.col(order)),
        keys,
        backwards,
        [Running(name, "min", "_row", before=True)],
    ).drop("_row", backwards)
