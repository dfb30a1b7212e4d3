"""Periodic runs of words, found by recompression.

The words of some texts, each text between marks that occur once, are one string of numbers.
Block compression replaces every maximal block of an equal symbol by one symbol, pair
compression splits the alphabet in two and replaces every pair of a left symbol and a right
one; they alternate until one symbol is left. The levels are a run-length grammar in which
equal stretches are cut alike but for one symbol or block at their ends, so the longest common
extension of two places is found by going up the levels as long as both stand at the start of
a symbol, past one symbol or block where they do not, and down again from the first difference.

A run of period p and at least two periods covers a place g that p divides, together with
g + p. For every p these grid places are the candidates; those whose next few words differ are
left out by a rolling hash, the others are extended to both sides, exactly, by the grammar of
the string or of its mirror image. Of equal stretches the smallest period counts.

Edge cases: null and empty texts, and texts of white space, have no word and no run; a text of
any length is one row and is searched whole; null and repeated ids have a row each; an empty
table gives an empty result; ``keep`` names the columns that are carried along, others are
ignored, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 24
MIN_EXPONENT = 3
BLOCK_WORDS = 1 << 16  # words of short texts that are searched as one string
CANDIDATES = 1 << 18  # pairs of places that are extended at once
TRIES = 4  # splits of the alphabet of which a round takes the best
WHITE = "[\\x20\\x09-\\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _scrambled(numbers: np.ndarray, seed: int) -> np.ndarray:
    x = numbers.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


class Step:
    """How the symbols of one level make up those of the next.

    first[s] is the place in the lower level where symbol s of the next one starts, with one
    more entry for the end; parent[c] is the symbol that place c belongs to.
    """

    def __init__(self, block: bool, starts: np.ndarray, length: int):
        self.block = block
        self.first = np.append(starts, length)
        self.parent = np.repeat(np.arange(len(starts)), np.diff(self.first))

    def mirrored(self) -> Step:
        length = int(self.first[-1])
        return Step(self.block, length - self.first[:0:-1], length)


class Grammar:
    """Levels of a string whose first and last symbols occur once."""

    def __init__(self, levels: list[np.ndarray], steps: list[Step]):
        self.levels, self.steps = levels, steps

    @classmethod
    def of(cls, symbols: np.ndarray) -> Grammar:
        levels, steps, seed = [symbols], [], 0
        while len(levels[-1]) > 1:
            now = levels[-1]
            new = np.concatenate(([True], now[1:] != now[:-1]))
            if not new.all():
                starts = np.flatnonzero(new)
                sizes = np.diff(np.append(starts, len(now)))
                keys = now[starts] * (sizes.max() + 1) + sizes
                levels.append(np.unique(keys, return_inverse=True)[1])
                steps.append(Step(True, starts, len(now)))
                continue
            best = None
            for _ in range(TRIES):
                bits = (_scrambled(now, seed) & np.uint64(1)).astype(bool)
                seed += 1
                for left in (bits, ~bits):
                    pairs = left[:-1] & ~left[1:]
                    if best is None or pairs.sum() > best.sum():
                        best = pairs
            if not best.any():
                continue
            starts = np.flatnonzero(np.concatenate(([True], ~best)))
            second = np.where(
                np.append(best, False)[starts], now[np.minimum(starts + 1, len(now) - 1)] + 1, 0
            )
            keys = now[starts] * (int(now.max()) + 2) + second
            levels.append(np.unique(keys, return_inverse=True)[1])
            steps.append(Step(False, starts, len(now)))
        return cls(levels, steps)

    def mirrored(self) -> Grammar:
        return Grammar([level[::-1] for level in self.levels], [s.mirrored() for s in self.steps])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest equal stretches that start at places i and j, i != j."""
        a, b = i.copy(), j.copy()
        stop = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        for height, step in enumerate(self.steps):
            level, x, y = self.levels[height], a[live], b[live]
            equal = level[x] == level[y]
            stop[live] = height
            live, x, y = live[equal], x[equal], y[equal]
            if not len(live):
                break
            px, py = step.parent[x], step.parent[y]
            inside = (step.first[px] != x) | (step.first[py] != y)
            if step.block:
                rest_x, rest_y = step.first[px + 1] - x, step.first[py + 1] - y
                move = np.where(inside, np.minimum(rest_x, rest_y), 0)
                differ = inside & (rest_x != rest_y)
            else:
                move, differ = inside.astype(np.int64), np.zeros(len(live), bool)
            a[live], b[live] = x + move, y + move
            live = live[~differ]
            a[live], b[live] = step.parent[a[live]], step.parent[b[live]]
            stop[live] = height + 1
        for height in range(int(stop.max(initial=0)), 0, -1):
            step, level = self.steps[height - 1], self.levels[height - 1]
            at = np.flatnonzero(stop >= height)
            sx, sy = a[at], b[at]
            x, y = step.first[sx], step.first[sy]
            move = (level[x] == level[y]).astype(np.int64)
            if step.block:
                move *= np.minimum(step.first[sx + 1] - x, step.first[sy + 1] - y)
            a[at], b[at] = x + move, y + move
        return a - i


def _width(min_length: int, min_exponent: int) -> int:
    """Words, a power of two, that agree at some grid place and its successor in any run."""
    sure = min(
        max(min_length, min_exponent * p) - 2 * p + 1 for p in range(1, max(min_length, 1) + 1)
    )
    return 1 << max(0, sure.bit_length() - 1)


def _rolled(symbols: np.ndarray, width: int) -> np.ndarray:
    """A hash of each stretch of so many symbols."""
    code, size = _scrambled(symbols, 0), 1
    while size < width:
        code = _scrambled(code[:-size] * np.uint64(0xD6E8FEB86659FD93) + code[size:], size)
        size *= 2
    return code


def runs_of(
    texts: list[np.ndarray], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> list[np.ndarray]:
    """(start, length, period) rows of each text of word numbers, by start and period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes + 1) - sizes
    longest = int(sizes.max(initial=0))
    words = 1 + max((int(t.max()) for t in texts if len(t)), default=0)
    marks = words + np.arange(len(texts) + 1)
    parts = [p for mark, text in zip(marks, texts, strict=False) for p in ([mark], text)]
    string = np.concatenate([*parts, marks[-1:]]).astype(np.int64)
    width = _width(min_length, min_exponent)
    if len(string) <= width or longest < min_length:
        return [np.empty((0, 3), np.int64) for _ in texts]
    code = _rolled(string, width)
    grammar = mirror = None
    found = np.empty((0, 3), np.int64)
    held: list[np.ndarray] = []
    waiting = 0
    last = longest // min_exponent
    for period in range(1, last + 1):
        left, right = code[:-period:period], code[period::period]
        grid = np.flatnonzero(left == right) * period
        if len(grid):
            held.append(np.column_stack((grid, np.full(len(grid), period))))
            waiting += len(grid)
        if held and (waiting >= CANDIDATES or period == last):
            grammar = grammar or Grammar.of(string)
            mirror = mirror or grammar.mirrored()
            pairs = np.concatenate(held)
            held, waiting = [], 0
            for at in range(0, len(pairs), CANDIDATES):
                i, p = pairs[at : at + CANDIDATES].T
                right_end = i + p + grammar.common(i, i + p)
                start = i - mirror.common(len(string) - i, len(string) - i - p)
                length = right_end - start
                enough = (length >= min_length) & (length >= min_exponent * p)
                new = np.column_stack((start, length, p))[enough]
                if len(new):
                    found = _smallest_periods(np.concatenate((found, new)))
    owner = np.searchsorted(begins, found[:, 0], side="right") - 1
    found[:, 0] -= begins[owner] if len(found) else 0
    cuts = np.searchsorted(owner, np.arange(1, len(texts)))
    return np.split(found, cuts)


def _smallest_periods(runs: np.ndarray) -> np.ndarray:
    """Of rows of equal start and length that of the smallest period, by start and period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    again = (runs[1:, 0] == runs[:-1, 0]) & (runs[1:, 1] == runs[:-1, 1])
    runs = runs[np.concatenate(([True], ~again))]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _kept(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that lie in no run beyond its first period."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    stays = np.cumsum(change)[:-1] == 0
    return b" ".join([words[i] for i in np.flatnonzero(stays)])


def _searched(
    texts: list[list[bytes]], min_length: int, min_exponent: int
) -> list[np.ndarray]:
    numbers = defaultdict(count().__next__)
    coded = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in texts]
    return runs_of(coded, min_length, min_exponent)


def periodic_runs(
    docs: DataFrame,
    keep: list[str],
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """(keep, runs, collapsed) per row of docs: a struct of the columns named, all runs of at
    least so many words and periods by start and period, and the words that no run repeats,
    joined by one space."""
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run has at least two periods and one word")

    def made(part: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = _searched(texts, min_length, min_exponent)
        rows = np.concatenate(runs)
        ends = np.cumsum([0, *map(len, runs)])
        fields = [pa.array(np.ascontiguousarray(column)) for column in rows.T]
        structs = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
        kept = pa.array([_kept(w, r) for w, r in zip(texts, runs, strict=True)], pa.binary())
        arrays = [part, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs), kept]
        return pa.RecordBatch.from_arrays(arrays, ["keep", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, size, texts = 0, 0, []
            for row in range(batch.num_rows):
                texts.append((batch.column(1)[row].as_py() or b"").split())
                size += len(texts[-1])
                if size >= BLOCK_WORDS or row == batch.num_rows - 1:
                    yield made(batch.column(0).slice(begin, len(texts)), texts)
                    begin, size, texts = row + 1, 0, []

    rows = docs.select(
        F.struct(*keep).alias("keep"), F.col(text_col).cast("binary").alias("body")
    )
    kind = rows.schema["keep"].dataType.simpleString()
    found = rows.mapInArrow(run, f"keep {kind}, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def longest_by_period(runs: Column) -> Column:
    """The run of the greatest exact length / period; of equal ones the first."""
    return F.aggregate(
        runs,
        F.try_element_at(runs, F.lit(1)),
        lambda best, r: F.when(r.length * best.period > best.length * r.period, r).otherwise(best),
    )


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): in each tenth document by hash of the id the words from some place on
    repeat the first of them; the other texts, and those without an id, stay as they are."""
    split = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.crc32(F.col(id_col).cast("string").cast("binary")).alias("h"),
    ).withColumn(
        "words",
        F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", WHITE), "")).otherwise(
            F.array().cast("array<string>")
        ),
    )
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    unit = F.slice("words", a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")
    return split.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = periodic_runs(with_planted_runs(docs), ["doc_id"]).withColumn(
        "best", longest_by_period(F.col("runs"))
    )
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    )
    digest = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        F.col("keep.doc_id").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(digest, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
