"""Benchmark passages in documents, found with Wu-Manber shift tables over words.

Texts become words: A-Z lower-cased, then maximal runs of digits, letters a-z and
characters beyond ASCII. Every run of ``window`` consecutive words of a benchmark item is a
test string; an item with fewer words, but not none, is one. Words are the symbols. For the
test strings of one length a shift table tells, for each pair of words, how far a scan may
jump when it meets the pair; pairs in no test string jump furthest. A pair that ends test
strings selects them by their first word, and words are compared one by one.

Test strings are built inside the tasks from blocks of the benchmark of a bounded size, one
pass over the documents for each block, so a benchmark of any size is covered.

Edge cases: null or empty texts have no words, no hits and no items, on either side; items
of equal text all count; an item id that occurs twice counts once; a null item id counts as
an empty string; repeated or null document ids give a row each; empty tables give an empty
result, or documents without hits; of extra columns none is touched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.llm.common import Scratch, kept_with_text, let_go_in_worker

WINDOW = 10
BLOCK_BYTES = 4 << 20
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 bytes; every byte of a character beyond ASCII is at least 0x80."""
    return WORDS.findall((text or b"").lower())


class TestStrings:
    """Shift and suffix tables of the test strings of one length."""

    __test__ = False

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.furthest = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.ending: dict[tuple, dict[bytes, dict[tuple, set[str]]]] = {}

    def add(self, words: tuple, item: str) -> None:
        last = self.length - self.block
        for at in range(last + 1):
            pair = words[at : at + self.block]
            self.shift[pair] = min(self.shift.get(pair, self.furthest), last - at)
        by_first = self.ending.setdefault(words[last:], {})
        by_first.setdefault(words[0], {}).setdefault(words, set()).add(item)

    def scan(self, words: list[bytes], hit: bytearray, items: set[str]) -> None:
        """Mark the words inside any occurrence, and collect the items that occur."""
        length, block, shift, furthest = self.length, self.block, self.shift, self.furthest
        end, n = length, len(words)
        while end <= n:
            pair = tuple(words[end - block : end])
            jump = shift.get(pair, furthest)
            if jump:
                end += jump
                continue
            first = words[end - length]
            for string, owners in self.ending[pair].get(first, {}).items():
                if string == tuple(words[end - length : end]):
                    hit[end - length : end] = b"\1" * length
                    items |= owners
            end += 1


def test_strings(items: list[tuple[str, bytes | None]], window: int) -> list[TestStrings]:
    tables: dict[int, TestStrings] = {}
    for item, text in items:
        words = tuple(words_of(text))
        if not words:
            continue
        length = min(window, len(words))
        table = tables.setdefault(length, TestStrings(length))
        for at in range(len(words) - length + 1):
            table.add(words[at : at + length], item)
    return list(tables.values())


test_strings.__test__ = False


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark without repeats, cut by hash into parts of about block_bytes."""
    rows = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
        F.col(text_col).cast("binary").alias("body"),
    ).distinct()
    total = rows.agg(F.sum(F.octet_length("body") + F.octet_length("item"))).first()[0] or 0
    parts = -(-total // block_bytes) or 1
    part = F.pmod(F.xxhash64("item", "body"), F.lit(parts))
    return [rows.where(part == i) for i in range(parts)] if parts > 1 else [rows]


def _scan_block(items: list[tuple[str, bytes | None]], window: int, texts_of):
    """Adds to hits the word numbers hit and to items the items found, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go_in_worker()
        tables = test_strings(items, window)
        for batch in batches:
            counts, hits, found = [], [], []
            for text, old, had in zip(
                texts_of(batch), *(batch.column(c) for c in ("hits", "items")), strict=True
            ):
                words = words_of((text.as_py() or "").encode())
                marks, ids = bytearray(len(words)), set(had.as_py() or ())
                for number in old.as_py() or ():
                    marks[number] = 1
                for table in tables:
                    table.scan(words, marks, ids)
                counts.append(len(words))
                hits.append([i for i, mark in enumerate(marks) if mark] if any(marks) else [])
                found.append(sorted(ids))
            columns = batch.columns[:-3] + [
                pa.array(counts, pa.int64()),
                pa.array(hits, pa.list_(pa.int32())),
                pa.array(found, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(keep, n_words, hits, items) per row of docs.

    keep is a struct of the columns named; hits are the numbers of the words inside test
    strings, items the ids of the items that occur, both ascending.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    kept, texts_of = kept_with_text(docs, keep, text_col)
    state = kept.select(
        "*",
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<int>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    for number, block in enumerate(blocks):
        if number:
            state = scratch.write(state, f"pass-{number}")
            if number > 1:
                scratch.drop(f"pass-{number - 1}")
        items = [(r.item, None if r.body is None else bytes(r.body)) for r in block.collect()]
        state = state.mapInArrow(_scan_block(items, window, texts_of), state.schema)
    return state.drop("body")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs with all their columns, without the rows that hold a benchmark passage."""
    found = benchmark_hits(docs, benchmark, ["*"], **options)
    return found.where(F.size("hits") == 0).select("keep.*")


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = benchmark_hits(docs, benchmark, ["doc_id"])
    return found.select(
        F.col("keep.doc_id").alias("doc_id"),
        "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


ORACLE_SQL = {
    "op9_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
s AS (
  SELECT DISTINCT item, least(10, len(w)) AS size,
         array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS words
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
p AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM s))),
m AS (SELECT doc_id, item, i, p.size FROM p JOIN s ON p.size = s.size AND p.words = s.words),
h AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM m) GROUP BY doc_id),
n AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""
}
