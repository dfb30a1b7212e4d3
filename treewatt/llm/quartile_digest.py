"""Locality-sensitive digests: hashed byte triplets, coded by quartile of their bucket.

Every three consecutive bytes of a text are hashed to one of ``BUCKETS`` buckets. A digest
holds the length of the text on a logarithmic scale and two bits per bucket: the number of
quartiles of all bucket counts that its own count exceeds. The difference of two digests is
the mean distance of their codes, in units of what unrelated codes would have, and a part
for each doubling of the length; it is bounded by 1. Likeness is 1 minus the difference.

Edge cases: a null text is an empty one; texts under three bytes have only a length; equal
texts have equal digests and the likeness 1; of several rows with one id the order is by
text hash, descending, like the ids; rows without an id come last; the only row of a table
is its own next; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.functions.tables import sized
from treewatt.llm.common import Scratch, let_go_in_worker

BUCKETS = 1024
PART = 1 << 20
UNRELATED = 1.25  # mean distance of two independent quartile codes
DOUBLING, MOST_FOR_LENGTH = 0.1, 0.3
STEPS = 8  # length codes per doubling


def bucket_counts(data: bytes) -> np.ndarray:
    """How many triplets fall in each bucket; long texts go through in parts."""
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data) - 2, PART):
        part = np.frombuffer(data[at : at + PART + 2], np.uint8).astype(np.uint32)
        mixed = part[:-2] * np.uint32(0x9E3779B1)
        mixed += part[1:-1] * np.uint32(0x85EBCA77)
        mixed += part[2:] * np.uint32(0xC2B2AE3D)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        counts += np.bincount(mixed >> np.uint32(22), minlength=BUCKETS)
    return counts


def digest_codes(text: str) -> tuple[int, np.ndarray]:
    """Length code, and the quartile code of each bucket."""
    data = text.encode()
    counts = bucket_counts(data)
    ordered = np.sort(counts)
    quartiles = ordered[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts[:, None] > quartiles).sum(axis=1).astype(np.uint8)
    return round(STEPS * math.log2(len(data) + 1)), codes


def digest_bytes(digest: tuple[int, np.ndarray]) -> bytes:
    """Two bytes of length, and four codes in each further byte."""
    length, codes = digest
    four = codes.reshape(-1, 4)
    packed = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    return length.to_bytes(2, "big") + packed.astype(np.uint8).tobytes()


def digest_string(digest: tuple[int, np.ndarray]) -> str:
    return digest_bytes(digest).hex()


def parse_digest(text: str) -> tuple[int, np.ndarray]:
    data = bytes.fromhex(text)
    packed = np.frombuffer(data[2:], np.uint8)
    codes = np.stack([packed >> 6, packed >> 4 & 3, packed >> 2 & 3, packed & 3], axis=1)
    return int.from_bytes(data[:2], "big"), codes.reshape(-1)


def difference(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """0 for equal digests, at most 1."""
    body = np.abs(a[1].astype(np.int16) - b[1]).sum() / (UNRELATED * len(a[1]))
    length = min(MOST_FOR_LENGTH, DOUBLING * abs(a[0] - b[0]) / STEPS)
    return float(min(1.0, body + length))


def edited_text(text: str, following: str) -> str:
    """The last third replaced by the beginning of the text that follows."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _compared(text: str, own, following: str, next_own) -> tuple:
    edited = edited_text(text, following)
    other = digest_codes(edited)
    return (
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        digest_bytes(own),
        digest_bytes(other),
        1.0 - difference(own, other),
        1.0 - difference(own, next_own),
    )


COMPARED = {
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.binary(),
    "edited_fingerprint": pa.binary(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}
SCHEMA = (
    "n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
KINDS = {"doc_id": pa.int64(), **COMPARED}
EDGE_KINDS = {**KINDS, "kind": pa.string(), "part": pa.int32(), "body": pa.string()}


def _batch(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with the row after them; its first and last row as they are."""
    let_go_in_worker()
    part, nothing = TaskContext.get().partitionId(), (None,) * len(COMPARED)
    held = None
    for batch in batches:
        rows = []
        for key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or ""
            own = digest_codes(text)
            if held is None:
                rows.append((key, *nothing, "head", part, text))
            else:
                rows.append((held[0], *_compared(held[1], held[2], text, own), "done", part, None))
            held = (key, text, own)
        yield _batch(rows, EDGE_KINDS)
    if held is not None:
        yield _batch([(held[0], *nothing, "tail", part, held[1])], EDGE_KINDS)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, text, following in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = digest_codes(text)
            rows.append((key, *_compared(text, own, following, digest_codes(following))))
        yield _batch(rows, KINDS)


def compared_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's digest, its edited text's digest, and their likeness, also to the next row.

    Next is the row with the next smaller id, over the whole table; after the last comes
    the first. The table is sorted once over ranges of ids and each range is streamed. The
    last row of a range needs the first of the following one: these rows, two per range,
    are joined afterwards.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "digest")
    order = [F.desc("doc_id"), F.desc("text_hash")]
    ranges = (
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.col(text_col).alias("body"),
            F.xxhash64(F.col(text_col)).alias("text_hash"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "body")
    )
    schema = f"doc_id bigint, {SCHEMA}, kind string, part int, body string"
    seen = scratch.write(ranges.mapInArrow(_neighbours, schema), "ranges")
    heads, tails = seen.where("kind = 'head'"), seen.where("kind = 'tail'")
    parts = sorted(r.part for r in heads.select("part").collect())
    following = list(zip(parts, parts[1:] + parts[:1], strict=True))
    links = spark.createDataFrame(following, "part int, following int")
    edges = (
        tails.join(sized(links, len(parts), 100_000), "part")
        .join(
            heads.select(F.col("part").alias("following"), F.col("body").alias("next_body")),
            "following",
        )
        .select("doc_id", "body", "next_body")
    )
    done = seen.where("kind = 'done'").drop("kind", "part", "body")
    both = done.unionByName(edges.mapInArrow(_pairs, f"doc_id bigint, {SCHEMA}"))
    names = ("fingerprint", "edited_fingerprint")
    return both.withColumns({name: F.lower(F.hex(name)) for name in names})


def op8_quartile_digest(spark, sf_dir: str) -> DataFrame:
    return compared_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
