"""Near duplicates by SimHash fingerprints, linked with multi-index hashing.

A bit of a fingerprint is 1 if it is set in over half the XXH64 hashes (UTF-8, seed 42) of a
text's word shingles, repeats included. Two fingerprints are linked if they differ in at most
``max_distance`` of their 64 bits.

The bits are cut into segments, and each fingerprint has a table entry for every value within
one bit of a segment's value. Two fingerprints whose segments differ in at most two bits meet
at a value between them, so all pairs are found whose distance is below three times the
segments; two segments are exact for the distance 4. Complete distances are then compared.

The members of an entry are not paired with each other. Each is compared with the entry's
smallest fingerprint, and components are formed. Where members lie outside the component of
that one, the smallest of those is compared with all members in turn, in rounds, as long as a
round leaves half of them at most. The members left then, which mostly have no link, are
compared with those of the entry's other components that agree with them in one of
``max_distance + 1`` pieces of the bits outside the segment, as any linked pair does.

Edge cases: a null or empty text, or one of white space, has the fingerprint zero, which is
linked like any other; a text of fewer words than a shingle is one shingle; equal texts, and
other texts of equal fingerprints, are one node whose copies are never compared; ids may be
any numbers; rows without an id are linked too, and their component has a null id if none of
it has one; a repeated id has a row per occurrence; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treewatt.functions.tables import setting, sized
from treewatt.llm.common import Scratch, let_go_in_worker
from treewatt.llm.components import components

SEED = 42
HASH_BLOCK = 1 << 14
BATCH_ROWS = "1000"  # texts that travel to a worker at once
BROADCAST_ROWS = 1_000_000  # table entries of two numbers each


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """XXH64 of every shingle; a shorter text is one shingle, no word gives none."""
    tokens = (text or b"").lower().split()
    n = len(tokens)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(words, n)
    lengths = np.fromiter(map(len, tokens), np.int64, n)
    ends = np.cumsum(lengths) + np.arange(n)
    begins = (ends - lengths)[: n - k + 1].tolist()
    joined, digest = memoryview(b" ".join(tokens)), xxhash.xxh64_intdigest
    spans = zip(begins, ends[k - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[b:e], SEED) for b, e in spans), np.uint64, n - k + 1)


def fingerprint(text: bytes | None, words: int) -> int:
    """The fingerprint of a text as an unsigned number."""
    hashes = shingle_hashes(text, words).astype("<u8", copy=False)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASH_BLOCK):
        block = hashes[at : at + HASH_BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, text_hash, print) per row; print has the 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go_in_worker()
        for batch in batches:
            bits = [fingerprint(text.as_py(), words) for text in batch.column(2)]
            signed = pa.array(np.array(bits, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), signed], ["id", "text_hash", "print"]
            )

    return docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.col(text_col).cast("binary").alias("body"),
    ).mapInArrow(run, "id bigint, text_hash bigint, print bigint")


def _bits(low: int, high: int) -> Column:
    return F.shiftrightunsigned("print", low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def _ball(number: int, low: int, high: int) -> Column:
    """The segment's value and those one bit away, each with the segment's number."""
    flips = F.array(*[F.lit(f).cast("bigint") for f in (0, *(1 << i for i in range(high - low)))])
    return F.transform(flips, lambda flip: F.lit(number << 48) + _bits(low, high).bitwiseXOR(flip))


def _entries_of(segments: int) -> Column:
    """The table entries of a print."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return F.flatten(F.array(*[_ball(n, cuts[n], cuts[n + 1]) for n in range(segments)]))


def _pieces(segments: int, number_of: int) -> Column:
    """The bits outside the segment of key, in so many pieces, each with its number."""
    out = F.lit(None)
    for number in range(segments):
        low, high = 64 * number // segments, 64 * (number + 1) // segments
        width = 64 - (high - low)
        above = F.shiftrightunsigned("print", high) if high < 64 else F.lit(0).cast("bigint")
        below = F.col("print").bitwiseAND(F.lit((1 << low) - 1))
        others = F.shiftleft(above, low).bitwiseOR(below)
        cuts = [width * i // number_of for i in range(number_of + 1)]
        pieces = F.array(
            *[
                F.struct(
                    F.lit(n).alias("piece"),
                    F.shiftrightunsigned(others, start)
                    .bitwiseAND(F.lit((1 << (end - start)) - 1))
                    .alias("bits"),
                )
                for n, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False))
            ]
        )
        out = F.when(F.shiftright("key", 48) == number, pieces).otherwise(out)
    return F.inline(out)


def linked_components(
    nodes: DataFrame, segments: int, max_distance: int, scratch: Scratch
) -> DataFrame:
    """(node, root) over the distinct fingerprints (print); lone ones are left out."""
    if not 2 <= segments <= 64 or 3 * segments <= max_distance:
        raise ValueError("distances must stay below three times the segments, 2 to 64")
    ball = nodes.select("print", F.explode(_entries_of(segments)).alias("key"))
    entries = scratch.write(
        ball.groupBy("key")
        .agg(F.min("print").alias("rep"), F.count(F.lit(1)).alias("members"))
        .where("members > 1")
        .select("key", "rep"),
        "entries",
    )
    rows = entries.count()

    def near(left: str, right: str) -> Column:
        return F.bit_count(F.col(left).bitwiseXOR(F.col(right))) <= max_distance

    links = scratch.write(
        ball.join(sized(entries, rows, BROADCAST_ROWS), "key")
        .where((F.col("print") != F.col("rep")) & near("print", "rep"))
        .select(F.col("print").alias("u"), F.col("rep").alias("v"))
        .distinct(),
        "links-0",
    )
    left = None
    for turn in count():
        found = scratch.write(components(links, scratch, f"turn-{turn}"), f"parts-{turn}")
        placed = nodes.join(found, F.col("print") == F.col("node"), "left").select(
            "print", F.coalesce("root", "print").alias("part")
        )
        known = entries.join(
            placed.select(F.col("print").alias("rep"), F.col("part").alias("rep_part")), "rep"
        ).select("key", "rep_part")
        ball = placed.select("print", "part", F.explode(_entries_of(segments)).alias("key"))
        rest = scratch.write(
            ball.join(sized(known, rows, BROADCAST_ROWS), "key")
            .where("part != rep_part")
            .select("key", "print", "part"),
            f"rest-{turn}",
        )
        before, left = left, rest.count()
        if not left:
            return found
        again = scratch.write(
            rest.groupBy("key").agg(F.min("print").alias("one")), f"again-{turn}"
        )
        members = scratch.write(
            ball.join(sized(again, left, BROADCAST_ROWS), "key"), f"members-{turn}"
        )
        if before is not None and 2 * left > before:
            break
        new = (
            members.where((F.col("print") != F.col("one")) & near("print", "one"))
            .select(F.col("print").alias("u"), F.col("one").alias("v"))
            .distinct()
        )
        links = scratch.write(links.unionByName(new), f"links-{turn + 1}")
        scratch.drop(f"members-{turn}")
    pieces = _pieces(segments, max_distance + 1)
    others = members.select("key", "print", "part", pieces)
    met = rest.select("key", "print", "part", pieces).select(
        "key", "piece", "bits", F.col("print").alias("one"), F.col("part").alias("one_part")
    )
    across = scratch.write(
        met.join(others, ["key", "piece", "bits"])
        .where((F.col("part") != F.col("one_part")) & near("print", "one"))
        .select(F.greatest("part", "one_part").alias("u"), F.least("part", "one_part").alias("v"))
        .distinct(),
        "across",
    )
    if across.isEmpty():
        return found
    return components(links.unionByName(across), scratch, "last")


def _classes(marked: DataFrame, segments: int, max_distance: int, scratch: Scratch) -> DataFrame:
    """(print, root, least) of each distinct print: its component and the smallest id of it."""
    nodes = scratch.write(marked.groupBy("print").agg(F.min("id").alias("least")), "nodes")
    found = linked_components(nodes.select("print"), segments, max_distance, scratch)
    return scratch.write(
        nodes.join(found, F.col("print") == F.col("node"), "left").select(
            "print", F.coalesce("root", "print").alias("root"), "least"
        ),
        "classes",
    )


def _marked(docs: DataFrame, id_col: str, text_col: str, words: int, scratch: Scratch) -> DataFrame:
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS):
        return scratch.write(fingerprints(docs, id_col, text_col, words), "marked")


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    segments: int = 2,
    max_distance: int = 4,
) -> DataFrame:
    """(id, text_hash, print, component) per row of docs.

    component is the smallest id that links lead to. Equal fingerprints are one node of an
    aggregate, so thousands of copies cost as much as one.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = _marked(docs, id_col, text_col, words, scratch)
    classes = _classes(marked, segments, max_distance, scratch)
    smallest = classes.groupBy("root").agg(F.min("least").alias("component"))
    named = classes.join(smallest, "root").select("print", "component")
    return marked.join(named, "print")


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    segments: int = 2,
    max_distance: int = 4,
) -> DataFrame:
    """docs with all its columns, and of each component only the row of the smallest id.

    Of several rows with the smallest id the one with the smaller text hash stays, and one
    of wholly equal id and text. Rows without an id come after all others.
    """
    scratch = Scratch(docs.sparkSession, "dedup")
    marked = _marked(docs, id_col, text_col, words, scratch)
    classes = _classes(marked, segments, max_distance, scratch).select("print", "root")
    rows = scratch.write(
        marked.groupBy("id", "text_hash", "print").agg(F.count(F.lit(1)).alias("copies")).join(
            classes, "print"
        ),
        "rows",
    )
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash")
    first = (
        rows.groupBy("root")
        .agg(F.min(place).alias("best"), F.sum("copies").alias("size"))
        .where("size > 1")
        .select("root", "best")
    )
    marks = scratch.write(
        rows.join(first, "root").select(
            F.col("id").isNull().alias("_unnamed"),
            F.coalesce("id", F.lit(0)).alias("_id"),
            F.col("text_hash").alias("_hash"),
            place.eqNullSafe(F.col("best")).alias("_stays"),
            (F.col("copies") > 1).alias("_repeated"),
        ),
        "marks",
    )
    key = ["_unnamed", "_id", "_hash"]
    number = F.col(f"_row.{id_col}").cast("bigint")
    keyed = docs.select(F.struct("*").alias("_row")).select(
        "_row",
        number.isNull().alias("_unnamed"),
        F.coalesce(number, F.lit(0)).alias("_id"),
        F.xxhash64(F.col(f"_row.{text_col}")).alias("_hash"),
    )
    found = marks.count()
    gone = marks.where("_repeated or not _stays").select(key)
    kept = keyed.join(sized(gone, found, BROADCAST_ROWS), key, "left_anti").select("_row.*")
    once = marks.where("_repeated and _stays").select(key)
    for name in ("marked", "nodes", "classes", "rows"):
        scratch.drop(name)
    if once.isEmpty():
        return kept
    again = keyed.join(sized(once, found, BROADCAST_ROWS), key, "left_semi").dropDuplicates(key)
    return kept.unionByName(again.select("_row.*"))


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_components(docs).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
