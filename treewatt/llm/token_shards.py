"""Token ids of documents in binary shards, with keyed access through a perfect hash.

Documents are put in ascending order of their id over all partitions. Each task writes its
range as shards: ``<shard>.ids`` holds nothing but the ids, little-endian, in two bytes if
the vocabulary allows it and else in four; ``<shard>.idx`` holds a minimal perfect hash of
the document keys with their fingerprints, for each slot the first document and the number
of documents of that key, and the offset of every document. A lookup hashes the key, checks
the fingerprint, and reads one range of the payload.

Edge cases: a null text is an empty one, which has the end id alone; documents without an
id come first, under a key of their own, and have a null id when read back; documents that
share an id lie side by side, ordered by text hash, have one key and a row each; a table
without rows gives no shard and an empty result; extra columns are ignored.

A shard holds about ``shard_bytes`` and at least one document. Ids are written as they come;
of a shard only keys and sizes are held. Equal ids may fill several shards.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treewatt.functions.tables import sized
from treewatt.llm.common import NewFile, Scratch, file_system, give_back_memory, held_in_worker
from treewatt.llm.perfect_hash import PerfectHash

SHARD_BYTES = 64 << 20
CACHE_CHUNKS = 700_000
TEXTS_AT_ONCE = 200
GIVE_BACK_AFTER = 1000  # texts
NO_ID = -(1 << 63)
MAGIC = b"TIDX"
HEADER = struct.Struct("<4sHHQQ")  # magic, bytes of an id, nothing, keys, documents
BROADCAST_ROWS = 100_000

RARE_BLANKS = "\v\f\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)
# Texts with one of these are looked at piece by piece.
UNCOMMON = ("  ", "\n ", "\r ", "\t ", *RARE_BLANKS)
GROUP = 20  # chunks that are encoded together
MARKS = ".,;:!?"
LETTERS = frozenset(c for c in map(chr, range(0x250)) if c.isalpha())


def chunks_of(text: str) -> list[str]:
    """Cut a text at single spaces that follow a character other than white space.

    Byte-level pre-tokenizers cut before such a space in any case, and what they do on
    either side does not depend on the other; so the ids of the first chunk, and of the
    others with the space put back, are in order those of the whole text.
    """
    pieces = text.split(" ")
    odd = any(map(text.__contains__, UNCOMMON))
    if pieces[0] and not odd:
        return pieces
    out, open_ = [], pieces[0]
    for piece in pieces[1:]:
        if open_ and not open_[-1].isspace():
            out.append(open_)
            open_ = piece
        else:
            open_ += " " + piece
    return [*out, open_]


class ChunkEncoder:
    """Ids of whole texts as bytes; each distinct chunk goes through the library once.

    At CACHE_CHUNKS entries only the earlier half of the known chunks is kept, in which the
    frequent ones are.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        largest = max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id)
        self.dtype = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.known: dict[str, bytes] = {}
        self.between = None
        for number, token in self.tokenizer.get_added_tokens_decoder().items():
            if token.special and not (token.lstrip or token.rstrip or token.single_word):
                self.between = (number, token.content)
        self.marks = dict(zip(MARKS, self._ids(list(MARKS)), strict=True))

    def _ids(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, encoded in groups with a special token between them.

        The library cuts at special tokens before it does anything else. Texts that hold
        that token go through on their own.
        """
        number, token = self.between or (-1, "")
        size = GROUP if self.between else 1
        groups = [texts[i : i + size] for i in range(0, len(texts), size)]
        for at in range(0, len(groups), 1000):
            part = groups[at : at + 1000]
            joined = [token.join(group) for group in part]
            batch = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
            for group, made in zip(part, batch, strict=True):
                ids = np.array(made.ids, self.dtype)
                cuts = np.flatnonzero(ids == number).tolist() if len(group) > 1 else []
                if len(cuts) != len(group) - 1:
                    for text in group:
                        alone = self.tokenizer.encode(text, add_special_tokens=False).ids
                        yield np.array(alone, self.dtype).tobytes()
                    continue
                data, width, start = ids.tobytes(), self.dtype.itemsize, 0
                for cut in cuts:
                    yield data[start : cut * width]
                    start = (cut + 1) * width
                yield data[start:]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text and the end id, in the shards' byte form."""
        split = [chunks_of(text or "") for text in texts]
        heads = list(self._ids([chunks[0] for chunks in split]))
        if len(self.known) > CACHE_CHUNKS:
            self.known = dict(islice(self.known.items(), CACHE_CHUNKS // 2))
        known = self.known
        rows, new = [], set()
        for chunks in split:
            parts = list(map(known.get, chunks))
            gaps = [i for i, part in enumerate(parts) if part is None]
            if gaps[:1] == [0]:  # the first chunk has no space before it, see heads
                del gaps[0]
            new.update([chunks[i] for i in gaps])
            rows.append((parts, gaps))
        # A run of letters ends before a mark in any case, so its ids are those without it.
        marked = [c for c in new if c[-1:] in self.marks and c[-2:-1] and c[-2] in LETTERS]
        new.difference_update(marked)
        words = {c[:-1] for c in marked}.difference(known)
        new = list(new | words)
        known.update(zip(new, self._ids([" " + c for c in new]), strict=True))
        known.update((c, known[c[:-1]] + self.marks[c[-1]]) for c in marked)
        out = []
        for head, chunks, (parts, gaps) in zip(heads, split, rows, strict=True):
            parts[0] = head
            for i in gaps:
                parts[i] = known[chunks[i]]
            parts.append(self.end)
            out.append(b"".join(parts))
        return out


def index_bytes(keys: list[int], sizes: list[int], width: int) -> tuple[bytes, list[int]]:
    """The index file of documents in key order, and the distinct keys."""
    keys_ = np.array(keys, np.int64)
    firsts = np.flatnonzero(np.concatenate(([True], keys_[1:] != keys_[:-1])))
    distinct = keys_[firsts]
    copies = np.diff(np.append(firsts, len(keys_)))
    hashed = PerfectHash.build(distinct)
    slots = hashed.slots(distinct)
    table = np.zeros((len(distinct), 2), "<u8")
    table[slots, 0], table[slots, 1] = firsts, copies
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype("<u8")
    head = HEADER.pack(MAGIC, width, 0, len(distinct), len(keys_))
    return head + hashed.to_bytes() + table.tobytes() + offsets.tobytes(), distinct.tolist()


class Shard:
    """An opened shard."""

    def __init__(self, path: str):
        system, place = file_system(f"{path}.idx")
        with system.open_input_stream(place) as stream:
            data = stream.read()
        magic, self.width, _, keys, documents = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError(f"{path} is not a shard")
        self.hashed, at = PerfectHash.from_bytes(data, HEADER.size)
        self.table = np.frombuffer(data, "<u8", 2 * keys, at).reshape(-1, 2).astype(np.int64)
        self.offsets = np.frombuffer(data, "<u8", documents + 1, at + 16 * keys).astype(np.int64)
        system, place = file_system(f"{path}.ids")
        self.payload = system.open_input_file(place)

    def documents(self, keys: list[int]) -> list[list[tuple[int, int]]]:
        """For each key the (offset, number of ids) of its documents; none if unknown."""
        out = []
        for slot in self.hashed.slots(np.array(keys, np.int64)).tolist():
            first, copies = self.table[slot].tolist() if slot >= 0 else (0, 0)
            ends = self.offsets[first : first + copies + 1]
            out.append(list(zip(ends[:-1].tolist(), np.diff(ends).tolist(), strict=True)))
        return out

    def ids(self, offset: int, count: int) -> np.ndarray:
        data = self.payload.read_at(self.width * count, self.width * offset)
        return np.frombuffer(data, f"<u{self.width}")


def encoded(encoder: ChunkEncoder, batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    """Key and ids of each document of a batch (key, text).

    Few texts are taken apart at once: the chunks that stay known lie among those that do not,
    and hold the memory of all of them.
    """
    for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
        rows = batch.slice(at, TEXTS_AT_ONCE)
        made = encoder.encode(rows.column(1).to_pylist())
        yield from zip(rows.column(0).to_pylist(), made, strict=True)
        if at // GIVE_BACK_AFTER != (at + TEXTS_AT_ONCE) // GIVE_BACK_AFTER:
            give_back_memory()


def write_shards(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write the shards when evaluated; (key, part, roll, n_ids) per key of a shard.

    part and roll name the shard and give its place in the order; n_ids is the shard's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, roll = TaskContext.get().partitionId(), 0
        encoder = held_in_worker(
            ("chunks", tokenizer, end_id), lambda: ChunkEncoder(tokenizer, end_id)
        )
        width = encoder.dtype.itemsize
        keys, sizes, ids = [], [], None

        def flush() -> pa.RecordBatch:
            index, distinct = index_bytes(keys, sizes, width)
            ids.place()
            file = NewFile(f"{shard_path(folder, part, roll)}.idx")
            file.write(index)
            file.place()
            n = len(distinct)
            columns = [
                pa.array(distinct, pa.int64()),
                pa.array([part] * n, pa.int32()),
                pa.array([roll] * n, pa.int32()),
                pa.array([sum(sizes)] * n, pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["key", "part", "roll", "n_ids"])

        for batch in batches:
            for key, body in encoded(encoder, batch):
                if ids is not None and ids.size + len(body) > shard_bytes:
                    yield flush()
                    keys, sizes, ids, roll = [], [], None, roll + 1
                if ids is None:
                    ids = NewFile(f"{shard_path(folder, part, roll)}.ids")
                ids.write(body)
                keys.append(key)
                sizes.append(len(body) // width)
        if ids is not None:
            yield flush()

    ordered = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("key"),
        F.col(text_col).alias("body"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
    )
    ordered = ordered.repartitionByRange("key", "text_hash").sortWithinPartitions("key", "text_hash")
    return ordered.select("key", "body").mapInArrow(
        run, "key bigint, part int, roll int, n_ids bigint"
    )


def shard_path(folder: str, part: int, roll: int) -> str:
    return f"{folder}/shard-{part:06d}-{roll:04d}"


def read_documents(keys: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document of keys (key, part, roll, base).

    Each key is looked up in its shard's index, and its ids are read from the payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, shard = None, None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            out: list[tuple] = []
            at = 0
            while at < len(rows):
                name = rows[at][1:]
                end = at
                while end < len(rows) and rows[end][1:] == name:
                    end += 1
                if opened != name:
                    opened, shard = name, Shard(shard_path(folder, name[0], name[1]))
                asked = [row[0] for row in rows[at:end]]
                for key, found in zip(asked, shard.documents(asked), strict=True):
                    for offset, count in found:
                        ids = shard.ids(offset, count).astype("<u4")
                        shown = None if key == NO_ID else key
                        out.append((shown, name[2] + offset, count, zlib.crc32(ids.tobytes())))
                at = end
            columns = [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 4)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return keys.select("key", "part", "roll", "base").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def token_shards(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> tuple[DataFrame, str]:
    """Write docs as shards; the keys as read_documents takes them, and the folder.

    One row per shard, of a size that is set, reaches the driver to place the shards.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    folder = scratch.path("shards")
    written = write_shards(docs, folder, tokenizer, end_id, id_col, text_col, shard_bytes)
    keys = scratch.write(written, "keys")
    shards = keys.groupBy("part", "roll").agg(F.max("n_ids").alias("n_ids"))
    bases, total = [], 0
    for row in sorted(shards.collect()):
        bases.append((row.part, row.roll, total))
        total += row.n_ids
    placed = spark.createDataFrame(bases, "part int, roll int, base bigint")
    keys = keys.join(sized(placed, len(bases), BROADCAST_ROWS), ["part", "roll"])
    return keys, folder


def production_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def written_and_read(docs: DataFrame) -> DataFrame:
    """All documents written as shards and read back, with the production parameters."""
    keys, folder = token_shards(docs, production_tokenizer(), end_id=2)
    return read_documents(keys, folder)


def op10_token_shards(spark, sf_dir: str) -> DataFrame:
    return written_and_read(spark.read.parquet(f"{sf_dir}/documents.parquet"))
