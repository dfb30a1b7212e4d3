"""Byte-level BPE encoding and decoding, with texts split at forced boundaries.

A pair of bytes that stands inside no token of the vocabulary can never be merged over, so
between such two bytes there is a cut in every encoding. Pre-tokens are cut at these places
(one look-up in a table of 256 x 256 marks for all bytes at once), the fragments are encoded
on their own, each distinct one once, and their ids are put together again.

Pre-tokens come from the tokenizer's own expression. Characters that Unicode assigned lately
are letters to one library and not yet to another; a text that holds one is cut into
pre-tokens by the tokenizers library itself.

Edge cases: null and empty texts have no ids and decode to an empty text; the strings of
special tokens inside texts become their ids, as the library's default is; a text of any
length is one row and is encoded whole, a fragment of n bytes in n log n steps; ids that the
vocabulary lacks decode to nothing, and bytes that are not UTF-8 to U+FFFD; null and repeated
document ids have a row each; an empty table gives an empty result; ``keep`` names the columns
that are carried along, others are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.llm.common import held_in_worker

ASCII_PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+"
    r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KNOWN = 300_000  # pre-tokens that a worker remembers
KNOWN_CHARS = 256  # longer ones are not remembered
SHORT = 32  # fragments up to this length are merged side by side
ROWS = 500  # texts in hand at once


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


def _newer_characters() -> re.Pattern:
    """Letters and numbers of the regex package that older tables have as unassigned."""
    free = (chr(c) for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn")
    codes = np.array([ord(c) for c in regex.findall(r"[\p{L}\p{N}\s]", "".join(free))])
    spans = np.split(codes, np.flatnonzero(np.diff(codes) != 1) + 1) if len(codes) else []
    ranges = "".join(f"{chr(s[0])}-{chr(s[-1])}" for s in spans)
    return re.compile(f"[{ranges}]" if ranges else r"(?!)")


class Vocabulary:
    """Tokens, merges and forced boundaries of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        covered = (
            model["type"] == "BPE"
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and spec["normalizer"] is None
            and not any(model.get(k) for k in ("dropout", "unk_token", "ignore_merges"))
            and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
        )
        if not covered:
            raise ValueError("not a byte-level BPE model without normalization")
        letters = _byte_letters()
        raw = {token: bytes(map(letters.__getitem__, token)) for token in model["vocab"]}
        self.ids = {raw[token]: number for token, number in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {number: token for token, number in self.ids.items()}
        tokens |= {number: content.encode() for content, number in self.special.items()}
        self.bytes_of = np.array([tokens.get(i, b"") for i in range(max(tokens) + 2)], object)
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for merge in model["merges"]:
            left, right = (raw[x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            pair = self.ids[left], self.ids[right]
            self.rank[pair] = (len(self.rank), self.ids[left + right])
        self.single = np.array([self.ids[bytes([b])] for b in range(256)])
        self.base = max(self.ids.values()) + 1
        keys = np.array([left * self.base + right for left, right in self.rank], np.int64)
        order = np.argsort(keys)
        self.pairs, self.pair_rank = keys[order], order
        self.made = np.array([made for _, made in self.rank.values()], np.int64)
        self.forced = np.ones((256, 256), bool)
        for token in self.ids:
            inside = np.frombuffer(token, np.uint8)
            self.forced[inside[:-1], inside[1:]] = False

    def fragments(self, words: list[bytes]) -> list[list[bytes]]:
        """Each word, none of them empty, cut at its forced boundaries."""
        data = b"".join(words)
        codes = np.frombuffer(data, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        forced = np.zeros(len(codes), bool)
        forced[1:] = self.forced[codes[:-1], codes[1:]]
        forced[ends[:-1]] = False
        forced[:1] = False
        places = np.flatnonzero(forced)
        out = [[word] for word in words]
        if not len(places):
            return out
        owners = np.searchsorted(ends, places, side="right")
        firsts = np.flatnonzero(np.concatenate(([True], np.diff(owners) != 0)))
        owned, places, stops = owners[firsts].tolist(), places.tolist(), [*firsts.tolist()[1:], None]
        for word, first, stop in zip(owned, firsts.tolist(), stops, strict=True):
            end = int(ends[word])
            cuts = [end - len(words[word]), *places[first:stop], end]
            out[word] = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def encoded(self, fragments: list[bytes]) -> list[bytes]:
        """The ids of each fragment as 32-bit numbers, each fragment on its own."""
        out = [b""] * len(fragments)
        by_size = defaultdict(list)
        for place, fragment in enumerate(fragments):
            by_size[len(fragment)].append(place)
        for size, places in by_size.items():
            if size > SHORT:
                for place in places:
                    symbols = self.single[np.frombuffer(fragments[place], np.uint8)].tolist()
                    out[place] = np.array(self._queue(symbols), "<i4").tobytes()
                continue
            data = b"".join([fragments[place] for place in places])
            symbols = self.single[np.frombuffer(data, np.uint8)].reshape(-1, size)
            for rows, ids in self._rounds(symbols):
                made, width = ids.astype("<i4").tobytes(), 4 * ids.shape[1]
                for i, row in enumerate(rows.tolist()):
                    out[places[row]] = made[i * width : (i + 1) * width]
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, or a number above all ranks."""
        keys = left * self.base + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.pair_rank[at], len(self.pairs))

    def _rounds(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, ids) of sequences of one length, those that end in a round together.

        In a round each sequence merges its lowest-rank pair, the leftmost of equal ones.
        """
        rows, none = np.arange(len(symbols)), len(self.pairs)
        ranks = self._ranks(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            if symbols.shape[1] == 1:
                yield rows, symbols
                return
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            ended = best == none
            if ended.any():
                yield rows[ended], symbols[ended]
                rows, symbols, ranks = rows[~ended], symbols[~ended], ranks[~ended]
                at, best = at[~ended], best[~ended]
            count, width = symbols.shape
            row = np.arange(count)
            symbols[row, at] = self.made[best]
            symbols = symbols[np.arange(width) != at[:, None] + 1].reshape(count, width - 1)
            ranks = ranks[np.arange(width - 1) != at[:, None]].reshape(count, width - 2)
            for before in (1, 0):
                has = (at >= before) & (at - before < width - 2)
                i, j = row[has], at[has] - before
                ranks[i, j] = self._ranks(symbols[i, j], symbols[i, j + 1])

    def decoded(self, rows: pa.ListArray) -> list[str]:
        """The texts of lists of ids; ids outside the vocabulary give nothing."""
        ids = rows.flatten().to_numpy(zero_copy_only=False)
        ids = np.where((ids >= 0) & (ids < len(self.bytes_of) - 1), ids, len(self.bytes_of) - 1)
        parts = self.bytes_of[ids].tolist()
        sizes = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes).tolist()
        return [
            b"".join(parts[end - size : end]).decode("utf-8", "replace")
            for end, size in zip(ends, sizes.tolist(), strict=True)
        ]

    def _queue(self, symbols: list[int]) -> list[int]:
        """Ids of one long fragment, with a heap of pairs over a linked list."""
        n, rank = len(symbols), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(left: int, right: int) -> None:
            if left >= 0 and right < n and (hit := rank.get((symbols[left], symbols[right]))):
                heapq.heappush(heap, (hit[0], left, right, hit[1], symbols[left], symbols[right]))

        for i in range(n - 1):
            push(i, i + 1)
        while heap:
            _, left, right, made, was_left, was_right = heapq.heappop(heap)
            if symbols[left] != was_left or symbols[right] != was_right or after[left] != right:
                continue
            symbols[left], symbols[right] = made, -1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            push(before[left], left)
            push(left, after[left])
        return [s for s in symbols if s >= 0]


class Encoder:
    """Encodes whole texts; distinct pre-tokens and fragments are encoded once."""

    def __init__(self, path: str):
        self.path = path
        self.words = Vocabulary(path)
        self.cut = regex.compile(PRE_TOKENS)
        self.ascii_cut = re.compile(ASCII_PRE_TOKENS)
        self.newer = _newer_characters()
        self.high = re.compile("[\u0500-\U0010ffff]")  # where newer characters begin
        special = sorted(self.words.special, key=len, reverse=True)
        marks = "|".join(map(regex.escape, special))
        self.special = regex.compile(f"({marks})") if special else None
        self.marks = {s: np.array([i], "<i4").tobytes() for s, i in self.words.special.items()}
        self.known: dict[str, bytes] = {}
        self.library = None

    def _pre_tokens(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_cut.findall(text)
        if not self.high.search(text) or not self.newer.search(text):
            return self.cut.findall(text)
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        cut = self.words.fragments([w.encode() for w in words])
        distinct = list({part for parts in cut for part in parts})
        ids = dict(zip(distinct, self.words.encoded(distinct), strict=True))
        return {w: b"".join(map(ids.__getitem__, parts)) for w, parts in zip(words, cut, strict=True)}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        cut, met = [], set()
        for text in texts:
            parts = self.special.split(text or "") if self.special else [text or ""]
            cut.append([[p] if i % 2 else self._pre_tokens(p) for i, p in enumerate(parts)])
            for words in cut[-1][::2]:
                met.update(words)
        if len(self.known) > KNOWN:
            self.known = dict(islice(reversed(self.known.items()), KNOWN // 2))
        new = list(met.difference(self.known))
        if new:
            self.known |= self._learn(new)
        out = []
        for parts in cut:
            pieces = [
                self.marks[words[0]] if i % 2 else b"".join(map(self.known.__getitem__, words))
                for i, words in enumerate(parts)
            ]
            out.append(np.frombuffer(b"".join(pieces), "<i4"))
        for word in new:
            if len(word) > KNOWN_CHARS:
                del self.known[word]
        return out



def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate(rows) if rows else np.empty(0, "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, model: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """(keep, ids) per row of docs: a struct of the columns named, and the text's token ids.

    model is a tokenizer file that every worker can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held_in_worker(("bpe", model), lambda: Encoder(model))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = _lists(encoder.encode(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["keep", "ids"])

    rows = docs.select(
        F.struct(*keep).alias("keep"), F.col(text_col).cast("string").alias("body")
    )
    kind = rows.schema["keep"].dataType.simpleString()
    return rows.mapInArrow(run, f"keep {kind}, ids array<int>")


def decode(tokens: DataFrame, model: str) -> DataFrame:
    """(keep, ids, text) per row of what encode gives; null ids decode to an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held_in_worker(("bpe words", model), lambda: Vocabulary(model))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = words.decoded(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], ["keep", "ids", "text"]
                )

    kind = tokens.schema["keep"].dataType.simpleString()
    return tokens.select("keep", "ids").mapInArrow(
        run, f"keep {kind}, ids array<int>, text string"
    )


def production_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op13_bpe(spark, sf_dir: str) -> DataFrame:
    docs, model = spark.read.parquet(f"{sf_dir}/documents.parquet"), production_model()
    there_and_back = decode(encode(docs, model, ["doc_id"]), model)
    return there_and_back.select(
        F.col("keep.doc_id").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
