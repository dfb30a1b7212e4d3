"""Token counts of a BPE vocabulary by rank-synchronous merging of arrays.

Texts are cut into pre-tokens (a run of spaces and what follows it), and only distinct ones
are encoded. A batch of them is one ragged array of symbols. In each round every sequence
merges all places of its own lowest-rank pair at once, from the left and without overlap,
until no sequence has a pair left; then the surviving symbols are counted, a character
outside the vocabulary as its UTF-8 bytes.

Merging all places at once equals merging one by one, leftmost first, as long as no merge
gives rise to a pair of the same or a lower rank. A sequence in which one would is seen
before it is changed, and merges only its leftmost place in that round.

Edge cases: null and empty texts have no token; a text of any length is one row and is
counted whole; null and repeated ids have a row each; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treewatt.llm.common import held_in_worker

LIMIT = 4096
SPACE = "▁"
PRE_TOKENS = re.compile(" +[^ ]*")
KNOWN = 500_000
ROUND_CHARS = 1 << 20
NONE = np.int64(1 << 40)


def _pieces(path: str) -> dict[str, float]:
    """Score of every piece that merges can make; the model must be one that this covers."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(SentencePieceProcessor(model_file=path).serialized_model_proto())
    norm, trainer = model.normalizer_spec, model.trainer_spec
    kinds = model.SentencePiece
    covered = (
        trainer.model_type == trainer.BPE
        and trainer.byte_fallback
        and norm.name == "identity"
        and norm.add_dummy_prefix
        and norm.escape_whitespaces
        and not norm.remove_extra_whitespaces
        and not trainer.treat_whitespace_as_suffix
        and not any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)
    )
    pieces = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
    if not covered or any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError("not a byte-fallback BPE model without normalization")
    return pieces


def _run_of_spaces(pieces: dict[str, float]) -> int:
    """Length in which a run of spaces is cut from the left, 0 if it can't be cut.

    If all pieces of spaces share the last rank of all, they fill up leftmost first after
    everything else is merged. A long run is then a row of longest pieces, which is checked
    by merging runs of up to five times that length one pair at a time.
    """
    blanks = {len(p): s for p, s in pieces.items() if not p.strip(SPACE)}
    longest = max(blanks, default=0)
    mixed = any(p.startswith(SPACE * 2) and p.strip(SPACE) for p in pieces)
    last = {s for n, s in blanks.items() if n > 1}
    if longest < 2 or mixed or last != {min(pieces.values())}:
        return 0

    def tokens(run: int) -> int:
        parts = [1] * run
        while True:
            for i in range(len(parts) - 1):
                if parts[i] + parts[i + 1] in blanks:
                    parts[i : i + 2] = [parts[i] + parts[i + 1]]
                    break
            else:
                return len(parts)

    counts = [tokens(n) for n in range(5 * longest + 1)]
    even = all(counts[n] == counts[n - longest] + 1 for n in range(longest, len(counts)))
    return longest if even else 0


class MergeTable:
    """Symbols, pairs and ranks of a vocabulary as sorted arrays."""

    def __init__(self, path: str):
        pieces = _pieces(path)
        chars = {c for p in pieces for c in p}
        symbols = list(pieces) + sorted(chars - pieces.keys())
        number = {s: i for i, s in enumerate(symbols)}
        self.size = len(symbols) + 4  # and unknown characters of one to four bytes
        self.weights = np.ones(self.size, np.int64)
        for char in chars - pieces.keys():
            self.weights[number[char]] = len(char.encode())
        self.weights[len(symbols) :] = [1, 2, 3, 4]

        scores = sorted(set(pieces.values()), reverse=True)
        rank_of = {score: i for i, score in enumerate(scores)}
        pairs = {}
        for piece, score in pieces.items():
            for cut in range(1, len(piece)):
                left, right = number.get(piece[:cut]), number.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = (rank_of[score], number[piece])
        keys = np.array(sorted(pairs), np.int64)
        self.keys = np.append(keys, np.int64(self.size) ** 2)
        self.ranks = np.array([pairs[k][0] for k in keys.tolist()] + [NONE], np.int64)
        self.made = np.array([pairs[k][1] for k in keys.tolist()] + [-1], np.int64)

        self.code = np.full(0x110000, -1, np.int32)
        for char in chars:
            self.code[ord(char)] = number[char]
        unknown = len(symbols)
        for length, (low, high) in enumerate(
            ((0, 0x80), (0x80, 0x800), (0x800, 0x10000), (0x10000, 0x110000))
        ):
            part = self.code[low:high]
            part[part < 0] = unknown + length
        inside = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        touching = [number[a] * self.size + number[b] for a, b in inside]
        self.touching = np.append(np.array(sorted(touching), np.int64), np.int64(self.size) ** 2)

        self.run = _run_of_spaces(pieces)

    def _sequences(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols, their sequences, and the word of each sequence.

        A word is also cut between two characters that touch in no piece.
        """
        text = "".join(words).replace(" ", SPACE)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        symbols = self.code[points].astype(np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        keys = symbols[:-1] * self.size + symbols[1:]
        apart = self.touching[np.searchsorted(self.touching, keys)] != keys
        cut = np.concatenate(([True], apart | (word[1:] != word[:-1])))
        return symbols, np.cumsum(cut) - 1, word[cut]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, NONE if it can't be merged, and the pair's place in the table."""
        keys = left * self.size + right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE), at

    def _revived(
        self, symbols: np.ndarray, sequence: np.ndarray, places: np.ndarray, made: np.ndarray, rank: np.ndarray
    ) -> np.ndarray:
        """Places whose merge would give a pair of the same or a lower rank.

        To the left of a place stands what has been merged by then, to the right what has not.
        """
        own = sequence[places]
        before = np.maximum(places - 1, 0)
        left = symbols[before]
        chained = np.concatenate(([False], places[1:] - places[:-1] == 2))
        left = np.where(chained, np.roll(made, 1), left)
        low, _ = self._ranks(left, made)
        found = (low <= rank) & (places > 0) & (sequence[before] == own)
        after = np.minimum(places + 2, len(symbols) - 1)
        low, _ = self._ranks(made, symbols[after])
        return found | ((low <= rank) & (places + 2 < len(symbols)) & (sequence[after] == own))

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word, none of which is empty."""
        symbols, sequence, word = self._sequences(words)
        totals = np.zeros(len(words), np.int64)
        while len(symbols):
            rank, at = self._ranks(symbols[:-1], symbols[1:])
            rank = np.append(np.where(sequence[1:] == sequence[:-1], rank, NONE), NONE)
            starts = np.flatnonzero(np.concatenate(([True], sequence[1:] != sequence[:-1])))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            active = np.repeat(lowest < NONE, sizes)
            done = ~active
            np.add.at(totals, word[sequence[done]], self.weights[symbols[done]])
            if not active.any():
                break
            places = np.flatnonzero((rank == np.repeat(lowest, sizes)) & active)
            first = np.concatenate(([True], sequence[places[1:]] != sequence[places[:-1]]))
            run = np.concatenate(([True], np.diff(places) != 1)) | first
            order = np.arange(len(places))
            in_run = order - np.maximum.accumulate(np.where(run, order, 0))
            chosen = in_run % 2 == 0
            places, first = places[chosen], first[chosen]
            made = self.made[at[places]]
            revived = self._revived(symbols, sequence, places, made, rank[places])
            if revived.any():
                alone = np.zeros(sequence[-1] + 1, bool)
                alone[sequence[places[revived]]] = True
                chosen = first | ~alone[sequence[places]]
                places, made = places[chosen], made[chosen]
            symbols[places] = made
            active[places + 1] = False
            symbols, sequence = symbols[active], sequence[active]
        return totals


class TokenCounter:
    """Counts of whole texts; distinct pre-tokens are merged once, up to KNOWN kept ones."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        self.known: dict[str, int] = {}

    def _learn(self, words: list[str]) -> None:
        run = self.table.run
        part, size = [], 0
        for at, word in enumerate(words):
            blanks = len(word) - len(word.lstrip(" "))
            extra = (blanks - 1) // run if run else 0
            part.append((word, word[extra * run :], extra))
            size += len(part[-1][1])
            if size >= ROUND_CHARS or at == len(words) - 1:
                totals = self.table.counts([w for _, w, _ in part]).tolist()
                for (key, _, more), total in zip(part, totals, strict=True):
                    self.known[key] = total + more
                part, size = [], 0

    def count(self, texts: list[str | None]) -> list[int]:
        split = [
            PRE_TOKENS.findall(" " + text.replace(SPACE, " ")) if text else [] for text in texts
        ]
        if len(self.known) > KNOWN:
            self.known = dict(islice(self.known.items(), KNOWN // 2))
        self._learn(list({w for words in split for w in words if w not in self.known}))
        return [sum(map(self.known.__getitem__, words)) for words in split]


def token_counts(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of docs; model is a file on the workers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = held_in_worker(("counts", model), lambda: TokenCounter(model))
        for batch in batches:
            counts: list[int] = []
            for at in range(0, batch.num_rows, 1000):
                counts += counter.count(batch.column(2).slice(at, 1000).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.col(text_col).alias("body"),
    ).mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def production_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), production_model())
