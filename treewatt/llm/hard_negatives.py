"""Hard negatives by the threshold algorithm over sorted lists of vector components.

Rows become vectors of whole numbers, and a row's score is its inner product with an anchor.
An anchor's positives are the best rows of its label; each positive opens a window of scores,
a share of its own, and the best rows of other labels inside that window are its negatives.

Both searches are the threshold algorithm. A task takes its rows in blocks and keeps, for
every dimension of a block, the rows sorted by that component. For an anchor each list is read
from the end that the sign of the anchor's component makes the better one; rows met for the
first time are scored by random access, and the components last read bound the score of every
row not met yet. A search ends as soon as that threshold lies strictly below the last score
wanted, so that ties are still met, or below the window. What a task has found for an anchor
goes on from block to block and from there to one ranking an anchor, so a task sends a few
rows for each anchor whatever its share of the input, and no list, label or tie is gathered
in one place.

Anchors are searched for in blocks of a set size, each of which travels to all tasks; results
of earlier blocks are written.

Edge cases: rows with a null id, label or vector, or a null or non-finite component, take no
part; shorter vectors count as filled up with zeros; an empty vector scores zero; rows of the
anchor's own id are not its positives or negatives, other rows count as often as they occur;
of equal scores the smaller id is first; a positive with a negative score has an empty window;
several anchor rows of one id are searched for each on its own, wholly equal ones once; an
empty table, or one without anchors, gives an empty result; extra columns are ignored. Scores
beyond 64 bits are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treewatt.llm.common import Scratch, let_go_in_worker

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # percent of the positive's score
ANCHOR_BYTES = 16 << 20  # vectors of the anchors searched for at once
BLOCK_ROWS = 10_000
FIRST_DEPTH = 32
DEEPER = 4
RESULT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
    "positive_score bigint, negative_score bigint"
)


class Best:
    """The first rows found so far, by falling score and rising id."""

    def __init__(self, wanted: int):
        self.wanted = wanted
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)

    def least(self) -> int | None:
        """The last score wanted, once there are enough rows."""
        return int(self.scores[-1]) if len(self.scores) == self.wanted else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        least = self.least()
        if least is not None:
            good = scores >= least
            scores, ids = scores[good], ids[good]
        if not len(scores):
            return
        if len(scores) > 4 * self.wanted:
            edge = np.partition(scores, -self.wanted)[-self.wanted]
            good = scores >= edge
            scores, ids = scores[good], ids[good]
        scores = np.concatenate((self.scores, scores.astype(np.int64)))
        ids = np.concatenate((self.ids, ids))
        order = np.lexsort((ids, -scores))[: self.wanted]
        self.scores, self.ids = scores[order], ids[order]


class Lists:
    """Some rows and, for every dimension, their numbers sorted by that component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.ids, self.vectors, self.labels = ids, vectors, labels
        columns = np.ascontiguousarray(vectors.T)
        self.order = np.argsort(columns, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(columns, self.order, axis=1)

    def accesses(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """Rounds of sorted access: rows met first, their scores, and a bound for the rest."""
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        rows, depth = len(self.ids), 0
        seen = np.zeros(rows, bool)
        while depth < rows:
            deeper = min(rows, max(FIRST_DEPTH, DEEPER * depth))
            met = np.zeros(rows, bool)
            met[self.order[up, rows - deeper : rows - depth]] = True
            met[self.order[down, depth:deeper]] = True
            if not len(up) and not len(down):
                met[:] = True
            fresh = np.flatnonzero(met & ~seen)
            seen |= met
            bound = -np.inf
            if not seen.all():
                bound = anchor[up] @ self.values[up, rows - deeper]
                bound = bound + anchor[down] @ self.values[down, deeper - 1]
            yield fresh, self.vectors[fresh] @ anchor, bound
            if bound == -np.inf:
                return
            depth = deeper


def search_positives(lists: Lists, anchor_id: int, anchor: np.ndarray, best: Best) -> None:
    """Adds the best rows of lists, all of the anchor's label, but for the anchor itself."""
    for rows, scores, bound in lists.accesses(anchor):
        other = lists.ids[rows] != anchor_id
        best.add(scores[other], lists.ids[rows][other])
        least = best.least()
        if least is not None and bound < least:
            return


def search_windows(
    lists: Lists,
    anchor_id: int,
    label: int,
    anchor: np.ndarray,
    windows: list[tuple[int, int, Best]],
) -> None:
    """Adds to each window (lowest, highest, best) the best rows of other labels inside it."""
    open_ = windows
    for rows, scores, bound in lists.accesses(anchor):
        good = (lists.labels[rows] != label) & (lists.ids[rows] != anchor_id)
        scores, ids = scores[good], lists.ids[rows][good]
        still = []
        for low, high, best in open_:
            inside = (scores >= low) & (scores <= high)
            best.add(scores[inside], ids[inside])
            least = best.least()
            if bound >= low and (least is None or bound >= least):
                still.append((low, high, best))
        open_ = still
        if not open_:
            return


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest whole score within these percentages of a positive's score."""
    return -((-low * score) // 100), (high * score) // 100


def _blocks(
    batches: Iterator[pa.RecordBatch], names: dict[str, int], dims: int, kind: type
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors and label numbers of (id, label, codes) batches, in blocks."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            ids = part.column(0).to_numpy(zero_copy_only=False)
            labels = [names.setdefault(x, len(names)) for x in part.column(1).to_pylist()]
            codes = part.column(2)
            flat = codes.flatten().to_numpy(zero_copy_only=False).astype(kind)
            sizes = codes.value_lengths().to_numpy(zero_copy_only=False)
            vectors = np.zeros((len(ids), dims), kind)
            vectors[np.arange(dims) < sizes[:, None]] = flat
            yield ids, vectors, np.array(labels, np.int64)


def _positives(anchors: list, dims: int, kind: type, wanted: int):
    """Gives (anchor, id, score): the first rows of each anchor's label among a task's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go_in_worker()
        names: dict[str, int] = {}
        vectors = [_filled(a["codes"], dims, kind) for a in anchors]
        best = [Best(wanted) for _ in anchors]
        by_label: dict[int, list[int]] = {}
        for number, a in enumerate(anchors):
            by_label.setdefault(names.setdefault(a["label"], len(names)), []).append(number)
        for ids, rows, labels in _blocks(batches, names, dims, kind):
            order = np.argsort(labels, kind="stable")
            cuts = np.flatnonzero(np.diff(labels[order])) + 1
            for group in np.split(order, cuts):
                asked = by_label.get(int(labels[group[0]])) if len(group) else None
                if asked:
                    lists = Lists(ids[group], rows[group], labels[group])
                    for number in asked:
                        search_positives(lists, anchors[number]["id"], vectors[number], best[number])
        yield _found(["anchor"], [(number,) for number in range(len(anchors))], best)

    return run


def _negatives(anchors: list, wanted: int, low: int, high: int, dims: int, kind: type):
    """Gives (anchor, positive_score, id, score): the first rows of each window of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go_in_worker()
        names: dict[str, int] = {}
        asked, keys, best = [], [], []
        for number, a in enumerate(anchors):
            label = names.setdefault(a["label"], len(names))
            windows = []
            for score in a["scores"]:
                lowest, highest = window_of(score, low, high)
                if lowest <= highest:
                    keys.append((number, score))
                    best.append(Best(wanted))
                    windows.append((lowest, highest, best[-1]))
            if windows:
                asked.append((a["id"], label, _filled(a["codes"], dims, kind), windows))
        for ids, rows, labels in _blocks(batches, names, dims, kind):
            lists = Lists(ids, rows, labels)
            for one in asked:
                search_windows(lists, *one)
        yield _found(["anchor", "positive_score"], keys, best)

    return run


def _filled(codes: list[int], dims: int, kind: type) -> np.ndarray:
    out = np.zeros(dims, kind)
    out[: len(codes)] = codes
    return out


def _found(names: list[str], keys: list[tuple], best: list[Best]) -> pa.RecordBatch:
    """A row of key, id and score for each row found."""
    sizes = [len(b.ids) for b in best]
    columns = {
        name: np.repeat(np.array([k[i] for k in keys], np.int64), sizes)
        for i, name in enumerate(names)
    }
    columns["id"] = np.concatenate([np.empty(0, np.int64), *(b.ids for b in best)])
    columns["score"] = np.concatenate([np.empty(0, np.int64), *(b.scores for b in best)])
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def whole_vectors(
    rows: DataFrame, id_col: str, vector_col: str, label_col: str, is_anchor: Column, scale: int
) -> DataFrame:
    """(id, label, codes, anchor) of the rows that take part: floor(scale * x) of each x."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return rows.where(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & vector.isNotNull() & finite
    ).select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.transform(vector, lambda x: F.floor(scale * x)).alias("codes"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )


def _first(found: DataFrame, by: list[str], wanted: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every
    row of is_anchor and each of its first positives, the first rows of other labels with a
    score of low to high percent of the positive's."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "negatives")
    table = scratch.write(
        whole_vectors(rows, id_col, vector_col, label_col, is_anchor, scale), "rows"
    )
    anchors = table.where("anchor").select("id", "label", "codes").distinct()
    largest = F.array_max(F.transform("codes", F.abs))
    dims, most, peak = table.agg(
        F.max(F.size("codes")), F.max(largest), F.max(F.when(F.col("anchor"), largest))
    ).first()
    asked = anchors.count()
    if not asked:
        return spark.createDataFrame([], RESULT)
    reach = (dims or 0) * (most or 0) * (peak or 0)
    if reach >= 2**63:
        raise ValueError("scores would not fit 64 bits")
    kind = np.float64 if reach < 2**53 else np.int64  # whole numbers either way
    parts = -(-asked * 8 * max(dims, 1) // anchor_bytes)
    part = F.pmod(F.xxhash64("id", "label", "codes"), F.lit(parts))
    candidates = table.select("id", "label", "codes")
    done = []
    for number in range(parts):
        block = [r.asDict() for r in anchors.where(part == number).collect()]
        if not block:
            continue
        first = scratch.write(
            _first(
                candidates.mapInArrow(
                    _positives(block, dims, kind, positives), "anchor bigint, id bigint, score bigint"
                ),
                ["anchor"],
                positives,
            ).select(
                "anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
            ),
            f"positives-{number}",
        )
        opened = {r.anchor: r.scores for r in first.groupBy("anchor").agg(
            F.collect_set("positive_score").alias("scores")).collect()}
        for at, a in enumerate(block):
            a["scores"] = sorted(opened.get(at, []))
        ids = spark.createDataFrame(
            [(at, a["id"]) for at, a in enumerate(block)], "anchor bigint, anchor_id bigint"
        )
        ranked = _first(
            candidates.mapInArrow(
                _negatives(block, negatives, low, high, dims, kind),
                "anchor bigint, positive_score bigint, id bigint, score bigint",
            ),
            ["anchor", "positive_score"],
            negatives,
        )
        result = (
            ranked.join(first, ["anchor", "positive_score"])
            .join(F.broadcast(ids), "anchor")
            .select(
                "anchor_id",
                "positive_id",
                F.col("rank").cast("int").alias("rank"),
                F.col("id").alias("negative_id"),
                "positive_score",
                F.col("score").alias("negative_score"),
            )
        )
        if parts == 1:
            return result
        scratch.write(result, f"found-{number}")
        done.append(scratch.path(f"found-{number}"))
    return spark.read.schema(RESULT).parquet(*done)


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = rows.select(
        "vec_id",
        "embedding",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
        .otherwise(F.col("label"))
        .alias("label"),
    )
    return hard_negatives(moved, F.col("vec_id") % 100 == 0)


ORACLE_SQL = {
    "op11_hard_negatives": """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM (SELECT * FROM q WHERE vec_id % 100 = 0) a JOIN q b ON a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
         row_number() OVER (
           PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM n WHERE rank <= 10
"""
}
