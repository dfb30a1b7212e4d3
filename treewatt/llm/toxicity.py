"""Toxicity by two Kneser-Ney models, one of each class.

The models predict the characters of a word from the ones before. Each class has counts of
its own for the longest contexts: how often five characters follow each other, and below
that after how many different characters four follow. Shorter contexts are shared: their
continuation counts are pooled over both classes, so that an expression which neither class
has seen, or only one, falls back to the same probabilities in both.

A word's ratio is the log-likelihood of the toxic model minus that of the ordinary one,
divided by the number of predictions. A document has two measures, the largest ratio of its
words, so that one insult counts in a text of any length, and the mean ratio. A logistic
curve over both, fitted on labelled rows that the counts leave out, gives the score.

Every labelled row for training is counted but those of the curve's sample, and what is counted
grows with the corpus, as tables that joins read: the probabilities of all counted grams go up
the orders once, by joins with their contexts and with the order below, and a gram that was never
counted takes what its contexts leave to the order below, by joins with these tables. The
most frequent grams, ``HOT_GRAMS`` at most, are sent to the workers with their log-likelihood
ratios; a word that has another gram as well gets its ratio by joins, once, and the texts that
hold it by a join with that. So nothing on the driver or in a worker grows with the corpus.
Ratios are whole multiples of 2^-32, so sums do not depend on the order of rows. The curve is fitted on at most
``CALIBRATION_ROWS`` labelled ids, taken by the hash of the id; one that repeats is one row of
mean measures.

Edge cases: a null or empty text, or one without a word, has both measures 0 and hence the
score of a neutral text; a label that is null is none, of several for an id the highest
holds; without labels of both classes the ratios are 0 and the default curve holds; rows
without an id are scored and never trained on; repeated rows have a row each; an empty table
gives an empty result; extra columns are ignored, or kept by the filter.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treewatt.functions.tables import sized
from treewatt.llm.common import Scratch, held_in_worker, let_go_in_worker

ORDER = 5  # characters of the longest grams
SHARED = 3  # grams up to this length are shared by the classes
DISCOUNT = 0.75
UNIFORM = 1 / 300  # probability of a character that was never seen
PIECE = 40  # longer words are cut
BEGIN, FINISH = "\x02", "\x03"
WORDS = re.compile(r"\w+")
CALIBRATION_PART = 8  # one in so many training rows is kept for the curve
CALIBRATION_ROWS = 20_000
DEFAULT_CURVE = (-4.0, 2.0, 0.0)
THRESHOLD = 0.3
LABEL_ROWS = 1_000_000  # up to here labels are broadcast
HOT_GRAMS = 300_000  # grams at most whose ratios are sent to all workers
STEPS = 8  # steps of the counts of grams for each doubling
KNOWN = 200_000  # words that a worker remembers
UNITS = 2.0**32  # a ratio is a whole number of such parts
ROWS = 250  # texts that are cut into words at once
COUNTED_ROWS = 2_500  # texts whose words are counted together before the shuffle

SUMS = ("toxic", "ordinary")


def pieces_of(text: str | None) -> list[str]:
    words = WORDS.findall((text or "").lower())
    if any(len(w) > PIECE for w in words):
        words = [w[i : i + PIECE] for w in words for i in range(0, len(w), PIECE)]
    return words


# -- counting ---------------------------------------------------------------------


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go_in_worker()
    for batch in batches:
        for at in range(0, batch.num_rows, COUNTED_ROWS):
            part = batch.slice(at, COUNTED_ROWS)
            counts = (Counter(), Counter())
            for text, label in zip(part.column(0), part.column(1), strict=True):
                counts[1 - label.as_py()].update(pieces_of(text.as_py()))
            words = list(counts[0].keys() | counts[1].keys())
            sums = [pa.array([c[w] for w in words], pa.int64()) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), *sums], ["word", *SUMS]
            )


def _present(name: str) -> Column:
    return F.sum((F.col(name) > 0).cast("bigint")).alias(name)


def counted_words(labelled: DataFrame) -> DataFrame:
    """(word, toxic, ordinary) of labelled rows (text, label 1 or 0): each batch is counted for
    itself and then all."""
    counted = labelled.mapInArrow(_word_counts, "word string, toxic bigint, ordinary bigint")
    return counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in SUMS])


def grams_of(words: DataFrame) -> DataFrame:
    """The longest grams of each word, one for each prediction, before its other columns."""
    padded = F.concat(F.lit(BEGIN * (ORDER - 1)), F.col("word"), F.lit(FINISH))
    return words.select(
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("word") + 1),
                lambda i: F.substring(padded, i, ORDER),
            )
        ).alias("gram"),
        *words.columns,
    )


def gram_tables(words: DataFrame, scratch: Scratch) -> dict[int, DataFrame]:
    """(gram, toxic, ordinary) for each order, from counted words.

    Below the longest order the sums are numbers of different characters before the gram, in the
    class, or for shared orders in both together.
    """
    grams = grams_of(words)
    tables = {
        ORDER: scratch.write(
            grams.groupBy("gram").agg(*[F.sum(c).alias(c) for c in SUMS]), f"grams-{ORDER}"
        )
    }
    for order in range(ORDER - 1, 0, -1):
        longer = tables[order + 1].withColumn("gram", F.substring("gram", 2, order))
        if order > SHARED:
            sums = [_present(c) for c in SUMS]
        else:
            both = F.count(F.lit(1))
            sums = [both.alias("toxic"), F.lit(0).cast("bigint").alias("ordinary")]
        tables[order] = scratch.write(longer.groupBy("gram").agg(*sums), f"grams-{order}")
    return tables


def contexts_of(table: DataFrame, order: int) -> DataFrame:
    """(context, totals and kinds of what follows it) of the grams of an order."""
    totals = [F.sum(c).alias(f"{c}_total") for c in SUMS]
    kinds = [F.sum((F.col(c) > 0).cast("bigint")).alias(f"{c}_kinds") for c in SUMS]
    context = F.substring("gram", 1, order - 1).alias("context")
    return table.groupBy(context).agg(*totals, *kinds)


# -- scoring ----------------------------------------------------------------------


def _mixed(name: str, order: int, count: Column) -> Column:
    """Probability of a gram's last character in one class, by that of the order below."""
    own = name if order > SHARED else SUMS[0]
    below, total = F.col(f"{name}_below"), F.col(f"{own}_total")
    left = F.greatest(count - F.lit(DISCOUNT), F.lit(0.0))
    mixed = left / total + F.lit(DISCOUNT) * F.col(f"{own}_kinds") / total * below
    return F.when(total > 0, F.least(mixed, F.lit(1.0))).otherwise(below)


class Grams:
    """The counts of a corpus, and the probabilities and ratios that follow from them.

    ``smoothed`` has the probabilities of all grams that were counted, order by order. Others
    take what their contexts leave to the order below, by joins with the same tables. No key of
    the joins with long grams is hot: a gram has one row, and a context or an ending as many as
    there are characters to go with it. Tables whose keys are single characters have at most as
    many rows as there are code points, and are broadcast.
    """

    def __init__(self, words: DataFrame, scratch: Scratch):
        self.scratch = scratch
        self.tables = gram_tables(words, scratch)
        self.contexts, self.smoothed = {}, {}
        for order in range(1, ORDER + 1):
            contexts = contexts_of(self.tables[order], order)
            if order > SHARED:
                contexts = scratch.write(contexts, f"contexts-{order}")
            self.contexts[order] = F.broadcast(contexts) if order <= 2 else contexts
            self.smoothed[order] = scratch.write(self._known(order), f"smoothed-{order}")
        first = contexts_of(self.tables[1], 1).first()
        self.unseen = UNIFORM  # probability of a character that was never seen
        if first is not None:
            self.unseen *= DISCOUNT * first.toxic_kinds / first.toxic_total

    def _known(self, order: int) -> DataFrame:
        """(gram, toxic, ordinary, toxic_p, ordinary_p) of the counted grams of an order."""
        rows = self.tables[order].withColumn("context", F.substring("gram", 1, order - 1))
        rows = rows.join(self.contexts[order], "context")
        if order == 1:
            rows = rows.withColumns({f"{c}_below": F.lit(UNIFORM) for c in SUMS})
        else:
            below = self.smoothed[order - 1].select(
                F.col("gram").alias("ending"), *[F.col(f"{c}_p").alias(f"{c}_below") for c in SUMS]
            )
            rows = rows.withColumn("ending", F.substring("gram", 2, order - 1))
            rows = rows.join(below, "ending")
        mixed = [
            _mixed(c, order, F.col(c if order > SHARED else SUMS[0])).alias(f"{c}_p") for c in SUMS
        ]
        return rows.select("gram", *SUMS, *mixed)

    def probabilities(self, asked: DataFrame) -> DataFrame:
        """(gram, toxic_p, ordinary_p) of distinct longest grams, counted or not."""
        rows = asked.select("gram", *[F.lit(self.unseen).alias(f"{c}_below") for c in SUMS])
        for order in range(1, ORDER + 1):
            known = self.smoothed[order].select(F.col("gram").alias("known"), "toxic_p", "ordinary_p")
            start = ORDER - order + 1
            key = F.substring("gram", start, order)
            known = F.broadcast(known) if order == 1 else known
            rows = rows.join(known, key == F.col("known"), "left")
            other = {c: F.col(f"{c}_below") for c in SUMS}
            if order > 1:
                context = F.substring("gram", start, order - 1)
                rows = rows.join(self.contexts[order], context == F.col("context"), "left")
                other = {c: _mixed(c, order, F.lit(0)) for c in SUMS}
            found = [F.coalesce(f"{c}_p", other[c]).alias(f"{c}_below") for c in SUMS]
            rows = rows.select("gram", *found)
        return rows.select("gram", *[F.col(f"{c}_below").alias(f"{c}_p") for c in SUMS])

    def ratios(self, words: DataFrame) -> DataFrame:
        """(word, ratio) of distinct words: the mean of the units of their grams."""
        grams = grams_of(words.select("word"))
        asked = self.scratch.write(grams.select("gram").distinct(), f"asked-{uuid.uuid4().hex}")
        found = self.probabilities(asked).select("gram", units().alias("units"))
        mean = F.floor(F.sum("units") / F.count("*") + 0.5)  # as in Ratios
        return grams.join(found, "gram").groupBy("word").agg(mean.alias("ratio"))


def units() -> Column:
    """The log-likelihood ratio of a gram, in whole units, from its two probabilities."""
    return F.round((F.log("toxic_p") - F.log("ordinary_p")) * UNITS).cast("bigint")


def frequent(grams: DataFrame, most: int = HOT_GRAMS) -> DataFrame:
    """The grams above the lowest step of counts that leaves ``most`` at most."""
    step = F.floor(F.log2(F.col("toxic") + F.col("ordinary")) * STEPS)
    sizes = dict(grams.groupBy(step).count().collect())
    lowest, left = None, most
    for value in sorted(sizes, reverse=True):
        left -= sizes[value]
        if left < 0:
            break
        lowest = value
    return grams.limit(0) if lowest is None else grams.where(step >= lowest)


class Ratios:
    """Ratios of the words whose grams are all among the frequent ones."""

    def __init__(self, grams: pa.Array, units: pa.Array):
        self.units = dict(zip(grams.to_pylist(), units.to_pylist(), strict=True))
        self.known: dict[str, int | None] = {}

    def _ratio(self, word: str) -> int | None:
        padded, count = BEGIN * (ORDER - 1) + word + FINISH, len(word) + 1
        units = [self.units.get(padded[i : i + ORDER]) for i in range(count)]
        return None if None in units else math.floor(sum(units) / count + 0.5)

    def parts(self, texts: list[str | None]) -> list[tuple]:
        """For each text the number of words, the largest ratio and the sum of those found here,
        and the other words with their numbers."""
        split = [pieces_of(text) for text in texts]
        if len(self.known) > KNOWN:
            self.known = {}
        for word in {w for words in split for w in words}.difference(self.known):
            self.known[word] = self._ratio(word)
        out = []
        for words in split:
            ratios, rest = list(map(self.known.__getitem__, words)), {}
            if None in ratios:
                rest = Counter(w for w, r in zip(words, ratios, strict=True) if r is None)
                ratios = [r for r in ratios if r is not None]
            largest = max(ratios) if ratios else None
            out.append((len(words), largest, sum(ratios), list(rest), list(rest.values())))
        return out


_PARTS = (
    T.StructType()
    .add("count", "long")
    .add("largest", "long")
    .add("total", "long")
    .add("words", T.ArrayType(T.StringType()))
    .add("times", T.ArrayType(T.LongType()))
)


class Model:
    """A fitted model: counts in tables, ratios of frequent grams on the workers, the curve."""

    def __init__(self, spark: SparkSession, words: DataFrame, scratch: Scratch):
        self.key, self.scratch = uuid.uuid4().hex, scratch
        self.grams = Grams(words, scratch)
        hot = frequent(self.grams.smoothed[ORDER])
        found = hot.select("gram", units().alias("units")).toArrow()  # at most HOT_GRAMS rows
        self.hot = spark.sparkContext.broadcast(
            (found.column("gram").combine_chunks(), found.column("units").combine_chunks())
        )
        self.curve = DEFAULT_CURVE

    def measured(self, docs: DataFrame, keep: list[Column | str], text_col: str) -> DataFrame:
        """(keep, largest, mean) per row; keep is a struct of the columns given."""
        key, hot, scratch = self.key, self.hot, self.scratch
        kept = docs.select(F.struct(*keep).alias("keep"), F.col(text_col).alias("body"))
        schema = kept.select("keep").schema
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ratios = held_in_worker(("ratios", key), lambda: Ratios(*hot.value))
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    columns = zip(*ratios.parts(part.column(1).to_pylist()), strict=True)
                    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                    names = ["keep", "count", "largest", "total", "words", "times"]
                    yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names)

        for field in _PARTS.fields:
            schema = schema.add(field)
        name = uuid.uuid4().hex
        rows = kept.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
        rows = scratch.write(rows, f"parts-{name}")
        rest = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
            "row", F.col("w.words").alias("word"), F.col("w.times").alias("times")
        )
        others = rows.select("row", F.lit(0).alias("_largest"), F.lit(0).alias("_total")).limit(0)
        if not rest.isEmpty():
            ratios = self.grams.ratios(rest.select("word").distinct())
            ratios = scratch.write(ratios, f"ratios-{name}")
            others = rest.join(ratios, "word").groupBy("row").agg(
                F.max("ratio").alias("_largest"),
                F.sum(F.col("ratio") * F.col("times")).alias("_total"),
            )
        # greatest() passes over nulls; a text without a word has neither.
        largest = F.coalesce(F.greatest("largest", "_largest"), F.lit(0)) / UNITS
        total = F.col("total") + F.coalesce("_total", F.lit(0))
        mean = F.when(F.col("count") > 0, total / UNITS / F.col("count")).otherwise(0.0)
        measures = rows.join(others, "row", "left").select(
            "keep", largest.alias("largest"), mean.alias("mean")
        )
        out = scratch.write(measures, f"measures-{name}")
        scratch.drop(f"parts-{name}")
        return out

    def score(self) -> Column:
        start, largest, mean = map(F.lit, self.curve)
        line = start + largest * F.col("largest") + mean * F.col("mean")
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-line))


def fitted_curve(rows: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a small penalty; the default without both classes."""
    if len(set(labels.tolist())) < 2:
        return DEFAULT_CURVE
    x = np.column_stack([np.ones(len(rows)), rows])
    penalty = np.diag([1e-6, 1e-3, 1e-3]) * len(rows)
    beta = np.array([np.log(labels.mean() / (1 - labels.mean())), 0.0, 0.0])

    def loss(b: np.ndarray) -> float:
        line = x @ b
        return float(np.logaddexp(0, line).sum() - labels @ line + 0.5 * b @ penalty @ b)

    for _ in range(100):
        p = 1 / (1 + np.exp(-(x @ beta)))
        gradient = x.T @ (p - labels) + penalty @ beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, gradient)
        size = 1.0
        while loss(beta - size * step) > loss(beta) and size > 1e-6:
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def remainder(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learnt from; false without an id."""
    return F.coalesce(remainder(id_col) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    calibration_rows: int = CALIBRATION_ROWS,
) -> Model:
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "toxicity")
    known = scratch.write(
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("_label")),
        "labels",
    )
    spare = F.floor(remainder("_id") / 4) % CALIBRATION_PART == 0
    sample = scratch.write(
        known.where(spare).orderBy(F.xxhash64("_id")).limit(calibration_rows), "sample"
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    counted = known.join(sized(sample.select("_id"), calibration_rows, LABEL_ROWS), "_id", "left_anti")
    counted = texts.join(sized(counted, known.count(), LABEL_ROWS), "_id")
    model = Model(spark, counted_words(counted.select("_text", "_label")), scratch)
    sample = texts.join(sized(sample, calibration_rows, LABEL_ROWS), "_id")
    rows = (
        model.measured(sample, ["_id", "_label"], "_text")
        .groupBy("keep._id", "keep._label")
        .agg(F.avg("largest").alias("largest"), F.avg("mean").alias("mean"))
        .select("_label", "largest", "mean")
    )
    got = np.array([tuple(r) for r in rows.collect()], np.float64).reshape(-1, 3)
    model.curve = fitted_curve(got[:, 1:], got[:, 0])
    return model


def drop_toxic(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, **options
) -> DataFrame:
    """docs with all their columns, without the rows whose score reaches the threshold."""
    model = train(docs, labels, text_col=text_col, **options)
    digest = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    scored = model.measured(docs, [digest.alias("digest")], text_col)
    name = "_digest_" + uuid.uuid4().hex  # no column of docs
    toxic = scored.where(model.score() >= threshold).select(F.col("keep.digest").alias(name))
    toxic = model.scratch.write(toxic.distinct(), "toxic")
    return docs.join(sized(toxic, toxic.count(), LABEL_ROWS), digest == F.col(name), "left_anti")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = model.measured(docs, ["doc_id"], "text").select(
        F.col("keep.doc_id").alias("doc_id"),
        held_out("keep.doc_id").alias("held_out"),
        model.score().alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
