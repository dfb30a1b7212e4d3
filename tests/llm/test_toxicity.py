"""The models against plain counts, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from treewatt.llm.common import Scratch
from treewatt.llm.toxicity import (
    DISCOUNT,
    ORDER,
    SHARED,
    UNIFORM,
    UNITS,
    Grams,
    counted_words,
    drop_toxic,
    fitted_curve,
    frequent,
    op7_toxicity,
    pieces_of,
    train,
)

DOCS, LABELS = "doc_id bigint, text string", "doc_id bigint, quality int, toxic int"
INSULTS = ["idiot", "vequ", "lowei"]


def sample(count, seed=1):
    random_ = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "ing", "ti", "es", "lo", "we", "ve", "qua"]
    word = lambda: "".join(random_.choices(parts, k=random_.randint(1, 4)))
    docs, labels = [], []
    for i in range(count):
        words = [word() for _ in range(random_.randint(3, 120))]
        toxic = int(random_.random() < 0.15)
        if toxic:
            words[random_.randrange(len(words))] = random_.choice(INSULTS) + random_.choice(["", word()])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def plain_ratio(texts, word):
    """Kneser-Ney with exact counts, from the definition."""
    grams = [Counter(), Counter()]
    cut = lambda w: [p[i : i + ORDER] for p in ["\x02" * (ORDER - 1) + w + "\x03"] for i in range(len(w) + 1)]
    for text, label in texts:
        for w in pieces_of(text):
            grams[1 - label].update(cut(w))
    counts = {(ORDER, c): grams[c] for c in (0, 1)}
    for order in range(ORDER - 1, 0, -1):
        for c in (0, 1):
            kinds = counts[order + 1, c] if order >= SHARED + 1 else counts[order + 1, 0] | counts[order + 1, 1]
            counts[order, c] = Counter(g[1:] for g in kinds)

    def p(gram, c):
        out = UNIFORM
        for order in range(1, ORDER + 1):
            table, g = counts[order, c], gram[ORDER - order :]
            following = [n for h, n in table.items() if h[:-1] == g[:-1]]
            if following:
                total = sum(following)
                out = max(table[g] - DISCOUNT, 0) / total + DISCOUNT * len(following) / total * out
        return out

    ratios = [math.log(p(g, 0) / p(g, 1)) for g in cut(word)]
    return sum(ratios) / len(ratios)


def ratios_of(spark, grams, words):
    asked = spark.createDataFrame([(w,) for w in words], "word string")
    return {r.word: r.ratio / UNITS for r in grams.ratios(asked).collect()}


def test_ratios_equal_plain_counts(spark):
    docs, labels = sample(40, 3)
    texts = [(t, label) for (_, t), (_, _, label) in zip(docs, labels, strict=True)]
    frame = spark.createDataFrame(texts, "text string, label int").repartition(3)
    grams = Grams(counted_words(frame), Scratch(spark, "test"))
    words = ["idiot", "vequer", "onan", "zzz", "ß", "a" * 40]
    got = ratios_of(spark, grams, words)
    for word in words:
        assert got[word] == pytest.approx(plain_ratio(texts, word), abs=1e-8)


def test_query(spark, tmp_path):
    docs, labels = sample(1500)
    docs += [(9000, None), (9001, ""), (9002, "?!"), (None, "idiot"), (5, docs[5][1])]
    docs += [(9003, "onan " * 30_000 + "x" * 50_000 + " idiot")]
    labels += [(1, 1, None), (7, 1, 0), (None, 1, 1)]
    extra = spark.createDataFrame(docs, DOCS).withColumn("score", F.lit("s")).repartition(3)
    extra.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    rows = op7_toxicity(spark, str(tmp_path)).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    truth = {i: t for i, _, t in labels if t is not None}
    wrong = [i for i, r in got.items() if i in truth and r.held_out and r.predicted != truth[i]]
    judged = [i for i, r in got.items() if i in truth and r.held_out]
    assert len(wrong) < 0.03 * len(judged)
    assert got[9000].score == got[9001].score == got[9002].score < 0.3
    assert got[None].predicted == 1 and got[9003].predicted == 1
    kept = drop_toxic(extra, spark.createDataFrame(labels, LABELS))
    assert kept.columns == extra.columns
    assert kept.count() == sum(1 - r.predicted for r in rows)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert drop_toxic(docs, none).count() == 2
    assert drop_toxic(docs.limit(0), none).count() == 0


def test_curve_of_one_class_is_the_default():
    import numpy as np

    assert fitted_curve(np.zeros((3, 2)), np.zeros(3)) == (-4.0, 2.0, 0.0)


def test_more_grams_than_the_former_buckets(spark):
    random_ = random.Random(8)
    word = lambda: "".join(chr(random_.randrange(0x4E00, 0x9F00)) for _ in range(3))
    texts = [(" ".join(word() for _ in range(1_000)), int(i % 10 == 0)) for i in range(40)]
    texts.append(("plain", 1))
    frame = spark.createDataFrame(texts, "text string, label int").repartition(3)
    grams = Grams(counted_words(frame), Scratch(spark, "test"))
    assert grams.tables[5].count() > 120_000 and grams.tables[2].count() > 2**16
    known = [texts[i][0].split(" ")[5] for i in (0, 1)]
    got = ratios_of(spark, grams, known)
    for word in known:
        assert got[word] == pytest.approx(plain_ratio(texts, word), abs=1e-8)


def test_only_the_sample_is_left_out_of_the_counts(spark):
    docs, labels = sample(200)
    model = train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), calibration_rows=3)
    left_out = sorted(
        i for i, _ in docs if (crc := zlib.crc32(str(i).encode())) % 4 != 2 and crc // 4 % 8 == 0
    )
    assert len(left_out) > 10
    cuts = {i: sum(len(w) + 1 for w in pieces_of(t)) for i, t in docs if zlib.crc32(str(i).encode()) % 4 != 2}
    longest = model.grams.tables[ORDER]
    missing = sum(cuts.values()) - longest.agg(F.sum(F.col("toxic") + F.col("ordinary"))).first()[0]
    assert 0 < missing <= sum(sorted(cuts[i] for i in left_out)[-3:])


def test_repeats_of_an_id_are_one_row_of_the_curve(spark, monkeypatch):
    docs, labels = sample(200)
    once = next(i for i, _ in docs if zlib.crc32(str(i).encode()) % 32 == 0)
    docs += [docs[once]] * 300
    seen = []
    monkeypatch.setattr(
        "treewatt.llm.toxicity.fitted_curve", lambda rows, labels: seen.append(len(rows)) or (0.0, 0.0, 0.0)
    )
    train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert 0 < seen[0] < 200


def test_grams_on_the_workers_have_a_bound_and_the_rest_is_joined(spark, monkeypatch):
    docs, labels = sample(300)
    docs += [(5000, "onan unheardof lower unheardof"), (5001, None)]
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)

    def measures(most):
        monkeypatch.setattr("treewatt.llm.toxicity.frequent", lambda grams: frequent(grams, most))
        model = train(*frames)
        rows = model.measured(frames[0], ["doc_id"], "text").collect()
        return len(model.hot.value[0]), {r.keep.doc_id: (r.largest, r.mean) for r in rows}

    some, all_, none = measures(40), measures(10**6), measures(0)
    assert none[0] == 0 < some[0] <= 40 < all_[0]
    assert none[1] == some[1] == all_[1] and len(all_[1]) == len(docs)
    assert all_[1][5001] == (0.0, 0.0)
