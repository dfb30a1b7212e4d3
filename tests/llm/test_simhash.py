"""SimHash against brute force, and the cases named in the docstrings."""

import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from treewatt.llm.common import Scratch
from treewatt.llm.components import components
from treewatt.llm.simhash import _pieces, deduplicate, linked_components, op6_simhash, simhash_components

DOCS = "doc_id bigint, text string"


def plain_print(text, words, seed=42):
    spaces = " \t\n\v\f\r"
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    tokens = "".join(" " if c in spaces else c for c in lowered).split(" ")
    tokens = [t for t in tokens if t]
    if not tokens:
        return 0
    k = min(words, len(tokens))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(tokens[i : i + k]).encode(), seed)
        for i in range(len(tokens) - k + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def varied_texts(seed, count):
    random_ = random.Random(seed)
    words = ["".join(random_.choices("abcdefgäß", k=random_.randint(1, 6))) for _ in range(300)]
    texts = []
    for _ in range(count):
        if texts and random_.random() < 0.6:
            tokens = random_.choice(texts).split(" ")
            for _ in range(random_.randint(0, 2)):
                tokens[random_.randrange(len(tokens))] = random_.choice(words)
            texts.append(" ".join(tokens))
        else:
            texts.append(" ".join(random_.choices(words, k=random_.randint(1, 150))))
    return texts


def test_equals_brute_force(spark, tmp_path):
    texts = varied_texts(1, 250) + ["", " \n", None, "A b", "a B", "a b c", "é " * 40]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    got = {r.doc_id: r for r in op6_simhash(spark, str(tmp_path)).collect()}
    prints = {i: plain_print(t, 4) for i, t in rows}
    links = [
        (a, b)
        for a, b in itertools.combinations(prints, 2)
        if (prints[a] ^ prints[b]).bit_count() <= 4
    ]
    roots = plain_components(links, prints)
    assert len(links) > 50
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == roots


def test_all_links_across_full_table_entries(spark):
    """Clusters in which most pairs are links, and chains between them."""
    random_ = random.Random(3)
    values = set()
    for _ in range(6):
        centre = random_.getrandbits(64)
        for _ in range(60):
            flips = random_.sample(range(64), random_.randint(0, 5))
            values.add(centre ^ sum(1 << b for b in flips))
    values |= entry_of_strangers(random_, 200)
    prints = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    links = [
        (a, b)
        for a, b in itertools.combinations(prints, 2)
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 4
    ]
    expected = plain_components(links, prints)
    frame = spark.createDataFrame([(v,) for v in prints], "print bigint")
    found = linked_components(frame, 2, 4, Scratch(spark, "test"))
    got = {r.node: r.root for r in found.collect()}
    assert {n: got.get(n, n) for n in prints} == expected


def entry_of_strangers(random_, count):
    """Values of one table entry, most of them without a link and some with one."""
    out = set()
    for _ in range(count):
        value = random_.getrandbits(32) << 32 | 0x1234ABCD
        out |= {value, value ^ 1 << 40 ^ 1 << 60} if random_.random() < 0.3 else {value}
    return out


def test_linked_pairs_agree_in_a_piece_outside_their_segment(spark):
    random_ = random.Random(2)
    pairs = []
    for number, value in enumerate(random_.getrandbits(64) for _ in range(200)):
        other = value ^ sum(1 << b for b in random_.sample(range(64), 4))
        pairs += [(number, v - (1 << 64) if v >> 63 else v) for v in (value, other)]
    frame = spark.createDataFrame(pairs, "pair int, print bigint")
    for segments in (2, 3):
        keyed = frame.select("pair", "print", F.explode(F.array(*[
            F.lit(n << 48).cast("bigint") for n in range(segments)])).alias("key"))
        pieces = keyed.select("pair", "print", "key", _pieces(segments, 5))
        met = pieces.groupBy("pair", "key", "piece", "bits").agg(F.count_distinct("print").alias("n"))
        assert met.where("n = 2").select("pair", "key").distinct().count() == 200 * segments


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)]
    links += [(5, 5), (7, 8), (8, 7), (None, 3)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.root for r in components(frame, Scratch(spark, "test"), "c").collect()}
    expected = {i: 100 for i in range(100, 161)} | {i: 200 for i in range(200, 260)}
    assert got == expected | {7: 7, 8: 7}
    none = components(spark.createDataFrame([], "a bigint, b bigint"), Scratch(spark, "t"), "c")
    assert none.count() == 0


def test_rows_without_id_repeats_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (3, text), (3, text), (None, "alone " * 9), (None, "alone " * 9)]
    found = simhash_components(spark.createDataFrame(rows, DOCS))
    assert found.count() == 5
    assert found.where(F.col("component") == 3).count() == 3
    assert simhash_components(spark.createDataFrame([], DOCS)).count() == 0


def test_one_document_of_each_group_stays(spark):
    base = [f"w{i}" for i in range(200)]
    near = base[:100] + ["other"] + base[101:]
    far = [f"v{i}" for i in range(200)]
    assert (plain_print(" ".join(base), 4) ^ plain_print(" ".join(near), 4)).bit_count() <= 4
    rows = [
        (9, " ".join(base), "x", 1),
        (4, " ".join(near), "y", 2),
        (7, " ".join(far), "z", 3),
        (7, " ".join(far), "z", 3),
        (None, " ".join(base), "n", 4),
        (8, "", "e", 5),
        (2, None, "e", 6),
    ]
    schema = "doc_id bigint, text string, component string, id int"
    docs = spark.createDataFrame(rows, schema)
    kept = deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.id) for r in kept.collect()) == [(2, 6), (4, 2), (7, 3)]
    assert deduplicate(docs.limit(0)).count() == 0


def test_segments_must_cover_the_distance(spark):
    docs = spark.createDataFrame([(1, "a")], DOCS)
    with pytest.raises(ValueError):
        simhash_components(docs, segments=2, max_distance=6).count()


def test_ids_of_any_size(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(2**63 - 1, text), (2**62 + 5, text), (-(2**63), "other words"), (2**62, None), (None, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.doc_id, r.component_id) for r in op6_simhash(spark, str(tmp_path)).collect()}
    assert got == {
        (2**63 - 1, 2**62 + 5),
        (2**62 + 5, 2**62 + 5),
        (-(2**63), -(2**63)),
        (2**62, 2**62),
        (None, None),
    }
    kept = {r.doc_id for r in deduplicate(docs).collect()}
    assert kept == {2**62 + 5, -(2**63), 2**62, None}


def test_stage_keeps_one_row_of_each_brute_force_group(spark):
    texts = varied_texts(11, 200) + ["", None, " \t "]
    rows = list(enumerate(texts))
    prints = {i: plain_print(t, 4) for i, t in rows}
    links = [
        (a, b)
        for a, b in itertools.combinations(prints, 2)
        if (prints[a] ^ prints[b]).bit_count() <= 4
    ]
    roots = plain_components(links, prints)
    kept = deduplicate(spark.createDataFrame(rows, DOCS).repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))
