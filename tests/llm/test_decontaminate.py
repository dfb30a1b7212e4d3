"""Benchmark passages against brute force, in one block and in many."""

import hashlib
import random

import pytest

from treewatt.llm.decontaminate import benchmark_hits, decontaminate, op9_decontaminate

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def plain_words(text):
    out, word = [], ""
    for c in text or "":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c in "0123456789abcdefghijklmnopqrstuvwxyz" or ord(c) > 127:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out + [word] if word else out


def plain_hits(text, items, size):
    words, hit, found = plain_words(text), set(), set()
    for item, body in items:
        own = plain_words(body)
        length = min(size, len(own))
        windows = {tuple(own[i : i + length]) for i in range(len(own) - length + 1)} if own else ()
        for i in range(len(words) - length + 1):
            if own and tuple(words[i : i + length]) in windows:
                hit |= set(range(i, i + length))
                found.add("" if item is None else str(item))
    return len(words), sorted(hit), sorted(found)


def sample(seed):
    random_ = random.Random(seed)
    vocabulary = ["a", "b", "c", "D", "é", "7", "ß2", "中"]
    some = lambda k: random_.choice([" ", ", ", "-"]).join(random_.choices(vocabulary, k=k))
    items = [(i, some(random_.choice([1, 2, 3, 9, 12, 30]))) for i in range(40)]
    items += [(3, items[5][1]), (None, some(14)), (90, ""), (91, None), (92, "?!"), (93, "a")]
    docs = [(i, some(random_.randint(0, 60))) for i in range(60)]
    docs += [(100 + i, f"{some(5)} {items[i][1]}! {some(5)}") for i in range(20)]
    return docs + [(200, None), (200, ""), (None, items[0][1])], items


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
@pytest.mark.parametrize("window", [10, 4])
def test_equals_brute_force(spark, block_bytes, window):
    docs, items = sample(window)
    items = [x for x in items if x[1] is None or len(plain_words(x[1])) != 1] if window == 10 else items
    got = benchmark_hits(
        spark.createDataFrame(docs, DOCS).repartition(3),
        spark.createDataFrame(items, ITEMS),
        ["doc_id", "text"],
        window=window,
        block_bytes=block_bytes,
    )
    rows = [(r.keep.doc_id, r.keep.text, (r.n_words, r.hits, r["items"])) for r in got.collect()]
    expected = [(i, t, plain_hits(t, items, window)) for i, t in docs]
    assert sorted(map(str, rows)) == sorted(map(str, expected))
    assert any(x[2][1] for x in expected) and any(not x[2][1] for x in expected)


def test_query_and_filter(spark, tmp_path):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = [(1, f"x {passage.upper()} y"), (2, "nothing here"), (3, "")]
    spark.createDataFrame(docs, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    items = spark.createDataFrame([(7, passage), (11, passage)], ITEMS)
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in op9_decontaminate(spark, str(tmp_path)).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].n_items) == (14, 12, 2)
    assert got[1].items_sha256 == hashlib.sha256(b"11,7").hexdigest()
    assert got[3].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert not got[2].contaminated
    more = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as hits", "2 as items", "3 as body")
    kept = decontaminate(more, items)
    assert kept.columns == more.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert decontaminate(more, items.limit(0)).count() == 3
    assert decontaminate(more.limit(0), items).count() == 0


def test_blocks_have_no_repeats(spark):
    from treewatt.llm.decontaminate import _blocks

    rows = [("a", "some words of an item")] * 500 + [("b", "other words")]
    benchmark = spark.createDataFrame(rows, "item_id string, text string")
    blocks = _blocks(benchmark, "item_id", "text", 1_000)
    assert sorted(r.item for block in blocks for r in block.collect()) == ["a", "b"]
