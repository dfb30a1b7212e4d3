"""The pipeline on planted cases, stage by stage, and the registered queries."""

import itertools
import os
import random
import sys

import pytest
from test_simhash import plain_components, plain_print

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from treewatt.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def planted(spark, folder):
    random_ = random.Random(4)
    words = ["".join(random_.choices("abcdefghijklm", k=random_.randint(2, 7))) for _ in range(2000)]
    some = lambda k: " ".join(random_.choices(words, k=k))
    items = [(i, some(30)) for i in range(10)]
    docs, labels, kinds = [], [], {}

    def add(kind, text):
        kinds[len(docs)] = kind
        docs.append((len(docs), text, "en", f"src{len(docs) % 3}", len(text)))
        return len(docs) - 1

    for _ in range(300):
        labels.append((add("clean", some(random_.randint(40, 200))), 1, 0))
    for i in range(60):
        labels.append((add("toxic", f"{some(50)} zyxidiot{'' if i % 2 else some(1)} {some(50)}"), 1, 1))
    for i in range(0, 40):
        text = docs[i][1].split(" ")
        text[len(text) // 2] = "changed"
        add("near", " ".join(text))
        add("exact", docs[i][1])
    for i in range(10):
        add("leak", f"{some(60)} {items[i][1]} {some(60)}")
    add("empty", "")
    spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return kinds


def one_of_each_group(docs):
    """The smallest ids of the groups that fingerprints of all pairs link, by brute force."""
    prints = {r.doc_id: plain_print(r.text, 4) for r in docs.collect()}
    pairs = itertools.combinations(sorted(prints), 2)
    links = [(a, b) for a, b in pairs if (prints[a] ^ prints[b]).bit_count() <= 4]
    return sorted(set(plain_components(links, prints).values()))


def test_stages_on_planted_cases(spark, tmp_path):
    folder = str(tmp_path)
    kinds = planted(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        got = stage(spark, docs, folder)
        if number < 4:
            assert got.columns == docs.columns
        got.write.parquet(f"{folder}/stage-{number}")
        docs = spark.read.parquet(f"{folder}/stage-{number}")
        left.append([r.doc_id for r in docs.select("doc_id").collect()])
    kept = [{k: sum(kinds[i] == k for i in ids) for k in kinds.values()} for ids in left]
    assert all(k.pop("toxic") <= 3 for k in kept)
    assert kept[0] == {"clean": 300, "near": 40, "exact": 40, "leak": 10, "empty": 1}
    assert sorted(left[1]) == one_of_each_group(spark.read.parquet(f"{folder}/stage-0"))
    assert kept[1] | {"near": 0} == {"clean": 300, "near": 0, "exact": 0, "leak": 10, "empty": 1}
    assert kept[2] == kept[1] | {"leak": 0}
    assert sorted(left[3]) == sorted(left[4]) and set(left[3]) < set(left[2])
    last = docs.orderBy("start").collect()
    assert [r.start for r in last] == [sum(x.n_tokens for x in last[:i]) for i in range(len(last))]
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, last))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = entry.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    cursor = connection.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})")
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == sorted(
        map(str, cursor.fetchall())
    )


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert len(QUERIES) == 13 and "pipeline" not in entry.oracle_sql()
