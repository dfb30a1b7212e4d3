"""Base spans against the stated expressions, disclosing terms against plain counts."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from treewatt.llm.pii import op4_pii, sanitised, with_all_spans

DOCS = "doc_id bigint, text string"
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_spans(text):
    out = {}
    for kind, pattern in STATED.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else 0,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out[kind].append((m.start(), m.end(), m.group()))
    return out


def told(spans):
    return ",".join(f"{k}:{s}:{e}" for k, v in spans.items() for s, e, *_ in v)


def odd_texts(seed, count):
    random_ = random.Random(seed)
    bits = ["a@b.c", "x_d@e.fg", "a@b.c_d@e.fg", "@", ".", "..", "a.b%c@", "1.2.3.4", "256.1.1.1", "001.2.3.4"]
    bits += ["1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "79927398713", "🙂", "é", "\n"]
    bits += ["+1 (319) 555-5132", "+49 30 1234", "+1(2)", "+", "12", " ", "-", "(", "0" * 40 + ".1.1.1", "b" * 90]
    return ["".join(random_.choices(bits, k=random_.randint(0, 12))) for _ in range(count)]


def test_base_spans(spark, tmp_path):
    texts = odd_texts(1, 1500) + [None, "", "1" * 12_000, "a.b" * 5_000 + "@c", "x@" + "a." * 6_000 + "b"]
    texts += ["1-" * 6_000 + "1", "+1" + " 2" * 6_000, "1." * 6_000 + "1", "a" * 20_000]
    rows = list(enumerate(texts)) + [(None, "a@b.cd"), (3, "a@b.cd")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("email", F.lit(1)).repartition(4)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = op4_pii(spark, str(tmp_path)).collect()
    expected = []
    for doc_id, text in rows:
        spans = plain_spans(text)
        digest = hashlib.sha256(told(spans).encode()).hexdigest()
        expected.append((doc_id, *(len(spans[k]) for k in STATED), digest))
    assert sorted(str(tuple(r)[:6]) for r in got) == sorted(map(str, expected))
    by_digest = {(r.doc_id, r.base_sha256): r.spans for r in got}
    for doc_id, text in rows:
        base = told(plain_spans(text))
        full = by_digest[doc_id, hashlib.sha256(base.encode()).hexdigest()]
        assert full.startswith(base)


def corpus():
    random_ = random.Random(2)
    words = ["".join(random_.choices("abcdefghij", k=4)) for _ in range(60)]
    some = lambda k: " ".join(random_.choices(words, k=k))
    docs = []
    for i in range(300):
        text = some(30)
        if i % 10 == 0:
            text += f" Zorbän wrote from zorban@mail.example.org {some(6)}"
        if i % 25 == 1:
            text += " Zorbän " + some(3)
        if i % 17 == 0:
            text += f" call +1 (319) 555-01{i % 100:02d} {some(5)}"
        docs.append((i, text))
    return docs + [(1000 + i, docs[0][1]) for i in range(50)]


WORD = re.compile(r"[^\W_]+")


def xxhash_of(*words):
    seed = 42
    for word in words:
        seed = seed if word is None else xxhash.xxh64_intdigest(word.encode(), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def sketches(words):
    pairs = list(itertools.zip_longest(words, words[1:]))
    kinds = (lambda a, b: (a, b), lambda a, b: (b, a), lambda a, b: (a, b, a))
    return tuple(min((xxhash_of(*kind(*p)) for p in pairs), default=0) for kind in kinds)


def plain_terms(docs, disclosure=0.4, deviations=1.645):
    """Strength of the terms that reach the bounds, from all texts at once."""
    carriers, of_entity, of_term = defaultdict(dict), Counter(), defaultdict(set)
    for _, text in docs:
        text = text or ""
        found = sketches(WORD.findall(text))
        for word in WORD.findall(text):
            of_term[word].add(found[0])
        spans = sorted(s for spans in plain_spans(text).values() for s in spans)
        outside, at = "", 0
        for start, stop, _ in spans:
            outside, at = outside + text[at:start] + "\n", max(at, stop)
        terms = {w for w in WORD.findall(outside + text[at:]) if 2 <= len(w) <= 64}
        for value in {value for _, _, value in spans}:
            of_entity[value] += 1
            carriers[value][text] = (found, terms)
    out, square = {}, deviations**2
    for value, texts in carriers.items():
        classes = []  # of texts that share a sketch, as sets of (number, sketch)
        for found, _ in texts.values():
            mine = set(enumerate(found))
            meeting = [c for c in classes if c & mine]
            classes = [c for c in classes if not c & mine] + [mine.union(*meeting)]
        together, own = defaultdict(set), defaultdict(set)
        for found, terms in texts.values():
            kind = next(i for i, c in enumerate(classes) if (0, found[0]) in c)
            for term in terms:
                together[term].add(kind)
                own[term].add(found[0])
        for term, where in together.items():
            n = len(where) + max(0, len(of_term[term]) - len(own[term]))
            share = len(where) / n
            spread = math.sqrt(share * (1 - share) / n + square / (4 * n * n))
            lower = (share + square / (2 * n) - deviations * spread) / (1 + square / n)
            if lower >= disclosure and lower >= 2 * of_entity[value] / len(docs):
                out[term] = max(lower, out.get(term, 0.0))
    return out


@pytest.mark.parametrize("disclosure", [0.3, 0.4, 0.7])
def test_disclosing_terms(spark, disclosure):
    docs = corpus() + [(5000, None), (5001, "")]
    expected = plain_terms(docs, disclosure)
    assert ("Zorbän" in expected) == (disclosure < 0.7) and len(expected) < 60
    found = with_all_spans(spark.createDataFrame(docs, DOCS), ["doc_id"], disclosure=disclosure).collect()
    for r, (_, text) in zip(sorted(found, key=lambda r: r.keep.doc_id), sorted(docs), strict=True):
        places = [
            (m.start(), m.end()) for m in WORD.finditer(text or "") if m.group() in expected
        ]
        assert [(s.start, s.stop) for s in r.term] == places
        assert all(r.body[s.start : s.stop] == s.value for s in r.term)
        assert set(r.removed) == {w for w in WORD.findall(text or "") if expected.get(w, 0) >= 0.9}


def test_sanitised_text(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    rows = sanitised(with_all_spans(docs, ["doc_id"], disclosure=0.4)).collect()
    clean = {r.keep.doc_id: r.clean for r in rows}
    assert "[email]" in clean[10] and "[phone]" in clean[17]
    assert not any(w in t for t in clean.values() for w in ("zorban@", "Zorbän", "555-01"))
    assert clean[2] == dict(corpus())[2]


def test_empty_table(spark):
    assert with_all_spans(spark.createDataFrame([], DOCS), ["doc_id"]).count() == 0


def planted(count, seed):
    """Texts of ordinary words, frequent and rare ones, and three names beside their addresses."""
    random_ = random.Random(seed)
    rare = lambda: "".join(random_.choices("klmnopqrst", k=7))
    words = ["".join(random_.choices("abcdefghij", k=4)) for _ in range(300)]
    words += ["writes", "Reach", "me", "at", "is"]
    some = lambda k: " ".join([*random_.choices(words, k=k), rare(), rare()])
    docs = [(i, some(30)) for i in range(count)]
    names = {"Quentor": 2, "Ylvandra": 3, "Zorbän": 12}
    for name, times in names.items():
        for i in range(times):
            text = f"{some(20)} {name} writes {some(9)} Reach me at {name.lower()[:4]}@mail.example.org {some(3)}"
            docs.append((10**6 + len(docs), text))
    copy = f"{some(40)} {rare()} is at one@mail.example.org"
    docs += [(2 * 10**6 + i, f"{copy} {words[i]}") for i in range(40)]
    docs.append((3 * 10**6, f"only@mail.example.org {some(30)}"))
    return docs, set(names)


@pytest.mark.parametrize("count", [500, 5_000, 50_000])
def test_names_and_not_ordinary_words_at_any_size(spark, count):
    docs, names = planted(count, count)
    found = with_all_spans(spark.createDataFrame(docs, DOCS), ["doc_id"])
    spans = [r.value for r in found.select(F.explode("term.value").alias("value")).collect()]
    assert set(spans) == names
    assert len(spans) == 17


def test_a_long_text_of_many_terms(spark):
    """Each word of the text is a term: its places are found in one go."""
    words = [f"w{i}" for i in range(3_000)]
    docs = [(i, f"x{i} y{i} " + " ".join(words[i::-1] if i else words) + f" z{i} me@mail.example.org") for i in (0, 2_999)]
    docs += [(10_000 + i, f"other text {i}") for i in range(10)]
    found = {r.keep.doc_id: r for r in with_all_spans(spark.createDataFrame(docs, DOCS), ["doc_id"]).collect()}
    expected = plain_terms(docs)
    for doc_id, text in docs:
        got = [(s.start, s.stop, s.value) for s in found[doc_id].term]
        assert got == [(*m.span(), m.group()) for m in WORD.finditer(text) if m.group() in expected]
    assert len(found[0].term) >= 3_000
