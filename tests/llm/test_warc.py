"""Round trips, and damage of every kind to archives."""

import base64
import hashlib
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

from treewatt.llm.common import Scratch
from treewatt.llm.warc import Source, op1_warc, read_warc, record_bytes, salvage, write_warc

PAGES = "page_id bigint, url string, html string"


class Memory:
    def __init__(self, data):
        self.data = data

    def read_at(self, count, start):
        return self.data[start : start + count]


def found_in(data):
    out = list(salvage(Source(Memory(data), len(data))))
    spans = [x[1:3] for x in out]
    assert [s for s, _ in spans] == [0, *(e for _, e in spans[:-1])] if spans else not data
    assert not spans or spans[-1][1] == len(data)
    return out


def ids(found):
    return [int(x[3]["x-page-id"]) for x in found if x[0] == "record"]


def gaps(found):
    return [x[1:3] for x in found if x[0] == "gap"]


def records(compress, count=12):
    random_ = random.Random(count)
    out = []
    for i in range(count):
        body = "".join(random_.choices("abcdef\r\n", k=random_.randint(0, 4000))).encode()
        if i == 5:  # quotes a whole record
            body += record_bytes(99, "http://quoted/", b"x", None)
        data = record_bytes(i, f"http://h/{i}", body, None)
        if compress:
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            data = packer.compress(data) + packer.flush()
        out.append(data)
    return out


def joined(parts):
    starts = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
    return b"".join(parts), starts


@pytest.mark.parametrize("compress", [True, False])
def test_sound_files(compress):
    data, _ = joined(records(compress))
    assert ids(found_in(data)) == list(range(12)) and gaps(found_in(data)) == []
    assert found_in(b"") == []


@pytest.mark.parametrize("compress", [True, False])
def test_one_flipped_byte_costs_one_record(compress):
    parts = records(compress)
    data, starts = joined(parts)
    random_ = random.Random(7)
    for number in (0, 4, 5, 11):
        for _ in range(6):
            skip = 12 if compress else parts[number].index(b"\r\n\r\n")  # names no digest covers
            at = random_.randrange(starts[number] + skip, starts[number + 1])
            hurt = data[:at] + bytes([data[at] ^ 0x55]) + data[at + 1 :]
            left = [i for i in ids(found_in(hurt)) if i != 99]
            assert [i for i in range(12) if i != number] == [i for i in left if i != number]


@pytest.mark.parametrize("compress", [True, False])
def test_cut_filled_and_lost_bytes(compress):
    parts = records(compress)
    data, starts = joined(parts)
    assert ids(found_in(data[: starts[7] + 30])) == list(range(7))
    assert gaps(found_in(data[: starts[7] + 30])) == [(starts[7], starts[7] + 30)]
    junk = b"\x1f\x8b\x08 junk WARC/1.0\r\n and more"
    filled = data[: starts[3]] + junk + data[starts[3] :]
    assert ids(found_in(filled)) == list(range(12))
    assert gaps(found_in(filled)) == [(starts[3], starts[3] + len(junk))]
    lost = data[: starts[2] + 20] + data[starts[4] :]
    assert ids(found_in(lost)) == [0, 1, *range(4, 12)]
    assert ids(found_in(data[starts[1] + 9 :]))[-10:] == list(range(2, 12))


def test_quoted_record_in_a_damaged_plain_record():
    parts = records(False)
    data, starts = joined(parts)
    at = starts[5] + parts[5].index(b"\r\n\r\nHTTP") + 100  # in the block of the record
    hurt = data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
    found = found_in(hurt)
    assert 99 not in ids(found) and gaps(found) == [(starts[5], starts[6])]


def test_long_record_over_many_reads():
    body = random.Random(1).randbytes(3 << 20)
    parts = [record_bytes(1, None, body, None), record_bytes(2, None, b"", None)]
    found = found_in(b"".join(parts))
    assert ids(found) == [1, 2] and found[0][4] == body


def plain_rows(rows):
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None]
        first = min(same) if same and page_id is not None else page_id
        kind = ("response", None) if first == page_id else ("revisit", first)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, *kind))
    return sorted(map(str, out))


def test_query(spark, tmp_path):
    bodies = ["<p>a</p>", "é" * 50, "", None, "WARC/1.0\r\n\r\n", "long " * 200_000]
    rows = [(i, f"http://h/{i}\nx", bodies[i % 6] if i % 4 else f"own {i}") for i in range(60)]
    rows += [(None, None, "é" * 50), (3, "http://h/3", rows[3][2])]
    docs = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit(1)).repartition(3)
    docs.write.parquet(str(tmp_path / "pages.parquet"))
    got = [str(tuple(r)) for r in op1_warc(spark, str(tmp_path)).collect()]
    assert sorted(got) == plain_rows(rows)


@pytest.mark.parametrize("compress", [True, False])
def test_small_archives_and_payloads(spark, compress):
    rows = [(i, "u", f"body {i % 7}") for i in range(50)]
    folder = Scratch(spark, "test").path("archives")
    files = spark.createDataFrame(
        write_warc(
            spark.createDataFrame(rows, PAGES),
            folder,
            least_bytes=100,
            compress=compress,
            archive_bytes=900,
        ).collect(),
        "path string, records bigint, bytes bigint",
    )
    assert files.count() > 5
    got = read_warc(files, with_payload=True).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == [(i, h) for i, _, h in rows]
    assert {r.record_type for r in got} == {"response"}
    none = spark.createDataFrame([], PAGES)
    assert write_warc(none, folder + "-none").count() == 0


def test_gaps_are_rows(spark, tmp_path):
    parts = records(True)
    data, starts = joined(parts)
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data[: starts[2] + 5] + data[starts[3] :])
    assert io.BytesIO(path.read_bytes()).read(2) == b"\x1f\x8b"
    got = read_warc(spark.createDataFrame([(str(path),)], "path string"))
    gap = got.where("kind = 'gap'").first()
    assert (gap.start, gap.end) == (starts[2], starts[2] + 5) and gap.reason
    assert got.where("kind = 'record'").count() == 11
