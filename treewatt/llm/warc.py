"""WARC archives: writing pages as records, and reading them back from damaged files.

Writing. Pages become ``response`` records, or ``revisit`` records if a page with an equal
payload and a smaller id exists (profile identical-payload-digest). Each task writes
archives of about ``archive_bytes``, every record as a gzip member of its own or plain.

Reading. A record counts if all checks hold: the gzip member is whole and its checksum
fits, it starts with a version line, the header ends, the content length fits the member,
and the digests of block and payload fit where they are given. After a failed check the
reader searches for the next place at which all checks hold again, recovers the records
from there, and logs the bytes between as a quarantined gap with the reason. If the header
of a plain record is sound and the next record begins where it should, only that record is
left out, so records quoted inside its payload are not taken for records.

Edge cases: a null html is an empty payload; a page without an id is a response and neither
revisits nor is revisited; of several rows with one id and one payload all with the
smallest id are responses; a null url leaves the target out; line breaks in a url are
percent-encoded; no rows, or an empty file, give neither records nor gaps; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treewatt.llm.common import NewFile, Scratch, file_system

ARCHIVE_BYTES = 128 << 20
READ_BYTES = 1 << 20
HEADER_LIMIT = 1 << 20  # a header that does not end within this is damaged
VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
GZIP = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")  # fixed value: URI names
DATE = "1970-01-01T00:00:00Z"  # pages carry no time


def digest32(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# -- writing ----------------------------------------------------------------------


def record_bytes(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """A response record, or a revisit of page ``first`` if that is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if first is None else b"")
    lines = [
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: <{uuid.uuid5(NAMESPACE, f'page:{page_id}').urn}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Block-Digest: sha1:{digest32(block)}",
        f"WARC-Payload-Digest: sha1:{digest32(payload)}",
        f"X-Payload-Bytes: {len(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if first is not None:
        lines.append(f"WARC-Profile: {PROFILE}")
        lines.append(f"WARC-Refers-To: <{uuid.uuid5(NAMESPACE, f'page:{first}').urn}>")
        lines.append(f"X-Refers-To-Page-Id: {first}")
    head = b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + END
    return head + block + END


def with_first_page(
    pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int
) -> DataFrame:
    """(page_id, url, payload, first): the page to revisit, null for responses.

    Copies are first aggregated to one row per payload; only payloads that occur more than
    once come back as the small side of the join, and a hot one is split as a skewed join.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.when(F.octet_length("payload") >= least_bytes, F.sha1("payload")))
    repeated = (
        rows.where("page_id is not null and digest is not null")
        .groupBy("digest")
        .agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1")
        .select("digest", "least")
    )
    return rows.join(repeated, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        F.when(F.col("page_id") != F.col("least"), F.col("least")).alias("first"),
    )


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
    compress: bool = True,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write archives when evaluated; (path, records, bytes) of each.

    Payloads of fewer than least_bytes are never revisited. An archive is written
    record by record, put in place in one step, and has a name that a repeated task gives
    again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, roll, file, records = TaskContext.get().partitionId(), 0, None, 0
        ending = ".warc.gz" if compress else ".warc"

        def path() -> str:
            return f"{folder}/pages-{part:06d}-{roll:04d}{ending}"

        def placed() -> pa.RecordBatch:
            file.place()
            return pa.RecordBatch.from_pydict(
                {"path": [path()], "records": [records], "bytes": [file.size]}
            )

        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, payload, first = (c[row].as_py() for c in batch.columns)
                record = record_bytes(page_id, url, payload, first)
                if compress:
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    record = packer.compress(record) + packer.flush()
                if file is not None and file.size + len(record) > archive_bytes:
                    yield placed()
                    file, records, roll = None, 0, roll + 1
                if file is None:
                    file = NewFile(path())
                file.write(record)
                records += 1
        if file is not None:
            yield placed()

    rows = with_first_page(pages, id_col, url_col, html_col, least_bytes)
    return rows.mapInArrow(run, "path string, records bigint, bytes bigint")


# -- reading ----------------------------------------------------------------------


class Damaged(Exception):
    """A check that does not hold."""


class Source:
    """Random access to a file in bounded pieces."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.at, self.piece = 0, b""

    def read(self, start: int, count: int) -> bytes:
        """Up to count bytes from start, fewer at the end of the file."""
        count = max(0, min(count, self.size - start))
        inside = start - self.at
        if inside < 0 or inside + count > len(self.piece):
            self.at, inside = start, 0
            self.piece = self.file.read_at(min(max(count, READ_BYTES), self.size - start), start)
        return self.piece[inside : inside + count]

    def find(self, what: tuple[bytes, ...], start: int) -> int:
        """First place at or after start at which one of the strings begins, or the end."""
        overlap = max(map(len, what)) - 1
        while start < self.size:
            data = self.read(start, READ_BYTES)
            places = [p for p in map(data.find, what) if p >= 0]
            if places:
                return start + min(places)
            if start + len(data) >= self.size:
                break
            start += len(data) - overlap
        return self.size


def parse_header(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without a name")
        fields[name.strip().lower()] = value.strip()
    return fields


def check_record(head: bytes, block: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and payload of a record whose parts fit together."""
    fields = parse_header(head)
    if fields.get("content-length") != str(len(block)):
        raise Damaged("content length")
    given = fields.get("warc-block-digest")
    if given and given.startswith("sha1:") and given[5:] != digest32(block):
        raise Damaged("block digest")
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        payload = block.partition(END)[2]
    given = fields.get("warc-payload-digest")
    whole = fields.get("warc-type") != "revisit"
    if whole and given and given.startswith("sha1:") and given[5:] != digest32(payload):
        raise Damaged("payload digest")
    return fields, payload


def gzip_record(source: Source, start: int) -> tuple[int, dict[str, str], bytes]:
    """The record of the member at a place, and the place after it."""
    if source.read(start, 3) != GZIP:
        raise Damaged("no gzip member")
    unpacker, at, parts, known = zlib.decompressobj(31), start, [], False
    try:
        while not unpacker.eof:
            data = source.read(at, READ_BYTES)
            if not data:
                raise Damaged("gzip member cut short")
            parts.append(unpacker.decompress(data))
            at += len(data)
            if not known and sum(map(len, parts)) >= len(VERSIONS[0]):
                known = b"".join(parts).startswith(VERSIONS)
                if not known:
                    raise Damaged("no version line")
    except zlib.error as error:
        raise Damaged("gzip member") from error
    text = b"".join(parts)
    head, found, rest = text.partition(END)
    if not known or not found:
        raise Damaged("header")
    if not rest.endswith(END):
        raise Damaged("end of record")
    fields, payload = check_record(head, rest[: -len(END)])
    return at - len(unpacker.unused_data), fields, payload


def plain_extent(source: Source, start: int) -> tuple[bytes, int, int]:
    """Header, begin and end of the block of the plain record at a place."""
    if source.read(start, len(VERSIONS[0])) not in VERSIONS:
        raise Damaged("no version line")
    data = source.read(start, HEADER_LIMIT)
    size = data.find(END)
    if size < 0:
        raise Damaged("header")
    head = data[:size]
    length = parse_header(head).get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("content length")
    begin = start + size + len(END)
    if begin + int(length) + len(END) > source.size:
        raise Damaged("record cut short")
    return head, begin, begin + int(length)


def plain_record(source: Source, start: int) -> tuple[int, dict[str, str], bytes]:
    head, begin, end = plain_extent(source, start)
    if source.read(end, len(END)) != END:
        raise Damaged("end of record")
    fields, payload = check_record(head, source.read(begin, end - begin))
    return end + len(END), fields, payload


def next_plain(source: Source, start: int) -> int:
    """Where to look on after the damaged plain record at a place."""
    try:
        _, _, end = plain_extent(source, start)
        place = end + len(END)
        sound = source.read(end, len(END)) == END
        if sound and (place == source.size or source.read(place, 10) in VERSIONS):
            return place
    except Damaged:
        pass
    return source.find(VERSIONS, start + 1)


def salvage(source: Source) -> Iterator[tuple]:
    """("record", start, end, fields, payload) and ("gap", start, end, reason) in file order.

    Every byte of the file is in exactly one of them.
    """
    at, gap, reason = 0, None, ""
    packed = source.read(0, 2) == GZIP[:2] or source.find(VERSIONS, 0) == source.size
    while at < source.size:
        try:
            end, fields, payload = (gzip_record if packed else plain_record)(source, at)
        except Damaged as damage:
            if gap is None:
                gap, reason = at, str(damage)
            at = source.find((GZIP,), at + 1) if packed else next_plain(source, at)
            continue
        if gap is not None:
            yield "gap", gap, at, reason
            gap = None
        yield "record", at, end, fields, payload
        at = end
    if gap is not None:
        yield "gap", gap, source.size, reason


MOST_READERS = 20_000  # partitions; beyond it a task reads several archives

FOUND = (
    "path string, kind string, start bigint, end bigint, reason string, record_type string, "
    "target_uri string, payload_digest string, payload_bytes bigint, page_id bigint, "
    "refers_to bigint"
)


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def read_warc(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records and gaps of the archives in the column path; one archive is read by one task.

    kind is ``record`` or ``gap``; a gap has its bytes [start, end) and the reason. The
    length of a revisited payload is what its record states.
    """
    names = [f.split(" ")[0] for f in FOUND.split(", ")] + ["payload"] * with_payload
    schema = FOUND + (", payload binary" if with_payload else "")
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4]
    kinds += [pa.int64()] * 3 + [pa.binary()] * with_payload

    def row_of(path: str, found: tuple) -> tuple:
        kind, start, end, *rest = found
        if kind == "gap":
            return (path, kind, start, end, rest[0], *[None] * (len(names) - 5))
        fields, payload = rest
        size = _number(fields.get("x-payload-bytes"))
        whole = fields.get("warc-type") != "revisit"
        return (
            path,
            kind,
            start,
            end,
            None,
            fields.get("warc-type"),
            fields.get("warc-target-uri"),
            digest32(payload) if whole else fields.get("warc-payload-digest", "")[5:] or None,
            len(payload) if whole else size,
            _number(fields.get("x-page-id")),
            _number(fields.get("x-refers-to-page-id")),
            *[payload] * with_payload,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = file_system(path)
                size, rows, held = system.get_file_info(place).size, [], 0
                with system.open_input_file(place) as file:
                    for found in salvage(Source(file, size)):
                        rows.append(row_of(path, found))
                        held += 100 + (len(rows[-1][-1] or b"") if with_payload else 0)
                        if held > 8 * READ_BYTES:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    return files.select("path").mapInArrow(run, schema)


def written_archives(spark: SparkSession, pages: DataFrame, **options) -> DataFrame:
    """Write the pages to the shared folder and return the table of archives."""
    scratch = Scratch(spark, "warc")
    written = write_warc(pages, scratch.path("archives"), **options)
    return scratch.write(written, "files")


def spread(files: DataFrame) -> DataFrame:
    """A partition for each archive, up to MOST_READERS of them; a given number of partitions is
    one that adaptive execution does not merge, small as the rows are."""
    return files.repartition(min(max(files.count(), 1), MOST_READERS))


def op1_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = read_warc(spread(written_archives(spark, pages)))
    return found.where("kind = 'record'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = {
    "op1_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS hex FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS least FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS INTEGER), 5))::BIGINT
      >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31) AS INTEGER) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = least THEN NULL ELSE least END AS refers_to
FROM m
"""
}
