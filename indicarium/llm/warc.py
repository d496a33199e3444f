"""Legacy archive converter: ARC files in, WARC files out, both read and written by Spark.

An ARC file opens with a ``filedesc`` record that names its version. A
version 1 header line has five fields, a version 2 line ten; the last is
the declared length, after which the next header line follows. Each record
becomes a WARC record with an identifier made from its place in the
archive, an ISO time, a type and SHA-1 digests. Of records with equal
payloads of ``MIN_REVISIT`` bytes or more one is a response and the others
are revisits that name it and carry no payload.

Files are written by Spark's text writer, one row a file, and read as
binary files, so any store that Spark reaches will do; a file is ``FILE_BYTES``
long, or one record. Payloads are shuffled once at most, compressed, as
whole files, to meet what was decided about their records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium.llm.common import dropped, in_arrow, scratch, shipped, small_batches, staged, utf8

#: Uncompressed bytes of one archive file, about.
FILE_BYTES = 32 << 20
#: Shorter payloads are never revisits.
MIN_REVISIT = 1000

#: Fixed values of the ARC format: names of the header fields of each version.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"),
}
#: Fixed value of the WARC format: the profile of revisits of equal payloads.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

_STRAY = re.compile(rb"[\x00-\x20\x7f]")
_PAGE = re.compile(rb"(?im)^x-page-id: *(-?\d+) *\r?$")


@dataclass
class Record:
    """One ARC record: header fields by name, the record's bytes, its place in the file."""

    fields: dict[str, str]
    body: bytes
    offset: int
    version: int

    @property
    def http_head(self) -> bytes:
        """Status line and headers of a stored HTTP answer, with the blank line; empty for other records."""
        if not self.body.startswith(b"HTTP/") or (at := self.body.find(b"\r\n\r\n")) < 0:
            return b""
        return self.body[: at + 4]

    @property
    def payload(self) -> bytes:
        return self.body[len(self.http_head) :]

    @property
    def page_id(self) -> int | None:
        found = _PAGE.search(self.http_head)
        return int(found[1]) if found else None


def arc_line(version: int, url: bytes, ip: str, date: str, kind: str, body: bytes, status: int = 200, filename: str = "-", offset: int = 0) -> bytes:
    """A header line of the version; blanks and controls of the url are percent-encoded."""
    url = _STRAY.sub(lambda m: b"%%%02X" % m[0][0], url) or b"-"
    middle = f"{ip} {date} {kind}" if version == 1 else f"{ip} {date} {kind} {status} {hashlib.sha1(body).hexdigest()} - {offset} {filename}"
    return url + f" {middle} {len(body)}\n".encode()


def arc_open(version: int, date: str) -> bytes:
    """The ``filedesc`` record: version line, names of the fields, as the format asks for."""
    names = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}[version]
    body = f"{version} 0 indicarium\n{names}\n".encode()
    return arc_line(version, b"filedesc://pages.arc", "0.0.0.0", date, "text/plain", body) + body + b"\n"


def read_arc(data: bytes) -> Iterator[Record]:
    """The file's records, the ``filedesc`` first, by their declared lengths."""
    at, version = 0, 0
    while at < len(data):
        if data[at : at + 1] in b"\r\n":  # between records
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"an ARC header line at byte {at} has no end")
        parts = data[at:end].rstrip(b"\r").decode("utf-8", "replace").split(" ")
        if not version:
            first = data[end + 1 : end + 1 + int(parts[-1])]
            if not parts[0].startswith("filedesc:") or not (version := int(first.split(b" ", 1)[0])) in ARC_FIELDS:
                raise ValueError("no ARC file of a known version: its filedesc record is missing or names another one")
        names = ARC_FIELDS[version]
        if len(parts) != len(names):
            raise ValueError(f"an ARC header line at byte {at} has {len(parts)} fields; version {version} has {len(names)}")
        fields = dict(zip(names, parts))
        n = int(fields["length"])
        if end + 1 + n > len(data):
            raise ValueError(f"an ARC record at byte {at} declares {n} bytes; the file ends before")
        yield Record(fields, data[end + 1 : end + 1 + n], at, version)
        at = end + 1 + n


def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}>"


def warc_date(date: str) -> str:
    """ARC's 14 digits as an ISO time; digits that are missing at the end are the period's first."""
    d = (date + "00000101000000"[len(date) :])[:14] if date.isdigit() and len(date) >= 4 else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def to_warc(record: Record, archive: str, revisits: int | None = None, target: str | None = None) -> bytes:
    """The equivalent WARC record, up to and without the two line ends after its block.

    ``target`` is the identifier of the response that a revisit names, and
    ``revisits`` that response's page.
    """
    head = record.http_head
    if record.fields["url"].startswith("filedesc:"):
        kind, media, block = "warcinfo", "application/warc-fields", f"software: indicarium\r\nformat: WARC File Format 1.0\r\nisPartOf: ARC version {record.version}\r\n".encode()
    elif not head:
        kind, media, block = "resource", record.fields["type"], record.body
    else:
        kind, media, block = ("response", "application/http; msgtype=response", record.body) if target is None else ("revisit", "application/http; msgtype=response", head)
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(archive, record.offset)}", f"WARC-Date: {warc_date(record.fields['date'])}"]
    if kind != "warcinfo":
        lines += [f"WARC-Target-URI: {record.fields['url']}", f"WARC-Payload-Digest: {_digest(record.payload)}"]
        if record.fields["ip"] not in ("0.0.0.0", "-"):
            lines.append(f"WARC-IP-Address: {record.fields['ip']}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {target}", f"X-Refers-To-Page-Id: {revisits}", f"X-Payload-Length: {len(record.payload)}"]
    lines += [f"WARC-Block-Digest: {_digest(block)}", f"Content-Type: {media}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record, by its Content-Length."""
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])}
        n = int(head["content-length"])
        yield head, data[end + 4 : end + 4 + n]
        at = end + 4 + n


def _files(df: DataFrame, path: str) -> None:
    """One file a row, of the column ``data`` and one line end, gzipped."""
    df.select(F.col("data").cast("string")).write.option("maxRecordsPerFile", 1).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _opened(spark: SparkSession, path: str) -> DataFrame:
    """path, content: a row for each archive file, still compressed."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _bytes(content: pa.Scalar) -> bytes:
    return zlib.decompress(content.as_buffer(), wbits=47)


def write_arc(pages: DataFrame, path: str, version: int = 1, date: str = "20240101000000") -> None:
    """ARC files of (page_id, url, html): HTTP answers whose payload is the html in UTF-8, null as empty."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [arc_open(version, date)]
        size = len(parts[0])
        for batch in batches:
            for page, url, html in zip(batch.column("page_id").to_pylist(), utf8(batch.column("url")), utf8(batch.column("html"))):
                number = b"" if page is None else b"X-Page-Id: %d\r\n" % page
                body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + number + b"Content-Length: %d\r\n\r\n" % len(html) + html
                parts += [arc_line(version, url, "0.0.0.0", date, "text/html", body, offset=size), body, b"\n"]
                size += sum(map(len, parts[-3:]))
                if size >= FILE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["data"])
                    parts = [arc_open(version, date)]
                    size = len(parts[0])
        if len(parts) > 1:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["data"])

    _files(pages.select("page_id", "url", "html").mapInArrow(run, "data binary"), path)


def arc_index(spark: SparkSession, path: str) -> DataFrame:
    """archive, offset, page_id, payload_bytes, digest of every record but the ``filedesc``."""
    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"archive": [], "offset": [], "page_id": [], "payload_bytes": [], "digest": []}
        for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            for r in read_arc(_bytes(content)):
                if not r.fields["url"].startswith("filedesc:"):
                    for k, v in zip(out, (name, r.offset, r.page_id, len(r.payload), hashlib.sha1(r.payload).hexdigest())):
                        out[k].append(v)
        return out

    shipped(spark)
    return in_arrow(_opened(spark, path), run, "archive string, offset long, page_id long, payload_bytes long, digest string")


def convert_arc(spark: SparkSession, arc: str, warc: str, min_revisit: int = MIN_REVISIT) -> None:
    """WARC files in ``warc`` of the ARC files in ``arc``.

    The response of a payload is its record of largest page_id (null last, then
    by archive and offset). A payload that very many records share is
    combined before its shuffle and is a skewed key that AQE splits.
    """
    index = staged(arc_index(spark, arc), "arc-index")
    rank = F.struct(F.col("page_id").isNotNull().alias("has_id"), "page_id", "archive", "offset")
    best = index.where(F.col("payload_bytes") >= min_revisit).groupBy("digest").agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    late = index.where(F.col("payload_bytes") >= min_revisit).join(best, "digest").where(rank != F.col("best"))
    late = late.groupBy("archive").agg(F.collect_list(F.struct("offset", F.col("best.page_id").alias("page"), F.col("best.archive").alias("of"), F.col("best.offset").alias("at"))).alias("late"))
    # a row for each file: its records are FILE_BYTES long, or one; the files stream past the smaller side
    files = _opened(spark, arc).join(late.hint("shuffle_hash"), F.col("path") == F.col("archive"), "left").select("path", "content", "late")

    def run(batch: pa.RecordBatch) -> dict:
        out = []
        for name, content, late in zip(batch.column("path").to_pylist(), batch.column("content"), batch.column("late").to_pylist()):
            target = {x["offset"]: (x["page"], record_id(x["of"], x["at"])) for x in late or ()}
            records = [to_warc(r, name, *target.get(r.offset, (None, None))) for r in read_arc(_bytes(content))]
            out.append(b"\r\n\r\n".join(records) + b"\r\n\r")  # the writer adds the last line end
        return {"data": pa.array(out, pa.binary())}

    _files(in_arrow(files, run, "data binary"), warc)
    dropped(index)


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """Per record of the WARC files but ``warcinfo``: page_id, url, payload_bytes, payload_digest, record_type, refers_to, record_id."""
    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id")}
        for content in batch.column("content"):
            for head, block in read_warc(_bytes(content)):
                if head["warc-type"] == "warcinfo":
                    continue
                r = Record({"url": head["warc-target-uri"]}, block, 0, 0)
                n = int(head.get("x-payload-length", len(r.payload)))
                refers = head.get("x-refers-to-page-id")
                digest = base64.b32decode(head["warc-payload-digest"].partition(":")[2]).hex()
                if head["warc-type"] != "revisit" and digest != hashlib.sha1(r.payload).hexdigest():
                    raise ValueError(f"the payload of {head['warc-record-id']} is not what its digest says")
                for k, v in zip(out, (r.page_id, head["warc-target-uri"], n, digest, head["warc-type"], int(refers) if refers not in (None, "None") else None, head["warc-record-id"])):
                    out[k].append(v)
        return out

    shipped(spark)
    return in_arrow(_opened(spark, path), run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string")


def pages_through_warc(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``pages`` as ARC files of both versions, converted to WARC and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload, a null url is ``-``, a null page_id comes
    back null. Repeated rows are records each, one of them the response. An
    empty table gives no record.
    """
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    parity = F.pmod(F.xxhash64("page_id", "url"), F.lit(2))
    for version in (1, 2):
        write_arc(pages.where(parity == version - 1), f"{arc}/v{version}", version)
    convert_arc(spark, f"{arc}/*", warc)
    return warc_records(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
