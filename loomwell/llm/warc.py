"""Legacy archives: ARC records become WARC records, and archives are written and read back through Spark.

An ARC record is one header line, whose fields depend on the archive's version, then as many bytes as it declares.
Conversion makes what WARC wants and ARC lacks: a record id and a date from the header line, a type, and digests.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwell.llm.common import shared_dir

#: Fields of a record's header line by version of the archive (fixed values).
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "code", "checksum", "location", "offset", "filename", "length"),
}
#: Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 1000
#: Bytes after which a task starts another archive file; with one record more, what a reader holds at once.
SEGMENT = 8 << 20
#: When pages count as fetched: the table has no dates.
PAGE_DATE = "20240102030405"
_END = "\r\n\r\n"


def arc_bytes(version: int, name: str, records: list[tuple[dict[str, str], bytes]]) -> bytes:
    """An ARC file: its version block, then each record behind a header line of that version."""
    block = f"{version} 0 loomwell\n{' '.join(ARC_FIELDS[version])}\n".encode()
    head = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": "20240101000000", "type": "text/plain", "code": "200", "checksum": "-", "location": "-", "offset": "0", "filename": name}
    out = b""
    for fields, content in [(head, block), *records]:
        line = " ".join(str(len(content)) if f == "length" else fields.get(f) or "-" for f in ARC_FIELDS[version])
        out += line.encode() + b"\n" + content + b"\n"
    return out


def parse_arc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, content) of an ARC file's records, its version block left out.

    The version is read from the file's first block. A header line with too few or many fields, or a declared length
    beyond the end, is a ValueError: what follows can't be located.
    """
    at, version = 0, None
    while at < len(raw):
        if raw[at : at + 1] == b"\n":
            at += 1
            continue
        end = raw.find(b"\n", at)
        parts = raw[at : end if end >= 0 else len(raw)].decode("utf-8", "replace").rstrip("\r").split(" ")
        if not parts[-1].isdigit():
            raise ValueError(f"no declared length at byte {at}")
        size = int(parts[-1])
        content = raw[end + 1 : end + 1 + size]
        if end < 0 or len(content) < size:
            raise ValueError(f"record at byte {at} ends early")
        at = end + 1 + size
        if version is None:
            version = int(content.split(b" ", 1)[0])
            continue
        if len(parts) != len(ARC_FIELDS[version]):
            raise ValueError(f"header line of {len(parts)} fields in an archive of version {version}")
        yield dict(zip(ARC_FIELDS[version], parts, strict=True)), content


def record_id(url: str, date: str, digest: str, key: str = "") -> str:
    """A stable identifier: the same record gets the same one wherever and however often it is converted."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join((url, date, digest, key)))}>"


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """(HTTP head with its empty line, payload); contents that don't begin with a status line are all payload."""
    if content.startswith(b"HTTP/") and (end := content.find(b"\r\n\r\n")) >= 0:
        return content[: end + 4], content[end + 4 :]
    return b"", content


def to_warc(fields: dict[str, str], content: bytes, refers: str | None = None, key: str = "", more: dict[str, str] | None = None) -> bytes:
    """The WARC record of an ARC record: a response (or resource, without an HTTP head), or a revisit of record ``refers``.

    The record is returned without the two line ends that close it in an archive.
    """
    head, payload = split_http(content)
    digest = hashlib.sha1(payload).hexdigest()
    d = fields["date"].ljust(14, "0")
    kind = "revisit" if refers else "response" if head else "resource"
    block = head if refers else content
    lines = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(fields["url"], fields["date"], digest, key),
        "WARC-Date": f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
        "WARC-Target-URI": fields["url"],
        "WARC-IP-Address": fields["ip"],
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{hashlib.sha1(block).hexdigest()}",
        "Content-Type": "application/http;msgtype=response" if head else fields["type"],
        "Content-Length": str(len(block)),
    }
    if refers:
        lines |= {"WARC-Refers-To": refers, "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    lines |= more or {}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()).encode() + b"\r\n" + block


def parse_warc(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records of a WARC file, by declared lengths; ValueError where one doesn't fit."""
    at = 0
    while at < len(raw):
        end = raw.find(b"\r\n\r\n", at)
        if end < 0 or not raw.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(x.split(": ", 1) for x in raw[at:end].decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        block = raw[end + 4 : end + 4 + size]
        if len(block) < size or raw[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} has another length than declared")
        yield fields, block
        at = end + 8 + size


def page_key(head: bytes) -> str:
    """The page's id in an HTTP head, as text; empty if it has none."""
    return next((x[11:].decode() for x in head.split(b"\r\n") if x.lower().startswith(b"x-page-id: ")), "")


def plain_url(url: str | None) -> str:
    return quote(url or "-", safe=":/?#[]@!$&'()*+,;=%-._~")


def pages_to_arc(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Pages as one-record ARC files (column arc): the page's id is an HTTP header, versions 1 and 2 take turns by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arcs = []
            for key, url, html in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
                head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if key is None else key}\r\n\r\n"
                fields = {"url": plain_url(url), "ip": "192.0.2.1", "date": PAGE_DATE, "type": "text/html", "code": "200"}
                arcs.append(arc_bytes(1 + (key or 0) % 2, "pages.arc", [(fields, head.encode() + (html or "").encode())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], pa.array(arcs, pa.binary())], [*batch.schema.names[3:], "arc"])

    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"), "refers", "refers_url").mapInArrow(run, "refers long, refers_url string, arc binary")


def convert(arcs: DataFrame) -> DataFrame:
    """(segment, record): the WARC records of ARC files; ``refers`` and ``refers_url`` are the page that a page's payload was seen at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = size = 0
        for batch in batches:
            segments, records = [], []
            for refers, url, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for fields, content in parse_arc(raw):
                    head, payload = split_http(content)
                    target = None if refers is None else record_id(plain_url(url), fields["date"], hashlib.sha1(payload).hexdigest(), str(refers))
                    records.append(to_warc(fields, content, target, page_key(head)))
                    segments.append(segment)
                    size += len(records[-1])
                    if size > SEGMENT:
                        segment, size = segment + 1, 0
            yield pa.RecordBatch.from_arrays([pa.array(segments, pa.int32()), pa.array(records, pa.binary())], ["segment", "record"])

    return arcs.select("refers", "refers_url", "arc").mapInArrow(run, "segment int, record binary")


def write_archives(records: DataFrame, path: str) -> None:
    """Write records as gzipped WARC files of about SEGMENT bytes before compression. Spark's text writer puts the bytes down as they are, each record
    closed by its line separator, under Spark's commit protocol."""
    records.select("segment", F.col("record").cast("string").alias("value")).write.mode("overwrite").partitionBy("segment").option("lineSep", _END).option("compression", "gzip").text(path)


def _plain(raw: bytes) -> bytes:
    return gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw


def read_records(spark, path: str) -> DataFrame:
    """Rows (page_id, payload_bytes, payload_digest, record_type, record_id, refers, url) of the records of WARC files, gzipped or
    not; a revisit has no payload and so no payload_bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers", "url"]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 5]
        for batch in batches:
            for raw in batch.column(0):
                rows = []
                for fields, block in parse_warc(_plain(raw.as_py())):
                    head, payload = split_http(block)
                    digest, revisit, key = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit", page_key(head)
                    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't have its digest")
                    rows.append((int(key) if key else None, None if revisit else len(payload), digest, fields["WARC-Type"], fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), fields["WARC-Target-URI"]))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, refers string, url string")


def read_archives(spark, path: str) -> DataFrame:
    """Rows (page_id, payload_bytes, payload_digest, record_type, refers_to, url): revisits are resolved by the identifier that they
    refer to, from whose record they have refers_to and payload_bytes. Equal identifiers (rows that repeat a page) resolve once."""
    rows = read_records(spark, path)
    seen = rows.where("record_type <> 'revisit'").groupBy(F.col("record_id").alias("__w_id")).agg(F.first("page_id").alias("__w_page"), F.first("payload_bytes").alias("__w_size"))
    asked = rows.where("record_type = 'revisit'").select(F.col("refers").alias("__w_id")).distinct()
    # Only responses that something refers to meet the revisits; one row an identifier, so a response of many revisits splits well.
    seen = seen.join(asked, "__w_id", "left_semi")
    out = rows.join(seen, F.col("refers") == F.col("__w_id"), "left")
    return out.select("page_id", F.coalesce("payload_bytes", "__w_size").alias("payload_bytes"), "payload_digest", "record_type", F.col("__w_page").alias("refers_to"), "url")


def archive_pages(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Convert pages from ARC to WARC, write the archives and read them back.

    Of payloads of LEAST_REVISIT bytes or more that are equal, the page of the largest id is a response and the others
    revisit it (a null id is never the largest: such a page revisits one with an id, if there is one). Null html is an
    empty payload, a null url is written as "-". Ids must be integers. Rows that repeat the largest id are all responses;
    where they repeat it with several urls, revisits refer to one of those records. Extra columns are
    ignored; an empty table gives no rows. ``path``: where archives go; by default a new folder in the shared one.
    """
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    raw = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    # Ids that aren't integers stop the job under ANSI rules, as they do anywhere below.
    own = pages.select(F.col(id_col).cast("long").alias(id_col), url_col, html_col).withColumns({"__w_d": F.sha1(raw), "__w_n": F.octet_length(raw)})
    # Digests with two pages or more only; the join back is one that Spark may broadcast or split.
    seen = own.where(F.col("__w_n") >= LEAST_REVISIT).groupBy("__w_d", "__w_n").agg(F.max(id_col).cast("long").alias("__w_top"), F.max_by(F.coalesce(F.col(url_col).cast("string"), F.lit("")), id_col).alias("refers_url"), F.count("*").alias("__w_m")).where("__w_m > 1")
    roles = own.join(seen, ["__w_d", "__w_n"], "left").withColumn("refers", F.when(~F.col(id_col).eqNullSafe(F.col("__w_top")), F.col("__w_top")))
    write_archives(convert(pages_to_arc(roles, id_col, url_col, html_col)), path)
    return read_archives(spark, path)
