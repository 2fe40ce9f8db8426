"""ARC archives converted to WARC.

An ARC file is a version block followed by records: a header line whose fields the version defines, and so many bytes
as it declares. The converter reads both versions by their header lines and lengths and makes the WARC records that
would have been written: record ids from the content, timestamps from archive dates, types from URL, media type and
content (the version block becomes a ``warcinfo`` record), digests of block and payload. A payload that another record holds is stored once; the others become revisit records. WARC files
are written with Spark's text writer, one file a task, and read back by declared lengths.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import map_rows, stage

#: Fixed values of the two formats: the fields of a header line by ARC version, the end of a WARC record.
ARC_FIELDS = {
    "1": ("url", "ip", "date", "type", "length"),
    "2": ("url", "ip", "date", "type", "code", "checksum", "location", "offset", "filename", "length"),
}
ARC_NAMES = {
    "1": b"URL IP-address Archive-date Content-type Archive-length",
    "2": b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
RECORD_END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

#: Record types that hold an HTTP answer.
ANSWERS = ("response", "revisit")
_DATE, _ADDRESS = re.compile(r"\d{14}"), re.compile(r"[0-9A-Fa-f.:]+|-")

#: Pages and bytes in one ARC file.
ARC_RECORDS = 256
ARC_BYTES = 1 << 23
ARC_DATE = "20000101000000"
#: Header of the stored answer that carries the row's key.
KEY_HEADER = "X-Row-Key"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def arc_url(url: str | None) -> str:
    """A URL that can stand in a header line: white space, control and other characters are escaped."""
    return quote(url or "", safe="!#$%&'()*+,/:;=?@[]~") or "unknown:"


def arc_file(version: str, name: str, records: list[tuple[str, bytes]]) -> bytes:
    """An ARC file of the given version over (url, stored answer)."""
    names = ARC_NAMES[version]
    block = f"{version} 0 Origin\n".encode() + names + b"\n"
    out = [f"filedesc://{name} 0.0.0.0 {ARC_DATE} text/plain {_more(version, 0, name)}{len(block)}\n".encode() + block]
    at = len(out[0])
    for url, answer in records:
        head = f"\n{url} 0.0.0.0 {ARC_DATE} text/html {_more(version, at, name)}{len(answer)}\n".encode()
        out += [head, answer]
        at += len(head) + len(answer)
    return b"".join(out)


def _more(version: str, offset: int, name: str) -> str:
    return f"200 - - {offset} {name} " if version == "2" else ""


def arc_header(line: bytes, version: str) -> dict[str, str]:
    """Fields of a header line.

    A URL and a media type may hold spaces, so the fields are taken from both ends: the archive date and the address
    before it part the URL from the rest, and what follows the media type has a fixed number of fields.
    """
    parts, names = line.decode("utf-8", "surrogateescape").split(" "), ARC_FIELDS[version]
    tail = len(names) - names.index("type") - 1
    dates = [i for i in range(len(parts) - tail - 1) if _DATE.fullmatch(parts[i]) and i >= 2 and _ADDRESS.fullmatch(parts[i - 1])]
    if not dates:
        raise ValueError(f"No archive date in the header line {line[:200]!r}.")
    at, behind = dates[-1], len(parts) - tail
    fields = [" ".join(parts[: at - 1]), parts[at - 1], parts[at], " ".join(parts[at + 1 : behind]), *parts[behind:]]
    return dict(zip(names, fields))


def read_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of each record; the first is the version block, whose URL names the file.

    A record that the file cuts short has the content that is there.
    """
    end = data.index(b"\n")
    size = int(data[:end].rsplit(b" ", 1)[1])
    body = data[end + 1 : end + 1 + size]
    version = body.split(b" ", 1)[0].decode()
    yield arc_header(data[:end], version), body
    at = end + 1 + len(body)
    while at < len(data):
        if data[at : at + 1] == b"\n":  # records are parted by a line end
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            return
        header = arc_header(data[at:end], version)
        size = int(header["length"])
        yield header, data[end + 1 : end + 1 + size]
        at = end + 1 + size


def record_kind(header: dict[str, str], content: bytes) -> str:
    """The WARC type: the version block is ``warcinfo``, an HTTP answer ``response``, all else ``resource``."""
    scheme = header["url"].partition(":")[0].lower()
    if scheme == "filedesc":
        return "warcinfo"
    other = header["type"].lower().startswith("text/dns")
    return "response" if content.startswith(b"HTTP/") and scheme != "dns" and not other else "resource"


def pages_to_arc(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """ARC files over pages, both versions in turn, as rows of ``arc``; a page is an HTTP answer with its key."""

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        held, size, files = [], 0, 0
        for row_key, address, body in given:
            payload = bytes(body) if body is not None else b""
            known = "" if row_key is None else str(row_key)
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{KEY_HEADER}: {known}\r\n\r\n"
            held.append((arc_url(address), head.encode() + payload))
            size += len(payload)
            if len(held) >= ARC_RECORDS or size >= ARC_BYTES:
                yield (arc_file("12"[files % 2], f"pages-{files}.arc", held),)
                held, size, files = [], 0, files + 1
        if held:
            yield (arc_file("12"[files % 2], f"pages-{files}.arc", held),)

    given = pages.select(F.col(key), F.col(url).cast("string"), F.col(html).cast("string").cast("binary"))
    return map_rows(given, "arc binary", rows, 1)


def convert_arc(arcs: DataFrame, arc_col: str = "arc") -> DataFrame:
    """Records of ARC files as the fields of WARC records.

    Columns: ``kind`` (see ``record_kind``), ``media`` (type of the block), ``row_key`` (null if the answer names none),
    ``uri``, ``date``, ``head`` (of an HTTP answer, else empty), ``payload``, ``digest`` (of the payload).
    """

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        for (data,) in given:
            for header, content in read_arc(bytes(data)):
                kind, media, head, payload = record_kind(header, content), header["type"], b"", content
                if kind == "response":
                    head, _, payload = content.partition(b"\r\n\r\n")
                    head, media = head + b"\r\n\r\n", "application/http; msgtype=response"
                d = header["date"]
                date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
                known = _fields(head).get(KEY_HEADER.lower()) or None
                yield kind, media, known, header["url"], date, head, payload, payload_digest(payload)

    schema = (
        "kind string, media string, row_key string, uri string, date string, head binary, payload binary, digest string"
    )
    return map_rows(arcs.select(F.col(arc_col)), schema, rows, 64)


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def record_id(uri: str, date: str, row_key: str | None, digest: str) -> str:
    """The same record always gets the same id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri} {date} {row_key} {digest}')}>"


def warc_record(row: tuple) -> bytes:
    """One record without its end."""
    kind, media, row_key, uri, date, head, payload, digest, first_key, first_uri, first_date = row
    revisit = kind == "response" and first_key is not None and first_key != row_key
    block = bytes(head) if revisit else bytes(head) + bytes(payload)
    lines = [
        "WARC/1.0",
        f"WARC-Type: {'revisit' if revisit else kind}",
        f"WARC-Record-ID: {record_id(uri, date, row_key, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Filename: {uri.removeprefix('filedesc://')}" if kind == "warcinfo" else f"WARC-Target-URI: {uri}",
        f"Content-Type: {media}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(first_uri, first_date, first_key, digest)}",
            f"WARC-Refers-To-Target-URI: {first_uri}",
            f"WARC-Refers-To-Date: {first_date}",
            f"X-Refers-To-Key: {first_key}",
        ]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def write_warc(records: DataFrame, path: str, folder: str, least_bytes: int = 0) -> None:
    """Write converted records as compressed WARC files, each payload of ``least_bytes`` or more once.

    The record with the largest key (as a number) holds the payload, the others refer to it. Only one row a payload is
    joined to the records, so a payload that many records share is not gathered anywhere. Only answers are shared.
    ``folder`` takes the table of digests.
    """
    number = F.col("row_key").cast("long")
    shared = (F.octet_length("payload") >= least_bytes) & number.isNotNull() & (F.col("kind") == "response")
    narrow = records.where(shared).select(F.col("digest").alias("fd"), number.alias("fk"), "uri", "date")
    narrow = stage(narrow, folder, "digests")  # so that archives are converted for this and for the files only
    firsts = narrow.groupBy(F.col("fd").alias("d")).agg(F.max("fk").alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.join(narrow, (F.col("d") == F.col("fd")) & (F.col("first") == F.col("fk")))
    firsts = firsts.groupBy("d", "first").agg(F.min("uri").alias("first_uri"), F.min("date").alias("first_date"))
    joined = records.join(firsts, (F.col("digest") == F.col("d")) & shared, "left")
    fields = ["kind", "media", "row_key", "uri", "date", "head", "payload", "digest"]
    fields += [F.col("first").cast("string"), "first_uri", "first_date"]

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        for row in given:
            yield (warc_record(row),)

    lines = map_rows(joined.select(*fields), "value binary", rows, 64).select(F.col("value").cast("string"))
    lines.write.option("lineSep", RECORD_END.decode()).option("compression", "gzip").text(path)


def read_warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, by declared lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        header = _fields(data[at:end])
        size = int(header["content-length"])
        yield header, data[end + 4 : end + 4 + size]
        at = end + 4 + size + len(RECORD_END)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: key, type, uri, date, ids, declared and actual payload length and digest."""

    def rows(given: Iterator[tuple]) -> Iterator[tuple]:
        for (data,) in given:
            for header, block in read_warc_records(gzip.decompress(data)):
                kind = header["warc-type"]
                head, _, payload = block.partition(b"\r\n\r\n") if kind in ANSWERS else (b"", b"", block)
                known = _fields(head).get(KEY_HEADER.lower()) or None
                digest = header["warc-payload-digest"].removeprefix("sha1:")
                if kind != "revisit" and payload_digest(payload) != digest:
                    raise ValueError(f"{header['warc-record-id']} does not have the digest that it declares.")
                size = int(header["x-payload-length"]) if kind == "revisit" else len(payload)
                yield (
                    known, kind, header.get("warc-target-uri"), header["warc-date"], header["warc-record-id"],
                    header.get("warc-refers-to"), header.get("x-refers-to-key"), size, digest,
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    schema = (
        "row_key string, record_type string, uri string, date string, record_id string, refers_to_id string, "
        "refers_to_key string, payload_bytes long, payload_digest string"
    )
    return map_rows(files, schema, rows)


def pages_through_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages to ARC, ARC to WARC files in ``folder``, and what is read back, one row a page.

    A null page is empty; pages with one key and payload are all responses if that key is the largest; a page without
    a key is a response that nothing refers to. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = f"{folder}/warc"
    write_warc(convert_arc(pages_to_arc(pages, key, url, html)), path, folder)
    kind = pages.schema[key].dataType.simpleString()
    back = read_warc(spark, path).where(F.col("record_type").isin(*ANSWERS))
    return back.select(
        F.col("row_key").cast(kind).alias(key),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to_key").cast(kind).alias("refers_to"),
        "record_id",
        "uri",
    )
