"""ARC to WARC: parse legacy archives, synthesise equivalent WARC records, write and read them.

An ARC file starts with a version block whose body names the version: records of version 1
have a header line of five fields, those of version 2 one of ten, the last of which is the
length of the document that follows.  Each record gets a WARC identifier derived from its
place and content, a type from its document, a timestamp and SHA-1 digests.  Of records with equal
payloads the first is a response; the others become revisits that refer to it and keep the
HTTP header only.

Archives travel as rows (name, content); records are parsed in Python tasks.  Spark's text
writer stores WARC records (its line separator is the blank line behind a record), and its
binary file reader reads them, so any file system that Spark knows will do, and a lost task
is written again.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator, Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.common import salted_join

ARC_BYTES = 4 << 20
END = "\r\n\r\n"
# The names of the header fields of both versions.
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD = ("record_id string, warc_type string, target_uri string, ip string, date string, content_type string, "
          "payload_digest string, block_digest string, payload_bytes bigint, head binary, payload binary, truncated boolean")
FOUND = ("record_id string, warc_type string, target_uri string, date string, payload_digest string, refers_to_id string, "
         "payload_bytes bigint, intact boolean, head binary")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def warc_date(text: str) -> str:
    """14 digits, or fewer of them, as a WARC timestamp; the epoch if they are no time."""
    digits = re.sub(r"\D", "", text)[:14]
    padded = digits + "00000101000000"[len(digits):] if len(digits) >= 4 else ""
    try:
        return datetime.strptime(padded, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


# --- ARC --------------------------------------------------------------------


def _clean(value: object) -> str:
    """A header field of an ARC line: no white space, and never empty."""
    return re.sub(r"[\s\x00]", lambda m: f"%{ord(m[0]):02X}", str(value)) if value not in (None, "") else "-"


def version_block(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 adtally\n{' '.join(FIELDS[version])}\n\n".encode()
    extra = "" if version == 1 else "200 - - 0 " + _clean(name) + " "
    return f"filedesc://{_clean(name)} 0.0.0.0 {date} text/plain {extra}{len(body)}\n".encode() + body


def arc_record(url: str | None, date: str, kind: str, document: bytes, version: int, name: str, offset: int) -> bytes:
    extra = "" if version == 1 else f"200 {digest(document)} - {offset} {_clean(name)} "
    line = f"{_clean(url)} 0.0.0.0 {date} {kind} {extra}{len(document)}\n"
    return line.encode("utf-8", "surrogatepass") + document + b"\n"


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                  date: str = "20200101000000", arc_bytes: int = ARC_BYTES) -> DataFrame:
    """ARC files (name, content) of about ``arc_bytes`` that hold a page per row.

    Versions 1 and 2 take turns.  The key travels as HTTP header ``X-Page-Id``, left out if
    null; a null URL is ``-`` and white space in one is percent-encoded; a null page is empty.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, parts, size = TaskContext.get().partitionId(), 0, [], 0
        name = lambda: f"pages-{part:06d}-{number:06d}.arc"
        done = lambda: pa.RecordBatch.from_arrays([pa.array([name()]), pa.array([b"".join(parts)], pa.binary())],
                                                  names=["name", "content"])
        for batch in batches:
            for k, u, h in zip(*batch.columns):
                body = (h.as_py() or "").encode("utf-8", "surrogatepass")
                own = f"X-Page-Id: {k.as_py()}\r\n" if k.is_valid else ""
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(body)}\r\n\r\n"
                version = 1 + number % 2
                if not parts:
                    parts.append(version_block(name(), version, date))
                    size = len(parts[0])
                parts.append(arc_record(u.as_py(), date, "text/html", head.encode() + body, version, name(), size))
                size += len(parts[-1])
                if size >= arc_bytes:
                    yield done()
                    number, parts, size = number + 1, [], 0
        if parts:
            yield done()

    rows = pages.select(F.col(key).cast("string"), F.col(url).cast("string"), F.col(html).cast("string"))
    return rows.mapInArrow(write, "name string, content binary")


def read_archives(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Archive files as rows (name, content)."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def parse_arc(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes, bool]]:
    """(offset, header fields, document, truncated) of each record, the version block first.

    Lines that are no header of the archive's version are passed over until one is; a
    document that ends early is given as far as it goes.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    names, at = FIELDS[1], 0
    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        first = at == 0 and line.startswith("filedesc://")
        # The version is known only from the block's body; its own line is of either kind.
        options = FIELDS.values() if first else [names]
        cells = next((c for o in options if len(c := line.rsplit(" ", len(o) - 1)) == len(o) and c[-1].isdigit()
                      and c[2].isdigit() and not (first and " " in c[0])), None)
        if cells is None:
            at = end + 1
            continue
        length, start = int(cells[-1]), end + 1
        document = data[start:start + length]
        if first:
            version = document.split(b" ", 1)[0].strip()
            names = FIELDS.get(int(version) if version.isdigit() else 1, FIELDS[1])
        used = FIELDS[1] if len(cells) == 5 else FIELDS[2]
        yield at, dict(zip(used, cells)), document, len(document) < length
        at = start + length


def convert(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One WARC record per ARC record, the version block as warcinfo.

    HTTP documents are responses, others resources.  ``payloads=False`` leaves head and
    payload out, for passes that need digests only.  A null or empty archive has no records.
    """
    schema = pa.schema([("record_id", pa.string()), ("warc_type", pa.string()), ("target_uri", pa.string()), ("ip", pa.string()),
                        ("date", pa.string()), ("content_type", pa.string()), ("payload_digest", pa.string()),
                        ("block_digest", pa.string()), ("payload_bytes", pa.int64()), ("head", pa.binary()),
                        ("payload", pa.binary()), ("truncated", pa.bool_())])

    def records(name: str | None, data: bytes | None) -> Iterator[tuple]:
        for offset, header, document, truncated in parse_arc(data or b""):
            uri = None if header["URL"] == "-" else header["URL"]
            head, payload = b"", document
            if document.startswith(b"HTTP/"):
                kind, content = "response", "application/http; msgtype=response"
                cut = document.find(b"\r\n\r\n")
                cut = len(document) if cut < 0 else cut + 4
                head, payload = document[:cut], document[cut:]
            elif offset == 0 and uri is not None and uri.startswith("filedesc:"):
                kind, content = "warcinfo", "application/warc-fields"
                uri, payload = None, f"software: adtally\r\nformat: WARC File Format 1.0\r\ndescription: {name}\r\n".encode()
            else:
                kind, content = "resource", header["Content-type"]
            own = digest(payload)
            place = uuid.uuid5(uuid.NAMESPACE_URL, f"{name}#{offset}#{own}")
            yield (f"<urn:uuid:{place}>", kind, uri, header["IP-address"], warc_date(header["Archive-date"]), content, own,
                   digest(head + payload), len(payload), head if payloads else None, payload if payloads else None, truncated)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(*batch.columns):
                rows = list(records(name.as_py(), data.as_py()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return archives.select("name", "content").mapInArrow(parse, RECORD)


# --- WARC -------------------------------------------------------------------


def with_revisits(records: DataFrame, digests: DataFrame, order: Sequence[str], min_bytes: int = 0) -> DataFrame:
    """``records`` with ``refers``: of equal payloads the first by ``order`` has none.

    ``digests`` are the same records without payloads; both have the columns of ``order``,
    in which null comes last.  Payloads under ``min_bytes`` are never revisits.  The
    firsts are combined on the map side and joined to salted parts of a frequent digest.
    """
    rank = [x for c in order for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))]
    able = (F.col("warc_type") == "response") & (F.col("payload_bytes") >= min_bytes)
    firsts = (digests.filter(able).groupBy("payload_digest")
              .agg(F.min(F.struct(*rank, "record_id", "target_uri", "date")).alias("refers")))
    refers = F.when(able & (F.col("refers.record_id") != F.col("record_id")), F.col("refers"))
    narrow = firsts.select("payload_digest", F.struct("refers.record_id", "refers.target_uri", "refers.date").alias("refers"))
    return salted_join(records, narrow, ["payload_digest"]).withColumn("refers", refers)


def warc_text(records: DataFrame) -> DataFrame:
    """Records as WARC text, without the blank line behind each.  Bytes stay as they are."""
    revisit = F.col("refers").isNotNull()
    block = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))
    field = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    header: list[Column] = [
        F.lit("WARC/1.0\r\n"), field("WARC-Type", F.when(revisit, "revisit").otherwise(F.col("warc_type"))),
        field("WARC-Record-ID", F.col("record_id")), field("WARC-Date", F.col("date")),
        field("WARC-Target-URI", F.col("target_uri")), field("WARC-IP-Address", F.col("ip")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        field("WARC-Block-Digest", F.when(~revisit, F.concat(F.lit("sha1:"), "block_digest"))),
        field("WARC-Refers-To", F.col("refers.record_id")), field("WARC-Refers-To-Target-URI", F.col("refers.target_uri")),
        field("WARC-Refers-To-Date", F.col("refers.date")), field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        field("WARC-Truncated", F.when(F.col("truncated"), "length")), field("Content-Type", F.col("content_type")),
        field("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block.cast("string")]
    return records.select(F.concat(*header).alias("value"))


def write_warc(records: DataFrame, path: str, compress: bool = True) -> None:
    (warc_text(records).write.mode("overwrite").option("lineSep", END)
     .option("compression", "gzip" if compress else "none").text(path))


def parse_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a WARC stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:60]!r}")
        header = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            header[name.strip().lower()] = value.strip()
        yield header, stream.read(int(header["content-length"]))


def read_warc(archives: DataFrame) -> DataFrame:
    """The records of WARC files (name, content), payload sizes and digests checked.

    A response's size and digest are those of the payload that is there, and ``intact``
    says whether the digest is the declared one; a revisit's are the declared ones.
    """
    schema = pa.schema([("record_id", pa.string()), ("warc_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
                        ("payload_digest", pa.string()), ("refers_to_id", pa.string()), ("payload_bytes", pa.int64()),
                        ("intact", pa.bool_()), ("head", pa.binary())])

    def rows(data: bytes) -> Iterator[tuple]:
        stream = io.BytesIO(data)
        stream = gzip.GzipFile(fileobj=stream) if data[:2] == b"\x1f\x8b" else stream
        for header, block in parse_warc(io.BufferedReader(stream)):
            kind, declared = header["warc-type"], header.get("warc-payload-digest", "").removeprefix("sha1:")
            head, payload = b"", block
            if header.get("content-type", "").startswith("application/http"):
                cut = block.find(b"\r\n\r\n") + 4
                head, payload = (block, b"") if cut < 4 else (block[:cut], block[cut:])
            if kind == "revisit":
                size = re.search(rb"(?im)^content-length:\s*(\d+)", head)
                size, own = int(size[1]) if size else None, declared
            else:
                size, own = len(payload), digest(payload)
            yield (header["warc-record-id"], kind, header.get("warc-target-uri"), header["warc-date"], own,
                   header.get("warc-refers-to"), size, own == declared, head)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                found = list(rows(data.as_py() or b""))
                for i in range(0, len(found), 1000):
                    part = found[i:i + 1000]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)

    return archives.select("content").mapInArrow(parse, FOUND)


def page_id(head: Column) -> Column:
    """The ``X-Page-Id`` of an HTTP header."""
    return F.regexp_extract(head.cast("string"), r"\r\nX-Page-Id: ([^\r]*)\r\n", 1).try_cast("bigint")


def pages_through_warc(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Pages put into ARC files, converted, written as WARC below ``path`` and read back.

    Returns page_id, url, payload_bytes, payload_digest, record_type and refers_to (the
    page_id of the response a revisit refers to).  Of equal payloads the smallest page_id
    is the response; a null one comes last, and rows that repeat one tie by record.  Other
    columns are ignored; no pages give no rows.
    """
    arcs = archive_pages(pages)
    key = page_id(F.col("head"))
    full = convert(arcs).withColumn("page_id", key)
    write_warc(with_revisits(full, full.drop("payload"), ["page_id"], min_bytes), path)
    index = f"{path}-index"  # one row per record without its block, so that the archives are read once
    found = read_warc(read_archives(pages.sparkSession, path)).filter(F.col("warc_type").isin("response", "revisit"))
    found.withColumn("page_id", key).drop("head").write.mode("overwrite").parquet(index)
    found = pages.sparkSession.read.parquet(index)
    responses = found.filter(F.col("warc_type") == "response").select(F.col("record_id").alias("refers_to_id"),
                                                                     F.col("page_id").alias("refers_to"))
    revisits = found.filter(F.col("warc_type") == "revisit").join(responses, "refers_to_id", "left")
    own = found.filter(F.col("warc_type") == "response").withColumn("refers_to", F.lit(None).cast("bigint"))
    columns = ["page_id", F.col("target_uri").alias("url"), "payload_bytes", "payload_digest",
               F.col("warc_type").alias("record_type"), "refers_to"]
    return own.select(*columns).unionAll(revisits.select(*columns))
