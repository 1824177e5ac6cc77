"""Legacy archives to WARC: parse ARC (versions 1 and 2) by declared lengths, write equivalent WARC records.

An ARC file begins with a version block, whose lines name the version and the fields of every record's
header line; a record is that line and as many bytes as its last field declares. The converter takes the names
from the file, so both versions parse alike. It synthesises record id (a name-based UUID), 14-digit dates as
ISO timestamps, record type and SHA-256 digests. A payload seen before (the smallest key keeps
it) becomes a revisit record that refers to the first.

Archives are text files of Spark's text sink, one row (whole archive, about ARCHIVE_BYTES, gzip) a file,
and are read as binary files; nothing touches a local path.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

#: Bytes of an archive before compression, about: records are added until it has as many.
ARCHIVE_BYTES = 4 << 20
#: Payloads of fewer bytes are never revisits.
REVISIT_BYTES = 100

#: Fixed values of the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
KEY_HEADER = "X-Record-Key"

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of name-based UUIDs


# --- ARC -------------------------------------------------------------------------------------

def _arc_line(version: int, url: str, date: str, kind: str, length: int) -> str:
    known = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": kind, "Archive-length": str(length), "Result-code": "200"}
    return " ".join(known.get(f, "-") for f in ARC_FIELDS[version].split())


def _arc_files(date: str, batches: Iterator[pa.RecordBatch]):
    """Whole ARC files from (key, url, text) rows; versions alternate, as in a collection of several years."""
    held, size, made = [], 0, 0

    def whole(records: list[str], n: int) -> pa.RecordBatch:
        version = 1 + n % 2
        block = f"{version} 0 archive\n{ARC_FIELDS[version]}\n\n"
        head = _arc_line(version, f"filedesc://{n}.arc", date, "text/plain", len(block))
        lines = [f"{_arc_line(version, u, date, 'text/html', m)}\n{x}" for u, x, m in records]
        return pa.RecordBatch.from_arrays([pa.array(["\n".join([f"{head}\n{block}", *lines])], pa.string())], names=["value"])

    for batch in batches:
        for key, url, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            n = len(text.encode())
            mark = "" if key is None else f"{KEY_HEADER}: {key}\r\n"
            http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n{mark}\r\n{text}"
            url = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "") or "about:blank"
            length = len(http.encode())
            held.append((url, http, length))
            size += length
            if size >= ARCHIVE_BYTES:
                yield whole(held, made)
                held, size, made = [], 0, made + 1
    if held:
        yield whole(held, made)


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, content) of each record after the version block."""
    fields, at = None, 0
    while at < len(data):
        if data[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].rstrip(b"\r").decode()
        length = int(line.rsplit(" ", 1)[1])
        content = data[end + 1 : end + 1 + length]
        if len(content) != length:
            raise ValueError(f"record cut short: {line[:200]}")
        at = end + 1 + length
        if fields is None:
            version, names = content.decode().split("\n")[:2]
            if int(version.split()[0]) not in ARC_FIELDS:
                raise ValueError(f"unknown version: {version}")
            fields = names.split()
            continue
        # the URL comes first and may hold spaces in old files: count the other fields from the right
        yield dict(zip(fields, line.rsplit(" ", len(fields) - 1))), content


def _http(content: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """(head with its blank line, payload, header fields) of an HTTP response; other content is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content, {}
    head, mark, payload = content.partition(b"\r\n\r\n")
    lines = [x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:]]
    return head + mark, payload, {k: v.strip() for k, _, v in lines}


def _key(fields: dict[str, str]) -> int | None:
    return int(fields[KEY_HEADER]) if KEY_HEADER in fields else None


def _inflate(content: bytes) -> bytes:
    return zlib.decompress(content, 31) if content[:2] == b"\x1f\x8b" else content


_SEEN = "path string, nth long, key long, digest string, size long"


def _survey(batches: Iterator[pa.RecordBatch]):
    """What the revisit decision needs of each ARC record."""
    for batch in batches:
        for path, content in zip(*(c.to_pylist() for c in batch.columns)):
            rows = {"path": [], "nth": [], "key": [], "digest": [], "size": []}
            for nth, (_, record) in enumerate(parse_arc(_inflate(content))):
                _, payload, fields = _http(record)
                for name, x in zip(rows, (path, nth, _key(fields), hashlib.sha256(payload).hexdigest(), len(payload))):
                    rows[name].append(x)
            types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], names=list(rows))


# --- WARC ------------------------------------------------------------------------------------

def _record_id(url: str, date: str, key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{url} {date} {key} {digest}')}>"


def _iso(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def _warc_record(arc: dict[str, str], record: bytes, refers_to: int | None) -> bytes:
    head, payload, fields = _http(record)
    key, digest, url, date = _key(fields), hashlib.sha256(payload).hexdigest(), arc["URL"], arc["Archive-date"]
    block = head if refers_to is not None else record
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(url, date, key, digest)}",
        f"WARC-Date: {_iso(date)}", f"WARC-Target-URI: {url}", f"WARC-IP-Address: {arc['IP-address']}",
        f"Content-Type: {'application/http; msgtype=response' if head else arc['Content-type']}",
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Key: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _convert(key, files, revisits):
    """One WARC file from one ARC file; a path has one file row, or none if it was empty."""
    refers = dict(zip(revisits["nth"].to_pylist(), revisits["least"].to_pylist()))
    out = []
    for content in files["content"].to_pylist():
        out.append(b"".join(_warc_record(arc, record, refers.get(nth)) for nth, (arc, record) in enumerate(parse_arc(_inflate(content)))))
    # the sink ends each row with the last line feed of its last record
    return pa.table({"value": pa.array([x[:-1] for x in out if x], pa.binary()).cast(pa.string())})


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:80]}")
        fields = {k: v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin, length = end + 4, int(fields["Content-Length"])
        if data[begin + length : begin + length + 4] != b"\r\n\r\n":
            raise ValueError(f"record cut short: {lines[:3]}")
        yield fields, data[begin : begin + length]
        at = begin + length + 4


def _read(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for content in batch.column(0).to_pylist():
            rows = []
            for fields, block in parse_warc(_inflate(content)):
                _, payload, http = _http(block)
                whole = fields["WARC-Type"] == "response"
                rows.append((
                    _key(http), len(payload) if whole else int(http["Content-Length"]), fields["WARC-Payload-Digest"].partition(":")[2],
                    fields["WARC-Type"], int(fields["X-Refers-To-Key"]) if "X-Refers-To-Key" in fields else None,
                    fields["WARC-Record-ID"], fields["WARC-Date"], fields["WARC-Target-URI"], payload if whole else None,
                ))
            if rows:  # the sink may leave a file without records
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _READ_TYPES)], names=[x.split()[0] for x in _READ.split(", ")])


_READ = "key long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, date string, url string, payload binary"
_READ_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)


def _save(rows: DataFrame, folder: str) -> None:
    rows.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(folder)


def write_arc(pages: DataFrame, folder: str, key: str, url: str, text: str, date: str) -> None:
    """Write (key, url, text) rows as ARC files of alternating versions; key is an integer and may be null."""
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.col(text).cast("string").alias("text"))
    _save(rows.mapInArrow(partial(_arc_files, date), "value string"), folder)


def convert_arc(spark: SparkSession, arc_folder: str, warc_folder: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Convert every ARC file of a folder to a WARC file.

    Of records with equal payloads of at least ``revisit_bytes``, those with the smallest key are responses and
    the others revisits. Only digests and places are grouped; payloads are read where they lie, and compressed
    files move once to meet their list of revisits. A hot payload is one partial minimum per task.

    Defined cases: records without key are responses always; rows that repeat the smallest key are responses too; an empty
    folder gives an empty one.
    """
    files = _files(spark, arc_folder)
    seen = files.select("path", "content").mapInArrow(_survey, _SEEN).checkpoint()
    equal = seen.where((F.col("size") >= revisit_bytes) & F.col("key").isNotNull())
    least = equal.groupBy("digest").agg(F.min("key").alias("least"), F.count("*").alias("n")).where("n > 1")
    revisits = equal.join(least, "digest").where("key > least").select("path", "nth", "least")
    out = files.select("path", "content").groupBy("path").cogroup(revisits.groupBy("path")).applyInArrow(_convert, "value string")
    _save(out, warc_folder)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: key, payload_bytes and payload_digest of the full payload, record_type, refers_to, record_id, date,
    url, payload (null for revisits)."""
    return _files(spark, folder).select("content").mapInArrow(_read, _READ)


def op4_arc_to_warc(spark, sf_dir: str) -> DataFrame:
    """Pages as legacy archives, converted to WARC and read back."""
    base = f"{ensure_checkpoint_dir(spark)}/archives-{uuid.uuid4().hex}"
    write_arc(spark.read.parquet(f"{sf_dir}/pages.parquet"), f"{base}/arc", "page_id", "url", "html", "20200101000000")
    convert_arc(spark, f"{base}/arc", f"{base}/warc")
    out = read_warc(spark, f"{base}/warc")
    return out.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, min(page_id) AS least FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > least THEN least END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)
"""
