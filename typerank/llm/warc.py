"""WARC archives: a writer, and a reader that salvages damaged files.

The writer makes one gzip member per record. Records of equal payloads are written once, as
a response; the others are revisits that refer to it. Spark's text writer puts the members
into files (its line separator is an empty gzip member), so commits and retries are Spark's.

The reader checks every member and record: gzip checksum, version line, header fields,
lengths and the digests of block and payload. After a failed check it searches for the next
valid member (or, outside gzip, the next version line), goes on from there, and logs the
bytes between as a quarantined gap.
"""

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typerank.llm.common import staged
from typerank.sources.stage import new_folder

#: Payloads from this size on are written once.
LEAST_BYTES = 1000
#: Records of one file at most. A reader holds a whole file, and Spark reads files of less
#: than 2 GiB only, so pages of up to 100 kB on average, compressed, are safe.
FILE_RECORDS = 20_000
#: An empty gzip member, the separator of members.
_EMPTY_MEMBER = bytes.fromhex("1f8b080000000000000303000000000000000000")
_DATE = "2025-01-01T00:00:00Z"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
RECORDS = (
    "file string, kind string, start long, length long, reason string, warc_type string, record_id string, "
    "refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary"
)


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(text: str | None) -> str:
    """A header value: no line ends."""
    return re.sub(r"[\r\n]+", " ", text or "")


def record(page_id, url: str | None, payload: bytes, refers_to, sha1: str) -> bytes:
    """Bytes of one record; ``refers_to`` makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _line(url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()),
        ("WARC-Block-Digest", _digest(block)),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))])
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def marked_pages(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to) of every row.

    The digests that repeat are a stored table: few of them are sent to the pages, which
    are then not shuffled; with many, both sides are plain shuffles, and the planner splits
    a payload that a third of all pages share.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    copies = (
        rows.where(F.octet_length("payload") >= least).groupBy("sha1")
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first")).where("n > 1")
    )
    copies = staged(copies.select("sha1", "first"), "copies")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    marked = rows.join(copies, "sha1", "left").withColumn("refers_to", F.when(other, F.col("first")))
    return marked.select("page_id", "url", "payload", "refers_to", "sha1")


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """One record per row (page_id, url, html); ``path`` gets files of gzip members.

    Null html is an empty payload, a null url an empty field. Of rows with equal payloads of
    at least ``least`` bytes the one with the largest page_id is the response (all of them,
    if it repeats; a row without an id only if none has one). Other columns are not read.
    """
    marked = marked_pages(pages, least)

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to", "sha1"))
            for row in zip(*columns, strict=True):
                pack = zlib.compressobj(3, zlib.DEFLATED, 31)
                member = pack.compress(record(*row)) + pack.flush()
                yield pa.RecordBatch.from_arrays([pa.array([member], pa.binary())], ["value"])

    members = marked.mapInArrow(run, "value binary")
    (
        members.select(F.col("value").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1").option("lineSep", _EMPTY_MEMBER.decode("latin-1"))
        .option("maxRecordsPerFile", FILE_RECORDS).text(path)
    )


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            out[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    return out


def _hex(digest: str) -> str | None:
    kind, _, value = digest.partition(":")
    if kind.lower() != "sha1":
        return None
    value = value.strip()
    try:
        return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at ``at`` and the place after it; ValueError names a failed check."""
    version = _VERSION.match(data, at)
    if not version:
        raise ValueError("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise ValueError("header without an end")
    fields = _fields(data[version.end() : stop])
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        raise ValueError("header fields are missing")
    begin = stop + 4
    end = begin + int(fields["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("block of another length")
    block = data[begin:end]
    if (told := _hex(fields.get("warc-block-digest", ""))) and told != hashlib.sha1(block).hexdigest():
        raise ValueError("block digest differs")
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(length) if (length := _fields(http).get("content-length", "")).isdigit() else len(payload)
    digest = _hex(fields.get("warc-payload-digest", ""))
    if fields["warc-type"] == "revisit":
        payload = None
    else:
        own, size = hashlib.sha1(payload).hexdigest(), len(payload)
        if digest and digest != own:
            raise ValueError("payload digest differs")
        digest = own
    return {
        "warc_type": fields["warc-type"], "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to"),
        "target_uri": fields.get("warc-target-uri"), "payload_digest": digest, "payload_bytes": size, "payload": payload,
    }, end + 4


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """The gzip member at ``at`` and the place after it; fed in parts, so nothing is copied twice."""
    unpack, out, view = zlib.decompressobj(31), [], memoryview(data)
    while not unpack.eof:
        part = view[at : at + (1 << 16)]
        if not len(part):
            raise ValueError("member without an end")
        try:
            out.append(unpack.decompress(part))
        except zlib.error as error:
            raise ValueError(f"member: {error}") from None
        at += len(part) - len(unpack.unused_data)
    return b"".join(out), at


def salvage(data: bytes):
    """Records and gaps of one file, in order: (kind, start, length, reason, record).

    Records and gaps cover every byte but empty members and the line ends between records.
    """
    at, bad, reason, size = 0, None, None, len(data)
    while at < size:
        found, after = [], at
        try:
            if data[at : at + 2] == b"\x1f\x8b":
                text, after = _member(data, at)
                inner = 0
                while inner < len(text):
                    row, inner = parse(text, inner)
                    found.append(row)
            elif data[at : at + 5] == b"WARC/":
                row, after = parse(data, at)
                found.append(row)
            else:
                raise ValueError("neither a member nor a version line")
        except ValueError as error:
            # Records before the failed one inside a member are whole; the member is not.
            if bad is None:
                bad, reason = at, str(error)
            places = [x for x in (data.find(b"\x1f\x8b\x08", at + 1), data.find(b"WARC/1.", at + 1)) if x >= 0]
            at = min(places, default=size)
            if found:
                yield from (("record", bad, 0, None, row) for row in found)
            continue
        if bad is not None:
            yield "gap", bad, at - bad, reason, None
            bad = None
        for row in found:
            yield "record", at, after - at, None, row
        at = after
    if bad is not None:
        yield "gap", bad, size - bad, reason, None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``kind`` record and gap of all files under ``path``, whatever their names
    (Spark skips those that begin with a dot or an underscore).

    A gap has start, length and the reason of the first failed check, and no record fields.
    A file is read whole by one task, so it must be smaller than 2 GiB, else Spark raises
    an error; the writer's have ``FILE_RECORDS`` records at most. An empty file has no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                name, rows, size = batch.column("path")[i].as_py(), [], 0
                for kind, start, length, reason, row in salvage(batch.column("content")[i].as_py()):
                    rows.append({"file": name, "kind": kind, "start": start, "length": length, "reason": reason} | (row or {}))
                    size += len((row or {}).get("payload") or b"")
                    if size > 4 << 20 or len(rows) > 5000:
                        yield _rows(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows, names)

    return files.mapInArrow(run, RECORDS)


def _rows(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = {"start": pa.int64(), "length": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names], names)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as archives and read back: (page_id, payload_bytes, payload_digest,
    record_type, refers_to)."""
    spark = pages.sparkSession
    path = new_folder(spark, "llm-warc")
    write_archives(pages, path)
    page = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) AS BIGINT)")
    full = F.col("payload").isNotNull()
    return read_archives(spark, path).where("kind = 'record'").select(
        page("record_id").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(full, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        page("refers_to").alias("refers_to"),
    )
