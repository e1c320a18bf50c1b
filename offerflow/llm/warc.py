"""Convert legacy ARC archives to WARC: version-specific headers, declared lengths, synthesised WARC records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerflow import workdir

#: An archive file is closed once it holds this many bytes of records; a record is never cut.
SEGMENT = 16 << 20

# The field names of URL records by ARC version, as the version block states them.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_END = "\r\n\r\n"


def _sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _write(df: DataFrame, path: str, line_end: str) -> None:
    """Rows (segment, at, value binary) to one compressed file per segment, by ``at``, ``line_end`` after each value.

    Rows are sorted by segment and place here. Left to itself the writer sorts by segment alone, and rows of
    a segment lose their order where that sort spills; the segment is not null, so the writer takes this order as its own. The cast only relabels bytes, so payloads in any encoding stay as they are. Spark's committer
    publishes whole tasks, so a lost executor leaves no part of an archive.
    """
    rows = df.select(F.coalesce("segment", F.lit("")).alias("segment"), "at", F.col("value").cast("string").alias("value"))
    rows.sortWithinPartitions("segment", "at").drop("at").write.partitionBy("segment") \
        .option("lineSep", line_end).option("compression", "gzip").text(path)


def _segments(batches: Iterator[pa.RecordBatch], head: Callable[[str], bytes],
              record: Callable[[dict, str, int], bytes], names: str, line_end: str) -> Iterator[pa.RecordBatch]:
    """Records of a task in segments that each begin with ``head``, with their places. Segment names follow from the task."""
    number, size, part = 0, SEGMENT, TaskContext.get().partitionId()
    segment = ""
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            rows: list[tuple[str, int, bytes]] = []
            for row in batch.slice(low, 256).to_pylist():
                if size >= SEGMENT:
                    segment, size, number = f"{names}-{part:06d}-{number:04d}", 0, number + 1
                    rows.append((segment, 0, head(segment)))
                    size = len(rows[-1][2]) + len(line_end)
                rows.append((segment, size, record(row, segment, size)))
                size += len(rows[-1][2]) + len(line_end)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.binary())], ["segment", "at", "value"])


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 offerflow\n{ARC_FIELDS[version]}\n".encode()
    rest = "" if version == 1 else " 200 - - 0 " + name
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{rest} {len(body)}\n".encode() + body


def write_arc(pages: DataFrame, path: str, date: str = "20250101000000", versions: tuple[int, ...] = (1, 2),
              key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write pages as legacy ARC files; input partitions take the versions in turn.

    A record's content is an HTTP response whose headers carry the key. White space and control characters of a URL are
    escaped, since header fields are separated by spaces; a null URL becomes ``urn:none``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = versions[TaskContext.get().partitionId() % len(versions)]

        def record(row: dict, name: str, offset: int) -> bytes:
            payload = (row["html"] or "").encode()
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
            if row["key"] is not None:
                head += f"X-Page-Id: {row['key']}\r\n"
            content = head.encode() + b"\r\n" + payload
            address = re.sub(r"[\x00-\x20\x7f\s]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), row["url"] or "")
            fields = [address or "urn:none", "0.0.0.0", date, "text/html"]
            if version == 2:
                fields += ["200", hashlib.md5(content).hexdigest(), "-", str(offset), name]
            return " ".join([*fields, str(len(content))]).encode() + b"\n" + content

        return _segments(batches, lambda name: arc_version_block(version, name, date), record, "arc", "\n")

    given = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    _write(given.mapInArrow(run, "segment string, at long, value binary"), path, "\n")


def read_arc(data: bytes) -> Iterator[dict]:
    """The records of an ARC file: header fields by the version its version block states, and the content.

    The declared length alone says where a record ends. Blank lines between records are skipped.
    """
    at, fields = 0, []
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.index(b"\n", at)
        values = data[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        length = int(values[-1])
        content = data[end + 1:end + 1 + length]
        if len(content) < length:
            raise ValueError(f"record at {at} declares {length} bytes, {len(content)} are there")
        if values[0].startswith("filedesc://"):
            version = int(content.split(b" ", 1)[0])
            fields = ARC_FIELDS[version].split(" ")
        elif len(values) != len(fields):
            raise ValueError(f"record at {at} has {len(values)} header fields, its version has {len(fields)}")
        else:
            yield {**dict(zip(fields, values, strict=True)), "offset": at, "content": content}
        at = end + 1 + length


def split_http(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header block with its blank line, and payload; content that is no HTTP response is all payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    head, mark, payload = content.partition(b"\r\n\r\n")
    return (head + mark, payload) if mark else (content, b"")


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?mi)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace") if found else None


def _content(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    for path, content in zip(batch["path"], batch["content"], strict=True):
        data = content.as_py()
        yield path.as_py(), gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def _rows(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if len(held) >= 1024 or size >= SEGMENT:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def arc_records(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """A row per ARC record: ``file``, ``offset``, ``key``, ``url``, ``ip``, ``date``, ``mime``, ``digest``, ``bytes`` and its ``content``."""
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("key", pa.int64()), ("url", pa.string()), ("ip", pa.string()),
                        ("date", pa.string()), ("mime", pa.string()), ("digest", pa.string()), ("bytes", pa.int64())]
                       + [("content", pa.binary())] * content)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for file, data in _content(batch):
                for r in read_arc(data):
                    head, payload = split_http(r["content"])
                    key = http_field(head, "X-Page-Id")
                    row = (file, r["offset"], int(key) if key else None, r["URL"], r["IP-address"], r["Archive-date"], r["Content-type"],
                           _sha1(payload), len(payload))
                    yield (*row, r["content"]) if content else row

    types = ("file string, offset long, key long, url string, ip string, date string, mime string, digest string, bytes long"
             + ", content binary" * content)
    return _files(spark, path).mapInArrow(lambda b: _rows(records(b), schema), types)


def record_id(file: str, offset: int, url: str) -> str:
    """The same record gets the same identifier in every run and retry."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file.rsplit("/", 1)[-1]}#{offset}#{url}')}>"


def _warc(kind: str, identifier: str, date: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", identifier), ("WARC-Date", date), *fields, ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in lines), "\r\n"]).encode() + block


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = 0) -> None:
    """Write the ARC records below a folder as WARC files.

    Of records with equal payloads of at least ``least_bytes`` bytes, the one with the smallest key (null last,
    then by its place) becomes a response, the others revisits that refer to it and keep the HTTP headers only. Digests
    of shared payloads are found by an aggregate over narrow rows; a payload moves only if they are too many to broadcast.
    """
    narrow = arc_records(spark, arc_path, content=False).where(F.col("bytes") >= least_bytes)
    order = F.struct(F.col("key").isNull().alias("unknown"), "key", "file", "offset", "url", "date")
    shared = narrow.groupBy("digest", "bytes").agg(F.min(order).alias("f"), F.count("*").alias("n")).where("n > 1")
    first = workdir.written(shared.select(
        "digest", "bytes", F.col("f.file").alias("f_file"), F.col("f.offset").alias("f_offset"),
        F.col("f.url").alias("f_url"), F.col("f.date").alias("f_date")), "shared-payloads")

    def iso(date: str) -> str:
        d = date.ljust(14, "0")
        return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"

    def head(name: str) -> bytes:
        return _warc("warcinfo", record_id(name, 0, "warcinfo"), "2025-01-01T00:00:00Z",
                     [("WARC-Filename", f"{name}.warc.gz"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")

    def record(row: dict, name: str, offset: int) -> bytes:
        http, payload = split_http(row["content"])
        own = record_id(row["file"], row["offset"], row["url"])
        fields = [("WARC-Target-URI", row["url"]), ("WARC-IP-Address", row["ip"]),
                  ("WARC-Payload-Digest", f"sha1:{row['digest']}"), ("WARC-Block-Digest", "")]
        revisit = row["f_file"] is not None and (row["f_file"], row["f_offset"]) != (row["file"], row["offset"])
        block = http if revisit else row["content"]
        fields[-1] = ("WARC-Block-Digest", f"sha1:{_sha1(block)}")
        if revisit:
            fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       ("WARC-Refers-To", record_id(row["f_file"], row["f_offset"], row["f_url"])),
                       ("WARC-Refers-To-Target-URI", row["f_url"]), ("WARC-Refers-To-Date", iso(row["f_date"]))]
        kind = "revisit" if revisit else "response" if http else "resource"
        fields.append(("Content-Type", "application/http; msgtype=response" if http else row["mime"]))
        return _warc(kind, own, iso(row["date"]), fields, block)

    joined = arc_records(spark, arc_path).join(first, ["digest", "bytes"], "left")
    made = joined.mapInArrow(lambda b: _segments(b, head, record, "warc", WARC_END), "segment string, at long, value binary")
    _write(made, warc_path, WARC_END)


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields (lower case) and block of each record; Content-Length says where a block ends."""
    at = 0
    while at < len(data):
        if data[at:at + 1] in (b"\r", b"\n"):
            at += 1
            continue
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(fields["content-length"])
        block = data[end + 4:end + 4 + length]
        if len(block) < length:
            raise ValueError(f"record at {at} declares {length} bytes, {len(block)} are there")
        yield fields, block
        at = end + 4 + length


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per response, revisit or resource: ``id``, ``type``, ``key``, ``url``, ``date``, ``digest``, ``bytes``, ``refers_to`` (a record id).

    Digests of responses are computed from the payload that was read; one that differs from the declared
    digest is an error. A revisit has the digest and length of the payload it stands for.
    """
    schema = pa.schema([("id", pa.string()), ("type", pa.string()), ("key", pa.int64()), ("url", pa.string()), ("date", pa.string()),
                        ("digest", pa.string()), ("bytes", pa.int64()), ("refers_to", pa.string())])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for file, data in _content(batch):
                for fields, block in read_warc(data):
                    if fields["warc-type"] == "warcinfo":
                        continue
                    head, payload = split_http(block)
                    digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), len(payload)
                    if fields["warc-type"] == "revisit":
                        size = int(http_field(head, "Content-Length") or 0)
                    elif _sha1(payload) != digest:
                        raise ValueError(f"{file}: payload of {fields['warc-record-id']} is not what its digest says")
                    key = http_field(head, "X-Page-Id")
                    yield (fields["warc-record-id"], fields["warc-type"], int(key) if key else None, fields.get("warc-target-uri"),
                           fields["warc-date"], digest, size, fields.get("warc-refers-to"))

    return _files(spark, path).mapInArrow(
        lambda b: _rows(records(b), schema),
        "id string, type string, key long, url string, date string, digest string, bytes long, refers_to string")


def archived(pages: DataFrame, least_bytes: int = 0, key: str = "page_id", url: str = "url", html: str = "html",
             folder: str | None = None) -> DataFrame:
    """Pages through ARC and WARC files and back: ``key``, ``bytes``, ``digest``, ``type``, ``refers_to`` (a key).

    Null html is an empty payload. Null keys are kept, and are first among equal payloads only if no record
    has a key. Repeated rows are records each, of which one is the response. Very long pages are records of any length; the
    archive closes after them. Other columns are ignored. An empty table gives no archives and an empty result. ``folder``
    keeps the archives; else they lie in the shared folder.
    """
    spark = pages.sparkSession
    base = folder or workdir.new_path(spark, "archives")
    write_arc(pages, f"{base}/arc", key=key, url=url, html=html)
    convert(spark, f"{base}/arc", f"{base}/warc", least_bytes)
    records = workdir.written(warc_records(spark, f"{base}/warc"), "warc-records")
    named = records.select(F.col("id").alias("refers_to"), F.col("key").alias("refers_key"))
    wanted = records.where("refers_to is not null").select("refers_to").distinct()
    named = named.join(wanted, "refers_to")
    return records.join(named, "refers_to", "left").select("key", "bytes", "digest", "type", F.col("refers_key").alias("refers_to"))
