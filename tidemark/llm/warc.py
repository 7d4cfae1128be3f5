"""WARC archives as a Python data source: ``spark.read.format("warc")`` and ``df.write``.

Reading. Every file of the path is a partition (small files share one). Predicates on
``record_type`` and on the header columns are pushed down: a record's headers are parsed first and a
record that fails is passed over. Records written here are gzip members that name their compressed
length in the ``sl`` extra field, so the reader inflates only the head of a member it passes over;
members without that field are inflated to find their end, but not parsed or kept. Payloads are not
decoded either when the option ``payload`` is false.

Writing. One file per task and ``roll_bytes``, one gzip member per record. The path may be anything
that ``pyarrow.fs`` opens (``file``, ``hdfs``, ``s3``, ``gs``), so it must be shared by all nodes.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, IsNotNull, IsNull,
    StringStartsWith, WriterCommitMessage)

from tidemark.session import fresh_path, settle

SCHEMA = ("record_id string, record_type string, date string, target_uri string, "
          "refers_to string, payload_digest string, content_length long, http_length long, "
          "payload binary")
#: Columns that come from the headers alone, with their header names.
HEADER_OF = {"record_id": "warc-record-id", "record_type": "warc-type", "date": "warc-date",
             "target_uri": "warc-target-uri", "refers_to": "warc-refers-to",
             "payload_digest": "warc-payload-digest"}
WRITE_SCHEMA = ("record_id string, record_type string, date string, target_uri string, "
                "refers_to string, payload_digest string, http_length long, payload binary")
ROLL_BYTES = 128 << 20
PACK_BYTES = 64 << 20
HEAD = 1 << 14
READ = 1 << 20


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def header_value(value: str) -> str:
    """A header value on one line: control characters and percent signs before them escaped."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def member(record: bytes) -> bytes:
    """One gzip member with its own and the record's length in an ``sl`` extra field."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF))


def record_bytes(row) -> bytes:
    """A record of a row of :data:`WRITE_SCHEMA`. A revisit keeps the HTTP head, not the payload."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"
            f"Content-Length: {row['http_length']}\r\n\r\n")
    block = http.encode() + (bytes(row["payload"] or b"") if row["record_type"] == "response"
                             else b"")
    heads = {"WARC-Type": row["record_type"], "WARC-Record-ID": row["record_id"],
             "WARC-Date": row["date"], "WARC-Target-URI": row["target_uri"],
             "WARC-Payload-Digest": row["payload_digest"], "WARC-Refers-To": row["refers_to"],
             "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
             if row["record_type"] == "revisit" else None,
             "Content-Type": "application/http; msgtype=response",
             "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {header_value(v)}\r\n" for k, v in heads.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    """Header names in lower case; the first line is the version."""
    lines = head.decode("utf-8", errors="replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    found: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            found[last] = value.strip()
    return found


class _Bytes:
    """A window over a file that is read forwards; what lies before ``at`` is let go."""

    def __init__(self, file):
        self.file, self.held, self.at = file, b"", 0

    def need(self, n: int) -> bool:
        """Whether ``n`` bytes are held from ``at`` on."""
        while len(self.held) - self.at < n:
            more = self.file.read(max(READ, n - (len(self.held) - self.at)))
            if not more:
                return False
            self.held, self.at = self.held[self.at:] + more, 0
        return True

    def skip(self, n: int) -> None:
        held = len(self.held) - self.at
        if n <= held:
            self.at += n
        else:
            self.file.seek(n - held, 1)
            self.held, self.at = b"", 0


class _Inflated:
    """The same window over the one gzip member that starts at the window's place."""

    def __init__(self, raw: _Bytes):
        self.raw, self.packer = raw, zlib.decompressobj(31)
        self.held, self.at, self.used = b"", 0, 0

    def need(self, n: int) -> bool:
        while len(self.held) - self.at < n and not self.packer.eof:
            if not self.raw.need(1):
                raise ValueError("a gzip member ends early")
            chunk = self.raw.held[self.raw.at:self.raw.at + READ]
            room = max(HEAD, n - (len(self.held) - self.at))
            out = self.packer.decompress(chunk, room)
            # at the member's end the rest is in unused_data, and may be in the tail as well
            rest = self.packer.unused_data if self.packer.eof else self.packer.unconsumed_tail
            taken = len(chunk) - len(rest)
            self.raw.at += taken
            self.used += taken
            self.held, self.at = self.held[self.at:] + out, 0
        return len(self.held) - self.at >= n

    def skip(self, n: int) -> None:
        while n:
            step = min(n, READ)
            if not self.need(step):
                raise ValueError("a record ends early")
            self.at += step
            n -= step

    def close(self, size: int | None) -> None:
        """Move the file to the end of the member: by its known size, or by inflating the rest."""
        if size is not None:
            self.raw.skip(size - self.used)
            return
        while not self.packer.eof:
            self.held, self.at = b"", 0
            self.need(1)


def _head(window) -> bytes | None:
    """The bytes up to the empty line, which is passed; None at the end."""
    if not window.need(1):
        return None
    n = HEAD
    while True:
        full = window.need(n)
        end = window.held.find(b"\r\n\r\n", window.at, window.at + n)
        if end >= 0:
            head = window.held[window.at:end]
            window.at = end + 4
            return head
        if not full:
            if window.held[window.at:].strip():
                raise ValueError("a record's headers end early")
            return None
        n *= 2


def _member_size(raw: _Bytes) -> int | None:
    if raw.need(24) and raw.held[raw.at + 3] & 4:
        length, = struct.unpack_from("<H", raw.held, raw.at + 10)
        if length >= 12 and raw.held[raw.at + 12:raw.at + 14] == b"sl":
            size, = struct.unpack_from("<I", raw.held, raw.at + 16)
            return size or None
    return None


def records(file, wanted, payload: bool = True, seen: dict | None = None) -> Iterator[tuple]:
    """Rows of :data:`SCHEMA` whose headers satisfy ``wanted``; plain or gzip members.

    ``seen`` counts ``heads`` parsed and ``payloads`` decoded.
    """
    raw = _Bytes(file)
    seen = {} if seen is None else seen
    while raw.need(1):
        packed = raw.need(2) and raw.held[raw.at:raw.at + 2] == b"\x1f\x8b"
        if not packed and raw.held[raw.at:raw.at + 1] in b"\r\n":
            raw.at += 1
            continue
        size = _member_size(raw) if packed else None
        window = _Inflated(raw) if packed else raw
        head = _head(window)
        if head is not None:
            heads = parse_head(head)
            seen["heads"] = seen.get("heads", 0) + 1
            n = int(heads.get("content-length", 0))
            if wanted(heads):
                yield _row(heads, n, window, payload, seen)
            elif not packed:
                window.skip(n)
        if packed:
            window.close(size)


def _row(heads: dict[str, str], n: int, window, payload: bool, seen: dict) -> tuple:
    http = {}
    rest = n
    if heads.get("content-type", "").startswith("application/http"):
        found = b""
        # the HTTP head is inside the block: never look behind it
        span, end = min(n, HEAD), -1
        while window.need(span):
            end = window.held.find(b"\r\n\r\n", window.at, window.at + span)
            if end >= 0 or span == n:
                break
            span = min(n, 2 * span)
        if end >= 0:
            found = window.held[window.at:end]
            rest -= end + 4 - window.at
            window.at = end + 4
        for line in found.decode("latin-1").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            http[name.strip().lower()] = value.strip()
    body = None
    if payload and heads.get("warc-type") != "revisit":
        if not window.need(rest):
            raise ValueError("a record ends early")
        body = window.held[window.at:window.at + rest]
        window.at += rest
        seen["payloads"] = seen.get("payloads", 0) + 1
    else:
        window.skip(rest)
    length = http.get("content-length", "")
    return (*[heads.get(h) for h in HEADER_OF.values()], n,
            int(length) if length.isdigit() else None, body)


@dataclass
class _Files(InputPartition):
    paths: list[str] = field(default_factory=list)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.filters: list = []

    def pushFilters(self, filters):
        """Take what the headers decide; everything else stays with Spark."""
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) else None
            if isinstance(f, EqualTo | In | IsNull | IsNotNull | StringStartsWith) \
                    and name in HEADER_OF and len(f.attribute) == 1:
                self.filters.append(f)
            else:
                yield f

    def wanted(self, heads: dict[str, str]) -> bool:
        for f in self.filters:
            value = heads.get(HEADER_OF[f.attribute[0]])
            if isinstance(f, EqualTo):
                ok = value is not None and value == f.value
            elif isinstance(f, In):
                ok = value is not None and value in f.value
            elif isinstance(f, IsNull):
                ok = value is None
            elif isinstance(f, IsNotNull):
                ok = value is not None
            else:
                ok = value is not None and value.startswith(f.value)
            if not ok:
                return False
        return True

    def partitions(self):
        """Files packed to about 64 MB; a larger file is a partition of its own."""
        system, place = open_path(self.path)
        info = system.get_file_info(place)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no archive at {self.path}")
        found = [info] if info.is_file else [
            f for f in system.get_file_info(fs.FileSelector(place, recursive=True))
            if f.is_file and f.base_name.endswith((".warc", ".warc.gz"))]
        parts, held = [_Files()], 0
        for f in sorted(found, key=lambda f: f.path):
            if parts[-1].paths and held + f.size > PACK_BYTES:
                parts.append(_Files())
                held = 0
            parts[-1].paths.append(f.path)
            held += f.size
        return parts

    def read(self, partition):
        system, _ = open_path(self.path)
        for path in partition.paths:
            with system.open_input_file(path) as file:
                yield from records(file, self.wanted, self.payload)


@dataclass
class _Written(WriterCommitMessage):
    paths: list[str]


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path = options["path"]
        self.roll = int(options.get("roll_bytes", ROLL_BYTES))
        if overwrite:
            raise ValueError("archives are appended to; give a new path instead of overwriting")

    def write(self, rows):
        system, place = open_path(self.path)
        system.create_dir(place, recursive=True)
        paths, file, held = [], None, 0
        try:
            for row in rows:
                if file is None:
                    # a dot in front until the job is committed: a lost task leaves nothing to read
                    paths.append(f"{place}/.{uuid.uuid4().hex}.warc.gz.part")
                    file, held = system.open_output_stream(paths[-1], compression=None), 0
                data = member(record_bytes(row))
                file.write(data)
                held += len(data)
                if held >= self.roll:
                    file.close()
                    file = None
        finally:
            if file is not None:
                file.close()
        return _Written(paths)

    def commit(self, messages):
        system, place = open_path(self.path)
        system.create_dir(place, recursive=True)
        for path in [p for m in messages if m for p in m.paths]:
            folder, _, name = path.rpartition("/")
            system.move(path, f"{folder}/{name[1:].removesuffix('.part')}")

    def abort(self, messages):
        system, _ = open_path(self.path)
        for path in [p for m in messages if m for p in m.paths]:
            system.delete_file(path)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known; filters are only pushed to Python sources when Spark is told so."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def page_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Rows of :data:`WRITE_SCHEMA` for ``page_id, url, html``.

    Of the rows with equal payloads of at least ``least_bytes`` bytes, those with the largest
    page_id are responses and the others revisit it; a null page_id is smaller than any number.
    The payloads are compared by SHA-1 and length.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    hashed = pages.select("page_id", "url", payload.alias("payload")).withColumns({
        "sha": F.sha1("payload"), "http_length": F.length("payload").cast("long")})
    narrow = hashed.filter(F.col("http_length") >= least_bytes)
    # pre-aggregated: a payload with a third of all rows is a row per task; only groups remain
    groups = settle(narrow.groupBy("sha", "http_length")
                    .agg(F.max("page_id").alias("keep"), F.count("*").alias("_n"))
                    .filter("_n > 1").select("sha", "http_length", "keep"), "payload-groups")
    known = hashed.join(groups, ["sha", "http_length"], "left")
    revisits = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))

    def urn(column: str):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"),
                                                        F.lit("null")), F.lit(">"))
    return known.select(
        urn("page_id").alias("record_id"),
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.lit("2024-01-01T00:00:00Z").alias("date"), F.col("url").alias("target_uri"),
        F.when(revisits, urn("keep")).alias("refers_to"),
        F.concat(F.lit("sha1:"), F.col("sha")).alias("payload_digest"), "http_length",
        F.when(~revisits, F.col("payload")).alias("payload"))


def write_pages(pages: DataFrame, path: str, least_bytes: int = 1000) -> None:
    """Archive every row of ``pages``; null html is an empty payload."""
    register(pages.sparkSession)
    page_records(pages, least_bytes).write.format("warc").mode("append").save(path)


def page_id_of(urn):
    return F.regexp_extract(urn, r"urn:page:(-?\d+)", 1).try_cast("long")


def round_trip(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` from written archives.

    Responses are read with their payloads, which are measured and digested anew; revisits by
    their headers alone. Row for row of ``pages``, also for repeated or null page_ids and an empty
    table; extra columns are ignored.
    """
    spark = pages.sparkSession
    path = fresh_path(spark, "archive")
    write_pages(pages, path, least_bytes)
    stored = spark.read.format("warc").load(path)
    full = stored.filter("record_type = 'response'").select(
        page_id_of("record_id").alias("page_id"), F.length("payload").cast("long")
        .alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"))
    brief = spark.read.format("warc").option("payload", "false").load(path).filter(
        "record_type = 'revisit'").select(
        page_id_of("record_id").alias("page_id"), F.col("http_length").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
        page_id_of("refers_to").alias("refers_to"))
    return full.unionByName(brief)
