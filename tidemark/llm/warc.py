"""WARC archives as a Python data source, and pages written to them with repeated payloads as revisits.

``spark.read.format("warc").load(folder)`` gives a row for each record. A folder is what ``write`` left: gzip files,
one member a record, and a ``_manifest`` naming the files of committed tasks with the places where ranges start.
Each member's header carries its compressed length (the ``sl`` extra field of the WARC format's annex on gzip), so a
reader steps over a record it does not want without inflating its payload.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from tidemark.session import share_code, work_dir

VERSION = b"WARC/1.1\r\n"
RANGE_BYTES = 8 << 20
FILE_BYTES = 256 << 20
HEAD_BYTES = 4096
MANIFEST = "_manifest"
WRITTEN = "record_id string, warc_type string, target_uri string, refers_to string, payload_digest string, payload_length long, payload binary"
HEADERS = {"record_id": "WARC-Record-ID", "warc_type": "WARC-Type", "target_uri": "WARC-Target-URI", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}


def _store(folder: str):
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))


def digest_of(payload: bytes) -> str:
    """Upper-case base32 of the payload's SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(name: str, value) -> str:
    """A header line. Line ends and control characters in a value, as in a broken URL, are percent-encoded."""
    return "" if value is None else name + ": " + "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(value)) + "\r\n"


def pack(record: dict) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header only, with the length of the payload it stands for."""
    payload = b"" if record["warc_type"] == "revisit" else record["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {record['payload_length']}\r\n\r\n".encode()
    head = "".join(_line(HEADERS[c], v) for c, v in (
        ("warc_type", record["warc_type"]), ("record_id", record["record_id"]), ("target_uri", record["target_uri"]), ("refers_to", record["refers_to"]),
        ("payload_digest", record["payload_digest"] and "sha1:" + record["payload_digest"]),
    )) + _line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if record["warc_type"] == "revisit" else None)
    head += _line("Content-Type", "application/http; msgtype=response") + _line("Content-Length", len(http) + len(payload))
    plain = VERSION + head.encode() + b"\r\n" + http + payload + b"\r\n\r\n"
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(plain) + deflate.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(plain) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v}


class Torn(ValueError):
    """The bytes of a member end inside its headers."""


def unpack(member: bytes, wanted, with_payload: bool, verify: bool) -> tuple | None:
    """The record of a gzip member (from its first byte), or None if ``wanted`` refuses its headers.

    Only the first bytes are inflated until the headers are whole and accepted; ``Torn`` if ``member`` is cut before.
    """
    inflate = zlib.decompressobj(31)
    plain, rest = b"", member
    while (end := plain.find(b"\r\n\r\n")) < 0:
        more = inflate.decompress(rest, max(HEAD_BYTES, len(plain)))
        if not more:
            raise Torn("a WARC record ends inside its header")
        plain, rest = plain + more, inflate.unconsumed_tail
    if not plain.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    named = _headers(plain[:end])
    row = {c: named.get(h.lower()) for c, h in HEADERS.items()}
    row["payload_digest"] = row["payload_digest"] and row["payload_digest"].removeprefix("sha1:")
    if not all(row[c] in values for c, values in wanted.items()):
        return None
    full = with_payload and row["warc_type"] != "revisit"
    while (split := plain.find(b"\r\n\r\n", end + 4)) < 0 or full and rest:
        more = inflate.decompress(rest, 0 if full else max(HEAD_BYTES, len(plain)))
        if not more:
            if not inflate.eof:
                raise Torn("a WARC record ends inside its HTTP header or payload")
            break
        plain, rest = plain + more, inflate.unconsumed_tail
    length = _headers(plain[end + 4 : split]).get("content-length")
    payload = None
    if full:
        payload = plain[split + 4 : end + 4 + int(named["content-length"])]
        if verify and digest_of(payload) != row["payload_digest"]:
            raise ValueError(f"payload of {row['record_id']} does not have its digest")
    return (row["record_id"], row["warc_type"], row["target_uri"], row["refers_to"], row["payload_digest"], length and int(length), *([payload] if with_payload else []))


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcReader(DataSourceReader):
    def __init__(self, folder: str, payload: bool, verify: bool):
        self.folder, self.payload, self.verify, self.wanted = folder, payload, verify, {}

    def pushFilters(self, filters: list) -> Iterator:
        """Takes equality and IN on header columns; the others stay with Spark."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo | In):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted.get(name, values) & values - {None}
            else:
                yield f

    def partitions(self) -> list[Range]:
        store, root = _store(self.folder)
        with store.open_input_stream(f"{root}/{MANIFEST}", compression=None) as manifest:
            files = json.loads(manifest.read())
        cuts = [(name, starts) for name, starts in files if len(starts) > 1]
        return [Range(name, a, b) for name, starts in cuts for a, b in zip(starts, starts[1:])] or [Range("", 0, 0)]

    def _headers(self, file, member: bytes, size: int) -> tuple[tuple | None, bytes]:
        """The record without its payload and the bytes read of it: twice as many as long as its headers go on."""
        while True:
            try:
                return unpack(member, self.wanted, False, False), member
            except Torn:
                more = file.read(min(size - len(member), len(member)))
                if not more:
                    raise
                member += more

    def read(self, part: Range) -> Iterator[tuple]:
        if not part.path:
            return
        store, root = _store(self.folder)
        with store.open_input_file(f"{root}/{part.path}") as file:
            at = part.start
            while at < part.end:
                file.seek(at)
                lead = file.read(24)
                if lead[:4] != b"\x1f\x8b\x08\x04" or lead[12:14] != b"sl":
                    raise ValueError("a gzip member without its length")
                size = struct.unpack("<I", lead[16:20])[0]
                # headers first: a refused record costs these few bytes
                member = lead + file.read(min(size - 24, HEAD_BYTES))
                if self.payload and (not self.wanted or len(member) == size):
                    row = unpack(member + file.read(size - len(member)), self.wanted, True, self.verify)
                else:
                    row, member = self._headers(file, member, size)
                    if row is not None and self.payload:
                        row = unpack(member + file.read(size - len(member)), self.wanted, True, self.verify)
                if row is not None:
                    yield row
                at += size


class WarcWriter(DataSourceWriter):
    """Each task attempt writes files of its own name; only those in the manifest, written at the end, are read."""

    def __init__(self, folder: str, columns: list[str]):
        self.folder, self.columns = folder, columns

    def write(self, rows: Iterator) -> Written:
        store, root = _store(self.folder)
        store.create_dir(root, recursive=True)
        files, out, starts, at = [], None, [0], 0

        def close():
            if out is not None:
                out.close()
                files.append((name, [*starts, at] if at > starts[-1] else starts))

        for row in rows:
            if out is None or at >= FILE_BYTES:
                close()
                name, starts, at = f"part-{uuid.uuid4().hex}.warc.gz", [0], 0
                out = store.open_output_stream(f"{root}/{name}", compression=None)
            member = pack(dict(zip(self.columns, row)))
            if at - starts[-1] >= RANGE_BYTES:
                starts.append(at)
            out.write(member)
            at += len(member)
        close()
        return Written(files)

    def commit(self, messages: list) -> None:
        store, root = _store(self.folder)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{MANIFEST}", compression=None) as manifest:
            manifest.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages: list) -> None:
        """Files of a failed job stay unnamed in the manifest and so unread."""


class WarcSource(DataSource):
    """Options of a read: ``payload`` (default true; false gives headers only), ``verify`` (false; true compares each payload with its digest)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def _flag(self, name: str, default: str) -> bool:
        return self.options.get(name, default).lower() == "true"

    def schema(self) -> str:
        return WRITTEN if self._flag("payload", "true") else WRITTEN.rpartition(",")[0]

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], self._flag("payload", "true"), self._flag("verify", "false"))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], schema.names)


def register(spark: SparkSession) -> None:
    share_code(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


ID = "urn:x-page:"


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """The records of a table of pages, ready to be written.

    The payload is the html in UTF-8, empty where null. Of records with equal payloads of at least ``least_bytes``
    bytes the one with the smallest id is the response and the others revisit it; shorter ones are all responses.
    Repeated rows of the smallest id are responses too. Rows without id get a record id without number; they are
    revisits if a row with an id has their payload. A null url is left out of the header.
    """
    payload = F.coalesce(F.encode(F.col(html_col), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("target_uri"), payload.alias("payload"), F.sha1(payload).alias("_sha"))
    first = (
        rows.where(F.octet_length("payload") >= least_bytes).groupBy("_sha").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1").drop("_n")
    )
    found = rows.join(first, "_sha", "left")
    again = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("_id"))
    return found.select(
        F.concat(F.lit(f"<{ID}"), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit(">")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("warc_type"), "target_uri",
        F.when(again, F.concat(F.lit(f"<{ID}"), F.col("_first").cast("string"), F.lit(">"))).alias("refers_to"),
        _base32(F.col("_sha")).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def _base32(sha1_hex):
    """Base32 of a SHA-1 in hex: five hex digits are four of base32."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    def four(i):
        value = F.conv(F.substring(sha1_hex, 5 * i + 1, 5), 16, 10).cast("int")
        return F.concat(*(letters.substr((F.shiftright(value, s).bitwiseAND(31) + 1), F.lit(1)) for s in (15, 10, 5, 0)))

    return F.concat(*(four(i) for i in range(8)))


def archive(pages: DataFrame, folder: str, **columns) -> None:
    """Write ``records`` of the pages to a new folder."""
    register(pages.sparkSession)
    records(pages, **columns).write.format("warc").mode("append").save(folder)


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Per record: page id, payload bytes and digest, type and the id referred to. Responses are read with their
    payload, whose length and verified digest count; of revisits only the headers are read."""
    register(spark)
    number = lambda c: F.nullif(F.regexp_extract(F.col(c), r"<" + ID + r"(-?\d*)>", 1), F.lit("")).cast("long")
    whole = spark.read.format("warc").option("verify", "true").load(folder).where(F.col("warc_type") == "response")
    brief = spark.read.format("warc").option("payload", "false").load(folder).where(F.col("warc_type") == "revisit")
    shown = [number("record_id").alias("page_id"), "_bytes", "payload_digest", F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to")]
    rows = whole.withColumn("_bytes", F.octet_length("payload").cast("long")).select(*shown).unionByName(brief.withColumn("_bytes", F.col("payload_length")).select(*shown))
    return rows.withColumnRenamed("_bytes", "payload_bytes")


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives in the shared folder and read back."""
    spark = pages.sparkSession
    folder = work_dir(spark, "warc")
    archive(pages, folder)
    return read_back(spark, folder)


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS s, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
           ((CAST('0x' || substr(s, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
       CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN f <> page_id THEN f END AS refers_to
FROM d
"""
