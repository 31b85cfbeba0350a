"""WARC archives as a Spark data source, read and written.

Reading plans one partition per archive file.  Predicates on the record type and on headers are
pushed into the reader: headers are parsed first, and a record that no predicate wants, or whose
payload the schema does not ask for, is passed over without decoding its payload.  In compressed
archives each record is a gzip member; a member's skip lengths (the ``sl`` extra field of the WARC
standard, which the writer adds) let the reader jump to the next one without inflating it.

Files are opened through ``pyarrow.fs``, so any store it knows will do.  Tasks write files of their
own names; a manifest written at commit names the files that count, so output of failed attempts is
never read.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from ..session import materialise, work_path
from .common import pick

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, payload_digest string, "
    "payload_length long, refers_to string, headers map<string,string>, payload binary"
)
# Header that each text column is taken from; these can be filtered on before a payload is read.
HEADER_OF = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROLL_BYTES = 256 << 20
CHUNK = 1 << 20
_MANIFEST = re.compile(r"_manifest-[0-9a-f]+\.json")
_ARCHIVE = re.compile(r"[^_.].*\.warc(?:\.gz)?")


def _open_store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def parse_headers(block: bytes) -> dict[str, str]:
    """Named fields of a WARC or HTTP header block; folded lines continue the one above."""
    out: dict[str, str] = {}
    last = None
    for line in block.decode("utf-8", "replace").split("\n"):
        line = line.rstrip("\r")
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if colon:
            last = name.strip()
            out[last] = value.strip()
    return out


class _Member:
    """Bytes of one record, decoded on demand, from a plain or a compressed archive."""

    def __init__(self, stream, compressed: bool):
        self.stream, self.compressed = stream, compressed
        self.ahead = b""  # bytes read from the store but not used

    def begin(self) -> bool:
        """Stand at the next record; false at the end of the file."""
        self.plain = b""
        self.inflater = None
        self.skip_to = None
        if not self.compressed:
            while True:
                self._fill(1)
                stripped = self.ahead.lstrip(b"\r\n")
                if stripped or not self.ahead:
                    self.ahead = stripped
                    return bool(stripped)
                self.ahead = b""
        if not self._fill(18):
            return False
        self.skip_to = self._skip_length()
        self.read_raw = 0
        self.inflater = zlib.decompressobj(31)
        return True

    def _fill(self, n: int) -> bool:
        while len(self.ahead) < n:
            more = self.stream.read(CHUNK)
            if not more:
                break
            self.ahead += more
        return len(self.ahead) >= n

    def _skip_length(self) -> int | None:
        """Compressed length of this member, if its extra field tells."""
        head = self.ahead[:18]
        if head[:3] != b"\x1f\x8b\x08" or not head[3] & 4:
            return None
        size = struct.unpack_from("<H", head, 10)[0]
        self._fill(12 + size)
        extra, at = self.ahead[12 : 12 + size], 0
        while at + 4 <= len(extra):
            name, length = extra[at : at + 2], struct.unpack_from("<H", extra, at + 2)[0]
            if name == b"sl" and length == 8:
                return struct.unpack_from("<I", extra, at + 4)[0]
            at += 4 + length
        return None

    def more(self) -> bool:
        """Decode a little more of the record into ``plain``."""
        if not self.compressed:
            chunk = self.ahead or self.stream.read(CHUNK)
            self.plain, self.ahead = self.plain + chunk, b""
            return bool(chunk)
        if self.inflater.eof:
            return False
        chunk = self.ahead or self.stream.read(CHUNK)
        if not chunk:
            return False
        out = self.inflater.decompress(chunk, 4096 if not self.plain else 1 << 20)
        rest = self.inflater.unconsumed_tail or self.inflater.unused_data
        self.read_raw += len(chunk) - len(rest)
        self.ahead = rest
        self.plain += out
        return True

    def until_blank_line(self) -> bytes | None:
        """The header block, up to the first empty line; None if there is none."""
        while b"\r\n\r\n" not in self.plain:
            if not self.more():
                return None
        head, _, self.plain = self.plain.partition(b"\r\n\r\n")
        return head

    def block(self, length: int) -> bytes:
        while len(self.plain) < length and self.more():
            pass
        out, self.plain = self.plain[:length], self.plain[length:]
        return out

    def pass_over(self, length: int) -> None:
        """Go past ``length`` bytes of the record without keeping or, if possible, decoding them."""
        if self.compressed:
            if self.skip_to is not None:
                self._drop_raw(self.skip_to - self.read_raw)
                self.inflater = None
            else:
                while not self.inflater.eof and self.more():
                    self.plain = b""
            return
        left = length - len(self.plain)
        self.ahead, self.plain = self.plain[length:], b""
        if left > 0:
            self.ahead = b""
            self._drop_raw(left)

    def _drop_raw(self, n: int) -> None:
        if n <= len(self.ahead):
            self.ahead = self.ahead[n:]
            return
        n -= len(self.ahead)
        self.ahead = b""
        self.stream.seek(self.stream.tell() + n)

    def end(self) -> None:
        """Leave the record; what follows it stays for the next one."""
        if not self.compressed:
            self.ahead, self.plain = self.plain + self.ahead, b""
        elif self.inflater is not None:
            while not self.inflater.eof and self.more():
                self.plain = b""


def read_records(stream, compressed: bool, wanted, with_payload: bool) -> Iterator[dict]:
    """Records whose headers satisfy ``wanted``; payloads only if asked for."""
    member = _Member(stream, compressed)
    while member.begin():
        head = member.until_blank_line()
        if head is None:
            return
        headers = parse_headers(head)
        length = int(headers.get("Content-Length", 0))
        if not wanted(headers):
            member.pass_over(length)
            continue
        row = {name: headers.get(header) for name, header in HEADER_OF.items()}
        row["headers"] = headers
        digest = row["payload_digest"]
        row["payload_digest"] = digest.partition(":")[2] if digest and ":" in digest else digest
        row["payload"] = None
        http = headers.get("Content-Type", "").startswith("application/http")
        own = length
        if http:
            inner = member.until_blank_line() or b""
            own = max(0, length - len(inner) - 4)
            fields = parse_headers(inner)
            row["payload_length"] = int(fields.get("Content-Length", own))
        else:
            row["payload_length"] = own
        if with_payload and row["record_type"] != "revisit":
            row["payload"] = member.block(own)
            member.end()
        else:
            member.pass_over(own)
        yield row


@dataclass
class ArchiveFile(InputPartition):
    path: str
    size: int

    def __init__(self, path: str, size: int):
        super().__init__(path)
        self.path, self.size = path, size


@dataclass
class Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)
    records: int = 0


class WarcReader(DataSourceReader):
    """One partition per archive; ``pushed`` holds (header, kind, values) to test per record."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.path, self.pushed = schema, options["path"], []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            value = getattr(f, "value", None)
            if column in HEADER_OF and isinstance(f, EqualTo) and isinstance(value, str):
                self.pushed.append((column, "in", (value,)))
            elif column in HEADER_OF and isinstance(f, In):
                self.pushed.append((column, "in", tuple(value)))
            elif column in HEADER_OF and isinstance(f, StringStartsWith):
                self.pushed.append((column, "prefix", value))
            else:
                yield f

    def partitions(self) -> list[ArchiveFile]:
        store, root = _open_store(self.path)
        infos = store.get_file_info(fs.FileSelector(root, recursive=False, allow_not_found=False))
        files = {i.base_name: i for i in infos if i.is_file and _ARCHIVE.fullmatch(i.base_name)}
        manifests = [i for i in infos if i.is_file and _MANIFEST.fullmatch(i.base_name)]
        if manifests:
            named = set()
            for m in manifests:
                with store.open_input_stream(m.path) as source:
                    named.update(json.loads(source.read())["files"])
            files = {n: i for n, i in files.items() if n in named}
        return [ArchiveFile(i.path, i.size) for _, i in sorted(files.items())]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for column, kind, values in self.pushed:
            value = headers.get(HEADER_OF[column])
            if value and column == "payload_digest":
                value = value.partition(":")[2] or value
            if value is None:
                return False
            if value not in values if kind == "in" else not value.startswith(values):
                return False
        return True

    def read(self, partition: ArchiveFile | None) -> Iterator[tuple]:
        if partition is None:
            return
        store, _ = _open_store(self.path)
        names = self.schema.fieldNames()
        with store.open_input_file(partition.path) as stream:
            compressed = partition.path.endswith(".gz")
            for row in read_records(stream, compressed, self._wanted, "payload" in names):
                yield tuple(row.get(n) for n in names)


def _line(name: str, value: str | None) -> str:
    return "" if value is None else f"{name}: {re.sub(r'[\r\n]+', ' ', value).strip()}\r\n"


def format_record(row: dict) -> bytes:
    """One record with an HTTP block.  A revisit has the HTTP header only, with the full length."""
    payload = row.get("payload") or b""
    revisit = row["record_type"] == "revisit"
    length = row.get("payload_length")
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload) if length is None else length}\r\n\r\n"
    ).encode()
    body = http if revisit else http + payload
    digest = row.get("payload_digest")
    head = (
        "WARC/1.1\r\n"
        + _line("WARC-Type", row["record_type"])
        + _line("WARC-Record-ID", row["record_id"])
        + _line("WARC-Date", row.get("date"))
        + _line("WARC-Target-URI", row.get("target_uri"))
        + _line("WARC-Payload-Digest", digest and f"sha256:{digest}")
        + (_line("WARC-Profile", REVISIT_PROFILE) if revisit else "")
        + _line("WARC-Refers-To", row.get("refers_to"))
        + "Content-Type: application/http;msgtype=response\r\n"
        + f"Content-Length: {len(body)}\r\n\r\n"
    )
    return head.encode("utf-8", "replace") + body + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    """A gzip member whose extra field holds its compressed and plain lengths."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    header = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff"
    total = len(header) + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total, len(data) & 0xFFFFFFFF)
    trailer = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    return header + struct.pack("<H", len(extra)) + extra + body + trailer


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.roll = options["path"], int(options.get("rollBytes", ROLL_BYTES))
        self.compressed = options.get("compression", "gzip") == "gzip"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _open_store(self.path)
        store.create_dir(root, recursive=True)
        done, out, size = Written(), None, 0
        for rows in iterator:
            for row in rows.to_pylist():
                if out is None or size >= self.roll:
                    if out is not None:
                        out.close()
                    name = f"part-{uuid.uuid4().hex}.warc" + (".gz" if self.compressed else "")
                    done.files.append(name)
                    out, size = store.open_output_stream(f"{root}/{name}", compression=None), 0
                data = format_record(row)
                data = gzip_member(data) if self.compressed else data
                out.write(data)
                size += len(data)
                done.records += 1
        if out is not None:
            out.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _open_store(self.path)
        store.create_dir(root, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        text = json.dumps({"files": files, "records": sum(m.records for m in messages if m)})
        with store.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(text.encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _open_store(self.path)
        for m in messages:
            for name in m.files if m is not None else ():
                store.delete_file(f"{root}/{name}")


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(folder)``; a user schema without ``payload`` skips payloads."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the ``warc`` format known to a session and let it push filters into Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def as_records(
    df: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    revisit_bytes: int = 100,
) -> DataFrame:
    """Rows to write: of equal payloads of ``revisit_bytes`` or more, the smallest id answers.

    A null payload is empty.  Rows that share the smallest id all answer; a null id is larger than
    any other, and if all ids of a payload are null, all answer.  Only digests are grouped; a
    payload that a large share of the rows holds is one row there.  The digests that occur again
    are stored first, so their size is known to the join back: while few, they are broadcast and no
    payload is shuffled or sorted; else adaptive execution splits the rows of a frequent one.
    """
    pages = pick(df, id=id_col, url=url_col, html=html_col).select(
        F.col("id").cast("long").alias("id"),
        F.col("url").cast("string").alias("target_uri"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    pages = pages.withColumns(
        {"payload_digest": F.sha2("payload", 256), "payload_length": F.octet_length("payload").cast("long")}
    )
    first = (
        pages.filter(F.col("payload_length") >= revisit_bytes)
        .groupBy("payload_digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first is not null")
        .select("payload_digest", "first")
    )
    first = materialise(first, "warc-first")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return pages.join(first, "payload_digest", "left").select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("id")).alias("record_id"),
        "target_uri",
        F.lit("2024-01-01T00:00:00Z").alias("date"),
        "payload_digest",
        "payload_length",
        F.when(revisit, urn(F.col("first"))).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def _page_of(urn: str):
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def archive_round_trip(df: DataFrame, **columns: str) -> DataFrame:
    """Write a record per page to archives in the shared folder and read them back, each once.

    ``payload_bytes`` and ``payload_digest`` of responses are computed from the payload read back,
    those of revisits, which carry none, are the header fields of their record.
    """
    spark = df.sparkSession
    register(spark)
    path = work_path(spark, "warc")
    as_records(df, **columns).write.format("warc").mode("append").save(path)
    archived = spark.read.format("warc").load(path)
    archived = archived.filter(F.col("record_type").isin("response", "revisit"))
    revisit = F.col("record_type") == "revisit"
    length = F.octet_length("payload").cast("long")
    return archived.select(
        _page_of("record_id").alias("page_id"),
        F.when(revisit, F.col("payload_length")).otherwise(length).alias("payload_bytes"),
        F.when(revisit, F.col("payload_digest")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        "record_type",
        F.when(revisit, _page_of("refers_to")).alias("refers_to"),
        "target_uri",
    )
