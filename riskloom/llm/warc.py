"""Web archives (WARC 1.1) as a Python data source of Spark.

Writing: every task writes gzip archives, one member for each record, below the shared folder; a member names its
own length (the "sl" field of the standard's gzip annex). The files of finished tasks are listed in a manifest when
the job commits, so files of failed or repeated attempts are never read.

Reading: files are planned into partitions of similar size. Predicates on the record type and on header fields are
pushed down. Of every record the headers are parsed first; a record that fails a predicate, or whose payload is not
asked for (no ``payload`` column in the schema), is skipped by its length without inflating or copying the rest.

Defined results: a header that is absent is null; a record of no payload has an empty one; files that are not
archives and records that are cut short raise an error; an empty folder gives an empty table. Files are opened with
``pyarrow.fs``, so local folders and the stores it knows can be used.
"""

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
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
    IsNotNull,
    WriterCommitMessage,
)

from riskloom.llm.common import new_folder, stored, whole_text

#: Bytes after which a task begins another file; bytes planned into a partition; bytes read at a time.
FILE_BYTES, PARTITION_BYTES, CHUNK = 64 << 20, 64 << 20, 1 << 18
MANIFEST = "_files.json"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Columns, the headers they come from, and whether they are numbers.
HEADERS = {
    "record_type": ("WARC-Type", False), "record_id": ("WARC-Record-ID", False), "target_uri": ("WARC-Target-URI", False),
    "date": ("WARC-Date", False), "refers_to": ("WARC-Refers-To", False), "payload_digest": ("WARC-Payload-Digest", False),
    "payload_length": ("X-Payload-Length", True), "page_id": ("X-Page-ID", True),
}
SCHEMA = ", ".join(f"{c} {'long' if number else 'string'}" for c, (_, number) in HEADERS.items()) + ", payload binary"


def _open(path: str):
    """File system and path within it; a plain path is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# --- records -----------------------------------------------------------------------------------------


def record_bytes(row: dict) -> bytes:
    """A whole record; a revisit has the HTTP headers only."""
    payload = row.get("payload") or b""
    revisit = row["record_type"] == "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
    block = http if revisit else http + payload
    lines = ["WARC/1.1"]
    lines += [f"{name}: {_one_line(row[c])}" for c, (name, _) in HEADERS.items() if row.get(c) is not None]
    if revisit:
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _one_line(value) -> str:
    return " ".join(str(value).splitlines()) if isinstance(value, str) else str(value)


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """One gzip member whose extra field "sl" holds its deflated and inflated lengths."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    extra = b"sl" + struct.pack("<HII", 8, len(body), len(data) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class Window:
    """Forward reading of a file with a small buffer; skipping beyond it is a seek."""

    def __init__(self, file, size: int):
        self.file, self.size, self.base, self.buffer = file, size, 0, b""

    def peek(self, n: int) -> bytes:
        while len(self.buffer) < n:
            more = self.file.read(max(CHUNK, n - len(self.buffer)))
            if not more:
                break
            self.buffer += more
        return self.buffer[:n]

    def skip(self, n: int) -> None:
        if n <= len(self.buffer):
            self.buffer = self.buffer[n:]
        else:
            self.file.seek(self.base + n)
            self.buffer = b""
        self.base += n

    def take(self, n: int) -> bytes:
        found = self.peek(n)
        if len(found) < n:
            raise ValueError(f"the archive ends within a record at byte {self.base}")
        self.skip(n)
        return found

    @property
    def ended(self) -> bool:
        return not self.peek(1)


def parse_headers(head: bytes, where: str) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {where}")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:]) if name}


def fields_of(headers: dict[str, str]) -> dict:
    out: dict = {}
    for column, (name, number) in HEADERS.items():
        value = headers.get(name.lower())
        out[column] = int(value) if number and value is not None else value
    return out


def _payload(block: bytes, headers: dict[str, str]) -> bytes:
    """What follows the HTTP headers; the whole block of records that are not HTTP."""
    if headers.get("warc-type") == "revisit":
        return b""
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _until_blank(more) -> tuple[bytes, bytes]:
    """Bytes up to the blank line that ends the headers, and those already read after it."""
    data = b""
    while b"\r\n\r\n" not in data:
        new = more()
        if not new:
            raise ValueError("the archive ends within the headers of a record")
        data += new
    head, _, rest = data.partition(b"\r\n\r\n")
    return head, rest


def _plain_records(window: Window, wanted, with_payload: bool) -> Iterator[dict]:
    while not window.ended:
        at, n = window.base, 1024
        while b"\r\n\r\n" not in window.peek(n):
            if len(window.peek(n)) < n:
                raise ValueError(f"the archive ends within the headers at byte {at}")
            n *= 2
        head = window.peek(n).partition(b"\r\n\r\n")[0]
        headers = parse_headers(head, f"byte {at}")
        window.skip(len(head) + 4)
        length, row = int(headers["content-length"]), fields_of(headers)
        if not wanted(row):
            window.skip(length + 4)
            continue
        if with_payload:
            row["payload"] = _payload(window.take(length), headers)
            window.skip(4)
        else:
            window.skip(length + 4)
        yield row


def _skip_length(window: Window) -> int | None:
    """Length of the whole member if it names it."""
    start = window.peek(12)
    if len(start) < 12 or not start[3] & 4:
        return None
    size = struct.unpack("<H", start[10:12])[0]
    extra = window.peek(12 + size)[12:]
    while len(extra) >= 4:
        mark, n = extra[:2], struct.unpack("<H", extra[2:4])[0]
        if mark == b"sl" and n == 8 and start[3] == 4:
            return 12 + size + struct.unpack("<I", extra[4:8])[0] + 8
        extra = extra[4 + n :]
    return None


def _gzip_records(window: Window, wanted, with_payload: bool) -> Iterator[dict]:
    while not window.ended:
        at, whole = window.base, _skip_length(window)
        inflate, offset = zlib.decompressobj(31), 0

        def more(n: int = 2048, read: int = 1024, inflate=inflate, at=at) -> bytes:
            """Some more inflated bytes; reads on in the file as needed."""
            nonlocal offset
            while not inflate.eof:
                data = inflate.unconsumed_tail
                if not data:
                    data = window.peek(offset + read)[offset:]
                    offset += len(data)
                    if not data:
                        raise ValueError(f"the archive ends within a record at byte {at}")
                new = inflate.decompress(data, n)
                if new:
                    return new
            return b""

        head, rest = _until_blank(more)
        headers = parse_headers(head, f"byte {at}")
        row = fields_of(headers)
        take = wanted(row)
        if take and with_payload:
            length, parts, have = int(headers["content-length"]), [rest], len(rest)
            while have < length:
                new = more(1 << 20, CHUNK)
                if not new:
                    raise ValueError(f"the archive ends within a record at byte {at}")
                parts.append(new)
                have += len(new)
            row["payload"] = _payload(b"".join(parts)[:length], headers)
        if whole is None:  # without a length the member must be inflated to its end
            while more(1 << 20, CHUNK):
                pass
            whole = offset - len(inflate.unused_data)
        window.skip(whole)
        if take:
            yield row


def read_file(path: str, wanted=lambda row: True, with_payload: bool = True) -> Iterator[dict]:
    """Records of an archive, compressed or not. ``wanted`` sees a record's header columns."""
    system, inner = _open(path)
    with system.open_input_file(inner) as file:
        window = Window(file, file.size())
        records = _gzip_records if window.peek(2) == b"\x1f\x8b" else _plain_records
        yield from records(window, wanted, with_payload)


# --- the data source ---------------------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


@dataclass
class Written(WriterCommitMessage):
    files: list = field(default_factory=list)


def plan(files: list[tuple[str, int]], most: int = PARTITION_BYTES) -> list[tuple[str, ...]]:
    """Files in partitions of at most ``most`` bytes, larger files by themselves."""
    out: list[list[str]] = []
    room = 0
    for path, size in sorted(files, key=lambda f: (-f[1], f[0])):
        if not out or size > room:
            out.append([])
            room = most
        out[-1].append(path)
        room -= size
    return [tuple(paths) for paths in out]


def archives(folder: str) -> list[tuple[str, int]]:
    """Archives of a folder with their sizes: those of its manifest, else all that are named as such."""
    from pyarrow import fs

    system, inner = _open(folder)
    prefix = folder.rstrip("/") + "/"
    manifest = f"{inner.rstrip('/')}/{MANIFEST}"
    if system.get_file_info(manifest).type == fs.FileType.File:
        with system.open_input_stream(manifest) as f:
            return [(prefix + name, size) for name, size in json.loads(f.read())]
    found = system.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True))
    return [(prefix + i.path[len(inner.rstrip("/")) + 1 :], i.size) for i in found
            if i.type == fs.FileType.File and i.base_name.endswith((".warc", ".warc.gz"))]


class WarcReader(DataSourceReader):
    def __init__(self, folder: str, columns: list[str], most: int):
        self.folder, self.columns, self.most = folder, columns, most
        self.tests: list[tuple[str, tuple | None]] = []

    def partitions(self) -> list[Files]:
        return [Files(paths) for paths in plan(archives(self.folder), self.most)] or [Files(())]

    def wanted(self, row: dict) -> bool:
        return all(row[c] is not None if values is None else row[c] in values for c, values in self.tests)

    def read(self, partition: Files):
        kinds = {c: pa.int64() if HEADERS.get(c, ("", False))[1] else pa.binary() if c == "payload" else pa.string() for c in self.columns}
        held: list[dict] = []
        size = 0
        for path in partition.paths:
            for row in read_file(path, self.wanted, "payload" in self.columns):
                held.append(row)
                size += len(row.get("payload", b"")) + 200
                if size >= 8 << 20:
                    yield self._batch(held, kinds)
                    held, size = [], 0
        if held:
            yield self._batch(held, kinds)

    @staticmethod
    def _batch(rows: list[dict], kinds: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in kinds.items()], names=list(kinds))


class PushingReader(WarcReader):
    """Takes over predicates ``column = value``, ``column IN (...)`` and ``column IS NOT NULL`` on header columns."""

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self.tests.append((column, (f.value,)))
            elif column in HEADERS and isinstance(f, In):
                self.tests.append((column, tuple(v for v in f.value if v is not None)))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((column, None))
            else:
                yield f


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, limit: int):
        self.folder, self.limit = folder, limit

    def write(self, iterator) -> Written:
        system, inner = _open(self.folder)
        system.create_dir(inner, recursive=True)
        done, out, name, size = Written(), None, "", 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{inner.rstrip('/')}/{name}", compression=None)
                member = gzip_member(record_bytes(row))
                out.write(member)
                size += len(member)
                if size >= self.limit:
                    out.close()
                    done.files.append((name, size))
                    out = None
        if out is not None:
            out.close()
            done.files.append((name, size))
        return done

    def commit(self, messages) -> None:
        system, inner = _open(self.folder)
        system.create_dir(inner, recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with system.open_output_stream(f"{inner.rstrip('/')}/{MANIFEST}") as f:
            f.write(json.dumps(files).encode())

    def abort(self, messages) -> None:
        """Nothing to undo: files without a manifest entry are not read."""


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").mode("append").save(folder)``.

    A job writes a folder of its own: the manifest lists the files of the last one. Options: ``pushdown`` (true where the session has
    ``spark.sql.python.filterPushdown.enabled``), ``where`` (a JSON object of header columns and the values wanted), ``partition_bytes``,
    ``file_bytes``.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        unknown = set(schema.names) - set(HEADERS) - {"payload"}
        if unknown:
            raise ValueError(f"a WARC record has no columns {sorted(unknown)}")
        kind = PushingReader if self.options.get("pushdown", "false") == "true" else WarcReader
        made = kind(self.options["path"], list(schema.names), int(self.options.get("partition_bytes", PARTITION_BYTES)))
        for column, values in json.loads(self.options.get("where", "{}")).items():
            if column not in HEADERS:
                raise ValueError(f"records cannot be chosen by {column}")
            made.tests.append((column, tuple(values)))
        return made

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("file_bytes", FILE_BYTES)))


def read(spark: SparkSession, folder: str, columns: list[str] | None = None, where: dict[str, list] | None = None) -> DataFrame:
    """Records of a folder. Without ``payload`` among the columns no payload is decoded.

    ``where`` has values wanted of header columns, record type among them. It goes to the reader whatever the session's settings
    are: headers are parsed first, and other records' payloads are skipped without being decoded.
    """
    spark.dataSource.register(WarcDataSource)
    pushdown = str(spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")).lower()
    chosen = columns or [*HEADERS, "payload"]
    kinds = {c: "binary" if c == "payload" else "long" if HEADERS[c][1] else "string" for c in chosen}
    return spark.read.format("warc").schema(", ".join(f"{c} {k}" for c, k in kinds.items())).option("pushdown", pushdown).option(
        "where", json.dumps(where or {})).load(folder)


def write(records: DataFrame, folder: str) -> None:
    records.sparkSession.dataSource.register(WarcDataSource)
    records.write.format("warc").mode("append").save(folder)


# --- pages -------------------------------------------------------------------------------------------


def page_records(pages: DataFrame, date: str = "2000-01-01T00:00:00Z", least: int = 100) -> DataFrame:
    """A record for every page. Of equal payloads of at least ``least`` bytes the page with the smallest page_id is
    the response, the others revisit it; rows that repeat that page_id with the same payload are responses too, and
    pages without a page_id revisit the smallest one that has an id."""
    payload = F.encode(whole_text("html"), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).cast("long").alias("payload_length"))
    small = stored(rows.select("page_id", "payload_digest", "payload_length"), "page-digests")
    first = small.where(F.col("payload_length") >= least).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    first = stored(first.select("payload_digest", "first"), "page-firsts")
    joined = rows.join(first, "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))

    def urn(column: str):
        return F.concat(F.lit("<urn:page:"), F.col(column).cast("string"), F.lit(">"))

    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.coalesce(urn("page_id"), F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))).alias("record_id"),
        "target_uri", F.lit(date).alias("date"), F.when(again, urn("first")).alias("refers_to"),
        F.concat(F.lit("sha256:"), "payload_digest").alias("payload_digest"), "payload_length", "page_id",
        F.when(~again, F.col("payload")).alias("payload"))


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back from archives of ``pages``.

    Length and digest of a response are taken from the payload read back, those of a revisit from its headers.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write(page_records(pages), folder)
    full = read(spark, folder, ["record_type", "page_id", "payload"], {"record_type": ["response"]})
    heads = read(spark, folder, ["record_type", "page_id", "payload_length", "payload_digest", "refers_to"], {"record_type": ["revisit"]})
    none = F.lit(None).cast("long")
    responses = full.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        "record_type", none.alias("refers_to"))
    revisits = heads.select(
        "page_id", F.col("payload_length").alias("payload_bytes"), F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        "record_type", F.regexp_extract("refers_to", r"<urn:page:(-?\d+)>", 1).cast("long").alias("refers_to"))
    return responses.unionByName(revisits)
