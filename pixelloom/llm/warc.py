"""WARC archives as a PySpark data source (format ``warc``), with revisit records for repeated payloads."""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage
from pyspark.sql.types import StructType

from pixelloom.llm.common import materialise, small_side

#: Payloads below this many bytes are always stored whole.
MIN_REVISIT_BYTES = 100
#: Each write adds a manifest of its own under this name and a number; those that are there name the archives that count.
MANIFEST = "_MANIFEST-"
SCHEMA = (
    "warc_type string, record_id string, warc_date string, target_uri string, page_id bigint, refers_to bigint, "
    "payload_digest string, payload_bytes bigint, payload binary"
)
#: Column of SCHEMA to the WARC header that holds it.
HEADERS = {
    "warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "warc_date": "WARC-Date", "target_uri": "WARC-Target-URI", "page_id": "X-Page-ID",
    "refers_to": "X-Refers-To-Page", "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Bytes",
}
NUMBERS = ("page_id", "refers_to", "payload_bytes")
BATCH_BYTES = 16 << 20


def record_id(page_id: int | None, uri: str) -> str:
    """A name-based record id: the same page always gets the same one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {uri}')}>"


def manifests(store: fs.FileSystem, root: str) -> list[str]:
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(x.path for x in found if x.base_name.startswith(MANIFEST))


def archives(store: fs.FileSystem, root: str, known: list[str]) -> list[tuple[str, int]]:
    """(path, size) of the archives that the manifests name."""
    out = []
    for path in known:
        with store.open_input_stream(path, compression=None) as f:
            out += [(f"{root}/{name}", size) for name, size in json.loads(f.read())]
    return out


@dataclass
class Part(InputPartition):
    files: list[tuple[str, int]]

    def __init__(self, files):
        super().__init__(files)
        self.files = files


@dataclass
class Written(WriterCommitMessage):
    file: str
    size: int


class WarcSource(DataSource):
    """Options: path (any URI that pyarrow.fs opens), compression (none or gzip), date, splitBytes, payload (true or false)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


class WarcWriter(DataSourceArrowWriter):
    """Each task writes one archive under a name of its own; only those in a manifest count, so a lost or repeated task leaves no trace.

    A write in mode append adds to what is there; one in mode overwrite takes its place once it is whole.
    """

    def __init__(self, options, overwrite: bool):
        self.overwrite = overwrite
        self.path, self.gzip = options["path"], options.get("compression", "none") == "gzip"
        self.date = options.get("date", "1970-01-01T00:00:00Z")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzip
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            for b in batches:
                columns = [b.column(b.schema.get_field_index(c)) for c in ("warc_type", "target_uri", "page_id", "refers_to", "refers_to_uri", "payload_digest", "payload")]
                for row in zip(*columns, strict=True):
                    record = self._record(*(x.as_py() for x in row))
                    out.write(gzip.compress(record, 6) if self.gzip else record)
        return Written(name, store.get_file_info(f"{root}/{name}").size)

    def _record(self, kind, uri, page_id, refers_to, refers_to_uri, digest, payload) -> bytes:
        clean = lambda u: "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in u)
        uri = clean(uri or "")
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        block = http + (payload if kind == "response" else b"")
        lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, uri)}", f"WARC-Date: {self.date}"]
        lines += [f"WARC-Target-URI: {uri}"] * bool(uri) + [f"X-Page-ID: {page_id}"] * (page_id is not None)
        if kind == "revisit":
            lines += [
                "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                f"WARC-Refers-To: {record_id(refers_to, clean(refers_to_uri or ''))}", f"X-Refers-To-Page: {refers_to}",
            ]
        lines += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Bytes: {len(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
        return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    def commit(self, messages: list[Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        before = manifests(store, root)
        files = sorted((m.file, m.size) for m in messages if m is not None)
        with store.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps(files).encode())
        for old in before if self.overwrite else ():
            for name, _ in archives(store, root, [old]):
                store.delete_file(name)
            store.delete_file(old)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        for m in messages:
            if m is not None:
                store.delete_file(f"{root}/{m.file}")


class WarcReader(DataSourceReader):
    """Plans partitions of whole files. Headers are parsed first; the payload of a record that pushed predicates reject is passed over unread."""

    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("splitBytes", 64 << 20))
        self.payload = options.get("payload", "true") == "true"
        self.wanted: dict[str, set] = {}
        self.present: set[str] = set()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name not in HEADERS or not isinstance(f, EqualTo | In | IsNotNull):
                yield f
            elif isinstance(f, IsNotNull):
                self.present.add(name)
            else:
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[name] = self.wanted.get(name, values) & values

    def partitions(self) -> list[Part]:
        store, root = fs.FileSystem.from_uri(self.path)
        if known := manifests(store, root):
            files = archives(store, root, known)
        else:
            found = store.get_file_info(fs.FileSelector(root, recursive=True))
            files = [(x.path, x.size) for x in found if x.path.endswith((".warc", ".warc.gz"))]
        parts: list[list[tuple[str, int]]] = []
        room = 0
        for name, size in sorted(files, key=lambda x: -x[1]):
            if size > room or not parts:
                parts.append([])
                room = self.split
            parts[-1].append((name, size))
            room -= size
        return [Part(p) for p in parts] or [Part([])]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.path)
        rows, held = [], 0
        for name, _ in part.files:
            with store.open_input_file(name) as raw:
                stream = gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw
                for row, size in self._records(stream):
                    rows.append(row)
                    held += size + 500
                    if held > BATCH_BYTES:
                        yield self._batch(rows)
                        rows, held = [], 0
        yield self._batch(rows)

    def _keeps(self, row: dict) -> bool:
        return all(row[c] in v for c, v in self.wanted.items()) and all(row[c] is not None for c in self.present)

    def _records(self, stream) -> Iterator[tuple[dict, int]]:
        buffered = _Lines(stream)
        while (line := buffered.line()) is not None:
            if not line.startswith(b"WARC/"):
                if line.strip():
                    raise ValueError(f"no WARC record at {line[:40]!r}")
                continue
            headers = {}
            while line := (buffered.line() or b"").rstrip(b"\r\n"):
                key, _, value = line.decode("utf-8", "replace").partition(":")
                headers[key.strip().lower()] = value.strip()
            row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
            for c in NUMBERS:
                row[c] = int(row[c]) if row[c] and row[c].lstrip("-").isdecimal() else None
            if row["payload_digest"] is not None:
                row["payload_digest"] = row["payload_digest"].rpartition(":")[2]
            if not headers.get("content-length", "").isdecimal():
                raise ValueError(f"WARC record {row['record_id']} has no length")
            length = int(headers["content-length"])
            if not self._keeps(row):
                buffered.skip(length)
                continue
            row["payload"] = None
            if not self.payload or row["warc_type"] == "revisit":
                buffered.skip(length)
            else:
                block = buffered.take(length)
                http = "application/http" in headers.get("content-type", "")
                row["payload"] = block.partition(b"\r\n\r\n")[2] if http else block
            yield row, len(row["payload"] or b"")

    @staticmethod
    def _batch(rows: list[dict]) -> pa.RecordBatch:
        kinds = {**dict.fromkeys(HEADERS, pa.string()), **dict.fromkeys(NUMBERS, pa.int64()), "payload": pa.binary()}
        order = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds[c]) for c in order], names=order)


class _Lines:
    """Lines, blocks and skips over a file of which one piece is held at a time."""

    def __init__(self, raw, piece: int = 1 << 16):
        self.raw, self.piece, self.held, self.at = raw, piece, b"", 0

    def _more(self) -> bool:
        new = self.raw.read(self.piece)
        self.held, self.at = self.held[self.at :] + new, 0
        return bool(new)

    def line(self) -> bytes | None:
        while (end := self.held.find(b"\n", self.at)) < 0:
            if not self._more():
                rest, self.held, self.at = self.held[self.at :], b"", 0
                return rest or None
        out, self.at = self.held[self.at : end + 1], end + 1
        return out

    def take(self, n: int) -> bytes:
        out = self.held[self.at : self.at + n]
        self.at += len(out)
        if len(out) < n:
            out += self.raw.read(n - len(out))
        if len(out) < n:
            raise ValueError("WARC record ends before its length")
        return out

    def skip(self, n: int) -> None:
        """Passes over n bytes; the last is read, to see that it is there."""
        have = min(max(0, n - 1), len(self.held) - self.at)
        self.at += have
        if n - 1 > have:
            self.raw.seek(self.raw.tell() + n - 1 - have)
        self.take(min(n, 1))


def write_archives(pages: DataFrame, path: str, compression: str = "none", mode: str = "append") -> None:
    """One WARC record for each row of (page_id, url, html) under path; payload: the html in UTF-8, null as empty.

    mode append leaves the archives of earlier writes in place, overwrite replaces them.

    Of rows with equal payloads of at least MIN_REVISIT_BYTES bytes, that with the smallest page_id is the response and
    the others revisit it; repeated rows of that page_id are responses too. Where no row of a group has a page_id all
    are responses. The html isn't shuffled unless repeated payloads are too many to broadcast (BROADCAST_BYTES).
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").alias("target_uri"), payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    size = F.octet_length("payload")
    first = rows.where(size >= MIN_REVISIT_BYTES).groupBy("payload_digest").agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "target_uri"))).alias("one"), F.count("*").alias("n"))
    first = first.where("n > 1 AND one IS NOT NULL").select("payload_digest", F.col("one.page_id").alias("refers_to"), F.col("one.target_uri").alias("refers_to_uri"))
    first = materialise(first, "repeated")
    first = small_side(first)
    again = (size >= MIN_REVISIT_BYTES) & F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    out = rows.join(first, "payload_digest", "left").withColumn("warc_type", F.when(again, "revisit").otherwise("response"))
    out = out.withColumn("refers_to", F.when(again, F.col("refers_to")))
    columns = ["warc_type", "target_uri", "page_id", "refers_to", "refers_to_uri", "payload_digest", "payload"]
    out.select(*columns).write.format("warc").option("path", path).option("compression", compression).mode(mode).save()


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records under path with the columns of SCHEMA. Equality and IN on header columns are pushed down to the reader.

    Numbers that a foreign archive's headers don't hold are null; a record that ends before its length is an error. Spark
    asks sessions that read sources with filters for spark.sql.python.filterPushdown.enabled; it is switched on here.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("path", path).option("payload", str(payload).lower()).load()

