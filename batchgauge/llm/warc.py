"""WARC archives as a Spark data source: read and written by tasks, pages deduplicated by revisit records.

`register(spark)` makes `format("warc")` known. Reading: the driver lists files and packs them into
partitions of about `split_bytes`; a file is never split, so the writer begins a new one at `max_bytes`. A
task parses a record's headers first and holds them against the pushed predicates (comparisons,
IN, prefixes and null tests on any header column, by SQL's rules for null). Only of records that pass is the block
read, and decoded only if the schema has `payload`. Ask for the columns you need
(`read(spark, path, columns)`): Spark hands a Python source its schema, not the columns a plan uses.

Files are plain (`.warc`) or hold one gzip member a record (`.warc.gz`). The writer notes each member's
length in its gzip header (the skip-length field `sl` of the format's annex): such a member is passed over without being
inflated. Members without the note are inflated in pieces and dropped.

Writing: each task writes files of its own names, whose names the driver puts into a `_manifest-*` file at the end;
a folder with such files is read by them, so files of lost or repeated tasks are never read.
Files are reached by pyarrow's file systems (file, hdfs, s3, gs), not only on local disks.

Columns: record_type, record_id, date, target_uri, content_type, content_length, payload_digest (bare
lowercase hex where it is SHA-1), payload_length (of the whole payload, also where a revisit leaves it out), refers_to,
refers_to_uri, headers (all, as written), payload (a response's body without HTTP headers; null for a revisit).

Defined results: a null payload is written as an empty one; null header columns are left out; line breaks in
header values become spaces. Empty tables write no archive file and read as no rows. Other columns of the input are not written.
A file that breaks off or holds no record where one is due raises an error that names file and place.
"""

from __future__ import annotations

import base64
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith,
    StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from batchgauge.llm.common import BROADCAST_BYTES, stored, text_batches

# The header of each column, as the format names it.
HEADER = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "date": "WARC-Date", "target_uri": "WARC-Target-URI",
    "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
    "refers_to_uri": "WARC-Refers-To-Target-URI",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = (
    "record_type string, record_id string, date string, target_uri string, content_type string, content_length long, "
    "payload_digest string, payload_length long, refers_to string, refers_to_uri string, headers map<string,string>, payload binary"
)
SPLIT_BYTES = 128 << 20
MAX_BYTES = 128 << 20
BATCH_BYTES = 8 << 20
BATCH_ROWS = 1000
#: From this length on, equal payloads are written once.
LEAST_REVISIT = 1000
PIECE = 1 << 16


# --- predicates on headers ---


def _compared(test):
    return lambda value, other: None if value is None or other is None else test(value, other)


_TESTS = {
    EqualTo: _compared(lambda a, b: a == b), GreaterThan: _compared(lambda a, b: a > b),
    GreaterThanOrEqual: _compared(lambda a, b: a >= b), LessThan: _compared(lambda a, b: a < b),
    LessThanOrEqual: _compared(lambda a, b: a <= b), StringStartsWith: _compared(lambda a, b: a.startswith(b)),
    StringEndsWith: _compared(lambda a, b: a.endswith(b)), StringContains: _compared(lambda a, b: b in a),
    EqualNullSafe: lambda a, b: a == b, In: _compared(lambda a, b: True if a in b else None if None in b else False),
}


def holds(test: Filter, values: dict) -> bool | None:
    """True, false or, by SQL's rules, unknown."""
    if isinstance(test, Not):
        inner = holds(test.child, values)
        return None if inner is None else not inner
    value = values.get(test.attribute[0])
    if isinstance(test, (IsNull, IsNotNull)):
        return (value is None) == isinstance(test, IsNull)
    return _TESTS[type(test)](value, test.value)


def on_headers(test: Filter, columns: Sequence[str]) -> bool:
    if isinstance(test, Not):
        return on_headers(test.child, columns)
    name = test.attribute
    return len(name) == 1 and name[0] in columns and name[0] not in ("headers", "payload") and isinstance(test, (*_TESTS, IsNull, IsNotNull))


# --- records in a file ---


class _Member:
    """One gzip member of a file, read forward: its length by the note in its header, if there is one."""

    def __init__(self, file) -> None:
        self.file, self.start = file, file.tell()
        head = _exactly(file, 10)
        self.length = None
        if head[3] & 4:
            extra = _exactly(file, struct.unpack("<H", _exactly(file, 2))[0])
            while len(extra) >= 4:
                size = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and size >= 8:
                    self.length = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size :]
        file.seek(self.start)
        self.inflate, self.ready = zlib.decompressobj(31), b""

    def _packed(self) -> bytes:
        """The next bytes to inflate."""
        if self.inflate.unconsumed_tail:
            return self.inflate.unconsumed_tail
        ahead = PIECE if self.length is None else min(PIECE, self.start + self.length - self.file.tell())
        piece = self.file.read(max(0, ahead))
        if not piece:
            raise ValueError("a compressed record breaks off")
        return piece

    def read(self, n: int) -> bytes:
        parts = [self.ready[:n]]
        self.ready, left = self.ready[n:], n - len(parts[0])
        while left and not self.inflate.eof:
            parts.append(self.inflate.decompress(self._packed(), left))
            left -= len(parts[-1])
        return b"".join(parts)

    def head(self) -> bytes:
        """All up to the first empty line, that included."""
        while b"\r\n\r\n" not in self.ready:
            more = self._more()
            if not more:
                break
            self.ready += more
        end = self.ready.find(b"\r\n\r\n") + 4
        if end < 4:
            raise ValueError("a record's headers break off")
        head, self.ready = self.ready[:end], self.ready[end:]
        return head

    def _more(self) -> bytes:
        while not self.inflate.eof:
            if out := self.inflate.decompress(self._packed(), PIECE):
                return out
        return b""

    def leave(self, left: int) -> None:
        """Go to the member's end."""
        if self.length is not None and not self.inflate.eof:
            self.file.seek(self.start + self.length)
            return
        while self._more():
            pass
        self.file.seek(self.file.tell() - len(self.inflate.unused_data))


class _Plain:
    """One record of a file that is not compressed."""

    def __init__(self, file) -> None:
        self.file = file

    def read(self, n: int) -> bytes:
        return self.file.read(n)

    def head(self) -> bytes:
        lines = []
        while not lines or lines[-1] != b"\r\n":
            lines.append(self.file.readline())
            if not lines[-1]:
                raise ValueError("a record's headers break off")
        return b"".join(lines)

    def leave(self, left: int) -> None:
        self.file.seek(left, io.SEEK_CUR)
        if self.file.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")


def _exactly(file, n: int) -> bytes:
    out = file.read(n)
    if len(out) < n:
        raise ValueError("the file breaks off")
    return out


def header_lines(block: bytes) -> tuple[str, dict[str, str]]:
    """The first line, and the headers by name; a line that begins with white space goes on."""
    first, *lines = block.decode("utf-8", "replace").split("\r\n")
    out: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in (" ", "\t") and last is not None:
            out[last] += " " + line.strip()
        elif ":" in line:
            last, _, value = line.partition(":")
            out[last := last.strip()] = value.strip()
    return first, out


def bare_digest(value: str | None) -> str | None:
    """SHA-1 as lowercase hex, whether it was written in base 32 or 16; any other as it is."""
    kind, _, digits = (value or "").partition(":")
    if kind.lower() == "sha1" and len(digits) == 32:
        return base64.b32decode(digits.upper()).hex()
    return digits.lower() if kind.lower() == "sha1" else value


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def records(file, gzipped: bool, tests: Sequence[Filter], columns: Sequence[str], place: str = "") -> Iterator[dict]:
    """The records of an open file for which all `tests` hold, with the asked columns."""
    wanted = set(columns)
    needs_block = bool(wanted & {"payload", "payload_length"}) or any("payload_length" in str(t) for t in tests)
    while True:
        at = file.tell()
        first = file.read(1)
        while first in (b"\r", b"\n"):
            at, first = at + 1, file.read(1)
        if not first:
            return
        file.seek(at)
        try:
            record = _Member(file) if gzipped else _Plain(file)
            version, headers = header_lines(record.head())
            if not version.startswith("WARC/"):
                raise ValueError("no record begins here")
            names = {k.lower(): v for k, v in headers.items()}
            left = int(names["content-length"])
            values = {c: names.get(h.lower()) for c, h in HEADER.items()}
            values |= {"content_length": left, "payload_digest": bare_digest(values["payload_digest"]), "headers": headers}
            late = [t for t in tests if "payload_length" in str(t)]
            if all(holds(t, values) for t in tests if t not in late):
                if needs_block:
                    left -= _open_block(record, values, left, "payload" in wanted)
                if all(holds(t, values) for t in late):
                    yield {c: values.get(c) for c in columns}
            record.leave(left)
        except (ValueError, KeyError, zlib.error) as e:
            raise ValueError(f"{place} at byte {at}: {e}") from e


def _open_block(record, values: dict, left: int, with_payload: bool) -> int:
    """Fill in payload_length and payload; the number of bytes read of the block."""
    http, used = {}, 0
    if (values["content_type"] or "").startswith("application/http"):
        head = b""
        if isinstance(record, _Plain):
            start = record.file.tell()
            head = record.head()
            used = record.file.tell() - start
        else:
            head = record.head()
            used = len(head)
        http = {k.lower(): v for k, v in header_lines(head)[1].items()}
    told = http.get("content-length", "")
    whole = values["record_type"] != "revisit"
    values["payload_length"] = int(told) if told.isdigit() else left - used if whole else None
    if with_payload and whole:
        body = record.read(left - used)
        if len(body) < left - used:
            raise ValueError("a record breaks off")
        used = left
        values["payload"] = _unchunked(body) if http.get("transfer-encoding", "").lower() == "chunked" else body
    return used


# --- writing ---


def member(block: bytes, level: int) -> bytes:
    """A gzip member that notes its own length."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(block) + squeeze.flush()
    # fixed part, length of the extra field, then its one entry: its name, its size, packed and plain length
    total = 10 + 2 + 12 + len(body) + 8
    if total >= 1 << 32 or len(block) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\x00\xff" + body + struct.pack("<II", zlib.crc32(block), len(block) & 0xFFFFFFFF)
    extra = b"sl" + struct.pack("<HII", 8, total, len(block))
    return (
        b"\x1f\x8b\x08\x04\0\0\0\0\x00\xff" + struct.pack("<H", len(extra)) + extra + body
        + struct.pack("<II", zlib.crc32(block), len(block))
    )


def encoded(row: dict) -> bytes:
    """A record: WARC headers, then HTTP headers and payload."""
    payload = row.get("payload") or b""
    size = row.get("payload_length")
    size = len(payload) if size is None else size
    kind = row.get("record_type") or "response"
    media = _clean(row.get("content_type") or "text/html; charset=utf-8")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {media}\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = [("WARC-Type", kind)]
    for column in ("record_id", "date", "target_uri", "refers_to", "refers_to_uri"):
        if row.get(column) is not None:
            lines.append((HEADER[column], _clean(row[column])))
    if row.get("payload_digest"):
        digits = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
        lines.append((HEADER["payload_digest"], f"sha1:{digits}"))
    if kind == "revisit":
        lines.append(("WARC-Profile", REVISIT_PROFILE))
    lines += [("Content-Type", f"application/http; msgtype={'response' if kind in ('response', 'revisit') else kind}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode("utf-8", "replace") + block + b"\r\n\r\n"


def _clean(value: str) -> str:
    return " ".join(str(value).splitlines()).strip()


def _info(name: str) -> bytes:
    body = b"software: batchgauge\r\nformat: WARC File Format 1.1\r\n"
    head = (
        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Filename: {name}\r\n"
        f"Content-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n"
    )
    return head.encode() + body + b"\r\n\r\n"


# --- the data source ---


@dataclass
class Files(InputPartition):
    files: list[str] = field(default_factory=list)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


def _located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.schema, self.path = schema, options["path"]
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if on_headers(f, self.schema.names):
                self.tests.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        system, path = _located(self.path)
        info = system.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else system.get_file_info(fs.FileSelector(path, recursive=True))
        lists = [i for i in found if i.base_name.startswith("_manifest-")]
        named = None
        if lists:
            named = {name for i in lists for name in json.loads(system.open_input_stream(i.path).read())}
        parts, size = [Files()], 0
        for i in sorted((i for i in found if i.is_file and i.base_name.endswith((".warc", ".warc.gz"))), key=lambda i: i.path):
            if named is not None and i.base_name not in named:
                continue
            if parts[-1].files and size + i.size > self.split_bytes:
                parts.append(Files())
                size = 0
            parts[-1].files.append(i.path)
            size += i.size
        return parts

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        system, _ = _located(self.path)
        shape, columns = to_arrow_schema(self.schema), self.schema.names
        rows, size = [], 0
        for path in partition.files:
            with system.open_input_file(path) as raw:
                file = io.BufferedReader(raw, 1 << 18)
                for row in records(file, path.endswith(".gz"), self.tests, columns, path):
                    if "headers" in row:
                        row["headers"] = list(row["headers"].items())
                    rows.append(row)
                    size += len(row.get("payload") or b"")
                    if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema=shape)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=shape)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite = options["path"], overwrite
        self.gzipped = options.get("compression", "gzip") != "none"
        self.level, self.max_bytes = int(options.get("level", 6)), int(options.get("max_bytes", MAX_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = _located(self.path)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for i in range(batch.num_rows):
                    if out is None or size >= self.max_bytes:
                        if out is not None:
                            out.close()
                        if not names:
                            system.create_dir(folder, recursive=True)
                        names.append(f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gzipped)
                        out, size = system.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                        size += self._put(out, _info(names[-1]))
                    size += self._put(out, encoded(batch.slice(i, 1).to_pylist()[0]))
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def _put(self, out, block: bytes) -> int:
        data = member(block, self.level) if self.gzipped else block
        out.write(data)
        return len(data)

    def commit(self, messages: list[Written | None]) -> None:
        """Name the files that count; after an overwrite, what was there before goes."""
        system, folder = _located(self.path)
        system.create_dir(folder, recursive=True)
        names = [n for m in messages if m is not None for n in m.files]
        old = system.get_file_info(fs.FileSelector(folder)) if self.overwrite else []
        with system.open_output_stream(f"{folder}/_manifest-{uuid.uuid4().hex}", compression=None) as out:
            out.write(json.dumps(names).encode())
        for i in old:
            if i.is_file and i.base_name not in names and i.base_name.startswith(("_manifest-", "part-")):
                system.delete_file(i.path)

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = _located(self.path)
        for name in (n for m in messages if m is not None for n in m.files):
            system.delete_file(f"{folder}/{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make format("warc") known, and let Spark hand predicates to Python sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The records of a folder or file, with these columns only; filters on header columns are tested before a block is read."""
    register(spark)
    kinds = StructType.fromDDL(SCHEMA)
    return spark.read.format("warc").schema(StructType([kinds[c] for c in columns or kinds.names])).load(path)


def write(rows: DataFrame, path: str, mode: str = "append", **options: object) -> None:
    """Write records (columns as above; those that are absent are null) to a folder."""
    register(rows.sparkSession)
    known = [c for c in StructType.fromDDL(SCHEMA).names if c in rows.columns and c not in ("headers", "content_length")]
    with text_batches(rows.sparkSession, BATCH_ROWS):
        rows.select(known).write.format("warc").mode(mode).options(**options).save(path)


# --- pages to records ---

#: A group of copies beyond this many pages has its row sent to every task; there is one in so many pages at most.
HOT_COPIES = 100_000
#: About what a group takes in a broadcast hash table, and the bound on all of it.
GROUP_BYTES = 400
BROADCAST_LIMIT = BROADCAST_BYTES


def page_records(pages: DataFrame, key: str, uri: str, body: str, date: str, least: int = LEAST_REVISIT) -> DataFrame:
    """A record per page. Of equal payloads of at least `least` bytes the one of the largest key is the response.

    The others revisit it. Rows that repeat the largest key with an equal payload are all responses; a null
    key is smaller than any. Ids are `urn:page:<key>:<digest>`: rows equal in both have one id.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit("").cast("binary"))
    base = pages.select(
        F.col(key).alias("_key"), F.col(uri).cast("string").alias("target_uri"), payload.alias("payload"),
        F.when(F.octet_length(payload) >= least, F.sha2(payload, 256)).alias("_same"),
    )
    copies = stored(
        base.filter("_same is not null").groupBy("_same")
        .agg(F.max("_key").alias("_keeper"), F.count("*").alias("_copies"),
             F.max(F.struct("_key", "target_uri"))["target_uri"].alias("refers_to_uri")).filter("_copies > 1"),
        "copies",
    )
    group = ["_same", "_keeper", "refers_to_uri"]
    hot = copies.filter(F.col("_copies") > HOT_COPIES).select(group)
    if copies.count() * GROUP_BYTES <= BROADCAST_LIMIT:
        found = base.join(F.broadcast(copies.select(group)), "_same", "left")
    else:  # the pages of a hot group stay where they are, the others meet their group by its hash
        told = base.join(F.broadcast(hot.withColumnsRenamed({c: f"{c}_hot" for c in group})), F.col("_same") == F.col("_same_hot"), "left")
        spread = F.concat("_same", F.lit("#"), F.pmod(F.xxhash64("_key"), F.lit(4096)).cast("string"))
        alone = F.coalesce(F.col("_same"), F.concat(F.lit("#"), F.xxhash64("_key", "target_uri").cast("string")))
        told = told.withColumn("_same", F.when(F.col("_same_hot").isNotNull(), spread).otherwise(alone))
        cold = copies.filter(F.col("_copies") <= HOT_COPIES).select(group)
        found = told.join(cold, "_same", "left").withColumns({
            "_keeper": F.coalesce("_keeper_hot", "_keeper"), "refers_to_uri": F.coalesce("refers_to_uri_hot", "refers_to_uri"),
        })
    revisit = F.col("_keeper").isNotNull() & ~F.col("_key").eqNullSafe(F.col("_keeper"))
    digest = F.sha1("payload")
    named = lambda k: F.concat(F.lit("<urn:page:"), F.coalesce(k.cast("string"), F.lit("")), F.lit(":"), digest, F.lit(">"))
    return found.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), named(F.col("_key")).alias("record_id"),
        F.lit(date).alias("date"), "target_uri", F.lit("text/html; charset=utf-8").alias("content_type"),
        digest.alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(revisit, named(F.col("_keeper"))).alias("refers_to"), F.when(revisit, F.col("refers_to_uri")).alias("refers_to_uri"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def page_key(record_id: str) -> Column:
    """The key in an id made by `page_records`, as text."""
    return F.regexp_extract(F.col(record_id), "^<urn:page:(.*):[0-9a-f]{40}>$", 1)
