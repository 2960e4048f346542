"""WARC archives as a Spark data source in Python: writer, reader with pushed-down predicates, and duplicates as revisits.

*Reading* (``spark.read.format("warc")`` after ``register``): every archive file, ``.warc`` or ``.warc.gz``, is planned into
a partition; small files share one up to ``partition_bytes``.  Predicates on header columns (``=``, ``IN``, ``<``,
``LIKE 'x%'``, ``IS NULL`` and their negations) are pushed down.  Of a record the headers are parsed first; where a predicate
fails, the payload is never decoded: in an uncompressed file it is skipped by Content-Length, in a compressed one by the
record's length in the gzip extra field that the writer sets (sub-field ``sl``), without inflating it; files of other
writers, which lack that field, are inflated past it.  ``headers`` names further header fields to read as text columns;
``payload=false`` leaves out the payload columns, and then no payload is decoded at all.

*Writing* (``df.write.format("warc")``): one gzip member for each record; a task starts a new file at ``file_bytes``.  Files
get their names when all tasks have ended, so a lost or repeated task leaves no file.  Both sides reach the files through
``pyarrow.fs``, on whatever file system the path names.

*Revisits*: ``with_revisits`` marks records whose payload an earlier record (smaller id) holds.  Payloads are compared by
length and SHA-256.  The few payloads that hold a large share of all rows are joined by broadcast, at most HOT of them by
proof; the others by a shuffle in which no payload has more than one row in HOT.

Defined cases: a null payload is empty; a record without id refers to the record with the smallest one, and where no copy
has an id all are responses; rows repeated with the smallest id are responses each; an empty table makes an archive without
records; names are taken by the writer from its own columns, others are not written.
"""

from __future__ import annotations

import fnmatch
import io
import struct
import uuid
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull,
    LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage)

#: Payloads with at least one row in HOT are joined by broadcast: there are HOT of them at most.
HOT = 10_000
PARTITION_BYTES = 16 << 20
FILE_BYTES = 256 << 20
READ_BYTES = 1 << 16
# The named fields of a record that have columns of their own.
FIELDS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
}
# Fixed value: the profile of revisit records with equal payload digests.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


# ------------------------------------------------------------------ files

def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it; a bare path is local, ``s3a`` and ``s3n`` are S3."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(("s3:" if scheme in ("s3a", "s3n") else scheme + ":") + rest)


def _archives(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the archives at ``path``: a file, or all of a folder that are not hidden."""
    fs, inner = _file_system(path)
    info = fs.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(inner, recursive=True))
    shown = [f for f in found if f.is_file and not f.base_name.startswith(("_", ".")) and (info.is_file or fnmatch.fnmatch(f.base_name, "*.warc*"))]
    return sorted((f.path, f.size) for f in shown)


# ------------------------------------------------------------------ records

def _member(block: bytes) -> bytes:
    """A gzip member whose extra field holds its compressed and plain length."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = packer.compress(block) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size if size < 1 << 32 else 0, len(block) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(block), len(block) & 0xFFFFFFFF)


def _skip_length(extra: bytes) -> int | None:
    """Length of the member from its gzip extra field, if a writer has put it there."""
    at = 0
    while at + 4 <= len(extra):
        size = struct.unpack_from("<H", extra, at + 2)[0]
        if extra[at:at + 2] == b"sl" and size == 8:
            return struct.unpack_from("<I", extra, at + 4)[0] or None
        at += 4 + size
    return None


def _clean(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def _record(kind: str, fields: list[tuple[str, str]], content: bytes) -> bytes:
    head = [("WARC-Type", kind), *((k, _clean(v)) for k, v in fields if v is not None), ("Content-Length", str(len(content)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + content + b"\r\n\r\n"


def _parsed_head(head: bytes) -> dict[str, str] | None:
    """Header fields by lower-case name; None for what is not a record.  Continued lines are joined."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        return None
    out: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


class _Plain:
    """Records of an uncompressed archive: the payload is passed by seeking."""

    def __init__(self, file):
        self.file, self.buffer, self.at = file, b"", 0

    def _fill(self) -> bool:
        more = self.file.read(READ_BYTES)
        self.buffer = self.buffer[self.at:] + more
        self.at = 0
        return bool(more)

    def records(self, wanted, with_content: bool = True):
        """(headers, content) of the records that ``wanted(headers)`` takes; empty content unless it is asked for."""
        while True:
            while self.buffer[self.at:self.at + 2] == b"\r\n" or (len(self.buffer) - self.at < 2 and self._fill()):
                if self.buffer[self.at:self.at + 2] == b"\r\n":
                    self.at += 2
            while (end := self.buffer.find(b"\r\n\r\n", self.at)) < 0:
                if not self._fill():
                    if self.buffer[self.at:].strip():
                        raise ValueError("archive ends inside the headers of a record")
                    return
            head = _parsed_head(self.buffer[self.at:end])
            if head is None:
                raise ValueError("not a WARC record")
            self.at, size = end + 4, int(head.get("content-length", 0))
            keep = wanted(head)
            if keep and with_content:
                while len(self.buffer) - self.at < size:
                    if not self._fill():
                        raise ValueError("archive ends inside a record")
                yield head, self.buffer[self.at:self.at + size]
                self.at += size
                continue
            if keep:
                yield head, b""
            if size <= len(self.buffer) - self.at:
                self.at += size
            else:
                self.file.seek(size - (len(self.buffer) - self.at), io.SEEK_CUR)
                self.buffer, self.at = b"", 0


class _Gzipped:
    """Records of an archive of gzip members, one record each: only as much is inflated as the headers need."""

    def __init__(self, file):
        self.file, self.inflated = file, 0

    def records(self, wanted, with_content: bool = True):
        """(headers, content) of the records that ``wanted(headers)`` takes; empty content unless it is asked for."""
        data = b""
        while True:
            if len(data) < READ_BYTES:
                data += self.file.read(READ_BYTES)
            if not data:
                return
            if data[:3] != b"\x1f\x8b\x08":
                raise ValueError("not a gzip member")
            skip = _skip_length(data[12:12 + struct.unpack_from("<H", data, 10)[0]]) if data[3] & 4 else None
            inflate = zlib.decompressobj(16 + zlib.MAX_WBITS)
            plain, rest = b"", data
            while (end := plain.find(b"\r\n\r\n")) < 0 and not inflate.eof:
                piece = inflate.decompress(rest, READ_BYTES // 8)
                plain += piece
                rest = inflate.unconsumed_tail
                if not piece and not rest and not inflate.eof:
                    rest = more = self.file.read(READ_BYTES)
                    data += more
                    if not more:
                        raise ValueError("archive ends inside a gzip member")
            head = _parsed_head(plain[:end]) if end >= 0 else None
            if head is None:
                raise ValueError("not a WARC record")
            self.inflated += len(plain)
            keep = wanted(head)
            if keep and not with_content:
                yield head, b""
                keep = False
            if not keep and skip is not None:
                if skip <= len(data):
                    data = data[skip:]
                else:
                    self.file.seek(skip - len(data), io.SEEK_CUR)
                    data = b""
                continue
            parts = [plain]
            while not inflate.eof:
                if not rest and not inflate.unconsumed_tail:
                    rest = self.file.read(READ_BYTES)
                    if not rest:
                        raise ValueError("archive ends inside a gzip member")
                piece = inflate.decompress(inflate.unconsumed_tail or rest)
                rest = b""
                if keep:
                    parts.append(piece)
                self.inflated += len(piece)
            data = inflate.unused_data
            if keep:
                plain = b"".join(parts)
                yield head, plain[end + 4:end + 4 + int(head.get("content-length", 0))]


def _payload(head: dict[str, str], content: bytes) -> bytes:
    """The payload of a record: without the HTTP headers where it has them."""
    if head.get("content-type", "").startswith("application/http"):
        end = content.find(b"\r\n\r\n")
        return content[end + 4:] if end >= 0 else b""
    return content


# ------------------------------------------------------------------ predicates

_TESTS = {
    EqualTo: lambda a, b: a == b, EqualNullSafe: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b, StringStartsWith: lambda a, b: a.startswith(b),
    StringEndsWith: lambda a, b: a.endswith(b), StringContains: lambda a, b: b in a,
}


def _test(predicate):
    """(column, test) of a pushed predicate; None where it cannot be tested on header text.  A test of an absent field is never true."""
    if isinstance(predicate, Not):
        inner = _test(predicate.child)
        if inner is None or isinstance(predicate.child, (IsNull, IsNotNull, EqualNullSafe, Not)):
            return None
        return inner[0], lambda value, t=inner[1]: value is not None and not t(value)
    if len(predicate.attribute) != 1:
        return None
    column = predicate.attribute[0]
    if isinstance(predicate, IsNull):
        return column, lambda value: value is None
    if isinstance(predicate, IsNotNull):
        return column, lambda value: value is not None
    test, want = _TESTS.get(type(predicate)), predicate.value
    texts = want if isinstance(predicate, In) else [want]
    if test is None or not all(isinstance(x, str) for x in texts):
        return None
    # Spark compares texts by their UTF-8 bytes.
    coded = [x.encode() for x in want] if isinstance(predicate, In) else want.encode()
    return column, lambda value: value is not None and test(value.encode(), coded)


# ------------------------------------------------------------------ reader

@dataclass
class Files(InputPartition):
    paths: list[str] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(None)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType, extra: dict[str, str]):
        self.path, self.schema, self.fields = options["path"], schema, FIELDS | extra
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.predicates: list = []

    def pushFilters(self, filters):
        for predicate in filters:
            found = _test(predicate)
            if found is None or found[0] not in self.fields:
                yield predicate
            else:
                self.predicates.append(predicate)

    def partitions(self):
        out, room = [], 0
        for path, size in sorted(_archives(self.path), key=lambda f: -f[1]):
            if size > room:
                out.append(Files())
                room = self.partition_bytes
            out[-1].paths.append(path)
            room -= size
        return out or [Files()]

    def read(self, partition):
        tests = [(self.fields[c].lower(), t) for c, t in map(_test, self.predicates)]
        names = [(f.name, self.fields[f.name].lower()) for f in self.schema.fields if f.name in self.fields]
        fs = _file_system(self.path)[0]
        kind = pa.schema([(f.name, {"binary": pa.binary(), "bigint": pa.int64()}.get(f.dataType.simpleString(), pa.string())) for f in self.schema.fields])

        def wanted(head):
            return all(t(head.get(name)) for name, t in tests)

        rows: dict[str, list] = {f.name: [] for f in self.schema.fields}
        held = n = 0
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                packed = file.read(2) == b"\x1f\x8b"
                file.seek(0)
                for head, content in (_Gzipped if packed else _Plain)(file).records(wanted, bool({"payload", "payload_bytes"} & set(rows))):
                    for name, header in names:
                        rows[name].append(head.get(header))
                    body = _payload(head, content)
                    if "payload" in rows:
                        rows["payload"].append(body)
                        held += len(body)
                    if "payload_bytes" in rows:
                        rows["payload_bytes"].append(len(body))
                    n += 1
                    if held >= 8 << 20 or n >= 10_000:
                        yield pa.RecordBatch.from_pydict(rows, schema=kind)
                        rows, held, n = {f.name: [] for f in self.schema.fields}, 0, 0
        if n:
            yield pa.RecordBatch.from_pydict(rows, schema=kind)


# ------------------------------------------------------------------ writer

@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Rows with the columns of FIELDS, ``payload``, and those of ``headers``: a record each."""

    def __init__(self, options: dict, extra: dict[str, str]):
        self.path, self.extra = options["path"], extra
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator):
        fs, root = _file_system(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        named = [(c, FIELDS[c]) for c in FIELDS if c not in ("record_type", "content_type")] + list(self.extra.items())
        for batch in iterator:
            columns = {c: batch[c].to_pylist() for c, _ in named if c in batch.schema.names}
            payloads = batch["payload"].cast(pa.binary()).to_pylist()
            kinds = batch["record_type"].to_pylist()
            for i, (kind, payload) in enumerate(zip(kinds, payloads)):
                if out is None or size >= self.file_bytes:
                    if out is not None:
                        out.close()
                    files.append(f"{root.rstrip('/')}/_writing-{uuid.uuid4().hex}.warc.gz")
                    out, size = fs.open_output_stream(files[-1], compression=None), 0
                    size += out.write(_member(_record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("Content-Type", "application/warc-fields")],
                                                      b"format: WARC File Format 1.1\r\n"))) or 0
                fields = [(header, columns[c][i]) for c, header in named if c in columns]
                content = HTTP_HEAD % len(payload or b"")
                if kind == "revisit":
                    fields.append(("WARC-Profile", REVISIT_PROFILE))
                else:
                    content += payload or b""
                fields.append(("Content-Type", "application/http; msgtype=response"))
                member = _member(_record(kind, fields, content))
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages):
        fs = _file_system(self.path)[0]
        for message in messages:
            for f in message.files if message else []:
                folder, _, name = f.rpartition("/")
                fs.move(f, f"{folder}/{name.removeprefix('_writing-')}")

    def abort(self, messages):
        fs = _file_system(self.path)[0]
        for message in messages:
            for f in message.files if message else []:
                fs.delete_file(f)


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def _extra(self) -> dict[str, str]:
        """Columns of further header fields: the name in lower case with underscores for hyphens."""
        names = [x.strip() for x in self.options.get("headers", "").split(",") if x.strip()]
        extra = {n.lower().replace("-", "_"): n for n in names}
        if taken := set(extra) & {*FIELDS, "payload", "payload_bytes"}:
            raise ValueError(f"header columns {sorted(taken)} exist already")
        return extra

    def schema(self):
        texts = [T.StructField(c, T.StringType()) for c in [*FIELDS, *self._extra()]]
        body = [T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType())]
        return T.StructType(texts + (body if self.options.get("payload", "true").lower() == "true" else []))

    def reader(self, schema):
        return WarcReader(dict(self.options), schema, self._extra())

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options), self._extra())


def register(spark: SparkSession) -> None:
    """Make ``warc`` known to the session, with predicates pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# ------------------------------------------------------------------ revisits

def base32(hex_text: Column) -> Column:
    """A SHA-1 in hexadecimal as the 32 characters of base 32."""
    digits = F.concat(*[F.lpad(F.conv(F.substring(hex_text, i, 10), 16, 32), 8, "0") for i in range(1, 41, 10)])
    return F.translate(F.upper(digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, id_col: str, payload: Column, least_bytes: int = 0) -> DataFrame:
    """``pages`` with ``payload`` (binary), ``payload_bytes``, ``payload_digest``, ``record_type`` and ``first_id``.

    A record is a revisit of the one with the smallest id among those of equal payloads of at least ``least_bytes`` bytes."""
    own = {"payload", "payload_bytes", "payload_digest", "record_type", "first_id", "same", "hot_id", "cold_id", "cold"}
    if taken := own & {c.lower() for c in pages.columns}:
        raise ValueError(f"columns {sorted(taken)} exist already")
    body = F.coalesce(payload, F.lit("")).cast("binary")
    rows = pages.withColumn("payload", body)
    # Payloads below the limit are all alone.
    same = F.when(F.octet_length("payload") >= least_bytes, F.concat(F.sha2("payload", 256), F.lit(":"), F.octet_length("payload").cast("string")))
    rows = rows.withColumn("same", same)
    groups = rows.filter("same IS NOT NULL").groupBy("same").agg(F.min(id_col).alias("first"), F.count(F.lit(1)).alias("copies"))
    total = rows.count()
    often = F.col("copies") * HOT >= total
    hot = groups.filter((F.col("copies") > 1) & often).select("same", F.col("first").alias("hot_id"))
    cold = groups.filter((F.col("copies") > 1) & ~often).select(F.col("same").alias("cold"), F.col("first").alias("cold_id"))
    rows = rows.join(F.broadcast(hot), "same", "left")
    # Rows that need no other join go to a place of their own instead of that of their payload.
    rows = rows.withColumn("cold", F.when(F.col("hot_id").isNull() & F.col("same").isNotNull(), F.col("same"))
                           .otherwise(F.concat(F.lit("-"), F.xxhash64(id_col, "same").cast("string"))))
    rows = rows.join(cold, "cold", "left").withColumn("first_id", F.coalesce("hot_id", "cold_id"))
    later = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col(id_col))
    return (rows.withColumn("record_type", F.when(later, "revisit").otherwise("response"))
            .withColumn("first_id", F.when(later, F.col("first_id")))
            .withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
            .withColumn("payload_digest", base32(F.sha1("payload")))
            .drop("same", "hot_id", "cold_id", "cold"))


def record_id(number: Column) -> Column:
    """A record id made of an integer id."""
    digits = F.lpad(F.hex(number), 16, "0")
    part = lambda a, n: F.lower(F.substring(digits, a, n))
    return F.when(number.isNotNull(), F.concat(F.lit("<urn:uuid:00000000-0000-8000-"), part(1, 4), F.lit("-"), part(5, 12), F.lit(">")))


def archive_pages(pages: DataFrame, path: str, date: str, least_bytes: int = 0) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html): response, or revisit of an equal payload."""
    rows = with_revisits(pages.select("page_id", "url", "html"), "page_id", F.col("html"), least_bytes)
    out = rows.select(
        F.coalesce(record_id(F.col("page_id")), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))).alias("record_id"), "record_type",
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.concat(F.lit("sha1:"), "payload_digest").alias("payload_digest"),
        record_id(F.col("first_id")).alias("refers_to"), F.when(F.col("record_type") == "response", F.col("payload")).alias("payload"),
        F.col("page_id").cast("string").alias("page_id"), F.col("first_id").cast("string").alias("first_page_id"),
        F.col("payload_bytes").cast("string").alias("full_length"))
    out.write.format("warc").option("headers", PAGE_HEADERS).mode("append").save(path)


#: Header fields of pages: their own and their response's integer id, and the length of the full payload.
PAGE_HEADERS = "Page-ID,First-Page-ID,Full-Length"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The page records of an archive: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest of a response are taken from the payload read, those of a revisit from its headers."""
    rows = (spark.read.format("warc").option("headers", PAGE_HEADERS).load(path).filter(F.col("record_type").isin("response", "revisit")))
    response = F.col("record_type") == "response"
    return rows.select(F.col("page_id").cast("bigint").alias("page_id"),
                       F.when(response, F.col("payload_bytes")).otherwise(F.col("full_length").cast("bigint")).alias("payload_bytes"),
                       F.when(response, base32(F.sha1("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
                       "record_type", F.col("first_page_id").cast("bigint").alias("refers_to"))
