"""WARC archives as a Python data source, read and written in parallel.

``spark.read.format("warc")`` reads ``.warc`` and ``.warc.gz`` files of a folder or one file:

* The driver lists the files and packs them into partitions of ``partitionBytes``.
* Equality, ``IN``, prefix, range and null predicates on the header columns are pushed into the reader
  (the session must have ``PUSHDOWN`` on; ``read`` sets it).
* Of each record the header is parsed first.  A record that fails a predicate is passed over: in a plain
  file by a seek, in a compressed one by a seek too where the gzip member states its length (``sl`` field,
  as the format's annex describes and ``write`` writes it), else by inflating into nothing.
* The payload is cut out, and its transfer and content coding are undone, for records that pass only, and
  only with ``payload`` true; without it the block is passed over after its HTTP head.

``write`` makes one gzip member per record and starts a new file every ``fileBytes``.  A task writes to a
staging folder, whose name readers pass over; the commit moves the files of the tasks that count, so what a lost
executor or a second attempt has written is never read.  Paths are opened by ``pyarrow.fs``: local and shared folders, and stores it knows.
A file is not divided between tasks, since only its beginning is known to be the start of a record.

Columns: record_type, record_id, target_uri, date, content_type, payload_digest, refers_to (header texts,
null if absent), content_length, http_status and payload_length (of the HTTP head in the block, null
without one), with ``payload`` the payload.  Option ``headers`` names further header fields, one text column each.

Nulls and edges: a null payload is empty; a null header value is left out; control characters of header
values are percent-coded; a folder without archives gives an empty table; leading blank lines and folded
header lines are read; a cut-off or foreign file raises ``ValueError`` with its name.  Of ``digest``: a null
or empty html is an empty payload, a page id that repeats with the same payload is a response each time if
it is the smallest, null ids are revisits of the smallest id that is not null, and responses if there is
none.  Further columns are ignored.
"""

import io
import json
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import clickmart.llm
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart import storage

# workers need not have the package on their path
cloudpickle.register_pickle_by_value(clickmart.llm)

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: fixed values: header fields by column
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "Content-Type",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
_BRACKETED = ("record_id", "refers_to")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "application/http;msgtype=response"
PARTITION_BYTES = 128 << 20
FILE_BYTES = 128 << 20
_BATCH_BYTES = 8 << 20
_PIECE = 1 << 16
MIN_REVISIT = 100


# ---- files ----------------------------------------------------------------------------------

def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"file:/(?!/)", path):
        path = path[len("file:"):]
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def _archives(path: str) -> list[tuple[str, int]]:
    """(file, bytes) of the archives at ``path``, in order of their names."""
    fs, root = filesystem(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(info.path, info.size)]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    below = len(root.rstrip("/")) + 1
    return sorted(
        (f.path, f.size) for f in found
        if f.type == pafs.FileType.File and f.path.endswith((".warc", ".warc.gz"))
        and not any(part.startswith(("_", ".")) for part in f.path[below:].split("/"))
    )


# ---- streams of records ---------------------------------------------------------------------

class _Plain:
    """Bytes of an uncompressed archive."""

    def __init__(self, file):
        self.file = file

    def line(self, most: int = -1) -> bytes:
        return self.file.readline(most)

    def read(self, n: int) -> bytes:
        return self.file.read(n)

    def skip(self, n: int) -> None:
        self.file.seek(n, io.SEEK_CUR)


class _Gzip:
    """Inflated bytes of the members of an archive, as far as they are asked for."""

    def __init__(self, file):
        self.file, self.held, self.zipped = file, b"", None

    def _open(self) -> bool:
        """Begin the next member; false at the end of the file."""
        self.start = self.file.tell()
        head = self.file.read(24)
        if not head:
            return False
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError("not a gzip member")
        self.sizes = None
        if len(head) == 24 and head[3] & 4 and head[12:16] == b"sl\x08\x00":
            self.sizes = struct.unpack("<II", head[16:24])
        self.file.seek(self.start)
        self.zipped, self.given = zlib.decompressobj(31), 0
        return True

    def _more(self) -> bytes:
        """Some more inflated bytes; none at the end of the file."""
        while True:
            if self.zipped is None and not self._open():
                return b""
            raw = self.zipped.unconsumed_tail or self.file.read(_PIECE)
            out = self.zipped.decompress(raw, _PIECE)
            if self.zipped.eof:
                # the next member begins right behind
                self.file.seek(-len(self.zipped.unused_data), io.SEEK_CUR)
                self.zipped = None
            elif not raw and not out:
                raise ValueError("the last gzip member is cut off")
            if out:
                self.given += len(out)
                return out

    def line(self, most: int = -1) -> bytes:
        """Up to and with the next line end, ``most`` bytes at most."""
        parts, size = [], 0
        while self.held or (piece := self._more()):
            self.held = self.held or piece
            ended = self.held.find(b"\n") + 1
            at = ended or len(self.held)
            if most >= 0:
                at = min(at, most - size)
            parts.append(self.held[:at])
            size, self.held = size + at, self.held[at:]
            if (ended and ended == at) or size == most:
                break
        return b"".join(parts)

    def read(self, n: int) -> bytes:
        parts, size = [self.held], len(self.held)
        while size < n and (piece := self._more()):
            parts.append(piece)
            size += len(piece)
        found = b"".join(parts)
        self.held = found[n:]
        return found[:n]

    def skip(self, n: int) -> None:
        # to the end of a member of known length: nothing needs to be inflated
        if self.zipped is not None and self.sizes and self.given - len(self.held) + n == self.sizes[1]:
            self.file.seek(self.start + self.sizes[0])
            self.held, self.zipped = b"", None
            return
        while n > 0:
            if not self.held and not (piece := self._more()):
                return
            self.held = self.held or piece
            n, self.held = n - min(n, len(self.held)), self.held[n:]


def _fields(stream) -> dict[str, str] | None:
    """The next header, names in lower case; None at the end."""
    line = stream.line()
    while line in (b"\r\n", b"\n"):
        line = stream.line()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record where one should begin: {line[:40]!r}")
    return _named(stream.line)


def _named(next_line) -> dict[str, str]:
    fields, name = {}, None
    while (line := next_line().rstrip(b"\r\n")):
        text = line.decode("utf-8", "replace")
        if text[0] in " \t" and name:
            fields[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        fields[name] = value.strip()
    return fields


class _Block:
    """The block of one record, of which the stream may be asked for any first part."""

    def __init__(self, stream, length: int):
        self.stream, self.left = stream, length

    def line(self) -> bytes:
        found = self.stream.line(self.left)
        self.left -= len(found)
        return found

    def read(self) -> bytes:
        found = self.stream.read(self.left)
        if len(found) < self.left:
            raise ValueError("the last record is cut off")
        self.left = 0
        return found

    def close(self) -> None:
        # a record ends with two line ends
        self.stream.skip(self.left + 4)


def _unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16) if end > at else 0
        if not size:
            return b"".join(parts)
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def _decoded(body: bytes, head: dict[str, str]) -> bytes:
    """The payload without its transfer and content coding."""
    if head.get("transfer-encoding", "").lower() == "chunked":
        body = _unchunked(body)
    coding = head.get("content-encoding", "").lower()
    if coding in ("gzip", "x-gzip", "deflate"):
        body = zlib.decompressobj(47).decompress(body)
    return body


# ---- predicates -----------------------------------------------------------------------------

@dataclass(frozen=True)
class _Test:
    column: str
    kind: str
    value: object = None
    negated: bool = False

    def passes(self, row: dict) -> bool:
        return self._holds(row.get(self.column)) != self.negated

    def _holds(self, found) -> bool:
        if self.kind == "null":
            return found is None
        if self.kind == "same":
            return found == self.value
        if found is None:
            # unknown: neither the predicate nor its negation lets the row pass
            return self.negated
        if self.kind == "prefix":
            return found.startswith(self.value)
        if self.kind == "in":
            return found in self.value
        return {
            "=": found == self.value, ">": found > self.value, ">=": found >= self.value,
            "<": found < self.value, "<=": found <= self.value,
        }[self.kind]


def _test(found: ds.Filter, columns: set[str]) -> _Test | None:
    """The filter as a test of a header column; None if Spark has to apply it."""
    if isinstance(found, ds.Not):
        inner = _test(found.child, columns)
        return None if inner is None or inner.negated else _Test(inner.column, inner.kind, inner.value, True)
    if len(getattr(found, "attribute", ())) != 1 or found.attribute[0] not in columns:
        return None
    column, value = found.attribute[0], getattr(found, "value", None)
    kinds = {
        ds.EqualTo: "=", ds.GreaterThan: ">", ds.GreaterThanOrEqual: ">=", ds.LessThan: "<",
        ds.LessThanOrEqual: "<=", ds.StringStartsWith: "prefix", ds.EqualNullSafe: "same",
    }
    if type(found) in kinds:
        return _Test(column, kinds[type(found)], value)
    if isinstance(found, ds.In):
        # a null in the list makes the rest unknown; Spark decides
        return None if None in found.value else _Test(column, "in", frozenset(found.value))
    if isinstance(found, ds.IsNull):
        return _Test(column, "null")
    if isinstance(found, ds.IsNotNull):
        return _Test(column, "null", negated=True)
    return None


# ---- the data source ------------------------------------------------------------------------

class WarcPartition(ds.InputPartition):
    def __init__(self, files: tuple[str, ...]):
        super().__init__(files)
        self.files = files


def _truth(options, name: str) -> bool:
    return str(options.get(name, "true")).lower() == "true"


class WarcDataSource(ds.DataSource):
    """Options: path, payload (true), headers (JSON list), partitionBytes, fileBytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def _further(self) -> list[str]:
        return json.loads(self.options.get("headers", "[]"))

    def schema(self) -> T.StructType:
        fields = [T.StructField(c, T.StringType()) for c in [*FIELDS, *self._further()]]
        fields += [
            T.StructField("content_length", T.LongType()), T.StructField("http_status", T.IntegerType()),
            T.StructField("payload_length", T.LongType()),
        ]
        if _truth(self.options, "payload"):
            fields.append(T.StructField("payload", T.BinaryType()))
        return T.StructType(fields)

    def reader(self, schema: T.StructType) -> "WarcReader":
        return WarcReader(dict(self.options), schema, self._further())

    def writer(self, schema: T.StructType, overwrite: bool) -> "WarcWriter":
        return WarcWriter(dict(self.options), schema, overwrite)


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType, further: list[str]):
        self.path = options["path"]
        self.payload = "payload" in schema.names
        self.target = int(options.get("partitionbytes", options.get("partitionBytes", PARTITION_BYTES)))
        self.columns = FIELDS | {name: name for name in further}
        self.names = schema.names
        self.tests: list[_Test] = []

    def pushFilters(self, filters):
        known = {*self.columns, "content_length"}
        for found in filters:
            test = _test(found, known)
            if test is None:
                yield found
            else:
                self.tests.append(test)

    def partitions(self) -> list[WarcPartition]:
        packed, held, size = [], [], 0
        for file, length in _archives(self.path):
            if held and size + length > self.target:
                packed.append(WarcPartition(tuple(held)))
                held, size = [], 0
            held.append(file)
            size += length
        if held:
            packed.append(WarcPartition(tuple(held)))
        return packed or [WarcPartition(())]

    def read(self, partition: WarcPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(self.path)
        rows, size = [], 0
        for path in partition.files:
            with fs.open_input_file(path) as raw, io.BufferedReader(raw, 1 << 20) as file:
                try:
                    for row in self._records(_Gzip(file) if path.endswith(".gz") else _Plain(file)):
                        rows.append(row)
                        size += 500 + len(row.get("payload") or b"")
                        if size >= _BATCH_BYTES:
                            yield self._batch(rows)
                            rows, size = [], 0
                except (ValueError, zlib.error) as fault:
                    raise ValueError(f"{path}: {fault}") from fault
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {
            "content_length": pa.int64(), "payload_length": pa.int64(), "http_status": pa.int32(),
            "payload": pa.binary(),
        }
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in self.names], self.names
        )

    def _records(self, stream) -> Iterator[dict]:
        while (fields := _fields(stream)) is not None:
            row = {c: fields.get(h.lower()) for c, h in self.columns.items()}
            for c in _BRACKETED:
                row[c] = row[c] and row[c].strip("<>")
            length = int(fields["content-length"])
            row["content_length"] = length
            block = _Block(stream, length)
            if all(test.passes(row) for test in self.tests):
                self._open(block, row)
                yield row
            block.close()

    def _open(self, block: _Block, row: dict) -> None:
        """HTTP head and payload of the block."""
        head: dict[str, str] = {}
        if (row["content_type"] or "").lower().replace(" ", "").startswith("application/http"):
            status = block.line().split()
            if len(status) > 1 and status[1].isdigit():
                row["http_status"] = int(status[1])
            head = _named(block.line)
            if head.get("content-length", "").isdigit():
                row["payload_length"] = int(head["content-length"])
        if self.payload:
            row["payload"] = _decoded(block.read(), head)


@dataclass
class WarcFiles(ds.WriterCommitMessage):
    names: list[str]


def _value(text) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(text))


def _member(record: bytes) -> bytes:
    """One gzip member that states its own length."""
    zipper = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = zipper.compress(record) + zipper.flush()
    size = 24 + len(body) + 8
    if max(size, len(record)) < 2**32:
        head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + b"\x0c\x00sl\x08\x00" + struct.pack("<II", size, len(record))
    else:
        head = b"\x1f\x8b\x08\x00" + bytes(5) + b"\xff"
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _record(row: dict, further: dict) -> bytes:
    """Header and block: a response with its payload, a revisit with the HTTP head only, or the payload itself."""
    kind, payload = row["record_type"], row.get("payload") or b""
    fields = {h: row.get(c) for c, h in FIELDS.items()} | further
    for c in _BRACKETED:
        if fields[FIELDS[c]] is not None:
            fields[FIELDS[c]] = f"<{fields[FIELDS[c]]}>"
    block = payload
    if kind in ("response", "revisit"):
        length = row.get("payload_length")
        length = len(payload) if length is None else length
        block = (
            f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n"
        ).encode()
        if kind == "response":
            block += payload
        else:
            fields["WARC-Profile"] = _PROFILE
        fields["Content-Type"] = _HTTP
    lines = ["WARC/1.1", *[f"{h}: {_value(v)}" for h, v in fields.items() if v is not None]]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""])
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, schema: T.StructType, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.limit = int(options.get("filebytes", options.get("fileBytes", FILE_BYTES)))
        self.date = options.get("date", "1970-01-01T00:00:00Z")
        self.staging = f"_staging-{uuid.uuid4().hex}"
        known = {*FIELDS, "payload", "payload_length"}
        self.further = [n for n in schema.names if n not in known]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WarcFiles:
        fs, root = filesystem(self.path)
        context = TaskContext.get()
        stem = f"part-{context.partitionId():06d}-{uuid.uuid4().hex}"
        fs.create_dir(f"{root}/{self.staging}", recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            columns = {n: batch.column(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                row = {n: c[i].as_py() for n, c in columns.items()}
                row["date"] = row.get("date") or self.date
                member = _member(_record(row, {n: row[n] for n in self.further}))
                if out is not None and size + len(member) > self.limit:
                    out.close()
                    out = None
                if out is None:
                    names.append(f"{stem}-{len(names)}.warc.gz")
                    out, size = fs.open_output_stream(f"{root}/{self.staging}/{names[-1]}", compression=None), 0
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
        return WarcFiles(names)

    def commit(self, messages) -> None:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        if self.overwrite:
            for file, _ in _archives(self.path):
                fs.delete_file(file)
        for message in messages:
            for name in message.names if message else []:
                fs.move(posixpath.join(root, self.staging, name), posixpath.join(root, name))
        self._clear(fs, root)

    def abort(self, messages) -> None:
        self._clear(*filesystem(self.path))

    def _clear(self, fs, root: str) -> None:
        if fs.get_file_info(f"{root}/{self.staging}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.staging}")


# ---- use ------------------------------------------------------------------------------------

def read(spark: SparkSession, path: str, payload: bool = True, headers: list[str] | None = None) -> DataFrame:
    """The records of the archives at ``path``; without ``payload`` no block is read beyond its HTTP head."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set(PUSHDOWN, "true")
    options = {"payload": str(payload).lower(), "headers": json.dumps(headers or [])}
    return spark.read.format("warc").options(**options).load(path)


def write(records: DataFrame, path: str, mode: str = "append", **options) -> None:
    """One record per row: record_type, and what there is of the header columns, payload and payload_length.

    Columns of other names become header fields of that name.
    """
    records.sparkSession.dataSource.register(WarcDataSource)
    records.write.format("warc").options(**options).mode(mode).save(path)


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Records to write: equal payloads of ``MIN_REVISIT`` bytes or more are stored once, with the smallest id."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").alias("target_uri"),
        F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    # few rows: the payloads that occur more than once
    shared = (
        rows.filter(F.octet_length("payload") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
        .filter("n > 1")
        .select("digest", "first_id")
    )
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))

    def name(page: str):
        return F.concat_ws(":", F.lit("urn:x-page"), F.col("digest"), F.coalesce(F.col(page).cast("string"), F.lit("")))

    return rows.join(shared, "digest", "left").select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        name("page_id").alias("record_id"),
        "target_uri",
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(again, name("first_id")).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def digest(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, read back from written archives."""
    spark = pages.sparkSession
    path = storage.scratch_path(spark, "warc")
    write(records_of_pages(pages), path)

    def page(record: str):
        return F.regexp_extract(record, r":(-?\d*)$", 1).try_cast("long")

    full = read(spark, path).filter("record_type = 'response'").select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"),
    )
    thin = read(spark, path, payload=False).filter("record_type = 'revisit'").select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
        page("refers_to").alias("refers_to"),
    )
    return full.unionByName(thin)
