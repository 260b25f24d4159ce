"""WARC records in ZIP packages: written by Spark, read by ranges, never extracted.

A package is a ZIP file of stored (uncompressed) members: `archive/data.warc.gz`, one gzip member
a record; `indexes/index.cdxj`, a line a record with its offset and length in the archive; and
`datapackage.json`. Each task writes packages of its own rows. A package counts only once Spark
has committed its line in the manifest, so what a lost task leaves behind is never read.

Reading needs the manifest, or any frame of paths. A task reads a package's end, finds the central
directory (by the ZIP64 records where there are any), each member's place, and then the index, in
pieces. An archive that no index covers is scanned once for the places of its records. The records
are then dealt out by package and stretch of the file, so that one large package is read by
many tasks, each stretch in order and through a buffer.

Packages are files that `pyarrow.fs` opens: a local or mounted folder, s3, gs, hdfs.

Of pages with equal payloads the one of the largest page_id is a response, with the payload; the
others are revisits, which hold its digest, its length and the id of the response. Odd cases: a
null page is an empty payload; empty payloads are equal payloads. A null page_id counts as the
smallest, and if a payload has no other all are responses; so are all rows that share
the largest id. A null url is an empty one; control characters and blanks in it are
percent-encoded. An empty table makes no package. Extra columns are ignored. A page is held in
memory as a whole, a package or an index never is.

What cannot be read is reported, not raised: a file that is no ZIP gives a row of `members` and of
`ranges` with an error and has no records, a member that is not stored is listed but has no records,
a package that cannot be read to its end has a record with an error behind those that were found, and
so has one with other than the `records` of its manifest; a record that cannot be parsed or whose
payload has another digest has an error. `pages`, the way back of what `write` made, raises all those.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm.common import ship, width
from barsmith.session import scratch_table, sized_side

ship(__name__)

# bytes or records of an archive after which a task begins another package; bytes of a stretch of a file
PACKAGE, LINES, STRETCH = 256 << 20, 200_000, 64 << 20
# bytes read at once
PIECE = 1 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
EPOCH = "1970-01-01T00:00:00Z"

# Signatures and layouts of the ZIP format, and its marks for "see ZIP64".
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4"
END_FORM = "<4s4H2LH"
END64_FORM = "<4sQ2H2L4Q"
LOCATOR_FORM = "<4sLQL"
ENTRY_FORM = "<4s6H3L5H2L"
LOCAL_FORM = "<4s5H3L2H"
MANY, LONG, STORED, ZIP64 = 0xFFFF, 0xFFFFFFFF, 0, 1

# Names of the WARC format.
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MEMBERS = "package string, name string, method int, start bigint, bytes bigint, error string"
RANGES = "package string, name string, start bigint, bytes bigint, error string"
RECORDS = (
    "package string, start bigint, record_id string, type string, url string, date string, refers_to string, "
    "payload_bytes bigint, payload_digest string, error string"
)


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


# Writing


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)


def _block(*lines: str) -> bytes:
    return "\r\n".join([*lines, "", ""]).encode()


def record(page_id, url: str, payload: bytes, digest: bytes, refers, date: str = EPOCH) -> bytes:
    """A response, or with `refers` a revisit, as one gzip member."""
    http = _block("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}")
    body = http + (payload if refers is None else b"")
    head = [
        VERSION.decode(),
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {url}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base32(digest)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if refers is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers}>"]
    return gzip.compress(_block(*head) + body + b"\r\n\r\n", 6, mtime=0)


class Package:
    """A ZIP package being written as a stream."""

    def __init__(self, path: str):
        self.path, self.size, self.lines = path, 0, []
        files, place = _file_system(path)
        files.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.out = files.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.archive = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)

    def add(self, data: bytes, url: str, digest: bytes, date: str = EPOCH) -> None:
        self.archive.write(data)
        facts = {"url": url, "digest": f"sha1:{base32(digest)}", "offset": self.size, "length": len(data)}
        stamp = re.sub(r"\D", "", date)
        self.lines.append(f"{url} {stamp} {json.dumps(facts | {'filename': ARCHIVE.split('/')[1]})}\n")
        self.size += len(data)

    def close(self) -> tuple[str, int, int]:
        self.archive.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w") as index:
            for line in sorted(self.lines):
                index.write(line.encode())
        about = {"profile": "data-package", "resources": [{"path": ARCHIVE, "bytes": self.size}, {"path": INDEX}]}
        self.zip.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps(about))
        self.zip.close()
        self.out.close()
        return self.path, len(self.lines), self.size


def write(pages: DataFrame, folder: str, package_bytes: int = PACKAGE) -> DataFrame:
    """Write pages (page_id, url, html) into packages below `folder`; the manifest.

    The manifest (package, records, bytes) is a written table.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    # Only payloads that repeat have a line here; the payloads themselves are not dealt out for it.
    repeated = rows.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("of"))
    repeated = sized_side(repeated.where((F.col("n") > 1) & F.col("of").isNotNull()).select("digest", "of"))
    refers = F.when(F.col("of").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("of")), F.col("of"))
    decided = rows.join(repeated, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers"))

    def run(batches):
        part, package = TaskContext.get().partitionId(), None

        def line(closed):
            return pa.RecordBatch.from_pylist([dict(zip(("package", "records", "bytes"), closed))])

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*batch.columns):
                if package is None:
                    package = Package(f"{folder.rstrip('/')}/part-{part:05d}-{uuid.uuid4().hex}.zip")
                url, digest = _clean(url.as_py()), digest.as_py()
                package.add(record(page_id.as_py(), url, payload.as_py(), digest, refers_to.as_py()), url, digest)
                if package.size >= package_bytes or len(package.lines) >= LINES:
                    yield line(package.close())
                    package = None
        if package is not None:
            yield line(package.close())

    return scratch_table(decided.mapInArrow(run, "package string, records bigint, bytes bigint"), "manifest")


# Reading


class File:
    """Ranges of a file, read through a buffer that suits rising places."""

    def __init__(self, path: str):
        files, place = _file_system(path)
        self.file = files.open_input_file(place)
        self.size, self.at, self.held = self.file.size(), 0, b""

    def read(self, start: int, size: int) -> bytes:
        if not self.at <= start <= start + size <= self.at + len(self.held):
            self.file.seek(start)
            self.at, self.held = start, self.file.read(max(size, PIECE))
        return self.held[start - self.at : start - self.at + size]

    def pieces(self, start: int, size: int):
        for at in range(start, start + size, PIECE):
            yield self.read(at, min(PIECE, start + size - at))

    def close(self) -> None:
        self.file.close()


def _end(file: File) -> tuple[int, bytes, int]:
    """Where the file's last bytes begin, those, and where the end of a central directory is in them, or -1."""
    tail_at = max(0, file.size - struct.calcsize(END_FORM) - MANY)
    tail = file.read(tail_at, file.size - tail_at)
    at = tail.rfind(END, 0, max(0, len(tail) - 18))
    while at >= 0 and at + struct.calcsize(END_FORM) + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(END, 0, at)  # the mark may stand in the comment
    return tail_at, tail, at


def directory(file: File) -> list[tuple[str, int, int, int]]:
    """(name, method, start, bytes) of each member, from the central directory."""
    tail_at, tail, at = _end(file)
    if at < 0:
        raise ValueError("no end of a central directory")
    _, _, _, _, count, size, offset, _ = struct.unpack_from(END_FORM, tail, at)
    end = tail_at + at
    if end >= struct.calcsize(LOCATOR_FORM):
        mark, _, place, _ = struct.unpack(LOCATOR_FORM, file.read(end - 20, 20))
        if mark == LOCATOR:
            fields = struct.unpack(END64_FORM, file.read(place, struct.calcsize(END64_FORM)))
            if fields[0] != END64:
                raise ValueError("no ZIP64 end where its locator points")
            count, size, offset, end = fields[7], fields[8], fields[9], place
    before = end - size - offset  # bytes that stand before the ZIP file, as in one that extracts itself
    if before < 0:
        raise ValueError("the central directory does not fit the file")
    members, at = [], offset + before
    for _ in range(count):
        entry = struct.unpack(ENTRY_FORM, file.read(at, 46))
        if entry[0] != ENTRY:
            raise ValueError("no entry where the central directory has one")
        method, packed, full, names, extras, comments, local = entry[4], entry[8], entry[9], *entry[10:13], entry[16]
        name, extra = file.read(at + 46, names), file.read(at + 46 + names, extras)
        at += 46 + names + extras + comments
        long = list(_zip64(extra))
        if full == LONG:
            full = long.pop(0)
        if packed == LONG:
            packed = long.pop(0)
        if local == LONG:
            local = long.pop(0)
        members.append((name.decode("utf-8", "replace"), method, local + before, packed))
    return [(name, method, _data(file, local), packed) for name, method, local, packed in members]


def _zip64(extra: bytes):
    """The numbers of the ZIP64 field among an entry's extra fields."""
    while len(extra) >= 4:
        kind, size = struct.unpack_from("<2H", extra)
        if kind == ZIP64:
            yield from struct.unpack_from(f"<{size // 8}Q", extra, 4)
            return
        extra = extra[4 + size :]


def _data(file: File, local: int) -> int:
    """Where a member's bytes begin: after its own header, whose fields may be longer than the entry's."""
    header = struct.unpack(LOCAL_FORM, file.read(local, 30))
    if header[0] != LOCAL:
        raise ValueError("no member where the central directory has one")
    return local + 30 + header[9] + header[10]


def _lines(pieces):
    rest = b""
    for piece in pieces:
        *whole, rest = (rest + piece).split(b"\n")
        yield from whole
    yield rest


def indexed(file: File, start: int, size: int):
    """(archive's file name, offset, length) for each line of an index."""
    for line in _lines(file.pieces(start, size)):
        parts = line.split(b" ", 2)  # the key and the time hold no blanks
        if len(parts) == 3:
            facts = json.loads(parts[2])
            yield facts["filename"], int(facts["offset"]), int(facts["length"])
        elif line.strip() and not line.startswith(b"!"):  # no line of the index's own head
            raise ValueError("an index line without a place")


def scanned(file: File, start: int, size: int, packed: bool):
    """(offset, length) of each record of an archive without an index."""
    if not packed:
        at = 0
        while at < size:
            head = b""
            while b"\r\n\r\n" not in head and at + len(head) < size:
                head += file.read(start + at + len(head), min(4096, size - at - len(head)))
            end = head.index(b"\r\n\r\n") + 4
            length = end + int(fields(head[:end])["content-length"]) + 4
            yield at, length
            at += length
        return
    begin, opened = 0, zlib.decompressobj(31)
    for number, piece in enumerate(file.pieces(start, size)):
        end = number * PIECE + len(piece)
        while piece:
            opened.decompress(piece)
            if not opened.eof:
                break
            piece = opened.unused_data
            yield begin, end - len(piece) - begin
            begin, opened = end - len(piece), zlib.decompressobj(31)
    if begin < size:
        raise EOFError("the archive ends within a record")


def ranges_of(file: File):
    """(archive, start, bytes) of the records of a package; starts count from its first byte."""
    stored = [m for m in directory(file) if m[1] == STORED]
    archives = {n.rsplit("/", 1)[-1]: (n, at, size) for n, _, at, size in stored if re.search(r"\.warc(\.gz)?$", n)}
    covered = set()
    for name, _, at, size in stored:
        if name.endswith(".cdxj"):
            for of, offset, length in indexed(file, at, size):
                if of in archives:
                    covered.add(of)
                    yield archives[of][0], archives[of][1] + offset, length
    for of, (name, at, size) in archives.items():
        if of not in covered:
            for offset, length in scanned(file, at, size, name.endswith(".gz")):
                yield name, at + offset, length


def fields(head: bytes) -> dict[str, str]:
    """Named fields of a header, names in lower case."""
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, colon, value in lines if colon}


def parsed(data: bytes) -> dict:
    """A record's facts, and its payload (None for a revisit)."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    named = fields(head)
    body = rest[: int(named["content-length"])]
    if len(body) < int(named["content-length"]):
        raise ValueError("the record is cut short")
    payload, http = body, {}
    if named.get("content-type", "").startswith("application/http"):
        first, _, payload = body.partition(b"\r\n\r\n")
        http = fields(first)
    digest = named.get("warc-payload-digest", "").removeprefix("sha1:")
    out = {
        "record_id": named.get("warc-record-id"),
        "type": named.get("warc-type"),
        "url": named.get("warc-target-uri"),
        "date": named.get("warc-date"),
        "refers_to": named.get("warc-refers-to"),
    }
    if out["type"] == "revisit":
        size = http.get("content-length")
        return out | {"payload": None, "payload_bytes": None if size is None else int(size), "payload_digest": digest or None}
    own = base32(hashlib.sha1(payload).digest())
    wrong = "the payload has another digest" if digest and digest != own else None
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": own, "error": wrong}


def _each(packages: DataFrame, read, schema: str, *more) -> DataFrame:
    """`read(path, *more)` gives rows for each package, each package in a task of its own if there are enough."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for given in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                for row in read(*given):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield _batch(names, rows, schema)
                        rows = []
                yield _batch(names, rows, schema)

    paths = packages.select("package", *more).where(F.col("package").isNotNull())
    return paths.repartition(width(packages.sparkSession), "package").mapInArrow(run, schema)


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _batch(names: list[str], rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = [_ARROW[f.split()[1]] for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def packages(spark: SparkSession, folder: str) -> DataFrame:
    """The ZIP files below a folder, of whatever origin, as `package`; none is opened."""
    listed = spark.read.format("binaryFile").options(pathGlobFilter="*.{zip,wacz}", recursiveFileLookup=True).load(folder)
    return listed.select(F.col("path").alias("package"))


def members(packages: DataFrame) -> DataFrame:
    """package, name, method (0: stored), start, bytes of every member; or an error."""

    def read(path):
        try:
            file = File(path)
            try:
                yield from ((path, *m, None) for m in directory(file))
            finally:
                file.close()
        except (ValueError, OSError, struct.error) as error:
            yield path, None, None, None, None, f"{type(error).__name__}: {error}"[:200]

    return _each(packages, read, MEMBERS)


def ranges(packages: DataFrame) -> DataFrame:
    """package, name (of the archive), start, bytes of every record; or an error.

    Records found before the damage stay. An error's start is 0, or null if the file is no ZIP at all.
    With a column `records`, as manifests have, each package must have that many.
    """
    due = F.col("records").cast("bigint") if "records" in packages.columns else F.lit(None).cast("bigint")

    def read(path, due):
        found, start = 0, 0
        try:
            file = File(path)
            try:
                if due is None and file.read(0, 4) != LOCAL and _end(file)[2] < 0:
                    start = None  # it neither begins nor ends as a ZIP
                for r in ranges_of(file):
                    yield path, *r, None
                    found += 1
            finally:
                file.close()
            if due not in (None, found):
                raise ValueError(f"{found} records of {due}")
        except (ValueError, OSError, KeyError, TypeError, IndexError, EOFError, zlib.error, struct.error) as error:
            yield path, None, start, None, f"{type(error).__name__}: {error}"[:200]

    return _each(packages, read, RANGES, due.alias("due"))


def records(ranges: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the ranges; with `payloads` also their payloads (null for revisits).

    An error of the ranges is a record with that error, but for files that are no ZIP.
    """
    schema = RECORDS + (", payload binary" if payloads else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        path, file = None, None
        for batch in batches:
            rows, held = [], 0
            for package, start, size, damage in zip(*(c.to_pylist() for c in batch.columns)):
                if damage is not None:
                    rows.append(tuple({"package": package, "start": start, "error": damage}.get(n) for n in names))
                    continue
                if package != path:
                    if file:
                        file.close()
                    path, file = package, File(package)
                try:
                    facts = parsed(file.read(start, size))
                except (ValueError, KeyError, EOFError, OSError, zlib.error) as error:
                    facts = {"error": f"{type(error).__name__}: {error}"[:200]}
                facts |= {"package": package, "start": start}
                rows.append(tuple(facts.get(n) for n in names))
                held += size
                if held > PIECE * 8:
                    yield _batch(names, rows, schema)
                    rows, held = [], 0
            yield _batch(names, rows, schema)
        if file:
            file.close()

    damage = F.col("error") if "error" in ranges.columns else F.lit(None).cast("string").alias("error")
    dealt = ranges.select("package", "start", "bytes", damage, F.floor(F.col("start") / STRETCH).alias("stretch"))
    dealt = dealt.where("start is not null")
    dealt = dealt.repartition(width(ranges.sparkSession), "package", "stretch").sortWithinPartitions("package", "start")
    return dealt.select("package", "start", "bytes", "error").mapInArrow(run, schema)


def pages(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records that `write` made.

    A record with an error ends the job: no page may be missing or have another's facts.
    """

    def number(column: str):
        digits = F.regexp_extract(column, "^<urn:page:(-?[0-9]+)>$", 1)
        return F.when(digits != "", digits.cast("bigint"))

    said = F.concat_ws(" ", F.lit("not read back:"), "package", "start", "error")
    whole = records.where(F.when(F.col("error").isNull(), True).otherwise(F.raise_error(said).cast("boolean")))
    return whole.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )
