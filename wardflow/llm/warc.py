"""WARC archives: written as whole-file gzip streams, normalised to a member per record with an index of offsets, read back.

A crawl writes each archive as one gzip stream, which can only be read from its beginning. The normaliser inflates such a
stream once, writes every record anew as a gzip member of its own, and notes where each member begins and how long it is
in a sidecar file next to the archive. Readers then fetch any record, or any range of an archive, by its offset. While
it rewrites, the normaliser turns responses whose payload another record keeps into revisits, which hold no payload.

Which record keeps a payload is decided by Spark between the two steps, on digests only; html moves through no shuffle.
Files lie in the shared folder under names that no other attempt uses, and count only once the task's rows are stored, so
a lost executor leaves at most a file that nobody refers to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_folder, stored

#: An archive is closed after so many bytes before compression, or so many records.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 64 << 20, 50_000
#: Bytes of a normalised archive that one task reads back.
RANGE_BYTES = 16 << 20
#: Payloads with at least a record in so many are frequent; so at most that many rows of about 200 bytes are broadcast.
SHARE = 4096
#: Most tasks of a step.
MOST_TASKS = 100_000
CHUNK = 1 << 16
VERSION = b"WARC/1.1\r\n"
#: Date of the records, as pages tell none.
DATE = "1970-01-01T00:00:00Z"
#: Fixed name of the profile of revisits by digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
KEY, REFERS_KEY = "X-Page-Key", "X-Refers-To-Page-Key"


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file of the cluster; a local path needs no scheme."""
    scheme = urlsplit(uri).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(uri).path
    return fs.FileSystem.from_uri(uri)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def head(fields: dict[str, str | None]) -> bytes:
    """A record's head; fields without a value are left out."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return VERSION + lines.encode() + b"\r\n"


def _line_safe(text: str | None) -> str | None:
    """Text that fits into one header line: white space and control characters, and the escape itself, are percent-coded."""
    return None if text is None else quote(text, safe=":/?#[]@!$&'()*+,;=~-._")


def _back(text: str | None) -> str | None:
    return None if text is None else unquote(text)


class Archive:
    """One archive being written, as one gzip stream or as a member per record."""

    def __init__(self, folder: str, whole: bool):
        self.files, path = located(folder)
        self.files.create_dir(path, recursive=True)
        self.name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        self._out = self.files.open_output_stream(located(self.name)[1], compression=None)
        self._whole = zlib.compressobj(1, zlib.DEFLATED, 31) if whole else None
        self._member = None
        self.raw = self.records = self.offset = 0

    def begin(self) -> None:
        self._member = self._whole or zlib.compressobj(6, zlib.DEFLATED, 31)
        self._start = self.offset

    def write(self, data: bytes) -> None:
        self.raw += len(data)
        self._put(self._member.compress(data))

    def end(self) -> tuple[int, int]:
        """Ends a record; where its member lies, if it is one."""
        self.records += 1
        if self._whole is None:
            self._put(self._member.flush())
        return self._start, self.offset - self._start

    def _put(self, data: bytes) -> None:
        self._out.write(data)
        self.offset += len(data)

    def close(self) -> None:
        if self._whole is not None:
            self._put(self._whole.flush())
        self._out.close()


def record_id(archive: str, ordinal: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{ordinal}')}>"


def crawled(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes every row as a response record into archives that are one gzip stream each.

    Gives archive, ordinal, page_id (as text), digest and bytes of each record, computed once.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            made = []
            for key, url, html in zip(*batch.columns):
                if archive is None:
                    archive = Archive(folder, whole=True)
                key, payload = key.as_py(), (html.as_py() or "").encode()
                digest, ordinal = base32_sha1(payload), archive.records
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                archive.begin()
                archive.write(
                    head(
                        {
                            "WARC-Type": "response",
                            "WARC-Record-ID": record_id(archive.name, ordinal),
                            "WARC-Date": DATE,
                            "WARC-Target-URI": _line_safe(url.as_py()),
                            "WARC-Payload-Digest": f"sha1:{digest}",
                            KEY: _line_safe(key),
                            "Content-Type": "application/http; msgtype=response",
                            "Content-Length": str(len(http) + len(payload)),
                        }
                    )
                    + http
                )
                archive.write(payload)
                archive.write(b"\r\n\r\n")
                archive.end()
                made.append((archive.name, ordinal, key, digest, len(payload)))
                if archive.raw >= ARCHIVE_BYTES or archive.records >= ARCHIVE_RECORDS:
                    archive.close()
                    archive = None
            yield _batch(made, RECORD)
        if archive is not None:
            archive.close()

    rows = pages.select(F.col(id_col).cast("string").alias("page_id"), url_col, html_col)
    return stored(rows.mapInArrow(write, "archive string, ordinal long, page_id string, digest string, bytes long"), "warc-records")


RECORD = pa.schema(
    [("archive", pa.string()), ("ordinal", pa.int64()), ("page_id", pa.string()), ("digest", pa.string()), ("bytes", pa.int64())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def decided(records: DataFrame, key_type: str, least: int = 0, share: int = SHARE) -> DataFrame:
    """archive, ordinal and keeper (archive, ordinal, page_id; null for a record that keeps its payload) of every record.

    Of records with equal payloads of at least `least` bytes, the one with the largest key keeps it, a null key coming last;
    of repeated keys exactly one does. Payloads with many records are sent to all tasks, which count them beforehand and
    are few; the others meet in a shuffle.
    """
    order = F.struct(F.col("page_id").cast(key_type).alias("key"), "archive", "ordinal", "page_id")
    groups = (
        records.filter(F.col("bytes") >= least)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max(order).alias("keeper"))
        .filter(F.col("n") > 1)
    )
    groups = stored(groups, "warc-groups")
    frequent = F.col("n") * share >= F.lit(records.count())
    rows = records.select("archive", "ordinal", F.when(F.col("bytes") >= least, F.col("digest")).alias("digest"))
    split = rows.join(F.broadcast(groups.filter(frequent).select("digest", "keeper")), "digest", "left")
    rest = split.filter(F.col("keeper").isNull()).drop("keeper")
    rest = rest.join(groups.filter(~frequent).select("digest", "keeper"), "digest", "left")
    keeps = (F.col("keeper.archive") == F.col("archive")) & (F.col("keeper.ordinal") == F.col("ordinal"))
    return (
        split.filter(F.col("keeper").isNotNull())
        .unionByName(rest)
        .select("archive", "ordinal", F.when(~keeps, F.col("keeper")).alias("keeper"))
    )


class Reader:
    """Records of a stream of inflated bytes, one after the other, in bounded memory."""

    def __init__(self, stream):
        self._in = stream

    def fields(self) -> dict[str, str] | None:
        """Head of the next record; None at the end."""
        line = self._in.readline()
        if not line:
            return None
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        found = {}
        while (line := self._in.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().partition(":")
            found[name.strip()] = value.strip()
        return found

    def http_head(self, left: int) -> bytes:
        """The head of the HTTP message that a block begins with; at most the block's bytes."""
        lines = []
        while left > 0 and (line := self._in.readline(left)):
            lines.append(line)
            left -= len(line)
            if line in (b"\r\n", b"\n"):
                break
        return b"".join(lines)

    def pieces(self, left: int) -> Iterator[bytes]:
        while left > 0:
            data = self._in.read(min(left, CHUNK))
            if not data:
                raise ValueError("a record is cut off")
            left -= len(data)
            yield data

    def close_record(self) -> None:
        if self._in.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")


def rewritten(reader: Reader, out: Archive, keeper: dict | None) -> dict | None:
    """Writes the next record as a member, as a revisit if another record keeps its payload; its entry of the index."""
    fields = reader.fields()
    if fields is None:
        return None
    size = int(fields["Content-Length"])
    http = reader.http_head(size) if fields.get("WARC-Type") == "response" else b""
    out.begin()
    if keeper is not None:
        fields |= {
            "WARC-Type": "revisit",
            "WARC-Profile": PROFILE,
            "WARC-Refers-To": record_id(keeper["archive"], keeper["ordinal"]),
            "Content-Length": str(len(http)),
        }
        if keeper["page_id"] is not None:
            fields[REFERS_KEY] = _line_safe(keeper["page_id"])
    out.write(head(fields) + http)
    digest = hashlib.sha1()
    for piece in reader.pieces(size - len(http)):
        digest.update(piece)
        if keeper is None:
            out.write(piece)
    reader.close_record()
    told = fields.get("WARC-Payload-Digest", "")
    if http and told.startswith("sha1:") and told[5:] != base64.b32encode(digest.digest()).decode():
        raise ValueError(f"payload of {fields.get('WARC-Record-ID')} is not what its digest says")
    out.write(b"\r\n\r\n")
    offset, length = out.end()
    return {"offset": offset, "length": length, "type": fields.get("WARC-Type"), "id": fields.get("WARC-Record-ID"), "digest": told}


def sidecar(archive: str) -> str:
    return f"{archive}.idx"


def _tasks(df: DataFrame, wanted: int) -> int:
    return max(1, min(max(wanted, df.sparkSession.sparkContext.defaultParallelism), MOST_TASKS))


def normalised(decisions: DataFrame, folder: str) -> DataFrame:
    """Rewrites the archives that the decisions name; archive and number of records of each new one, computed once.

    A task reads an archive's decisions in the order of its records while it inflates it, and holds none of them.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()))
        name = source = reader = out = index = None

        def finish():
            if reader.fields() is not None:
                raise ValueError(f"{name} holds records without a decision")
            source.close()
            out.close()
            index.close()
            return _batch([(out.name, out.records)], pa.schema([("archive", pa.string()), ("records", pa.int64())]))

        for archive, ordinal, keeper in rows:
            if archive != name:
                if name is not None:
                    yield finish()
                name, files = archive, located(archive)
                source = files[0].open_input_stream(files[1], compression=None)
                reader = Reader(io.BufferedReader(gzip.GzipFile(fileobj=source), CHUNK))
                out = Archive(folder, whole=False)
                index = out.files.open_output_stream(located(sidecar(out.name))[1], compression=None)
            if ordinal != out.records:
                raise ValueError(f"{name}: decision {ordinal} meets record {out.records}")
            entry = rewritten(reader, out, keeper)
            if entry is None:
                raise ValueError(f"{name} has fewer records than decisions")
            index.write(json.dumps(entry).encode() + b"\n")
        if name is not None:
            yield finish()

    archives = decisions.agg(F.approx_count_distinct("archive")).first()[0]
    placed = decisions.repartition(_tasks(decisions, 2 * archives), "archive").sortWithinPartitions("archive", "ordinal")
    return stored(placed.mapInArrow(rewrite, "archive string, records long"), "warc-archives")


def entries(archives: DataFrame) -> DataFrame:
    """archive, offset, length and type of every record, from the sidecar files."""
    schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, path = located(sidecar(name))
                with files.open_input_stream(path, compression=None) as f:
                    lines = [json.loads(line) for line in io.BufferedReader(f)]
                yield _batch([(name, e["offset"], e["length"], e["type"]) for e in lines], schema)

    return archives.select("archive").mapInArrow(listed, "archive string, offset long, length long, type string")


CONTENT = pa.schema(
    [
        ("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary()),
    ]
)


def parsed(member: bytes, with_payload: bool) -> tuple:
    """The columns of CONTENT of one member; size and digest of a response are those of the payload itself."""
    reader = Reader(io.BytesIO(gzip.decompress(member)))
    fields = reader.fields()
    size = int(fields["Content-Length"])
    http = reader.http_head(size)
    payload = b"".join(reader.pieces(size - len(http)))
    reader.close_record()
    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "revisit":
        digest, payload = told, None
        length = next(int(line.split(b":")[1]) for line in http.splitlines() if line.lower().startswith(b"content-length:"))
    else:
        digest, length = base32_sha1(payload), len(payload)
        if digest != told:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is not what its digest says")
    return (
        _back(fields.get(KEY)), _back(fields.get("WARC-Target-URI")), fields["WARC-Type"], digest, length,
        _back(fields.get(REFERS_KEY)), payload if with_payload else None,
    )


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records behind entries of an index: page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload.

    Ranges of an archive are read by different tasks, each by its offsets.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = source = None
        for batch in batches:
            made, held = [], 0
            for archive, offset, length in zip(*[batch.column(c).to_pylist() for c in ("archive", "offset", "length")]):
                if archive != name:
                    if source is not None:
                        source.close()
                    files, path = located(archive)
                    name, source = archive, files.open_input_file(path)
                source.seek(offset)
                made.append(parsed(source.read(length), with_payload))
                held += made[-1][4]
                if with_payload and held > ARCHIVE_BYTES:
                    yield _batch(made, CONTENT)
                    made, held = [], 0
            yield _batch(made, CONTENT)

    part = F.floor(F.col("offset") / RANGE_BYTES)
    size = index.agg(F.sum("length")).first()[0] or 0
    placed = index.repartition(_tasks(index, 2 * size // RANGE_BYTES), "archive", part).sortWithinPartitions("archive", "offset")
    columns = "page_id string, url string, record_type string, payload_digest string, payload_bytes long, refers_to string, payload binary"
    return placed.mapInArrow(fetch, columns)


def archived(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0
) -> DataFrame:
    """Writes, normalises and indexes the archives of all pages; archive and number of records of each, in `folder`.

    Null html counts as empty; a record without url or key has no such line. Of rows that repeat key and html one is the
    response. Payloads of fewer than `least` bytes are all responses. An empty table gives no archives; columns other than
    the three named are not read, whatever they are called.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    records = crawled(pages, f"{folder}/crawl", id_col, url_col, html_col)
    kind = pages.schema[id_col].dataType.simpleString()
    return normalised(decided(records, kind, least), f"{folder}/records")


def round_trip(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", least: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, as read back from its archives."""
    kind = pages.schema[id_col].dataType
    index = stored(entries(archived(pages, folder, id_col, least=least)), "warc-index")
    found = read_records(index, with_payload=False)
    return found.select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )
