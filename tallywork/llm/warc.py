"""WARC records, and metadata and plain-text conversion records derived from responses.

A derived record names the response it comes from (WARC-Refers-To) and carries its target address
and date; the metadata record keeps the response's status, HTTP headers and digests, and checks them
against the bytes. Identifiers are made from the source's identifier, so reruns give the same ones.
Records are handled one by one: one pass, no shuffle.
"""

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Generator, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.html_text import blocks_of
from tallywork.llm.texts import map_in_arrow, pieces

VERSION = "WARC/1.1"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of addresses
_BREAK = b"\r\n"
_AT_ONCE = 256  # records of a batch, and 32 MB or one longer record
_CHUNK = 1 << 16
_MEMBER = b"\x1f\x8b\x08"  # how a gzip member begins
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.IGNORECASE)
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.DOTALL | re.IGNORECASE)
_LINK = re.compile(r"<a\s[^>]*?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)


def digest(data: bytes) -> str:
    """SHA-1 in base 32, as WARC files write digests."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, ' '.join(names))}>"


@dataclass(frozen=True)
class Record:
    """One WARC record: its named fields in order, and its block."""

    fields: tuple[tuple[str, str], ...]
    block: bytes

    def get(self, name: str) -> str | None:
        return next((v for n, v in self.fields if n.lower() == name.lower()), None)

    def to_bytes(self) -> bytes:
        lines = [VERSION, *(f"{n}: {v}" for n, v in self.fields)]
        head = "".join(line + "\r\n" for line in lines).encode()
        return head + _BREAK + self.block + _BREAK * 2


def make_record(kind: str, block: bytes, content_type: str, **named: str | None) -> Record:
    """A record with its length and block digest; ``named`` are further fields, None left out.

    Underscores in a name stand for hyphens after ``WARC-``: ``refers_to`` is WARC-Refers-To. Line
    breaks in a value become spaces.
    """
    special = {
        "target_uri": "WARC-Target-URI",
        "record_id": "WARC-Record-ID",
        "refers_to_target_uri": "WARC-Refers-To-Target-URI",
    }
    fields = [("WARC-Type", kind)]
    for name, value in named.items():
        if value is not None:
            title = special.get(name, "WARC-" + name.replace("_", "-").title())
            fields.append((title, " ".join(value.split())))
    fields += [
        ("Content-Type", content_type),
        ("WARC-Block-Digest", digest(block)),
        ("Content-Length", str(len(block))),
    ]
    return Record(tuple(fields), block)


def _headers(lines: list[bytes]) -> tuple[tuple[str, str], ...]:
    """Named fields; a line that starts with white space goes on with the line before."""
    found: list[list[str]] = []
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and found:
            found[-1][1] += " " + text.strip()
        elif ":" in text:
            name, value = text.split(":", 1)
            found.append([name.strip(), value.strip()])
    return tuple((n, v) for n, v in found)


def parse_record(data: bytes) -> Record:
    """The record that ``data`` starts with; ValueError if it is none or cut off."""
    head, gap, rest = data.partition(_BREAK * 2)
    lines = head.split(_BREAK)
    if not gap or not lines[0].startswith(b"WARC/"):
        raise ValueError("no WARC record")
    record = Record(_headers(lines[1:]), b"")
    length = record.get("Content-Length") or ""
    if not length.isdigit() or int(length) > len(rest):
        raise ValueError("no length, or a block cut off")
    return Record(record.fields, rest[: int(length)])


def _unchunked(data: bytes) -> bytes:
    out = []
    while data:
        line, gap, data = data.partition(_BREAK)
        size = int(line.split(b";")[0].strip() or b"0", 16) if gap else 0
        if not size:
            break
        out.append(data[:size])
        data = data[size + 2 :]
    return b"".join(out)


@dataclass(frozen=True)
class Response:
    """An HTTP response out of a record's block; ``body`` is decoded, ``payload`` is as sent."""

    status: str
    headers: tuple[tuple[str, str], ...]
    payload: bytes
    body: bytes

    def get(self, name: str) -> str:
        return next((v for n, v in self.headers if n.lower() == name), "")

    @property
    def text(self) -> str:
        found = _CHARSET.search(self.get("content-type"))
        try:
            return self.body.decode(found[1] if found else "utf-8", "replace")
        except (LookupError, UnicodeError):  # a charset that nobody knows, or one that can't replace
            return self.body.decode("utf-8", "replace")


def parse_response(block: bytes) -> Response:
    """Status line, headers and body; a body that does not decode as declared stays as it is."""
    head, _, payload = block.partition(_BREAK * 2)
    lines = head.split(_BREAK)
    found = Response(lines[0].decode("latin-1"), _headers(lines[1:]), payload, payload)
    body = payload
    try:
        if found.get("transfer-encoding").lower() == "chunked":
            body = _unchunked(body)
        encoding = found.get("content-encoding").lower()
        if encoding in ("gzip", "x-gzip"):
            body = gzip.decompress(body)
        elif encoding == "deflate":
            body = zlib.decompress(body)
    except (ValueError, OSError, EOFError, zlib.error):
        body = payload
    return Response(found.status, found.headers, payload, body)


def _plain_text(response: Response) -> str | None:
    """All visible text of a page, one block per line; None for what is no text."""
    kind = response.get("content-type").split(";")[0].strip().lower()
    if kind in ("", "text/html", "application/xhtml+xml"):
        return "\n".join(" ".join(b.words) for b in blocks_of(response.text))
    return response.text if kind.startswith("text/") else None


def _metadata_block(source: Record, response: Response) -> bytes:
    page = response.text
    title = _TITLE.search(page)
    links = [html.unescape(a or b or c) for a, b, c in _LINK.findall(page)]
    declared = source.get("WARC-Payload-Digest"), source.get("WARC-Block-Digest")
    actual = digest(response.payload), digest(source.block)
    lines = [
        ("source-status", response.status),
        *((f"source-header-{n.lower()}", v) for n, v in response.headers),
        *(("source-" + n.lower(), v) for n, v in source.fields if n.lower().endswith("-digest")),
        ("payload-digest", actual[0]),
        ("digests-agree", str(all(d in (None, a) for d, a in zip(declared, actual, strict=True))).lower()),
        ("title", html.unescape(title[1]) if title else ""),
        *(("outlink", link) for link in links),
    ]
    return "".join(f"{n}: {' '.join(v.split())}\r\n" for n, v in lines).encode()


def derive(source: Record) -> list[Record]:
    """The metadata record of a response, and its conversion record if it holds text."""
    if (source.get("WARC-Type") or "").lower() != "response":
        return []
    response = parse_response(source.block)
    origin = source.get("WARC-Record-ID")
    shared = {
        "date": source.get("WARC-Date"),
        "target_uri": source.get("WARC-Target-URI"),
        "refers_to": origin,
        "refers_to_target_uri": source.get("WARC-Target-URI"),
        "refers_to_date": source.get("WARC-Date"),
    }
    own = record_id("metadata", origin or digest(source.block))
    made = [
        make_record(
            "metadata",
            _metadata_block(source, response),
            "application/warc-fields",
            record_id=own,
            **shared,
        )
    ]
    text = _plain_text(response)
    if text is not None:
        made.append(
            make_record(
                "conversion",
                text.encode("utf-8", "replace"),
                "text/plain; charset=utf-8",
                record_id=record_id("conversion", origin or digest(source.block)),
                **shared,
            )
        )
    return made


def page_responses(
    pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html", date: str
) -> DataFrame:
    """Pages as response records: ``key`` and ``record``, the bytes of one WARC record.

    A NULL page is an empty one; a NULL address is left out of the record. Rows with the same key,
    address and page give records with the same identifier. ``date`` is the records' WARC-Date. An empty
    table gives an empty result; other columns are not read.
    """
    rows = pages.select(F.col(key).alias("_key"), F.col(url).cast("string"), F.col(page))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, n in pieces(whole.column(2), _AT_ONCE):
                batch = whole.slice(start, n)
                rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
                records = [_page_response(*row, date) for row in rows]
                columns = [batch.column(0), pa.array(records, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["_key", "record"])

    schema = rows.select("_key").schema.add("record", "binary")
    return map_in_arrow(rows, run, schema).select(F.col("_key").alias(key), "record")


def _page_response(name, address: str | None, page: str | None, date: str) -> bytes:
    payload = (page or "").encode()
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    return make_record(
        "response",
        head + payload,
        "application/http; msgtype=response",
        record_id=record_id("response", str(name), address or "", digest(payload)),
        date=date,
        target_uri=address,
        payload_digest=digest(payload),
    ).to_bytes()


_DERIVED = (
    "record_type string, record_id string, refers_to string, refers_to_target_uri string, "
    "refers_to_date string, target_uri string, date string, "
    "content_type string, content_length bigint, block_digest string, block string, "
    "source_payload_digest string, source_headers map<string,string>, error string"
)


def derive_records(records: DataFrame, *, keep: list[str], record: str = "record") -> DataFrame:
    """Derived records of every response in a column of WARC records, with the columns ``keep``.

    One row per derived record: its fields, its text ``block`` and the response's payload digest and
    HTTP headers (names in lower case; repeated headers joined by a comma and a space). A record
    that is NULL or can't be read gives one row with the reason in ``error`` and nothing else;
    records of other types give no rows. Repeated records are derived each time, with the same
    identifiers. An empty table gives an empty result. ``keep`` must not hold the name of an added
    column.
    """
    clashing = {field.split(" ", 1)[0] for field in _DERIVED.split(", ")} & set(keep)
    if clashing:
        raise ValueError(f"keep holds names of added columns: {sorted(clashing)}")
    rows = records.select(F.struct(*keep).alias("_kept"), F.col(record).alias("_record"))
    schema = rows.select("_kept").schema
    derived = rows.select(F.lit(None).cast(f"struct<{_as_struct(_DERIVED)}>").alias("d")).schema
    schema = schema.add("d", derived["d"].dataType)
    kind = pa.struct(
        [
            (name, {"bigint": pa.int64(), "string": pa.string()}.get(t, pa.map_(pa.string(), pa.string())))
            for name, t in (field.split(" ", 1) for field in _DERIVED.split(", "))
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, n in pieces(whole.column(1), _AT_ONCE):
                batch = whole.slice(start, n)
                at, out = [], []
                for place, data in enumerate(batch.column(1).to_pylist()):
                    found = list(_rows(data))
                    at += [place] * len(found)
                    out += found
                kept = batch.column(0).take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([kept, pa.array(out, kind)], names=["_kept", "d"])

    return map_in_arrow(rows, run, schema).select("_kept.*", "d.*")


def _as_struct(ddl: str) -> str:
    return ",".join(f"{n}:{t}" for n, t in (field.split(" ", 1) for field in ddl.split(", ")))


def _rows(data: bytes | None) -> Iterator[dict]:
    try:
        source = parse_record(data or b"")
    except ValueError as problem:
        yield {"error": str(problem)}
        return
    headers: dict[str, str] = {}
    if (source.get("WARC-Type") or "").lower() == "response":
        for name, value in parse_response(source.block).headers:
            known = headers.get(name.lower())
            headers[name.lower()] = f"{known}, {value}" if known else value
    for made in derive(source):
        yield {
            "record_type": made.get("WARC-Type"),
            "record_id": made.get("WARC-Record-ID"),
            "refers_to": made.get("WARC-Refers-To"),
            "refers_to_target_uri": made.get("WARC-Refers-To-Target-URI"),
            "refers_to_date": made.get("WARC-Refers-To-Date"),
            "target_uri": made.get("WARC-Target-URI"),
            "date": made.get("WARC-Date"),
            "content_type": made.get("Content-Type"),
            "content_length": len(made.block),
            "block_digest": made.get("WARC-Block-Digest"),
            "block": made.block.decode(),
            "source_payload_digest": source.get("WARC-Payload-Digest"),
            "source_headers": list(headers.items()),
            "error": None,
        }


def _record_end(data: bytes, start: int) -> int | None:
    """Where the record at ``start`` ends, with the two breaks after it.

    None if the data end before the record does; ValueError if it is no record, or if what comes
    after its length can't be the end of one.
    """
    gap = data.find(_BREAK * 2, start)
    if not data.startswith((b"WARC/", b"WARC/"[: len(data) - start]), start):
        raise ValueError("no WARC record")
    if gap < 0:
        return None
    lines = data[start:gap].split(_BREAK)
    if any(line.startswith(b"WARC/") for line in lines[1:]):
        raise ValueError("another record begins inside the head")
    length = Record(_headers(lines[1:]), b"").get("Content-Length") or ""
    if not length.isdigit():
        raise ValueError("no length")
    end = gap + 4 + int(length)
    if end > len(data):
        return None
    rest = data[end : end + 4]
    if rest != _BREAK * 2 and not (end + len(rest) == len(data) and (_BREAK * 2).startswith(rest)):
        raise ValueError("a wrong length")
    return end + len(rest)


def _next_record(data: bytes, start: int) -> int:
    """The next place where a record may begin; the end of the data if there is none."""
    found = data.find(_BREAK + b"WARC/", start)
    return len(data) if found < 0 else found + len(_BREAK)


def _records_in(data: bytes, *, complete: bool) -> Generator[bytes, None, bytes]:
    """The records in some bytes, an empty one for each unreadable stretch; returns what is left.

    After a stretch that is no record, or whose length is wrong, reading goes on where the next record
    begins. If the data are not ``complete``, a record that their end cuts off is left.
    """
    at = 0
    while True:
        while data.startswith(_BREAK, at):
            at += len(_BREAK)
        if at >= len(data):
            return b""
        try:
            end = _record_end(data, at)
        except ValueError:
            end = -1
        following = None
        if end is None:  # cut off, or a length that is too large
            following = _next_record(data, at + 1)
            if following == len(data) and not complete:
                return data[at:]
        if end is None or end < 0:
            yield b""
            at = following if following is not None else _next_record(data, at + 1)
        else:
            yield data[at:end].removesuffix(_BREAK * 2) + _BREAK * 2
            at = end


def _members(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """What the gzip members of a file hold, and whether each is whole; goes on after a damaged one."""
    at, view = 0, memoryview(data)
    while at < len(data):
        reader, parts, start = zlib.decompressobj(31), [], at
        try:
            while not reader.eof and at < len(data):
                parts.append(reader.decompress(view[at : at + _CHUNK]))
                at += min(_CHUNK, len(data) - at) - len(reader.unused_data)
        except zlib.error:
            pass
        yield b"".join(parts), reader.eof
        if not reader.eof:  # the damage may hide the start of the next member
            at = data.find(_MEMBER, start + 1)
            while 0 <= at and not _starts_member(view, at):
                at = data.find(_MEMBER, at + 1)
            if at < 0:
                return


def _starts_member(view: memoryview, at: int) -> bool:
    """Whether a gzip member that begins at a place holds the start of a record."""
    try:
        return zlib.decompressobj(31).decompress(view[at : at + _CHUNK], 5).startswith(b"WARC/")
    except zlib.error:
        return False


def split_records(data: bytes) -> Iterator[bytes]:
    """The records of a WARC file's bytes, plain or in gzip members.

    Gives an empty record for each stretch that can't be read, and goes on after it.
    """
    if data[:2] != _MEMBER[:2]:
        yield from _records_in(data, complete=True)
        return
    left = b""
    for part, whole in _members(data):
        if left and part.startswith(b"WARC/"):
            yield b""  # the record before was never completed
            left = b""
        unread = False
        reading = _records_in(left + part, complete=not whole)
        while True:
            try:
                record = next(reading)
            except StopIteration as end:
                left = end.value
                break
            unread = not record
            yield record
        if not whole and not unread:
            yield b""
    if left:
        yield b""


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files (plain or gzip): ``path`` and ``record``.

    Files are read whole, one at a time per task, through Spark's own readers; a file must be under 2
    GB, the limit of a binary value. What can't be read, because the file is damaged or cut off, gives
    one empty record for each such stretch, which ``derive_records`` reports; whole records before and
    after it are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for record in split_records(data or b""):
                    columns = [pa.array([name]), pa.array([record], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "record"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return map_in_arrow(files, run, "path string, record binary")


def write_warc(records: DataFrame, folder: str, *, record: str = "record") -> int:
    """Write a column of WARC records as gzip files, one per task; returns the number of records.

    ``folder`` is an address that all executors reach (file, hdfs, s3, gs; see pyarrow's file
    systems). A task writes under a name of its own attempt and renames the file when it is
    complete, so a task that runs again replaces its file. The files become visible when all tasks
    are done, in place of the parts that earlier runs have written there. NULL records are left out;
    tasks without records write nothing.
    """
    run_folder = f"_{uuid.uuid4().hex}"  # readers skip names that begin so

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, base = FileSystem.from_uri(folder)
        name = f"part-{task.partitionId():06d}.warc.gz"
        waiting = f"{base}/{run_folder}/.{name}.{task.taskAttemptId()}"
        files.create_dir(f"{base}/{run_folder}", recursive=True)
        n = 0
        with files.open_output_stream(waiting, compression=None) as out:
            for batch in batches:
                for data in batch.column(0):
                    if data.is_valid:
                        out.write(gzip.compress(data.as_py(), mtime=0))
                        n += 1
        if n:
            files.move(waiting, f"{base}/{run_folder}/{name}")
        else:
            files.delete_file(waiting)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    written = map_in_arrow(records.select(record), run, "n bigint")
    total = written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    _replace_parts(folder, run_folder)
    return total


def _replace_parts(folder: str, run_folder: str) -> None:
    """Delete the parts of earlier runs and move those of this run to their place; names only."""
    files, base = FileSystem.from_uri(folder)

    def parts(place: str) -> list:
        found = files.get_file_info(FileSelector(place, allow_not_found=True))
        return [f for f in found if f.base_name.startswith("part-") and f.base_name.endswith(".warc.gz")]

    new = parts(f"{base}/{run_folder}")
    for old in parts(base):
        files.delete_file(old.path)
    for part in new:
        files.move(part.path, f"{base}/{part.base_name}")
    if files.get_file_info(f"{base}/{run_folder}").type != FileType.NotFound:
        files.delete_dir(f"{base}/{run_folder}")


def to_bytes(derived: dict) -> bytes:
    """The WARC record of one row of ``derive_records``."""
    named = ("record_id", "date", "target_uri", "refers_to", "refers_to_target_uri", "refers_to_date")
    return make_record(
        derived["record_type"],
        derived["block"].encode(),
        derived["content_type"],
        **{name: derived[name] for name in named},
    ).to_bytes()
