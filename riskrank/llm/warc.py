"""WARC archives: records with repeated payloads as revisits, and a reader that salvages damaged files.

Each record is a gzip member of its own, so a reader can start at any of them. Where a member or a record
fails its checks, the reader looks for the next member (or the next version line in plain files), goes on
from there, and reports the bytes between as a quarantined gap. A damaged record whose own length still leads to
another record is passed as a whole, so that a record that its payload quotes is not taken for one.
Archives of other writers are read too: digests in hexadecimal or base32, payloads with or without
an HTTP head, several records in a member.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.llm.common import Workspace

GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
FIRST_LINE = re.compile(rb"WARC/\d\.\d\r\n")
LENGTH = re.compile(rb"\r\nContent-Length: *(\d{1,15})\r\n", re.IGNORECASE)
FILE_BYTES = 32 << 20
REVISIT_BYTES = 1000
# Fixed value: the profile that marks a revisit of an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN_AT = datetime(2024, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

MANIFEST = "file string, n_records long, n_bytes long"
RECORDS = (
    "file string, begin long, end long, page_id long, url string, record_type string, payload binary, "
    "payload_bytes long, payload_digest string, refers_to long, after_gap boolean"
)
GAPS = "file string, begin long, end long, reason string"


# Digest algorithms that are checked; blocks with others are taken as they are.
ALGORITHMS = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "md5": hashlib.md5}
HTTP = "application/http; msgtype=response"
# So far the header lines of a damaged record are looked for.
HEAD_BYTES = 1 << 16


def record_id(page_id: int | None, digest: str) -> str:
    """The name of a response, which follows from what revisits know of it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, uncompressed: an HTTP response. A revisit has its head alone, and the payload's digest and size."""
    digest = hashlib.sha1(payload).hexdigest()
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, f"{digest} revisit" if revisit else digest)),
        ("WARC-Date", WRITTEN_AT),
        # Line ends and the like are escaped, so that a header stays a line.
        ("WARC-Target-URI", None if url is None else url.encode("unicode_escape").decode()),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
        ("WARC-Refers-To", record_id(refers_to, digest) if revisit else None),
        ("WARC-Profile", PROFILE if revisit else None),
        ("X-Page-Id", page_id),
        ("X-Payload-Length", len(payload)),
        ("X-Refers-To-Page-Id", refers_to),
        ("Content-Type", HTTP),
        ("Content-Length", len(block)),
    ]
    head_lines = "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None).encode()
    return VERSION + b"\r\n" + head_lines + b"\r\n" + block + b"\r\n\r\n"


def bare_digest(labelled: str) -> tuple[str, str]:
    """Algorithm and lower-case hexadecimal digest of ``sha1:...``, which others write in base32."""
    algorithm, _, value = labelled.strip().partition(":")
    algorithm, value = algorithm.strip().lower(), value.strip()
    size = ALGORITHMS[algorithm]().digest_size if algorithm in ALGORITHMS else 0
    if size and len(value.rstrip("=")) == -(-8 * size // 5) and len(value) != 2 * size:
        try:
            value = base64.b32decode(value.upper() + "=" * (-len(value) % 8)).hex()
        except ValueError:
            pass
    return algorithm, value.lower()


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _unescaped(url: str) -> str:
    try:
        return url.encode("latin-1").decode("unicode_escape")
    except UnicodeDecodeError:  # of another writer, who does not escape
        return url


def parse(data: bytes, at: int) -> tuple[dict | None, int, str]:
    """The record that begins at ``at``: (record or none, where it ends, what is wrong with it)."""
    if not FIRST_LINE.match(data, at):
        return None, at, "no gzip member or version line"
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None, at, "headers do not end"
    head = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None, at, "malformed header"
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("latin-1")
    try:
        size = int(head["content-length"])
        number = {k: int(head[k]) for k in ("x-page-id", "x-payload-length", "x-refers-to-page-id") if k in head}
    except (KeyError, ValueError):
        return None, at, "malformed length"
    body = data[end + 4 : end + 4 + size]
    stop = end + 4 + size + 4
    if size < 0 or len(body) != size or data[stop - 4 : stop] != b"\r\n\r\n":
        return None, at, "block does not end where its length says"
    algorithm, wanted = bare_digest(head.get("warc-block-digest", ""))
    if wanted and algorithm in ALGORITHMS and ALGORITHMS[algorithm](body).hexdigest() != wanted:
        return None, at, "block digest differs"
    if head.get("content-type", "").lower().startswith("application/http"):
        cut = body.find(b"\r\n\r\n")
        body = body[cut + 4 :] if cut >= 0 else b""
    url = head.get("warc-target-uri")
    algorithm, digest = bare_digest(head.get("warc-payload-digest", ""))
    found = {
        "page_id": number.get("x-page-id"),
        "url": None if url is None else _unescaped(url),
        "record_type": head.get("warc-type"),
        "payload": body,
        "payload_bytes": number.get("x-payload-length", len(body)),
        "payload_digest": digest if algorithm == "sha1" and digest else hashlib.sha1(body).hexdigest(),
        "refers_to": number.get("x-refers-to-page-id"),
        "after_gap": False,
    }
    return found, stop, ""


def _own_end(data: bytes, at: int) -> int:
    """Where the damaged plain record at ``at`` ends by its own length, if another record or nothing follows; else -1."""
    end = data.find(b"\r\n\r\n", at, at + HEAD_BYTES)
    size = LENGTH.search(data, at, max(at, end + 2))
    if end < 0 or not size:
        return -1
    stop = end + 4 + int(size.group(1)) + 4
    follows = stop == len(data) or FIRST_LINE.match(data, stop) or data.startswith(GZIP, stop)
    return stop if follows and data[stop - 4 : stop] == b"\r\n\r\n" else -1


def _records(content: bytes) -> tuple[list[dict], str]:
    """The records of a member one after the other, and what is wrong after the last of them."""
    out, at = [], 0
    while at < len(content):
        found, at, reason = parse(content, at)
        if not found:
            return out, reason
        out.append(found)
    return out, "" if out else "empty member"


def _inflate(data: bytes, at: int) -> tuple[bytes | None, int]:
    """One gzip member from ``at`` on, checked: (its content or none, where it ends)."""
    unpacker = zlib.decompressobj(31)
    try:
        out = unpacker.decompress(memoryview(data)[at:])
    except zlib.error:
        return None, at
    if not unpacker.eof:
        return None, at
    return out, len(data) - len(unpacker.unused_data)


def salvage(data: bytes) -> Iterator[tuple[str, int, int, object]]:
    """("record", begin, end, fields) and ("gap", begin, end, reason) of a file, in order and without holes.

    Records that share a member end where it begins, but for its last one. After damage both the next gzip member and
    the next version line are tried, whatever the file began with; ``after_gap`` marks the record found so, as it
    may be one that the damaged bytes quote.
    """
    at, bad, why, sure = 0, None, "", True
    packed = line = -1  # the next member and the next version line, looked for again once they are passed
    while at < len(data):
        begin = at
        if not data.startswith(GZIP, at):
            found, end, reason = parse(data, at)
            found = [found] if found else []
            partial = False
        else:
            content, end = _inflate(data[at : at + _reach(data, at)], 0)
            end += at
            found, reason = _records(content) if content is not None else ([], "gzip member fails its checks")
            partial = bool(reason)
        if found:
            if bad is not None:
                yield "gap", bad, at, why
            for i, r in enumerate(found):
                r["after_gap"] = bad is not None and not sure and i == 0
                whole = i + 1 == len(found) and not partial
                yield "record", at, end if whole else at, r
            if partial:
                yield "gap", at, end, reason
            bad, sure, at = None, True, end
            continue
        if bad is None:
            bad, why = at, reason
        own = -1 if data.startswith(GZIP, at) else _own_end(data, at)
        if own > at:
            at, sure = own, begin == bad
            continue
        sure = False
        if packed <= at:
            packed = data.find(GZIP, at + 1)
            packed = len(data) if packed < 0 else packed
        if line <= at:
            later = FIRST_LINE.search(data, at + 1)
            line = later.start() if later else len(data)
        at = min(packed, line)
    if bad is not None:
        yield "gap", bad, len(data), why


def _reach(data: bytes, at: int) -> int:
    """Bytes to hand to the unpacker: to the end, found in steps so that small members are not copied along."""
    step = 1 << 16
    while at + step < len(data):
        unpacker = zlib.decompressobj(31)
        try:
            unpacker.decompress(memoryview(data)[at : at + step])
        except zlib.error:
            return step
        if unpacker.eof:
            return step
        step *= 4
    return len(data) - at


def revisits(pages: DataFrame, at_least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, payload_digest, refers_to) of the rows that revisit another: the largest page_id of equal payloads stays."""
    sums = pages.select("page_id", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").alias("n"))
    large = sums.where((F.col("n") >= at_least) & F.col("page_id").isNotNull())
    last = large.groupBy("payload_digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("k"))
    copies = large.join(last.where("k > 1"), ["payload_digest", "n"]).where("page_id <> refers_to")
    return copies.select("page_id", "payload_digest", "refers_to").distinct()


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


def write_archives(
    pages: DataFrame,
    ws: Workspace,
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    file_bytes: int = FILE_BYTES,
    compressed: bool = True,
) -> DataFrame:
    """Write a record a row and return the manifest (file, n_records, n_bytes).

    Of equal payloads of ``REVISIT_BYTES`` or more, that with the largest id is a response and the others are
    revisits. Null payloads count as empty. Rows with a null id are responses; of rows that repeat the
    largest id, all are. Tasks write new files each time; only those in the manifest count.
    """
    rows = pages.select(
        F.col(id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).cast("binary").alias("payload")
    )
    again = revisits(rows)
    joined = (
        rows.withColumn("payload_digest", F.sha1("payload"))
        .join(again, ["page_id", "payload_digest"], "left")
        .select("page_id", "url", "payload", "refers_to")
    )
    folder = ws.path("warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = _open(folder)
        fs.create_dir(at, recursive=True)
        stream, name, n, size = None, "", 0, 0

        def manifest() -> pa.RecordBatch:
            stream.close()
            values = [pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64()), pa.array([size], pa.int64())]
            return pa.RecordBatch.from_arrays(values, names=["file", "n_records", "n_bytes"])

        for batch in batches:
            for page, target, payload, refers in zip(*batch.columns, strict=True):
                if stream is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc" + ".gz" * compressed, 0, 0
                    stream = fs.open_output_stream(f"{at}/{name}", compression=None)
                data = record(page.as_py(), target.as_py(), payload.as_py(), refers.as_py())
                data = member(data) if compressed else data
                stream.write(data)
                n, size = n + 1, size + len(data)
                if size >= file_bytes:
                    yield manifest()
                    stream = None
        if stream is not None:
            yield manifest()

    return ws.keep(joined.mapInArrow(run, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """All records of the files, and the gaps between them (``reason`` not null).

    Columns: those of ``RECORDS`` and ``reason``. With ``with_payload`` off, payloads are checked and left out.
    """
    schema = RECORDS + ", reason string"
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for file in frame.column(0).to_pylist():
                fs, at = _open(file)
                with fs.open_input_file(at) as stream:
                    data = stream.read()
                rows, held = [], 0
                for kind, begin, end, what in salvage(data):
                    row = dict.fromkeys(names) | {"file": file, "begin": begin, "end": end}
                    row |= what if kind == "record" else {"reason": what}
                    if not with_payload:
                        row["payload"] = None
                    held += len(row["payload"] or b"")
                    rows.append(row)
                    if held > 8 << 20 or len(rows) >= 10_000:
                        yield _rows(rows)
                        rows, held = [], 0
                yield _rows(rows)

    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    arrow = pa.schema([(c.strip().split()[0], types[c.strip().split()[1]]) for c in schema.split(",")])

    def _rows(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=arrow)

    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file").repartition(tasks, "file").mapInArrow(run, schema)


def records(read: DataFrame) -> DataFrame:
    return read.where("reason is null").drop("reason")


def gaps(read: DataFrame) -> DataFrame:
    """The log of quarantined bytes: file, begin, end, reason."""
    return read.where("reason is not null").select("file", "begin", "end", "reason")
