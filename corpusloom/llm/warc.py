"""WARC archives: deduplicated writing, and a reader that salvages.

Writing: each record is one gzip member. A page whose payload another page
already has becomes a ``revisit`` of it. Archives go through Spark's own file
writer to whatever file system the path names: a record is a line of the text
sink and the separator is the byte that ends every member. (The last byte of a
gzip member is the top byte of its length, zero below 16 MiB.) Longer records
are written uncompressed, where the separator is the record's own end.

Reading: members and plain records are checked one after the other (gzip
check sum, version line, header, length, end of record, digests). After a failed
check the reader searches for the next place where a valid member or version
line starts, goes on there and reports the bytes in between as a gap with the
reason; inside a member that unpacks soundly it does the same by version lines. An archive is handled by one task; the writer bounds its records.

Defined cases: a null or empty payload is an empty response; payloads under
``MIN_REVISIT`` bytes are always responses; rows that repeat the id of their
payload's response are responses, too; a null id is written as none and read as
null, and revisits an equal payload that has an id. Only the named columns are
read. An empty table gives an empty archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.rows import ROW, lasting, salted_lookup, with_row, without
from corpusloom.session import stage_table

MIN_REVISIT = 100
# Sizes of records below which so many go into a file: a file stays well under the
# 2 GB that a reader takes as one value, whatever its records hold.
RECORDS_PER_FILE = {256 << 10: 4000, 8 << 20: 200}
# Longer records are written uncompressed, each in its own file.
# A member that unpacks to more than a value of Spark may hold is not read.
MOST_BYTES = (1 << 31) - 1
DATE = "1970-01-01T00:00:00Z"
LEVEL = 5
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"
_FEED = 1 << 16
_VERSION = re.compile(rb"WARC/\d+\.\d+\r?\n")
_HEADER_END = re.compile(rb"\r\n\r\n")
# Rows and payload bytes that go back to Spark at a time.
_OUT_ROWS = 500
_OUT_BYTES = 32 << 20
# Where a member or a version line may start; after a record that was cut off
# it need not be at the start of a line.
_START = re.compile(rb"\x1f\x8b\x08|WARC/\d")
_LINE = re.compile(rb"WARC/\d")
FOUND = (
    "file string, kind string, offset bigint, length bigint, reason string, type string, "
    "record_id string, refers_to string, uri string, payload_bytes bigint, "
    "payload_digest string, payload binary"
)


# -- records -----------------------------------------------------------------


def record(
    name: str, uri: str | None, digest: str, size: int, payload: bytes | None, refers_to: str | None
) -> bytes:
    """One record; ``payload`` is None for a revisit of ``refers_to``."""
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    ).encode() + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{quote(name)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(uri or '', safe=';/?:@&=+$,#%~')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[2:2] = [f"WARC-Refers-To: <urn:page:{quote(refers_to)}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + _END + block + _END


def member(data: bytes) -> bytes:
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


class Damaged(Exception):
    """A check failed; the text says which."""


def _unpacked(data: memoryview, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at`` and where it ends."""
    unpack = zlib.decompressobj(31)
    parts, size, pos = [], 0, at
    while not unpack.eof:
        if pos >= len(data):
            raise Damaged("member is cut off")
        feed = data[pos : pos + _FEED]
        try:
            part = unpack.decompress(feed)
        except zlib.error as e:
            raise Damaged(f"member: {e}") from None
        pos += len(feed)
        size += len(part)
        if size > MOST_BYTES:
            raise Damaged("member unpacks to too much")
        parts.append(part)
    return b"".join(parts), pos - len(unpack.unused_data)


def _parsed(data, at: int) -> tuple[dict, memoryview, int]:
    """Header, block and end of the record at ``at`` of a buffer."""
    view = memoryview(data)
    if not _VERSION.match(view, at):
        raise Damaged("no version line")
    # A header line of any length; a header that never ends costs one search.
    ended = _HEADER_END.search(view, at)
    if not ended:
        raise Damaged("header does not end")
    stop = ended.start() - at
    header = {}
    for line in bytes(view[at : at + stop]).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        header[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = header.get("content-length", "")
    if not length.isdigit():
        raise Damaged("no length")
    start = at + stop + len(_END)
    end = start + int(length)
    if end > len(view):
        raise Damaged("record is cut off")
    if bytes(view[end : end + len(_END)]) != _END:
        raise Damaged("record does not end where its length says")
    return header, view[start:end], end + len(_END)


def _check(named: str | None, data) -> None:
    """A digest in hex or base 32, where its algorithm is known."""
    kind, _, value = (named or "").partition(":")
    if kind not in ("sha1", "sha256", "md5"):
        return
    digest = hashlib.new(kind, data)
    known = (digest.hexdigest(), base64.b32encode(digest.digest()).decode().lower())
    if value.lower() not in known:
        raise Damaged("digest differs")


def _payload(header: dict, block) -> tuple[dict, bytes]:
    """HTTP header and payload of a block; other blocks are all payload."""
    if not header.get("content-type", "").startswith("application/http"):
        return {}, bytes(block)
    data = bytes(block)
    head, end, payload = data.partition(_END)
    if not end:
        return {}, data
    lines = (x.decode("latin-1").partition(":") for x in head.split(b"\r\n")[1:])
    return {a.strip().lower(): b.strip() for a, _, b in lines}, payload


def _name(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def _row(header: dict, block) -> dict:
    _check(header.get("warc-block-digest"), block)
    http, payload = _payload(header, block)
    kind = header.get("warc-type")
    if kind == "revisit":
        size = http.get("content-length", "")
        told = header.get("warc-payload-digest", "")
        own = {
            "payload_bytes": int(size) if size.isdigit() else None,
            "payload_digest": told.partition(":")[2] or None,
            "payload": None,
        }
    else:
        _check(header.get("warc-payload-digest"), payload)
        own = {
            "payload_bytes": len(payload),
            "payload_digest": hashlib.sha256(payload).hexdigest(),
            "payload": payload,
        }
    return own | {
        "type": kind,
        "record_id": _name(header.get("warc-record-id")),
        "refers_to": _name(header.get("warc-refers-to")),
        "uri": header.get("warc-target-uri"),
    }


def _in_member(content: bytes) -> Iterator[dict]:
    """Records of what a member holds, and a gap with its place inside (``inner``)
    for each run of bytes that is none."""
    pos, start, reason = 0, None, ""
    while pos < len(content):
        try:
            header, block, end = _parsed(content, pos)
            row = _row(header, block)
        except Damaged as e:
            if start is None:
                start, reason = pos, str(e)
            found = _LINE.search(content, pos + 1)
            pos = found.start() if found else len(content)
            continue
        if start is not None:
            yield {"gap": reason, "inner": start, "inner_length": pos - start}
            start = None
        yield row
        pos = end
    if start is not None:
        yield {"gap": reason, "inner": start, "inner_length": len(content) - start}


def _rows_at(data: memoryview, at: int) -> tuple[list[dict], int]:
    """The records that start at ``at``. A member may hold several; one that
    unpacks soundly is salvaged inside, if it holds any record at all."""
    if bytes(data[at : at + 3]) != _MAGIC:
        header, block, end = _parsed(data, at)
        return [_row(header, block)], end
    content, end = _unpacked(data, at)
    rows = list(_in_member(content))
    if not any("gap" not in row for row in rows):
        raise Damaged(rows[0]["gap"] if rows else "empty member")
    return rows, end


def salvage(data: bytes) -> Iterator[dict]:
    """Records of an archive in order, and a gap for each run of bytes that is
    none. Offsets and lengths are those of the archive's bytes; a gap inside a
    sound member has the member's, and its own in the reason."""
    view, at = memoryview(data), 0
    while at < len(data):
        try:
            rows, end = _rows_at(view, at)
        except Damaged as e:
            reason, start, rows = str(e), at, None
            while rows is None:
                found = _START.search(data, at + 1)
                if not found:
                    at = len(data)
                    break
                at = found.start()
                try:
                    rows, end = _rows_at(view, at)
                except Damaged:
                    continue
            yield {"kind": "gap", "offset": start, "length": at - start, "reason": reason}
            if rows is None:
                return
        for row in rows:
            if "gap" in row:
                where = f"bytes {row['inner']} to {row['inner'] + row['inner_length']} of the member"
                yield {"kind": "gap", "offset": at, "length": end - at, "reason": f"{row['gap']} ({where})"}
            else:
                yield row | {"kind": "record", "offset": at, "length": end - at}
        at = end


# -- archives ----------------------------------------------------------------


def duplicates(
    pages: DataFrame, id_col: str, payload_col: str, uri_col: str, min_revisit: int = MIN_REVISIT
) -> DataFrame:
    """``ROW, page_id, payload_bytes, payload_digest, refers_to, record_bytes`` per
    page; ``refers_to`` is null for responses, ``record_bytes`` is what the record
    holds at most, besides its fixed parts."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = with_row(
        pages,
        F.col(id_col).alias("page_id"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
        # A quoted byte takes three.
        (F.coalesce(F.octet_length(F.col(uri_col)), F.lit(0)) * F.lit(3)).cast("bigint").alias("uri_bytes"),
    )
    rows = stage_table(rows, "payloads")
    firsts = rows.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("copies")
    )
    firsts = firsts.where("copies > 1").drop("copies")
    revisits = (F.col("payload_bytes") >= min_revisit) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return salted_lookup(rows, firsts, ["payload_digest"], ROW[1]).select(
        *ROW,
        "page_id",
        "payload_bytes",
        "payload_digest",
        F.when(revisits, F.col("first_id")).alias("refers_to"),
        (F.when(revisits, F.lit(0)).otherwise(F.col("payload_bytes")) + F.col("uri_bytes")).alias(
            "record_bytes"
        ),
    )


def _members(plain: bool):
    schema = pa.schema([("value", pa.binary())])

    def made(name, uri, digest, size, payload, refers) -> bytes:
        body = None
        if payload is not None:
            body = payload.encode("utf-8", "replace")
            digest, size = hashlib.sha256(body).hexdigest(), len(body)
        data = record(name or "", uri, digest, size, body, refers)
        # Without the bytes that the sink puts between lines.
        return data[: -len(_END)] if plain else member(data)[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _OUT_ROWS):
                columns = [c.to_pylist() for c in batch.slice(at, _OUT_ROWS).columns]
                rows = [made(*row) for row in zip(*columns)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], schema=schema)

    return run


def _write_records(rows: DataFrame, path: str, plain: bool, per_file: int) -> None:
    made = rows.mapInArrow(_members(plain), "value binary")
    made.select(F.col("value").cast("string").alias("value")).write.mode("append").option(
        "lineSep", _END.decode() if plain else "\0"
    ).option("maxRecordsPerFile", per_file).text(path)


def write(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    min_revisit: int = MIN_REVISIT,
) -> None:
    """Write ``pages`` as an archive folder at ``path``."""
    pages = lasting(pages)
    judged = stage_table(duplicates(pages, id_col, payload_col, uri_col, min_revisit), "page-fates")
    revisits = judged.where(F.col("refers_to").isNotNull())
    text = F.coalesce(F.col(payload_col), F.lit(""))
    responses = without(pages, revisits).select(
        F.col(id_col).cast("string").alias("name"),
        F.col(uri_col).alias("uri"),
        F.lit(None).cast("string").alias("digest"),
        F.lit(0).cast("bigint").alias("size"),
        text.alias("payload"),
        F.lit(None).cast("string").alias("refers"),
    )
    uris = with_row(pages, F.col(uri_col).alias("uri"))
    again = revisits.join(uris, ROW).select(
        F.col("page_id").cast("string").alias("name"),
        "uri",
        F.col("payload_digest").alias("digest"),
        F.col("payload_bytes").alias("size"),
        F.lit(None).cast("string").alias("payload"),
        F.col("refers_to").cast("string").alias("refers"),
    )
    uri_bytes = F.coalesce(F.octet_length("uri"), F.lit(0)) * 3
    every = responses.unionByName(again)
    size = F.coalesce(F.octet_length("payload"), F.lit(0)) + uri_bytes
    low = 0
    for high, per_file in [*RECORDS_PER_FILE.items(), (None, 1)]:
        held = F.col("record_bytes") >= low
        mine = size >= low
        if high is not None:
            held, mine = held & (F.col("record_bytes") < high), mine & (size < high)
        # Most tables have no large records: what nothing needs is not written.
        if low == 0 or judged.where(held).take(1):
            _write_records(every.where(mine), path, plain=high is None, per_file=per_file)
        low = high


def _salvaged(with_payload: bool):
    schema = _found_schema()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows, held = [], 0
                for row in salvage(data):
                    if not with_payload:
                        row.pop("payload", None)
                    rows.append(row | {"file": path})
                    held += len(row.get("payload") or b"")
                    if len(rows) >= _OUT_ROWS or held >= _OUT_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _found_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split(" ") for c in FOUND.split(", "))])


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records (``kind`` ``record``) and quarantined gaps (``gap``) of the
    archives under ``path``; ``payload`` stays null without ``with_payload``."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_salvaged(with_payload), FOUND)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """What ``write`` wrote: ``page_id`` (string), ``payload_bytes,
    payload_digest, record_type, refers_to`` (string)."""

    def id_of(column: str):
        # Ids were quoted as in a URL.
        raw = F.regexp_extract(column, "^urn:page:(.*)$", 1)
        return F.nullif(F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), F.lit(""))

    return read(spark, path, with_payload=False).where("kind = 'record'").select(
        id_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        id_of("refers_to").alias("refers_to"),
    )
