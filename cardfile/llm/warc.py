"""WARC archives: writing captures as records, and putting segmented records together again.

A capture is an HTTP response whose payload is framed in chunks. A block that is longer than a segment is cut: the
first record is followed by continuation records that name its identifier, count up, and end with the total length.
Segments of one capture may lie in different files. Reading groups them by that identifier, orders them by number,
verifies numbers and length, and takes the chunk framing away. Files are written and listed by Spark, so they can lie
in any store, and hold a bounded number of bounded records, so a task can hold one. Archives of other writers are read
as well: versions 1.0 and 1.1, plain or gzipped, damaged ones with a row that says what is wrong.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfile.session import fresh_path, materialize

VERSION = b"WARC/1.1"
#: What a record starts with.
_START = re.compile(rb"WARC/1\.[01]\r?\n")
_CHUNKED = re.compile(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked")
_HEAD_END = re.compile(rb"\r?\n\r?\n")
DATE = "2024-01-01T00:00:00Z"
#: Bytes of a segment's block and of a chunk, and records in a file.
SEGMENT, CHUNK, RECORDS_A_FILE = 64_000, 8_192, 1_000
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over. ValueError if the framing is broken."""
    at, parts = 0, []
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it says")
        parts.append(body[at : at + size])
        at += size + 2


def record(kind: str, block: bytes, fields: dict[str, object], date: str = DATE) -> bytes:
    """A record without the two line ends that follow it. Fields without a value are left out."""
    head = {"WARC-Type": kind, "WARC-Date": date, **fields, "Content-Length": len(block)}
    lines = [VERSION] + [f"{k}: {_flat(v)}".encode() for k, v in head.items() if v is not None]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def _flat(value) -> str:
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def _new_id() -> str:
    return f"<urn:uuid:{uuid.uuid4()}>"


def capture_records(page_id, url, payload: bytes, refers_to, repeats: bool, segment: int = SEGMENT) -> list[bytes]:
    """The records of a capture: a revisit without payload, or a response in one segment or more."""
    own = {
        "WARC-Record-ID": _new_id(),
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "X-Page-Id": page_id,
        "X-Payload-Length": len(payload),
    }
    http = {"Content-Type": "application/http; msgtype=response"}
    if repeats:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [record("revisit", _HTTP, {**own, **http, "WARC-Profile": profile, "X-Refers-To-Page-Id": refers_to})]
    block = _HTTP + chunked(payload)
    if len(block) <= segment:
        return [record("response", block, {**own, **http})]
    cuts = [block[at : at + segment] for at in range(0, len(block), segment)]
    out = [record("response", cuts[0], {**own, **http, "WARC-Segment-Number": 1})]
    for n, cut in enumerate(cuts[1:], 2):
        fields = {"WARC-Record-ID": _new_id(), "WARC-Target-URI": url, "WARC-Segment-Origin-ID": own["WARC-Record-ID"]}
        total = len(block) if n == len(cuts) else None
        out.append(record("continuation", cut, {**fields, "WARC-Segment-Number": n, "WARC-Segment-Total-Length": total}))
    return out


def write_archives(
    pages: DataFrame, path: str | None = None, least_bytes: int = 0, segment: int = SEGMENT,
    key: str = "page_id", url: str = "url", html: str = "html",
) -> str:
    """Writes a record (or its segments) for each row below ``path`` and returns the path.

    Of rows with equal payloads of ``least_bytes`` or more that with the smallest key is a response and the others
    are revisits that name it. A null or empty html is an empty payload. Rows that repeat key and payload of the
    response are responses as well; rows without a key are revisits if any row with the payload has one, else
    responses. Null keys and addresses are left out of the record. An empty table writes an empty archive. Other
    columns are not read.
    """
    path = path or fresh_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("sha"),
    )
    # Only payloads that occur more than once are joined back.
    same = pages.select(F.col(f"`{key}`").alias("id"), F.sha1(payload.cast("binary")).alias("sha"), F.octet_length(payload).alias("n"))
    same = same.where(F.col("n") >= least_bytes).groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("times"))
    same = materialize(same.where("times > 1 and first is not null").select("sha", "first"), "payloads")
    repeats = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    planned = rows.join(same, "sha", "left").select("id", "url", "payload", "first", repeats.alias("repeats"))

    def build(batches):
        for frame in batches:
            for row in frame.itertuples(index=False):
                number, known = (None if pd.isna(x) else int(x) for x in (row.id, row.first))
                out = capture_records(number, row.url, row.payload.encode(), known, bool(row.repeats), segment)
                yield pd.DataFrame({"record": out})

    # Bytes pass through the text writer as they are; the separator ends a record as the format wants it.
    records = planned.mapInPandas(build, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", RECORDS_A_FILE).text(path)
    return path


_RECORD = (
    "record_id string, type string, page_id bigint, url string, origin string, segment int, total bigint, "
    "said string, said_bytes bigint, refers_to bigint, block binary, problem string"
)
_FIELDS = tuple(x.split()[0] for x in _RECORD.split(", "))
#: Types that hold a capture or a part of one; others (warcinfo, request, metadata, conversion) describe it.
_CAPTURES = ("response", "revisit", "resource")


def unzipped(content: bytes) -> tuple[bytes, str | None]:
    """The bytes of a gzipped archive, member by member, and what is wrong; plain ones as they are."""
    if content[:2] != b"\x1f\x8b":
        return content, None
    view, at, parts = memoryview(content), 0, []
    while at < len(view):
        member = zlib.decompressobj(wbits=31)
        try:
            while not member.eof and at < len(view):
                parts.append(member.decompress(view[at : at + CHUNK]))
                at += CHUNK
        except zlib.error:
            return b"".join(parts), "the compression is broken"
        if not member.eof:
            return b"".join(parts), "the compressed file ends early"
        at = min(at, len(view)) - len(member.unused_data)
    return b"".join(parts), None


def parse(content: bytes):
    """(fields in small letters, block, problem) of each record; records are found by their stated length.

    After a record without a usable length reading goes on at the next start of a record, and so it does where a block
    is followed by something else than the end of the record. Bytes that no record starts in are a record without
    fields. A problem is null or says why the block is not whole.
    """
    content, broken = unzipped(content)
    at, seen = 0, False
    while found := _START.search(content, at):
        if not seen and content[: found.start()].strip():
            yield {}, b"", "there is no record at the start"
        seen = True
        end = _HEAD_END.search(content, found.end() - 1)
        if not end:
            yield _fields(content[found.end() :]), b"", broken or "the header ends early"
            return
        head = _fields(content[found.end() : end.start()])
        at, size = end.end(), head.get("content-length", "")
        if not (size.isascii() and size.isdigit()):
            yield head, b"", "there is no length"
            continue
        block = content[at : at + int(size)]
        if len(block) == int(size):
            at += len(block)
            yield head, block, None
            continue
        # Records that a wrong length has run over are read all the same.
        yield head, block, broken or "the block ends early"
        if not (inside := _START.search(content, at)):
            return
        at = inside.start()
    if not seen and content.strip():
        yield {}, b"", broken or "there is no record"
    elif broken:
        yield {}, b"", broken


def _fields(source: bytes) -> dict[str, str]:
    head: dict[str, str] = {}
    last = None
    for line in re.split(r"\r?\n", source.decode("utf-8", "replace")):
        if last and line[:1] in (" ", "\t"):
            head[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if colon:
            last = name.strip().lower()
            head[last] = value.strip()
    return head


def _row(head: dict, block: bytes, problem: str | None) -> tuple:
    said = head.get("warc-payload-digest", "")
    return (
        head.get("warc-record-id"), head.get("warc-type"), _whole(head, "x-page-id"), head.get("warc-target-uri"),
        head.get("warc-segment-origin-id"), _whole(head, "warc-segment-number", 31), _whole(head, "warc-segment-total-length"),
        said[5:] if said[:5].lower() == "sha1:" else None, _whole(head, "x-payload-length"),
        _whole(head, "x-refers-to-page-id"), block, problem,
    )


def _whole(head: dict, name: str, bits: int = 63) -> int | None:
    """The number in a field, null if there is none that fits."""
    value = head.get(name, "")
    if not re.fullmatch(r"-?[0-9]{1,19}", value, re.ASCII) or not -(1 << bits) <= int(value) < 1 << bits:
        return None
    return int(value)


def read_records(spark, path: str) -> DataFrame:
    """A row for each record of the archives below ``path``; ``problem`` is null or says why the block is not whole."""

    def records(batches):
        for frame in batches:
            for content in frame["content"]:
                rows, held = [], 0
                for head, block, problem in parse(content):
                    rows.append(_row(head, block, problem))
                    held += len(block)
                    if held > 4_000_000:
                        yield _frame(rows)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(records, _RECORD)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({k: pd.Series([r[i] for r in rows], dtype=object) for i, k in enumerate(_FIELDS)})


def reassembled(records: DataFrame) -> DataFrame:
    """A row for each capture, its block whole; ``problem`` says what is wrong with its segments, else null.

    Records without a segment number are whole, and so are those that name no identifier. Others are grouped by the
    identifier of the first: numbers must run from 1 without gap or repeat, and the blocks must add up to the total.
    A capture whose first segment is missing has no fields but the identifier. A problem of a record comes first.
    """
    group = F.coalesce("origin", "record_id")
    single = F.col("segment").isNull() | group.isNull()
    whole = records.where(single)
    parts = records.where(~single).withColumn("record_id", group)
    first = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    grouped = parts.groupBy("record_id").agg(
        *[first(c) for c in ("type", "page_id", "url", "said", "said_bytes", "refers_to")],
        F.max("total").alias("total"), F.min("problem").alias("damage"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    numbers = F.transform("parts", lambda p: p["segment"])
    bytes_ = F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, p: a + F.octet_length(p["block"]))
    problem = (
        F.when(F.col("damage").isNotNull(), F.col("damage"))
        .when(numbers != F.sequence(F.lit(1), F.size("parts")), "segments are missing or repeated")
        .when(F.col("total").isNull() | (bytes_ != F.col("total")), "the length is not the total")
    )

    @F.pandas_udf("binary")
    def joined(blocks: pd.Series) -> pd.Series:
        return blocks.map(b"".join)

    grouped = grouped.withColumn("problem", problem).withColumn("block", joined(F.transform("parts", lambda p: p["block"])))
    columns = ["record_id", "type", "page_id", "url", "said", "said_bytes", "refers_to", "block", "problem"]
    return whole.select(columns).union(grouped.select(columns))


def read_captures(spark, path: str) -> DataFrame:
    """``page_id``, ``url``, ``record_type``, ``payload`` (null for a revisit), its bytes and digest, ``refers_to``,
    ``problem``: null, or what is wrong with the record, segments, framing or digest (the payload is null then).

    Records that are no capture (warcinfo, request, metadata) have a row only if they are damaged. Fields that are
    missing or no numbers are null. A folder of empty files gives no row. A digest is compared if it is a SHA-1.
    """

    @F.pandas_udf("payload binary, digest string, problem string")
    def decoded(blocks: pd.Series, said: pd.Series) -> pd.DataFrame:
        out = [_decode(b, s) for b, s in zip(blocks, said, strict=True)]
        return pd.DataFrame(out, columns=["payload", "digest", "problem"], dtype=object)

    rows = reassembled(read_records(spark, path))
    rows = rows.where(F.col("type").isin(*_CAPTURES) | F.col("problem").isNotNull())
    plain = F.col("type").isin("response", "resource") & F.col("problem").isNull()
    rows = rows.withColumn("d", decoded(F.when(plain, F.col("block")), "said"))
    return rows.select(
        "page_id", "url", F.col("type").alias("record_type"), F.when(plain, F.col("d.payload")).alias("payload"),
        F.when(plain, F.octet_length("d.payload")).otherwise(F.col("said_bytes")).cast("bigint").alias("payload_bytes"),
        F.when(plain, F.col("d.digest")).otherwise(F.col("said")).alias("payload_digest"),
        "refers_to", F.coalesce("problem", F.when(plain, F.col("d.problem"))).alias("problem"),
    )


def _decode(block, said) -> tuple:
    if block is None:
        return None, None, None
    try:
        head, _, body = bytes(block).partition(b"\r\n\r\n") if block[:5] == b"HTTP/" else (b"", b"", bytes(block))
        payload = dechunked(body) if _CHUNKED.search(head) else body
    except ValueError:
        return None, None, "the chunk framing is broken"
    found = digest(payload)
    return (payload, found, None) if said in (None, found) else (None, found, "the digest does not fit")
