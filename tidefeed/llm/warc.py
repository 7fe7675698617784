"""WARC archives: write pages as records with revisits and segments, read archives back.

Archives are gzip files of WARC/1.1 records in the shared folder, written and read by Spark. A payload
is sent in chunked transfer framing. A record block longer than ``segment_bytes`` is cut into a first
record with ``WARC-Segment-Number: 1`` and continuation records that name the first in
``WARC-Segment-Origin-ID``; the last has ``WARC-Segment-Total-Length``. Reading gathers segments by
origin wherever they lie, orders them by number, verifies the total length, and undoes the framing.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefeed.llm.sharing import checked, shipped
from tidefeed.storage import new_folder

#: Bytes of a chunk of the transfer framing.
CHUNK = 8192
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_DATE = "2024-01-01T00:00:00Z"
_END = "\r\n\r\n"


def digest_text(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer framing."""
    parts = [payload[k : k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """What chunked framing holds; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0].strip(), 16)
        at = line + 2
        if size < 0:
            raise ValueError("a chunk of negative size")
        if size == 0:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut off")
        out.append(body[at : at + size])
        at += size + 2


def _header(first: str, fields: list[tuple[str, object]]) -> bytes:
    return (first + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def _one_line(value: str | None) -> str:
    return re.sub(r"[\r\n]+", " ", value or "")


def page_records(row_id: str, page_id, url, payload: bytes, refers_to, segment_bytes: int) -> list[bytes]:
    """The records of one page, without the blank lines that end each."""
    uid = f"<urn:uuid:{uuid.uuid5(_SPACE, row_id)}>"
    digest = f"sha1:{digest_text(payload)}"
    fields = [
        ("WARC-Record-ID", uid),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", digest),
        ("X-Page-ID", "" if page_id is None else page_id),
    ]
    if refers_to is not None:
        block = _header("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("X-Refers-To-Page", refers_to),
        ]
        kind = "revisit"
    else:
        head = [("Content-Type", "text/html; charset=utf-8"), ("Transfer-Encoding", "chunked")]
        block, kind = _header("HTTP/1.1 200 OK", head) + chunked(payload), "response"
    fields = [("WARC-Type", kind), *fields, ("Content-Type", "application/http; msgtype=response")]
    pieces = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    if len(pieces) == 1:
        return [_header("WARC/1.1", [*fields, ("Content-Length", len(block))]) + block]
    out = [_header("WARC/1.1", [*fields, ("WARC-Segment-Number", 1), ("Content-Length", len(pieces[0]))]) + pieces[0]]
    for number, piece in enumerate(pieces[1:], 2):
        more = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_SPACE, f'{row_id}/{number}')}>"),
            ("WARC-Date", _DATE),
            ("WARC-Target-URI", _one_line(url)),
            ("WARC-Segment-Origin-ID", uid),
            ("WARC-Segment-Number", number),
        ]
        if number == len(pieces):
            more.append(("WARC-Segment-Total-Length", len(block)))
        out.append(_header("WARC/1.1", [*more, ("Content-Length", len(piece))]) + piece)
    return out


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``payload``, and ``refers_to``: the page whose response a revisit means.

    Only digests and lengths are grouped; the payloads join a checked table of those that repeat.
    """
    rows = pages.select(
        "page_id",
        "url",
        F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"),
    ).withColumn("sha", F.unhex(F.sha1("payload")))
    repeated = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("sha")
        .agg(F.max("page_id").alias("owner"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    repeated = checked(repeated, "payloads", 64)
    again = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return rows.join(repeated, "sha", "left").withColumn("refers_to", F.when(again, F.col("owner"))).drop("sha", "owner")


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, segment_bytes: int = 65536, records_per_file: int = 20000
) -> None:
    """Write a WARC record for each row of ``pages`` (``page_id``, ``url``, ``html``) below ``path``.

    Of rows with equal payloads of ``min_bytes`` or more the one with the largest ``page_id`` is a
    response, the others are revisits of it; rows that repeat that ``page_id`` are responses too, and a
    NULL ``page_id`` counts as the smallest. NULL html is an empty payload. An empty table writes no record.
    """

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for number, page_id, url, payload, refers_to in batch.itertuples(index=False):
                page_id = None if pd.isna(page_id) else int(page_id)
                refers_to = None if pd.isna(refers_to) else int(refers_to)
                out += page_records(f"{number}/{page_id}/{url}", page_id, url, payload, refers_to, segment_bytes)
                if len(out) >= 256:
                    yield pd.DataFrame({"value": out})
                    out = []
            yield pd.DataFrame({"value": out})

    numbered = with_revisits(pages, min_bytes).select(
        F.monotonically_increasing_id().alias("number"), "page_id", "url", "payload", "refers_to"
    )
    # The text writer puts out the bytes of a string as they are, and a cast keeps them.
    shipped(numbered).mapInPandas(records, "value binary").select(F.col("value").cast("string").alias("value")).write.option(
        "lineSep", _END
    ).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _inflated(data: bytes) -> Iterator[bytes]:
    """The content of an archive, gzipped or not, in pieces of at most ``PIECE`` bytes; it ends where it is damaged."""
    if data[:2] != b"\x1f\x8b":
        yield from (data[a : a + PIECE] for a in range(0, len(data), PIECE))
        return
    member, at, rest = zlib.decompressobj(31), 0, b""
    try:
        while rest or at < len(data):
            if not rest:
                rest, at = data[at : at + PIECE], at + PIECE
            yield member.decompress(rest, PIECE)
            rest = member.unconsumed_tail
            if member.eof:
                member, rest = zlib.decompressobj(31), member.unused_data
    except zlib.error:
        return


#: Bytes of an archive that are read and inflated at once.
PIECE = 1 << 18
_STARTS = re.compile(rb"WARC/\d+\.\d+\r\n")


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers (names in lower case) and block of each record of an archive, gzipped or not.

    No more than a record is held inflated. The block is None where a record has no length or is cut off; reading
    goes on at the next beginning of a record.
    """
    pieces, held = _inflated(data), bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        while not (found := _STARTS.search(held)):
            del held[: max(0, len(held) - 16)]
            if not more():
                return
        del held[: found.start()]
        stop = held.find(b"\r\n\r\n")
        while stop < 0 and more():
            stop = held.find(b"\r\n\r\n")
        if stop < 0:
            yield _headers(held), None
            return
        headers = _headers(held[:stop])
        size = _number(headers.get("content-length"))
        del held[: stop + 4]
        if size is None or size < 0:
            yield headers, None
            continue
        while len(held) < size and more():
            pass
        if len(held) < size:
            yield headers, None
            return
        block = bytes(held[:size])
        del held[:size]
        yield headers, block


def _headers(lines: bytearray) -> dict[str, str]:
    fields = (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in fields}


def _number(text: str | None) -> int | None:
    """A whole number that fits a long; None for anything else."""
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,18}", text) else None


RECORD = (
    "origin string, number long, total long, record_type string, page_id long, url string, "
    "digest string, refers_to long, block binary"
)


def _records(spark: SparkSession, path: str) -> DataFrame:
    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                out = []
                for h, block in parse_archive(data):
                    out.append(
                        (
                            h.get("warc-segment-origin-id", h.get("warc-record-id")),
                            _number(h.get("warc-segment-number")),
                            _number(h.get("warc-segment-total-length")),
                            h.get("warc-type"),
                            _number(h.get("x-page-id")),
                            h.get("warc-target-uri"),
                            h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                            _number(h.get("x-refers-to-page")),
                            block,
                        )
                    )
                    if len(out) >= 256:
                        yield _frame(out)
                        out = []
                yield _frame(out)

    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select("content")
    return shipped(files).mapInPandas(parse, RECORD)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[x.split()[0] for x in RECORD.split(",")])
    return out.astype({c: "Int64" for c in ("number", "total", "page_id", "refers_to")})


def payload_of(block: bytes) -> tuple[bytes | None, int]:
    """The payload of an HTTP response block and its length; None for headers alone.

    Framing or a length that can't be read is a ValueError.
    """
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        body = unchunked(body)
        return body, len(body)
    size = int(fields.get(b"content-length", len(body)))
    return (body, size) if len(body) == size else (None, size)


READ = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary, intact boolean"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, segments put together: ids, type, payload, its length and digest.

    ``intact`` is false where segments are missing or repeated, the lengths or digests disagree, or a record is
    cut off or can't be read; such a row has no payload, and the other records come out as they are. An id that is no
    number is NULL. A revisit has the length and digest of the payload it means, and no payload.
    A missing archive is an error; one without records gives no rows.
    """
    records = _records(spark, path)
    whole = records.where("number is null")
    parts = records.where("number is not null")
    first = F.col("number") == 1
    joined = (
        parts.groupBy("origin")
        .agg(
            F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"),
            F.max("total").alias("total"),
            *(F.max(F.when(first, F.col(c))).alias(c) for c in ("record_type", "page_id", "url", "digest", "refers_to")),
        )
        .withColumn("numbers", F.col("parts.number"))
        .withColumn("block", F.aggregate("parts.block", F.lit(b""), lambda a, b: F.concat(a, b)))
        .withColumn("block", F.when(F.expr("numbers = sequence(1L, cast(size(numbers) as bigint))"), F.col("block")))
        .withColumn("block", F.when(F.octet_length("block") == F.col("total"), F.col("block")))
    )
    names = ["page_id", "url", "record_type", "refers_to", "digest", "block"]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page_id, url, kind, refers_to, digest, block in batch.itertuples(index=False):
                row = [page_id, url, kind, refers_to, None, None, None, False]
                try:
                    payload, size = payload_of(block) if block is not None else (None, None)
                except ValueError:
                    block = None
                if block is not None:
                    found = digest if payload is None else digest_text(payload)
                    if found == digest and (payload is not None or kind == "revisit"):
                        row[4:] = [size, digest, payload, True]
                out.append(row)
            frame = pd.DataFrame(out, columns=[x.split()[0] for x in READ.split(",")])
            yield frame.astype({c: "Int64" for c in ("page_id", "refers_to", "payload_bytes")})

    return shipped(whole.select(*names).unionAll(joined.select(*names))).mapInPandas(decode, READ)


def round_trip(pages: DataFrame, min_bytes: int = 0, **writing) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back; see both functions."""
    path = new_folder(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes, **writing)
    return read_archives(pages.sparkSession, path)
