"""WARC archives: deduplicating writer with segmented records, and a reader that reassembles them."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import importable, written

#: Equal payloads from this size on are stored once.
MIN_REVISIT = 1000
CHUNK = 8192
SEGMENT = 32768
RECORDS_PER_FILE = 2000
#: Bytes of records that a task gathers before it passes them on.
HELD_BYTES = 1 << 22
#: Bytes of an archive that are unpacked at once.
STEP = 1 << 14
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"

RECORD = (
    "page_id long, url string, record_type string, record_id string, refers_to long, refers_to_id string, "
    "payload_bytes long, payload_digest string, stated_digest string"
)
PIECE = f"{RECORD}, origin string, number int, total long, block binary"


# --- writing --------------------------------------------------------------------------------------


def planned(pages: DataFrame) -> DataFrame:
    """Every page with its payload, digest, identifier, and the page that it revisits (null: none).

    Only pages that share a digest meet in the join, on narrow rows; the join then moves each page
    once. A digest that many pages share is pre-aggregated, and its pages may be split by the
    adaptive skew join. Equal payloads are told by page_id, then url; a row's number decides only
    among rows equal in all three, so that the order of rows matters to nothing else.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    own = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        payload.alias("payload"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= MIN_REVISIT
    first = (
        own.filter(large)
        .groupBy("digest", "page_id", "url")
        .agg(F.max("row").alias("row"), F.count("*").alias("n"))
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "url", "row", "n")).alias("kept"), F.sum("n").alias("total"))
        .filter("total > 1")
        .drop("total")
    )
    stays = (
        F.col("page_id").eqNullSafe(F.col("kept.page_id"))
        & F.col("url").eqNullSafe(F.col("kept.url"))
        & ((F.col("kept.n") == 1) | (F.col("row") == F.col("kept.row")))
    )
    shared = large & F.col("kept").isNotNull()
    return own.join(first, "digest", "left").select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "payload",
        "digest",
        F.when(shared & stays, F.col("digest")).otherwise(F.col("row").cast("string")).alias("name"),
        F.when(shared & ~stays, F.struct(F.col("kept.page_id").cast("string").alias("page_id"))).alias("kept"),
    )


def _id(page_id, name: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{name}>"


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.0" + CRLF + head.encode("ascii") + CRLF + block + CRLF + CRLF


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def records_of(page_id, url, payload: bytes, name: str, digest: str, kept, segment: int = SEGMENT) -> list[bytes]:
    """One page as complete WARC records: a revisit, or a response in as many segments as needed.

    A response that others revisit has its digest for a name.
    """
    own = _id(page_id, name)
    fields = [
        ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%-._~")),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if kept is not None:
        block = status + b"Content-Length: %d\r\n\r\n" % len(payload)
        more = [
            ("WARC-Refers-To", _id(kept["page_id"], digest)),
            ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
        ]
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *fields, *more], block)]
    block = status + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    if len(parts) == 1:
        return [_record([("WARC-Type", "response"), ("WARC-Record-ID", own), *fields], block)]
    out = [_record([("WARC-Type", "response"), ("WARC-Record-ID", own), *fields, ("WARC-Segment-Number", "1")], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{n}>"), ("WARC-Date", DATE)]
        more += [("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(n))]
        if n == len(parts):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_record(more, part))
    return out


def packed(record: bytes) -> bytes:
    """The record as a gzip member of its own."""
    own = zlib.compressobj(wbits=31)
    return own.compress(record) + own.flush()


def write(pages: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """Writes archives below ``path``, a gzip member per record, with Spark's own text writer.

    A member ends with the length of what it holds, whose highest byte is zero below 16 MB; the
    writer adds that byte as its line end. Segments bound the size of a record, and the record count
    that of an archive.
    """
    if segment > 1 << 23:
        raise ValueError("a segment has at most 8 MB")

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            held: list[bytes] = []
            size = 0
            for p in zip(f["page_id"], f["url"], f["payload"], f["name"], f["digest"], f["kept"]):
                for record in records_of(*p, segment=segment):
                    if len(record) >= 1 << 24:
                        raise ValueError("a record's head takes more than 8 MB")
                    held.append(packed(record)[:-1])
                    size += len(held[-1])
                    if size >= HELD_BYTES:
                        yield pd.DataFrame({"record": held})
                        held, size = [], 0
            yield pd.DataFrame({"record": held})

    importable(pages.sparkSession)
    built = planned(pages).mapInPandas(build, "record binary")
    (
        built.select(F.col("record").cast("string"))
        .write.option("lineSep", "\x00")
        .option("compression", "none")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


# --- reading --------------------------------------------------------------------------------------


def unpacked(content: bytes) -> Iterator[bytes]:
    """The bytes of an archive in steps: all gzip members, one after the other, or as they are."""
    view, at = memoryview(content), 0
    if content[:2] != b"\x1f\x8b":
        while at < len(view):
            yield bytes(view[at : at + STEP])
            at += STEP
        return
    while at < len(view):
        member = zlib.decompressobj(31)
        while not member.eof:
            if at >= len(view):
                raise ValueError("archive ends within a gzip member")
            step = view[at : at + STEP]
            yield member.decompress(step)
            at += len(step) - len(member.unused_data)
        while at < len(view) and view[at] == 0:  # padding
            at += 1


def parsed(steps: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an unpacked archive; lengths decide, not content.

    A record may lie in one step, in several, or share one with others; one record is held at once.
    """
    steps, held, done = iter(steps), bytearray(), 0

    def more() -> None:
        step = next(steps, None)
        if step is None:
            raise ValueError(f"archive ends within the record at byte {done}")
        held.extend(step)

    while True:
        while held[:2] == CRLF:  # further empty lines after a record
            del held[:2]
            done += 2
        if not held:
            step = next(steps, None)
            if step is None:
                return
            held.extend(step)
            continue
        if not b"WARC/".startswith(held[:5]):
            raise ValueError(f"no record at byte {done}")
        end, seen = held.find(b"\r\n\r\n"), 0
        while end < 0:
            seen = max(len(held) - 3, 0)
            more()
            end = held.find(b"\r\n\r\n", seen)
        if held[:5] != b"WARC/":
            raise ValueError(f"no record at byte {done}")
        folded = re.sub(r"\r\n[ \t]+", " ", held[:end].decode("utf-8", "replace"))
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in folded.split("\r\n")[1:])}
        begin = end + 4
        stop = begin + int(headers["content-length"])
        while len(held) < stop + 4:
            more()
        if held[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {done} does not end where its length says")
        yield headers, bytes(held[begin:stop])
        del held[: stop + 4]
        done += stop + 4


def unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(CRLF, at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        begin = end + 2
        if body[begin + size : begin + size + 2] != CRLF:
            raise ValueError("chunk does not end where its size says")
        out.append(body[begin : begin + size])
        at = begin + size + 2


def payload_of(block: bytes) -> tuple[int, str]:
    """(length, SHA-1) of the payload of a whole response block; all of it, if it is not HTTP."""
    body = block
    if block.startswith(b"HTTP/"):
        head, _, body = block.partition(b"\r\n\r\n")
        if re.search(rb"\r\ntransfer-encoding:[ \t]*chunked[ \t]*(\r|$)", head.lower()):
            body = unchunked(body)
    return len(body), hashlib.sha1(body).hexdigest()


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+):[0-9a-f]+>", urn or "")
    return int(found[1]) if found else None


def _stated(digest: str | None) -> str | None:
    """A stated SHA-1, in hex or base 32, as lower-case hex; null if none is stated."""
    kind, _, value = (digest or "").partition(":")
    if kind.lower() != "sha1":
        return None
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def _row(headers: dict[str, str], block: bytes) -> dict | None:
    """What a response, a revisit or a segment of a response tells; null for other records."""
    kind, number = headers["warc-type"], headers.get("warc-segment-number")
    if kind not in ("response", "revisit", "continuation"):
        return None
    own = headers["warc-record-id"]
    out = dict.fromkeys(c.split()[0] for c in PIECE.split(", "))
    out |= {"page_id": _page(own), "url": headers.get("warc-target-uri"), "record_type": kind, "record_id": own}
    out["stated_digest"] = _stated(headers.get("warc-payload-digest"))
    if kind == "revisit":
        to = headers.get("warc-refers-to")
        out |= {"refers_to": _page(to), "refers_to_id": to}
    elif number is None:
        out["payload_bytes"], out["payload_digest"] = payload_of(block)
    else:
        total = headers.get("warc-segment-total-length")
        out |= {"origin": headers.get("warc-segment-origin-id", own), "number": int(number), "block": block}
        out["total"] = int(total) if total else None
    return out


def _frame(rows: list[dict], schema: str) -> pd.DataFrame:
    types = dict(c.split() for c in schema.split(", "))
    whole = {"long": "Int64", "int": "Int32"}
    return pd.DataFrame({n: pd.Series([r[n] for r in rows], dtype=whole.get(t, "object")) for n, t in types.items()})


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit in the archives below ``path``.

    Every file there is an archive, gzipped in one member or in many, or plain. Each is unpacked
    once. Unsegmented records are digested where they are read. Segments are grouped by the record they
    began with (a group is one page), ordered, checked for gaps and total length, joined and
    unchunked; those of other records than responses are left out. A revisit gets the length and
    digest of the response that it refers to by record identifier.

    These stop the job: an archive or record that is cut off, a payload that misses its stated SHA-1,
    a segment that is missing, a revisit whose response is missing or has another digest than the
    revisit states. Defined results: other record types give no rows; a digest of another
    kind than SHA-1 is not compared; page_id and refers_to are null for identifiers that ``write`` has not
    made, record_id and refers_to_id never; no archives, or empty ones, give no rows.
    """

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for content in f["content"]:
                rows, held = [], 0
                for headers, block in parsed(unpacked(content)):
                    row = _row(headers, block)
                    if row is None:
                        continue
                    rows.append(row)
                    held += len(row["block"] or b"")
                    if held > HELD_BYTES or len(rows) >= 5000:
                        yield _frame(rows, PIECE)
                        rows, held = [], 0
                yield _frame(rows, PIECE)

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for origin, r, parts, total in zip(f["origin"], f["first"], f["parts"], f["total"]):
                block = b"".join(bytes(p["block"]) for p in parts)
                if [p["number"] for p in parts] != list(range(1, len(parts) + 1)) or len(block) != total:
                    raise ValueError(f"record {origin}: segments are missing")
                length, digest = payload_of(block)
                rows.append(dict(r) | {"payload_bytes": length, "payload_digest": digest})
            yield _frame(rows, RECORD)

    importable(spark)
    names = [c.split()[0] for c in RECORD.split(", ")]
    files = spark.read.format("binaryFile").load(path).select("content")
    pieces = written(files.mapInPandas(split, PIECE), "records")
    joined = (
        pieces.filter("origin IS NOT NULL")
        .groupBy("origin")
        .agg(
            F.max(F.when(F.col("number") == 1, F.struct(*names))).alias("first"),
            F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
            F.max("total").alias("total"),
        )
        .mapInPandas(join, RECORD)
    )
    whole = pieces.filter("origin IS NULL AND record_type = 'response'").select(*names)
    responses = written(whole.unionByName(joined), "responses")
    # Identifiers are unique in sound archives; grouped, a repeated one gives no revisit twice.
    known = responses.groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.min(F.struct("payload_bytes", "payload_digest")).alias("response")
    )
    revisits = pieces.filter("record_type = 'revisit'").select(*names).join(known, "refers_to_id", "left")
    resolved = revisits.withColumns(
        {
            "payload_bytes": F.when(F.col("response").isNotNull(), F.col("response.payload_bytes")).otherwise(
                _stop("no response for revisit ", "record_id").cast("long")
            ),
            "payload_digest": F.col("response.payload_digest"),
        }
    ).select(*names)
    agrees = F.col("stated_digest").isNull() | (F.col("payload_digest") == F.col("stated_digest"))
    checked = F.when(agrees, F.col("payload_digest")).otherwise(_stop("digest mismatch in record ", "record_id"))
    return responses.unionByName(resolved).withColumn("payload_digest", checked).drop("stated_digest")


def _stop(message: str, column: str) -> Column:
    return F.raise_error(F.concat(F.lit(message), F.coalesce(F.col(column), F.lit("?"))))


def round_trip(pages: DataFrame, path: str, segment: int = SEGMENT) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives below ``path`` and reads them back.

    Defined results: a null html is an empty payload; a null url an empty target; a null page_id
    stays null; of rows with equal payload and page_id the one of the largest url is the response, of
    repeated rows any; the others revisit it (below the size for
    revisits, each is a response); an empty table gives no records. Other columns are ignored.
    """
    write(pages, path, segment)
    return read(pages.sparkSession, path)
