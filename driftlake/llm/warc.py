"""WARC archives: write pages as records, read them back, put segments together.

Writing: a page is a response record whose HTTP block frames the payload in chunks; a page
whose payload (of at least ``SMALLEST`` bytes) an earlier page has is a revisit record
without payload.  Blocks over ``SEGMENT`` bytes go on in continuation records that name
their origin.  Spark's text writer makes the files: its line separator is the two line
ends that close a record, so archives can lie in any store that Spark writes to.

Reading: each archive is cut by the records' own lengths.  Records without segments are
decoded on the spot; segments are grouped by the identifier of their origin, ordered by
number, checked for gaps and for the total length, then decoded.  A group is one record,
never more than one page.

A revisit is matched with the response that has its payload digest.

Defined results: a null page is empty; pages that are empty or short are all responses.
Rows that repeat the id and payload of a response are responses too, each with an
identifier of its own (revisits then name the digest only).  A null url is written as
empty; a null ``page_id`` is kept (and comes last when the first page is chosen).  Line ends in a url
become ``%0D`` and ``%0A`` in the header.  A broken archive raises; nothing is skipped.
Columns other than ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.llm.common import given, whole, written
from driftlake.session import scratch_path

#: Bytes of a payload from which copies become revisits.
SMALLEST = 100
#: Bytes of a record's block before it goes on in another record, and of a chunk.
SEGMENT, CHUNK = 8192, 4096
#: Records to an archive at most, so that a reader can hold one.
RECORDS_A_FILE = 2000
#: The date all records carry; an archive of the same pages has the same bytes but for identifiers.
DATE = "2024-01-01T00:00:00Z"

END = b"\r\n\r\n"
RESPONSE, REVISIT, CONTINUATION = "response", "revisit", "continuation"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- bytes of one record ---------------------------------------------------------------
def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """``payload`` in HTTP chunks."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(part), part) for part in parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The payload in ``framed``; extensions of chunks and trailers are read over."""
    parts, at = [], 0
    while True:
        line = framed.index(b"\r\n", at)
        size = int(framed[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        parts.append(framed[at : at + size])
        at += size + 2


def _header(kind: str, record: str, fields: dict[str, str], length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record}>", f"WARC-Date: {DATE}"]
    lines += [f"{name}: {value}" for name, value in fields.items()]
    return "\r\n".join([*lines, f"Content-Length: {length}"]).encode() + END


def records_of(page: dict) -> Iterator[bytes]:
    """The records of one page, without the line ends that close them."""
    record, html = page["record"], (page["html"] or "").encode()
    fields = {
        "WARC-Target-URI": (page["url"] or "").replace("\r", "%0D").replace("\n", "%0A"),
        "X-Page-Id": "" if pd.isna(page["page_id"]) else str(int(page["page_id"])),
        "WARC-Payload-Digest": f"sha256:{page['digest']}",
    }
    if page["revisits"]:
        fields |= {"WARC-Profile": PROFILE, "Content-Type": "application/http;msgtype=response"}
        if page["first_record"]:
            fields["WARC-Refers-To"] = f"<urn:uuid:{page['first_record']}>"
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        yield _header(REVISIT, record, fields, len(block)) + block
        return
    fields["Content-Type"] = "application/http;msgtype=response"
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
        + chunked(html)
    )
    if len(block) <= SEGMENT:
        yield _header(RESPONSE, record, fields, len(block)) + block
        return
    starts = range(0, len(block), SEGMENT)
    for number, start in enumerate(starts, 1):
        part = block[start : start + SEGMENT]
        if number == 1:
            yield _header(RESPONSE, record, fields | {"WARC-Segment-Number": "1"}, len(part)) + part
            continue
        own = hashlib.md5(f"{record}:{number}".encode()).hexdigest()
        more = {"WARC-Segment-Origin-ID": f"<urn:uuid:{record}>", "WARC-Segment-Number": str(number)}
        if number == len(starts):
            more["WARC-Segment-Total-Length"] = str(len(block))
        yield _header(CONTINUATION, own, more, len(part)) + part


def cut_archive(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record."""
    at = 0
    while at < len(archive):
        end = archive.index(END, at)
        first, *lines = archive[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        start = end + len(END)
        at = start + int(fields["content-length"])
        if archive[at : at + len(END)] != END:
            raise ValueError(f"the record at byte {start} does not end where its length says")
        yield fields, archive[start:at]
        at += len(END)


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP message, out of its chunks."""
    head, _, body = block.partition(END)
    names = head.lower().split(b"\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in names else body


# -- writing ---------------------------------------------------------------------------
def _last(page_id: str) -> Column:
    """The id with null behind all others."""
    return F.coalesce(F.col(page_id).cast("long"), F.lit(2**63 - 1))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write every row of ``pages`` to compressed archives below ``path``."""
    named = written(
        pages.select(
            F.col("page_id").cast("long").alias("page_id"),
            F.sha2(whole("html"), 256).alias("digest"),
            F.octet_length(whole("html")).alias("bytes"),
        )
        .groupBy("digest", "bytes", "page_id")
        .count(),
        "warc-digests",
    )
    firsts = written(
        named.filter(F.col("bytes") >= SMALLEST)
        .groupBy("digest")
        .agg(F.min(F.struct(_last("page_id").alias("page"), "count")).alias("first"), F.sum("count").alias("copies"))
        .filter("copies > 1")
        .select("digest", F.col("first.page").alias("first_page"), F.col("first.count").alias("times"))
        .withColumn("first_record", F.uuid()),
        "warc-firsts",
    )
    rows = pages.select("page_id", "url", "html", F.sha2(whole("html"), 256).alias("own"))
    joined = rows.join(firsts, rows["own"] == firsts["digest"], "left").select(
        "page_id",
        "url",
        "html",
        F.col("own").alias("digest"),
        F.when(F.col("times") == 1, F.col("first_record")).alias("first_record"),
        F.coalesce(_last("page_id") != F.col("first_page"), F.lit(False)).alias("revisits"),
        F.uuid().alias("new_record"),
    )

    def build(batches):
        for batch in batches:
            out: list[bytes] = []
            for page in batch.to_dict("records"):
                own = page["revisits"] or not page["first_record"]
                page["record"] = page["new_record"] if own else page["first_record"]
                out.extend(records_of(page))
            yield pd.DataFrame({"value": out})

    (
        joined.mapInPandas(build, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", END.decode())
        .option("maxRecordsPerFile", RECORDS_A_FILE)
        .option("compression", "gzip")
        .text(path)
    )


# -- reading ---------------------------------------------------------------------------
PARSED = (
    "record string, kind string, page_id long, origin string, segment int, total long, "
    "payload_bytes long, payload_digest string, block binary"
)


def _identifier(fields: dict[str, str], name: str) -> str | None:
    value = fields.get(name)
    return value.removeprefix("<urn:uuid:").removesuffix(">") if value else None


def _digest(fields: dict[str, str]) -> str | None:
    return fields.get("warc-payload-digest", "").removeprefix("sha256:") or None


def _parse(segments: bool):
    """Cut archives; yield the segments with their blocks, or the other records decoded."""

    def parse(batches):
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for fields, block in cut_archive(gzip.decompress(content)):
                    if ("warc-segment-number" in fields) != segments:
                        continue
                    record, page = _identifier(fields, "warc-record-id"), fields.get("x-page-id")
                    decoded = None
                    if not segments and fields["warc-type"] == RESPONSE:
                        decoded = payload_of(block)
                    rows.append(
                        (
                            record,
                            fields["warc-type"],
                            int(page) if page else None,
                            _identifier(fields, "warc-segment-origin-id") or record,
                            int(fields.get("warc-segment-number", 0)),
                            int(fields.get("warc-segment-total-length", -1)),
                            len(decoded) if decoded is not None else None,
                            hashlib.sha256(decoded).hexdigest() if decoded is not None else _digest(fields),
                            block if segments else None,
                        )
                    )
                frame = pd.DataFrame(rows, columns=[part.split()[0] for part in PARSED.split(", ")])
                yield frame.astype({"page_id": "Int64", "payload_bytes": "Int64"})

    return parse


def _together(groups):
    """One record out of its segments."""
    for numbers, totals, blocks in groups:
        block = b"".join(bytes(part) for part in blocks)
        if list(numbers) != list(range(1, len(numbers) + 1)) or totals[-1] != len(block):
            raise ValueError("a segment is missing, repeated or cut short")
        yield payload_of(block)


def _joined_payload(parts: pd.Series) -> pd.DataFrame:
    done = []
    for segments in parts:
        triples = ([p["segment"] for p in segments], [p["total"] for p in segments], [p["block"] for p in segments])
        (payload,) = _together([triples])
        done.append((len(payload), hashlib.sha256(payload).hexdigest()))
    return pd.DataFrame(done, columns=["payload_bytes", "payload_digest"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each page of the archives: ``page_id, payload_bytes, payload_digest,
    record_type, refers_to``; bytes and digest are of the full payload, for revisits too."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    single = files.mapInPandas(_parse(False), PARSED).drop("block", "origin", "segment", "total")
    parts = files.mapInPandas(_parse(True), PARSED)
    joined = F.pandas_udf(_joined_payload, "payload_bytes long, payload_digest string")
    rejoined = (
        parts.groupBy("origin")
        .agg(
            F.sort_array(F.collect_list(F.struct("segment", "total", "block"))).alias("parts"),
            F.max("page_id").alias("page_id"),
        )
        .select("origin", "page_id", joined("parts").alias("payload"))
        .select(
            F.col("origin").alias("record"), F.lit(RESPONSE).alias("kind"), "page_id",
            "payload.payload_bytes", "payload.payload_digest",
        )
    )
    records = written(single.unionByName(rejoined), "warc-records")
    answered = written(
        records.filter(F.col("kind") == RESPONSE)
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min("page_id").alias("first_page"), F.max("payload_bytes").alias("first_bytes")),
        "warc-answers",
    )
    revisits = records.filter(F.col("kind") == REVISIT)
    return (
        revisits.join(answered, revisits["payload_digest"] == answered["digest"], "left")
        .select("page_id", F.col("first_bytes").alias("payload_bytes"), "payload_digest", "kind", "first_page")
        .unionByName(
            records.filter(F.col("kind") == RESPONSE).select(
                "page_id", "payload_bytes", "payload_digest", "kind", F.lit(None).cast("long").alias("first_page")
            )
        )
        .withColumnsRenamed({"kind": "record_type", "first_page": "refers_to"})
    )


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    write_archives(given(spark, folder, "pages"), path)
    return read_archives(spark, path)


ORACLE = """
WITH whole_ AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
named AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM whole_),
firsts AS (SELECT *, first_value(page_id) OVER (PARTITION BY payload_digest, payload_bytes ORDER BY page_id) AS first_
    FROM named)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_ THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_ THEN first_ END AS refers_to
FROM firsts
"""
