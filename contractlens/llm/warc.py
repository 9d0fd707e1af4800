"""WARC archives: writing captures, streaming them back, assembling transactions.

A capture is a request, a response (or a revisit of an earlier response with the same
payload) and a metadata record; request and metadata name their response in
WARC-Concurrent-To. Archives are written and read by Spark's text source: the end of a
record is its line separator, so any store that Spark can reach will do.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.llm.common import slices
from contractlens.session import cut_lineage, scratch_path

# Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Records of one archive at most.
RECORDS_PER_FILE = 30_000
#: Copies of one row that one task numbers at a time.
COPIES = 256

RECORD_SCHEMA = (
    "record_type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
    "warc_date string, payload_digest string, payload_bytes long, page_id long, block binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record without the two line ends that close it. Fields without a value are
    left out; line ends in a value become spaces."""
    lines = [f"{name}: {' '.join(value.split())}" for name, value in fields if value]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"])
    return VERSION + head.encode() + END + block


def record_id(page: object, url: str | None, digest: str, copy: int, kind: str) -> str:
    name = uuid.UUID(bytes=hashlib.md5(repr((page, url, digest, copy, kind)).encode()).digest())
    return f"<urn:uuid:{name}>"


def capture_records(
    page: int | None, url: str | None, payload: bytes, first: tuple[int, str | None] | None, date: str, copy: int = 0
) -> list[bytes]:
    """The three records of a page. `first` is page and url of the response to revisit,
    copy 0 of it; `copy` tells equal rows apart."""
    digest = base32_sha1(payload)
    main = record_id(page, url, digest, copy, "response")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    common = [("WARC-Target-URI", url), ("WARC-Date", date)]
    if first is None:
        kind, extra, block = "response", [], http.encode() + payload
    else:
        kind, block = "revisit", http.encode()
        extra = [("WARC-Refers-To", record_id(*first, digest, 0, "response")), ("WARC-Profile", SAME_PAYLOAD)]
    answer = [
        ("WARC-Type", kind), ("WARC-Record-ID", main), *common, ("WARC-Payload-Digest", f"sha1:{digest}"),
        *extra, ("Content-Type", "application/http; msgtype=response"),
    ]
    side = [("WARC-Concurrent-To", main), *common]
    path = " ".join((url or "").split())
    request = f"GET {path} HTTP/1.1\r\n\r\n".encode()
    about = (f"page-id: {page}\r\n" if page is not None else "").encode() + f"payload-bytes: {len(payload)}\r\n".encode()
    return [
        record(
            [("WARC-Type", "request"), ("WARC-Record-ID", record_id(page, url, digest, copy, "request")), *side,
             ("Content-Type", "application/http; msgtype=request")], request),
        record(answer, block),
        record(
            [("WARC-Type", "metadata"), ("WARC-Record-ID", record_id(page, url, digest, copy, "metadata")), *side,
             ("Content-Type", "application/warc-fields")], about),
    ]


def revisits(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, digest and first (page_id, url): payloads that a smaller page_id has already.

    rows: page_id, url, digest, size. Payloads are counted before rows meet, so a payload
    of a third of all pages is one row on one side of the join; the rows on the other side
    are narrow.
    """
    page = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    firsts = cut_lineage(
        rows.filter(F.col("size") >= min_bytes)
        .groupBy("digest")
        .agg(F.min(page).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    return rows.join(firsts, "digest").filter("page_id > first.page_id").select("page_id", "digest", "first").distinct()


def numbered(rows: DataFrame, again: DataFrame, narrow: DataFrame, every_row: bool) -> DataFrame:
    """page_id, url, html, first and copy: the rows to write.

    Rows equal in id, url and payload are counted, become one row and are spelled out again
    with a number, a few hundred at a time, so many copies of one row go to many tasks.
    """
    key = ["page_id", "url", "digest"]
    counts = narrow.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    counts = cut_lineage(counts if every_row else counts.filter("page_id IS NULL"))
    joined = lambda some: some.join(again, ["page_id", "digest"], "left")
    if counts.isEmpty():
        return joined(rows).select("page_id", "url", "html", "first", F.lit(0).cast("bigint").alias("copy"))
    several = counts.select(*[F.col(name).alias(f"of_{name}") for name in key], "n")
    same = F.lit(True)
    for name in key:
        same &= F.col(name).eqNullSafe(F.col(f"of_{name}"))
    alone = joined(rows.join(several, same, "left_anti")).withColumn("copy", F.lit(0).cast("bigint"))
    once = rows.join(several, same, "left_semi").groupBy(*key).agg(F.first("html").alias("html"))
    once = joined(once.join(several, same).select(*key, "html", "n"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.least(F.col("n"), F.col("start") + COPIES) - 1
    copies = (
        once.withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(COPIES).cast("bigint"))))
        .repartition(parts, *key, "start")
        .withColumn("copy", F.explode(F.sequence("start", last)))
    )
    columns = ["page_id", "url", "html", "first", "copy"]
    return alone.select(*columns).unionByName(copies.select(*columns))


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2020-01-01T00:00:00Z",
    records_per_file: int = RECORDS_PER_FILE, every_row: bool = False,
) -> None:
    """Write the captures of pages (page_id, url, html) as gzip-compressed archives.

    Of equal payloads of at least `min_bytes` the smallest page_id is the response, the
    others revisit it.

    Defined cases: a null html is an empty payload; a null url is left out; a page
    without an id is a response, and every such row is a capture of its own; rows of one
    id with other urls or payloads are captures of their own; a row repeated with its id
    and url is the same capture, written again under the same record ids, or with
    `every_row` a capture of its own; further columns are left out; an empty table gives
    no record.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    narrow = cut_lineage(rows.select("page_id", "url", "digest", F.octet_length("html").alias("size")))
    again = cut_lineage(revisits(narrow, min_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=256):
            out: list[bytes] = []
            for page, url, html, first, copy in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                of = first and (first["page_id"], first["url"])
                out += capture_records(page, url, html.encode(), of, date, copy)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    (
        numbered(rows, again, narrow, every_row)
        .mapInArrow(run, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", END.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def stream_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record, from a stream cut at END + VERSION.

    Content-Length rules: a block that holds the separator itself is put together again,
    and several records in a piece are taken apart. A piece may end one file and the next
    may start another.
    """
    held = bytearray()
    for piece in pieces:
        if held:
            held += END + VERSION + piece
        else:
            held += piece if piece.startswith(VERSION) else VERSION + piece
        while held:
            head_end = held.find(END)
            if head_end < 0:
                break
            fields = parse_head(bytes(held[len(VERSION) : head_end]))
            start = head_end + len(END)
            stop = start + int(fields.get("content-length", 0))
            if len(held) < stop:
                break
            yield fields, bytes(held[start:stop])
            del held[:stop]
            if held.startswith(END):
                del held[: len(END)]
    if held.strip():
        raise ValueError("an archive ends within a record")


def http_payload(block: bytes) -> bytes:
    return block.partition(END)[2]


def read_records(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """One row per record (RECORD_SCHEMA); block is null unless asked for.

    Compressed archives are streams: a task holds one record at a time, however large
    the file. Size and digest of a response are computed from the payload that was read.
    """

    def row(fields: dict[str, str], block: bytes) -> tuple:
        kind = fields.get("warc-type")
        digest, size, page = fields.get("warc-payload-digest", "").rpartition(":")[2] or None, None, None
        if kind == "response":
            payload = http_payload(block)
            digest, size = base32_sha1(payload), len(payload)
        elif kind == "metadata":
            found = parse_head(block).get("page-id")
            page = int(found) if found is not None else None
        names = ("warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-date")
        return (kind, *(fields.get(n) for n in names), digest, size, page, block if blocks else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 7 + [pa.int64()] * 2 + [pa.binary()]
        names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

        rows, size = [], 0
        stream = (p for b in slices(batches, rows=256) for p in b["value"].to_pylist())
        for fields, block in stream_records(stream):
            rows.append(row(fields, block))
            size += len(block) if blocks else 0
            if len(rows) >= 1024 or size > 4 << 20:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)

    lines = spark.read.option("lineSep", (END + VERSION).decode()).schema("value string").text(path)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, RECORD_SCHEMA)


def assemble_transactions(records: DataFrame) -> DataFrame:
    """One nested row per capture: the main record's columns, requests and metadata.

    Requests and metadata join the response or revisit that they are concurrent to.
    Records written again under the same id are one. A main record without partners has
    empty lists; partners of an unknown record are left out.
    """
    main = records.filter(F.col("record_type").isin("response", "revisit")).dropDuplicates(["record_id"])

    def partners(kind: str, name: str) -> DataFrame:
        own = records.filter(F.col("record_type") == kind).dropDuplicates(["record_id"])
        nested = F.struct("record_id", "warc_date", "page_id", "block")
        return (
            own.filter("concurrent_to IS NOT NULL")
            .groupBy(F.col("concurrent_to").alias("record_id"))
            .agg(F.sort_array(F.collect_list(nested)).alias(name))
        )

    captures = main.drop("concurrent_to", "page_id")
    for kind, name in (("request", "requests"), ("metadata", "metadata")):
        captures = captures.join(partners(kind, name), "record_id", "left")
        captures = captures.withColumn(name, F.coalesce(name, F.array()))
    return captures


def resolve_captures(captures: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every capture.

    A revisit has its size and its response's page from the record that it refers to. The
    captures are read from a table, so that both sides of the join come out of plain
    shuffles and Spark can split a response that very many captures revisit.
    """
    rows = cut_lineage(
        captures.select(
            F.get(F.col("metadata"), F.lit(0))["page_id"].alias("page_id"),
            "record_id", "record_type", "refers_to", "payload_bytes", "payload_digest",
        )
    )
    target = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("target"), F.col("page_id").alias("target_page"),
        F.col("payload_bytes").alias("target_bytes"),
    )
    first = rows.filter("record_type = 'response'")
    later = rows.filter("record_type = 'revisit'").join(target, F.col("refers_to") == F.col("target"), "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return first.withColumn("refers_to", F.lit(None).cast("bigint")).select(*columns).unionByName(
        later.select(
            "page_id", F.col("target_bytes").alias("payload_bytes"), "payload_digest", "record_type",
            F.col("target_page").alias("refers_to"),
        )
    )


def archive_pages(pages: DataFrame, min_bytes: int = 0, every_row: bool = False) -> DataFrame:
    """Write the archives in the shared folder, read them back, assemble, resolve."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path, min_bytes, every_row=every_row)
    records = cut_lineage(read_records(spark, path, blocks=False))
    return resolve_captures(assemble_transactions(records))
