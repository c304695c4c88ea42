"""WARC archives with revisit records for repeated payloads."""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, scratch, table

#: Fixed values of the WARC 1.1 and base32 formats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32, HEX32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
DATE = "2024-01-01T00:00:00Z"

READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: four base-32 digits for every five hexadecimal ones."""
    digest = F.sha1(payload)
    five = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*five), HEX32, BASE32)


def _rows(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))}
    )


KEYS = ["payload_digest", "payload_bytes"]
HEAD = [*KEYS, "page_id", "url", "record_type", "refers_to", "refers_url", "copy"]


def _who() -> Column:
    """What orders records of equal payloads: page_id, null last, then the url."""
    return F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.col("url").isNull().alias("bare"), "url")


def resolve(pages: DataFrame, min_bytes: int = 0, *, broadcast_rows: int = 200_000) -> DataFrame:
    """One record per page: HEAD's columns, and the payload of responses (null for revisits).

    Of rows with equal payloads of at least ``min_bytes`` the one with the smallest page_id (null
    last, then the smallest url) is the response and the others revisit it; smaller ones are all responses. A null html is an
    empty payload.

    Only headers are shuffled: digest, size, page_id and url, rows that repeat all four as one with a count. Their first is
    found by digest, with partial aggregation. A revisit is written from its header alone. Payloads stay where they were
    read: digests that occur more than once are broadcast to them if they are at most ``broadcast_rows`` (about 150
    bytes each), else both are shuffled by digest, and what isn't its digest's first is dropped. Headers and
    firsts are written tables, so that both joins are of plain shuffles, whose hot digests AQE splits. Where
    the first itself is repeated, one of its equal rows is kept, by an aggregation of those rows.
    """
    rows = _rows(pages)
    large = F.col("payload_bytes") >= min_bytes
    heads = materialize(rows.where(large).groupBy(*KEYS, "page_id", "url").agg(F.count("*").alias("n")), "warc-headers")
    firsts = heads.groupBy(*KEYS).agg(F.min(_who()).alias("_first"), F.min_by("n", _who()).alias("_same"), F.sum("n").alias("_all"))
    firsts = materialize(firsts.where("_all > 1").drop("_all"), "warc-firsts")
    n, most = firsts.agg(F.count("*"), F.max("_same")).first()
    few = F.broadcast(firsts) if n <= broadcast_rows else firsts
    first = _who().eqNullSafe(F.col("_first"))
    if n:
        revisits = heads.join(few, KEYS).withColumn("_left", F.col("n") - first.cast("long")).where("_left > 0")
        revisits = revisits.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "_left").cast("array<string>"))).select(
            *KEYS,
            "page_id",
            "url",
            F.lit("revisit").alias("record_type"),
            F.col("_first.page_id").alias("refers_to"),
            F.col("_first.url").alias("refers_url"),
            "copy",
            F.lit(None).cast("string").alias("payload"),
        )
    kept = rows.join(few, KEYS, "left").where(F.col("_first").isNull() | first)
    if (most or 1) > 1:
        kept = kept.where("_same is null or _same = 1").unionByName(kept.where("_same > 1").dropDuplicates(KEYS))
    responses = kept.select(
        *KEYS,
        "page_id",
        "url",
        F.lit("response").alias("record_type"),
        F.lit(None).cast(pages.schema["page_id"].dataType).alias("refers_to"),
        F.lit(None).cast("string").alias("refers_url"),
        F.when(large, "0").otherwise(F.expr("uuid()")).alias("copy"),  # small rows may be equal, and nothing refers to them
        "payload",
    )
    return responses.unionByName(revisits) if n else responses


def _record_id(page: str, url: str, copy: Column) -> Column:
    named = F.coalesce(F.col(page).cast("string"), F.lit("null")), F.md5(F.coalesce(url, F.lit("")))
    return F.concat(F.lit("<urn:x-page:"), named[0], F.lit(":"), named[1], F.when(F.col(url).isNull(), "-").otherwise(":"), copy, F.lit(">"))


def _line(c: str) -> Column:
    return F.regexp_replace(c, r"[\r\n]", " ")


def record(date: str = DATE) -> Column:
    """The text of a record of ``resolve``'s rows, with the two line ends that close it."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    revisit = F.col("record_type") == "revisit"
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id("page_id", "url", F.col("copy"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), _line("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id("refers_to", "refers_url", F.lit("0")))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To-Target-URI: "), _line("refers_url"))),
        F.when(revisit, F.lit(f"WARC-Refers-To-Date: {date}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    )
    return F.concat(head, F.lit("\r\n\r\n"), http, F.when(revisit, "").otherwise(F.col("payload")), F.lit("\r\n\r\n"))


#: A gzip member of nothing, in Latin-1: the separator that Spark puts after each chunk of an archive, which readers skip.
NOTHING = gzip.compress(b"", mtime=0).decode("latin-1")


def write_archives(resolved: DataFrame, path: str, *, file_bytes: int = 64 << 20, chunk_bytes: int = 8 << 20) -> None:
    """Writes archives of a gzip member for each record, so any record can be read from its offset alone.

    Members are put together in chunks of at most ``chunk_bytes`` (or one record, if that is larger), and a file is closed
    when it has ``file_bytes`` of chunks. A task holds one chunk and one batch of records. Executors write through Spark,
    so ``path`` may be any store.
    """

    def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for value in batch.column(0):
                member = gzip.compress(value.as_buffer(), 6, mtime=0)
                if held and size + len(member) > chunk_bytes:
                    yield pa.record_batch([pa.array([b"".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
                held.append(member)
                size += len(member)
        if held:
            yield pa.record_batch([pa.array([b"".join(held)], pa.binary())], ["value"])

    chunks = resolved.select(record().alias("value")).mapInArrow(zipped, "value binary").select(F.col("value").cast("string"))
    chunks.write.option("lineSep", NOTHING).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", max(1, file_bytes // chunk_bytes)).text(path)


def records(archive: bytes, step: int = 1 << 14) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a gzipped archive, of one member or many, holding one record at a time."""
    unzip, held, at = zlib.decompressobj(31), bytearray(), 0

    def more() -> bool:
        nonlocal unzip, at
        if unzip.eof:
            unzip = zlib.decompressobj(31)
        part = archive[at : at + step]
        held.extend(unzip.decompress(part))
        at += len(part) - len(unzip.unused_data)
        return at < len(archive)

    going = bool(archive)
    while True:
        while (end := held.find(b"\r\n\r\n")) < 0 and going:
            going = more()
        if end < 0:
            return
        lines = held[:end].decode().split("\r\n")
        head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(head["content-length"])
        while len(held) < end + 8 + size and going:
            going = more()
        block = bytes(held[end + 4 : end + 4 + size])
        if len(block) < size:
            raise ValueError("an archive ends within a record")
        del held[: end + 8 + size]
        yield head, block


def _page(urn: str | None) -> int | None:
    found = (urn or "").removeprefix("<urn:x-page:").partition(":")[0].partition(">")[0]
    return int(found) if found not in ("", "null") else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, and the payload of responses.

    A response whose payload doesn't have the digest or the length of its headers raises.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for head, block in records(content.as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    response = head["warc-type"] == "response"
                    if response and (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()) != (size, digest):
                        raise ValueError(f"record {head['warc-record-id']} doesn't match its digest")
                    rows.append((_page(head["warc-record-id"]), size, digest, head["warc-type"], _page(head.get("warc-refers-to")), payload if response else None))
                    held += len(payload)
                    if held > 1 << 23 or len(rows) >= 5000:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, READ_SCHEMA + ", payload binary")


def deduplicate(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Writes the pages' deduplicated archives to ``path`` and reads them back.

    ``pages`` has page_id, url and html; other columns, whatever their names, aren't archived. Null ids and urls are kept as
    such, repeated rows are a record each, very long payloads are written whole (an archive holds one at least, and is read
    as one file, so a payload must stay below 2 GB). An empty table writes no records and gives an empty result.
    """
    write_archives(resolve(pages, min_bytes), path)
    return read_archives(pages.sparkSession, path)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return deduplicate(pages, scratch(spark, "warc")).drop("payload")


_DIGITS = " || ".join(
    f"substr('{BASE32}', 1 + CAST((CAST('0x' || substr(h, {5 * i + 1}, 5) AS BIGINT) >> {s}) & 31 AS INTEGER), 1)"
    for i in range(8)
    for s in (15, 10, 5, 0)
)

OP9_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_DIGITS} AS payload_digest,
             min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d
"""
