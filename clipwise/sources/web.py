"""What addresses answer, as a table: executors ask, answers come in parts of bounded size, and a failure is a row."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AGENT = "clipwise/1.0 (corpus curation)"
PARTS = "url string, part int, status int, body binary, error string"


def answers(urls: DataFrame, url: str = "url", *, part_bytes: int = 1 << 16, timeout: float = 60.0, pause: float = 0.0, hosts: int | None = None) -> DataFrame:
    """url, part (from 0), status, body and error of every address: a row for each ``part_bytes`` of an answer.

    A task holds one part, so an answer may be of any length. One that can't be had, or breaks off, ends in a row with its ``error`` and no
    body; parts before it stand. Addresses of one host are asked by one task, ``pause`` seconds apart; ``hosts`` says how many tasks
    there are (as many as shuffle partitions otherwise). Repeated addresses are asked once, null ones not at all.
    """
    asked = urls.where(F.col(url).isNotNull()).select(F.col(url).cast("string").alias("url")).distinct()
    host = F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit(""))
    dealt = asked.repartition(hosts, host) if hosts else asked.repartition(host)

    def row(address: str, part: int, status: int | None, body: bytes | None, error: str | None) -> pa.RecordBatch:
        cols = zip((address, part, status, body, error), (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.string()), strict=True)
        return pa.record_batch([pa.array([v], t) for v, t in cols], ["url", "part", "status", "body", "error"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column(0).to_pylist():
                part, status = 0, None
                try:
                    with urllib.request.urlopen(urllib.request.Request(address, headers={"User-Agent": AGENT}), timeout=timeout) as answer:
                        status = answer.status
                        body = answer.read(part_bytes)
                        while body or not part:
                            yield row(address, part, status, body, None)
                            part, body = part + 1, answer.read(part_bytes)
                except (OSError, ValueError) as e:
                    yield row(address, part, e.code if isinstance(e, urllib.error.HTTPError) else status, None, f"{type(e).__name__}: {e}")
                time.sleep(pause)

    return dealt.mapInArrow(ask, PARTS)


def pages(parts: DataFrame) -> DataFrame:
    """url, html and error: the text of each whole answer, with bytes that aren't UTF-8 replaced; null if it failed."""
    whole = parts.groupBy("url").agg(F.array_sort(F.collect_list(F.when(F.col("body").isNotNull(), F.struct("part", "body")))).alias("parts"), F.max("error").alias("error"))
    body = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["body"]))
    return whole.select("url", F.when(F.col("error").isNull(), F.make_valid_utf8(body)).alias("html"), "error")


def files(parts: DataFrame) -> DataFrame:
    """name (a digest of the address) and content of each whole answer, for ``files.write_files``."""
    whole = parts.groupBy("url").agg(F.array_sort(F.collect_list(F.struct("part", "body"))).alias("parts"), F.count("error").alias("failed")).where("failed = 0")
    return whole.select(F.sha1("url").alias("name"), F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["body"])).alias("content"))
