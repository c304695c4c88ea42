"""Periodic runs of words, by power-of-two naming: every block of 2^k words gets a number, equal blocks the same one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, table

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "struct<runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>"


def names(first: np.ndarray) -> list[np.ndarray]:
    """Level k has at i the name of the block of 2^k words from i on, -1 - i if no other block equals it.

    ``first`` names single words. A block's name is the rank of the pair of its halves' names, so equal names mean equal
    blocks, without any hash. Levels end when no block occurs twice; each has one entry more than there are words.
    """
    n, at, key = len(first), np.arange(len(first)), first.astype(np.int64)
    levels: list[np.ndarray] = []
    while len(at):
        _, name, times = np.unique(key, return_inverse=True, return_counts=True)
        again = times[name] > 1
        at, name = at[again], name[again]
        if not len(at):
            break
        level = -1 - np.arange(n + 1, dtype=np.int32 if n < 1 << 30 else np.int64)
        level[at] = name
        half = 1 << len(levels)
        levels.append(level)
        at = at[at + half < n]
        at = at[level[at + half] >= 0]
        key = level[at].astype(np.int64) * (n + 1) + level[at + half]
    return levels


def ahead(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from a on equal those from b on; no block of twice the highest level's size occurs twice."""
    i, j = a.copy(), b.copy()
    for k in range(len(levels) - 1, -1, -1):
        step = (levels[k][i] == levels[k][j]).astype(np.int64) << k
        i += step
        j += step
    return i - a


def behind(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words before a equal those before b, where a < b."""
    i, j = a.copy(), b.copy()
    for k in range(len(levels) - 1, -1, -1):
        low = i - (1 << k)
        step = ((low >= 0) & (levels[k][np.maximum(low, 0)] == levels[k][np.maximum(j - (1 << k), 0)])).astype(np.int64) << k
        i -= step
        j -= step
    return a - i


def _grid(levels: list[np.ndarray], longest: int, held: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """x and p, a bounded number at a time: x is a multiple of p, and two words at x or just before equal those p later.

    A run of period p has p or more places in a row (two at least) whose word equals the one p later, so one is a multiple of p.
    """
    if len(levels) < 2:
        return
    word, pair, n = levels[0], levels[1], len(levels[0]) - 1
    xs, ps, size = [], [], 0
    for p in range(1, longest // 2 + 1):
        x = np.flatnonzero(word[: n - p : p] == word[p:n:p]) * p
        if not len(x):
            continue
        low = np.maximum(x - 1, 0)
        x = x[(pair[x] == pair[x + p]) | (pair[low] == pair[low + p])]
        for part in np.array_split(x, 1 + len(x) // held) if len(x) else ():
            xs.append(part)
            ps.append(np.full(len(part), p))
            size += len(part)
            if size >= held:
                yield np.concatenate(xs), np.concatenate(ps)
                xs, ps, size = [], [], 0
    if size:
        yield np.concatenate(xs), np.concatenate(ps)


def runs(first: np.ndarray, longest: int, least: int = 12, held: int = 1 << 20) -> np.ndarray:
    """Rows (start, length, period) of all runs over named words, by start and period; ``longest`` bounds a run's length.

    A run is a longest stretch with smallest period q and at least ``max(least, 2 * q)`` words. Grid candidates are
    extended both ways; candidates of multiples of q give the same stretch and leave the smallest period. Takes n log n
    candidates, ``held`` at once, and n numbers a level.
    """
    if least < 3:
        raise ValueError("a run has three words at least")
    found = np.empty((0, 3), np.int64)
    levels = names(first)
    for x, p in _grid(levels, longest, held):
        back = behind(levels, x, x + p)
        same = back + ahead(levels, x, x + p)
        good = (same >= p) & (same + p >= least)
        found = np.concatenate([found, np.stack([(x - back)[good], (same + p)[good], p[good]], axis=1)])
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _found(texts: pa.Array, least: int) -> pa.Array:
    """Runs and collapsed text of each text. Words are named by text, so no block reaches over two of them."""
    split = pc.ascii_split_whitespace(texts)
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    words = split.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    words, of = words.filter(full), of[full.to_numpy(zero_copy_only=False)]
    sizes = np.bincount(of, minlength=len(texts))
    encoded = words.dictionary_encode()
    first = of.astype(np.int64) * (len(encoded.dictionary) + 1) + encoded.indices.to_numpy()
    rows = runs(first, int(sizes.max(initial=0)), least)
    start, length, period = rows.T
    text = of[start]
    marks = np.zeros(len(of) + 1, np.int64)
    np.add.at(marks, start + period, 1)
    np.add.at(marks, start + length, -1)
    kept = np.cumsum(marks[:-1]) == 0
    joined = pc.binary_join(_lists(words.filter(pa.array(kept)), np.bincount(of[kept], minlength=len(texts))), " ")
    local = start - (np.cumsum(sizes) - sizes)[text]
    listed = pa.StructArray.from_arrays([pa.array(local), pa.array(length), pa.array(period)], fields=list(RUN))
    return pa.StructArray.from_arrays([_lists(listed, np.bincount(text, minlength=len(texts))), joined], ["runs", "collapsed"])


def find(docs: DataFrame, text: str = "text", *, least: int = 12, chunk_bytes: int = 2_000_000) -> DataFrame:
    """Adds ``runs``, by start and period, and ``collapsed``, the text without what repeats a run's first period.

    Runs are stretches of words with smallest period q and at least ``max(least, 2 * q)`` words that can't be extended.
    ``collapsed`` joins by one space the words that no run has after its first q ones.

    Texts are worked on in chunks of ``chunk_bytes``, or one at a time if longer, each whole: a text of n words takes about
    ``4 * n * log2(longest repeated block)`` bytes. No row depends on another one, so nothing is shuffled and repeated rows
    give equal results. Null texts count as empty and have no runs; ids don't matter; an empty table gives no rows, and
    columns of ``docs`` named like an output are replaced.
    """
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            batch = batch.fill_null("")
            size = np.cumsum(pc.binary_length(batch).to_numpy(zero_copy_only=False).astype(np.int64))
            parts, a = [], 0
            while a < len(batch):
                b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + chunk_bytes, "right")))
                parts.append(_found(batch.slice(a, b - a), least))
                a = b
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("runs", pa.list_(RUN)), ("collapsed", pa.string())]))

    search.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    found = F.arrow_udf(search, FOUND)(F.col(f"`{text}`").cast("string"))
    searched = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), found.alias("found"))
    return searched.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("runs", "collapsed")], "found.runs", "found.collapsed")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, with a periodic end for one id in ten; texts of null ids stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    ws, n, g = F.col("ws"), F.size("ws"), F.floor(F.col("h") / 10)
    split = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("ws"))
    cut = split.select("doc_id", "text", "ws", F.when(n > 0, (g % n).cast("int")).alias("a"), F.when(n > 0, (3 + g % 8)).alias("parts"))
    cut = cut.withColumn("p", (1 + F.floor((n - F.col("a")) / F.col("parts"))).cast("int"))
    a, p = F.col("a"), F.col("p")
    periodic = F.array_join(F.transform(ws, lambda w, i: F.when(i < a, w).otherwise(F.get(ws, a + (i - a) % p))), " ")
    return cut.select("doc_id", F.when(a.isNotNull(), periodic).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(planted(docs.select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"),
        F.floor(1000 * F.col("_best.length") / -F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: A checksum bit by bit: each byte is met by an exclusive or, then shifted out eight times.
_CRC32 = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split({0}, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, 3988292384 * (s & 1)) END), 4294967295)"""

OP11_SQL = rf"""
WITH d0 AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws,
                   {_CRC32.format("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
d1 AS (SELECT *, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a, 3 + (h // 10) % 8 AS parts FROM d0),
d AS (SELECT rn, doc_id, ws AS o, a, 1 + (len(ws) - a) // parts AS p FROM d1),
e AS (SELECT rn, doc_id, CASE WHEN a IS NULL THEN o ELSE list_transform(range(len(o)), lambda i: CASE WHEN i < a THEN o[i + 1] ELSE o[a + (i - a) % p + 1] END) END AS ws FROM d),
t AS (SELECT rn, unnest(range(len(ws))) AS i, unnest(ws) AS w, len(ws) AS n FROM e),
m AS (SELECT x.rn, x.i, y.i - x.i AS p FROM t x JOIN t y ON x.rn = y.rn AND x.w = y.w AND y.i > x.i AND 2 * (y.i - x.i) <= x.n),
g AS (SELECT rn, p, i, i - row_number() OVER (PARTITION BY rn, p ORDER BY i) AS k FROM m),
s AS (SELECT rn, min(i) AS start, count(*) + p AS length, p FROM g GROUP BY rn, p, k HAVING count(*) >= p AND count(*) + p >= 12),
r AS (SELECT rn, start, length, min(p) AS period FROM s GROUP BY rn, start, length),
a AS (SELECT rn, count(*) AS n_runs, arg_min({{'s': start, 'l': length, 'p': period}}, {{'l': -length, 's': start, 'p': period}}) AS b,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM r GROUP BY rn),
gone AS (SELECT DISTINCT rn, unnest(range(start + period, start + length)) AS i FROM r),
c AS (SELECT t.rn, string_agg(t.w, ' ' ORDER BY t.i) AS kept FROM t ANTI JOIN gone USING (rn, i) GROUP BY t.rn)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.l AS BIGINT) AS length,
       CAST(b.p AS BIGINT) AS period, CAST(1000 * b.l // b.p AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM e LEFT JOIN a USING (rn) LEFT JOIN c USING (rn)
"""
