"""Exact n-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersection."""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, connected_components, grouped_batches, materialize, table, trimmed

U = np.uint64
_A, _B, _C = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64; wraps around by design."""
    x = (x ^ (x >> U(30))) * _A
    x = (x ^ (x >> U(27))) * _B
    return x ^ (x >> U(31))


class Hashes(dict):
    """64-bit hashes of words, filled as they come and emptied at ``limit``."""

    def __init__(self, limit: int = 150_000) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


def shingles(text: str | None, width: int, hashes: Hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``width`` words.

    A-Z are lower-cased; words lie between ASCII white space. Fewer words than ``width`` are one shingle, none are none.
    """
    ws = (text or "").encode().lower().split()
    if not ws:
        return np.zeros(0, U)
    ids = np.fromiter(map(hashes.__getitem__, ws), U, len(ws))
    n = min(width, len(ws))
    h = np.full(len(ws) - n + 1, n, U)
    for i in range(n):
        h = mix(h * _C + ids[i : len(ws) - n + 1 + i])
    return np.unique(h)


@dataclass(frozen=True)
class Bands:
    """Bands of set sizes, and how many parts a set is cut into in each.

    Two sets with J >= ``percent`` / 100 differ in at most (a + b) (1 - J) / (1 + J) elements. Cut by the value of
    the hashes into that many parts and ``spare`` more, they agree in ``spare`` + 1 parts at least. A part of fewer
    than ``least`` elements is weak, as many unrelated sets may share it. It is emitted only for sets
    with more weak parts than spare ones; for two others one part that they share isn't weak.
    So no pair is lost. A pair belongs to the band of its smaller set; a set that may be the larger one of
    a pair from the band below is emitted in that band too.
    """

    percent: int
    ratio: float = 1.5
    least: int = 3

    def low(self, band: int) -> int:
        return math.ceil(self.ratio**band - 1e-9)

    def of(self, n: int) -> int:
        band = int(math.log(n) / math.log(self.ratio))
        while self.low(band + 1) <= n:
            band += 1
        while self.low(band) > n:
            band -= 1
        return band

    def parts(self, band: int) -> tuple[int, int]:
        """Parts and spare parts; (0, 0) where only equal sets can link."""
        a = self.low(band + 1) - 1
        b = a * 100 // self.percent
        differ = (a + b) * (100 - self.percent) // (100 + self.percent)
        spare = 2 + differ // 8
        return (differ + 1 + spare, spare) if differ else (0, 0)

    def signatures(self, h: np.ndarray) -> np.ndarray:
        n = len(h)
        if not n:
            return h
        own = self.of(n)
        out = []
        for band in (own, own - 1):
            if band < own and (band < 0 or n * self.percent > (self.low(own) - 1) * 100):
                continue
            p, spare = self.parts(band)
            if not p:
                continue
            edges = np.searchsorted(h, (np.arange(p, dtype=np.float64) * (2.0**64 / p)).astype(U))
            sizes = np.diff(np.append(edges, n))
            sums = np.zeros(p, U)
            full = np.flatnonzero(sizes)
            sums[full] = np.add.reduceat(mix(h ^ _C), edges[full])
            weak = sizes < self.least
            keep = np.arange(p) if weak.sum() > spare else np.flatnonzero(~weak)
            out.append(mix(sums[keep] ^ mix(keep.astype(U) + U(band << 32 | 1))))
        return np.concatenate(out) if out else np.zeros(0, U)


PAIRED = 16  # sets with one signature up to which all their pairs are tested
CELLS, SLICES = 22, 64  # bits of a hash by which shingles share a counter; slices in which counters are added up


def cell_ranks(docs: DataFrame, width: int) -> np.ndarray:
    """A sketch of frequencies: for each of 2**22 cells of the hash how often shingles fall in it, as a logarithm.

    Every document counts, up to 2**32 - 1 times a cell in a task. A task adds up its counters and sends them in slices, packed; each slice is
    summed as the packs come, so a task holds one array however many there are. The driver gets 16 MB, executors 4 MB.
    """
    cells, size = 1 << CELLS, (1 << CELLS) // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = Hashes(), np.zeros((16, cells // 16), np.uint32)
        held: list[np.ndarray] = []
        many = 0

        def add() -> None:
            if held:
                at = np.sort((np.concatenate(held) >> U(64 - CELLS)).astype(np.int32))
                held.clear()
                for i, part in enumerate(np.split(at, np.searchsorted(at, np.arange(1, 16) * (cells // 16)))):
                    if len(part):
                        counts[i] += np.bincount(part - i * (cells // 16), minlength=cells // 16).astype(np.uint32)

        for batch in batches:
            for text in batch.column("text"):
                held.append(shingles(text.as_py(), width, hashes))
                many += len(held[-1])
                if many >= 500_000:
                    add()
                    many = 0
        add()
        every = counts.reshape(-1)
        for i in range(SLICES):
            own = every[i * size : (i + 1) * size].astype(np.int64)
            if own.any():
                large = np.flatnonzero(own > 254)
                rest = np.stack([large, own[large]]).tobytes()
                packed = zlib.compress(np.minimum(own, 254 * (own <= 254)).astype(np.uint8).tobytes(), 1)
                yield pa.record_batch([pa.array([i], pa.int32()), pa.array([packed]), pa.array([rest])], ["slice", "small", "large"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, small, large in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = sums.setdefault(i, np.zeros(size, np.int64))
                own += np.frombuffer(zlib.decompress(small), np.uint8)
                at, n = np.frombuffer(large, np.int64).reshape(2, -1)
                own[at] += n
        for i, own in sums.items():
            yield pa.record_batch([pa.array([i], pa.int32()), pa.array([np.minimum(own, 2**32 - 1).astype(np.uint32).tobytes()])], ["slice", "n"])

    packs = docs.select("text").mapInArrow(trimmed(count), "slice int, small binary, large binary")
    out = np.zeros(cells, np.uint32)
    for r in packs.repartition("slice").mapInArrow(trimmed(total), "slice int, n binary").collect():
        out[r["slice"] * size : (r["slice"] + 1) * size] = np.frombuffer(r["n"], np.uint32)
    return np.minimum(255, 8 * np.log2(out + 1.0)).astype(np.uint8)


@lru_cache(maxsize=8)
def size_bands(percent: int) -> list[int]:
    """Least sizes of bands: two sets that link lie in the same band or in neighbours."""
    lows = [1]
    while lows[-1] < 1 << 40:
        lows.append(-(-lows[-1] * 100 // percent))
    return lows


def prefix(h: np.ndarray, percent: int, ranks: np.ndarray) -> np.ndarray:
    """Signatures from the elements of a set that come first in a fixed order, one more than a linked set may lack.

    Two sets that link share one of these elements, whatever the order. It goes by the ranks of cells, so
    that shingles of passages that many documents share come last, then by hash. A signature is an element
    with the set's size band or the next one, so sets whose sizes rule out a link don't meet.
    """
    n = len(h)
    if not n:
        return h
    order = np.argsort(ranks[(h >> U(64 - CELLS)).astype(np.int64)], kind="stable")
    first = mix(h[order[: n - (percent * n + 99) // 100 + 1]])
    band = bisect_right(size_bands(percent), n)
    return np.concatenate([mix(first ^ U(band)), mix(first ^ U(band + 1))])


def linked(a: int, b: int, common: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def bitmaps(sets: list[np.ndarray], bits: int, most: int = 4 << 20) -> np.ndarray:
    """A row of ``bits`` bits for each set, with those of its elements set; some sets at a time, as a bit takes a byte until it is packed."""
    step = max(1, most // bits)
    out = np.zeros((len(sets), bits // 64), U)
    for a in range(0, len(sets), step):
        part = sets[a : a + step]
        flags = np.zeros((len(part), bits), np.uint8)
        for i, s in enumerate(part):
            flags[i, (s & U(bits - 1)).astype(np.int64)] = 1
        out[a : a + step] = np.packbits(flags, axis=1).view(U)
    return out


def tile_links(ids: np.ndarray, sets: list[np.ndarray], percent: int, every: bool = False, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links between the sets of one tile; only as many as join its components, unless ``every``.

    ``known`` names the component of each set as far as it is known; sets that share one aren't compared.

    Sets in order of size meet those that aren't too large. Bits of a hashed bitmap
    that one set has and the other lacks each stand for an element that isn't shared, which bounds the overlap from above; the
    pairs that pass are intersected exactly.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    ids, sizes, sets = ids[order], sizes[order], [sets[i] for i in order]
    m = len(sets)
    bits = 64
    while bits < min(4 * sizes[-1], 1 << 16):
        bits *= 2
    maps = bitmaps(sets, bits)
    root = list(range(m))
    if known is not None:
        _, first, which = np.unique(known[order], return_index=True, return_inverse=True)
        root = first[which].tolist()

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in range(m - 1):
        end = int(np.searchsorted(sizes, sizes[i] * 100 // percent, "right"))
        if not sizes[i] or end <= i + 1:
            continue
        other = maps[i + 1 : end]
        lost_i = np.bitwise_count(maps[i] & ~other).sum(axis=1, dtype=np.int64)
        lost_j = np.bitwise_count(other & ~maps[i]).sum(axis=1, dtype=np.int64)
        bound = np.minimum(sizes[i] - lost_i, sizes[i + 1 : end] - lost_j)
        for j in np.flatnonzero(100 * bound >= percent * (sizes[i] + sizes[i + 1 : end] - bound)) + i + 1:
            a, b = find(i), find(int(j))
            if a == b and not every:
                continue
            at = np.searchsorted(sets[j], sets[i])
            common = int((sets[j][np.minimum(at, sizes[j] - 1)] == sets[i]).sum())
            if linked(sizes[i], sizes[j], common, percent):
                root[max(a, b)] = min(a, b)
                out.append((int(ids[i]), int(ids[j])))
    return out


def _combined(sigs: np.ndarray, nodes: np.ndarray, most: int = 1) -> pa.RecordBatch:
    """Rows sig, node, lead and heavy of a batch's signatures. Of one that more than ``most`` sets have, the first set comes as heavy (lead null), and once each other set with that first one as its lead.

    Only firsts have to meet across batches; the others are dealt by their own number, so a signature that most sets share isn't one task's.
    """
    _, first, of, many = np.unique(sigs, return_index=True, return_inverse=True, return_counts=True)
    heavy = many > most
    rows = np.concatenate([first[heavy], np.flatnonzero(~heavy[of])])
    led = heavy[of]
    leads = nodes[first][of]
    led &= nodes != leads
    pairs = np.unique(np.stack([nodes[led], leads[led]], axis=1), axis=0) if len(nodes) else np.empty((0, 2), np.int64)
    known = np.concatenate([np.zeros(len(rows), bool), np.ones(len(pairs), bool)])
    lead = pa.array(np.concatenate([nodes[rows], pairs[:, 1]]), mask=~known)
    marks = pa.array(np.concatenate([np.arange(len(rows)) < heavy.sum(), np.zeros(len(pairs), bool)]))
    return pa.record_batch([pa.array(np.concatenate([sigs[rows], pairs[:, 0]])), pa.array(np.concatenate([nodes[rows], pairs[:, 0]])), lead, marks], ["sig", "node", "lead", "heavy"])


def _pairs(sig: np.ndarray, node: np.ndarray, heavy: np.ndarray, most: int) -> pa.RecordBatch:
    """Pairs a, b of whole groups: all of one with up to ``most`` rows, of others (sure) the first row with each other."""
    starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
    sizes = np.diff(np.append(starts, len(sig)))
    large = np.repeat((sizes > most) | np.logical_or.reduceat(heavy, starts), sizes)
    group = np.repeat(np.arange(len(starts)), sizes)
    firsts = node[starts][group]
    out = [np.stack([firsts, node, large], axis=1)[large]]
    for step in range(1, min(most, int(sizes.max()))):
        met = np.flatnonzero((group[step:] == group[:-step]) & ~large[step:])
        out.append(np.stack([node[met], node[met + step], np.zeros(len(met), np.int64)], axis=1))
    every = np.concatenate(out)
    every = every[every[:, 0] != every[:, 1]]
    every[:, :2].sort(axis=1)
    every = np.unique(every, axis=0)
    return pa.record_batch([pa.array(every[:, 0]), pa.array(every[:, 1]), pa.array(every[:, 2] > 0)], ["a", "b", "sure"])


def _stars(batches: Iterator[pa.RecordBatch], most: int = 1) -> Iterator[pa.RecordBatch]:
    """From rows sorted by signature: pairs a, b of sets with the same one, and of sets with the leads that they have.

    Of a signature that more than ``most`` sets have (or with a heavy row) the first set meets each other one, which is ``sure`` to be
    wanted, as those may link with each other; of others all pairs come, and one that can't link is none of a cluster's.
    """
    held = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    for batch in batches:
        led = batch.filter(batch.column("lead").is_valid())
        if led.num_rows:
            yield pa.record_batch([led.column("lead"), led.column("node"), pa.array(np.ones(led.num_rows, bool))], ["a", "b", "sure"])
        batch = batch.filter(batch.column("lead").is_null())
        if not batch.num_rows:
            continue
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "node", "heavy")]
        sig, node, heavy = (np.concatenate(x) for x in zip(held, now, strict=True))
        last = int(np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))[-1])
        if len(sig) - last > most:  # already large: its first row stands for what came
            yield _pairs(sig, node, heavy, most)
            held = sig[last : last + 1], node[last : last + 1], np.ones(1, bool)
        else:
            if last:
                yield _pairs(sig[:last], node[:last], heavy[:last], most)
            held = sig[last:], node[last:], heavy[last:]
    if len(held[0]):
        yield _pairs(*held, most)


def bitmap(h: np.ndarray) -> bytes:
    """A set's bits by the low bits of its hashes, at least one for each element."""
    bits = 64
    while bits < len(h):
        bits *= 2
    flags = np.zeros(bits, np.uint8)
    flags[(h & U(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags).tobytes()


def may_link(na: np.ndarray, maps_a: list[bytes], nb: np.ndarray, maps_b: list[bytes], percent: int) -> np.ndarray:
    """Which pairs of sets their sizes and bitmaps don't rule out; the longer map of a pair is folded to the length of the other."""
    wide = [np.array(list(map(len, maps))) for maps in (maps_a, maps_b)]
    width = np.minimum(*wide)
    out = np.zeros(len(na), bool)
    for w in np.unique(width):
        at = np.flatnonzero((width == w) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)))
        if not len(at):
            continue
        sides = []
        for maps, long in zip((maps_a, maps_b), wide, strict=True):
            side = np.empty((len(at), w // 8), U)
            for x in np.unique(long[at]):
                own = np.flatnonzero(long[at] == x)
                side[own] = np.bitwise_or.reduce(np.frombuffer(b"".join(maps[i] for i in at[own]), U).reshape(len(own), x // w, w // 8), axis=1)
            sides.append(side)
        a, b = sides
        lost_a = np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64)
        lost_b = np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64)
        bound = np.minimum(na[at] - lost_a, nb[at] - lost_b)
        out[at] = 100 * bound >= percent * (na[at] + nb[at] - bound)
    return out


def _likely(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The sure ones of ``pairs`` (a, b, sure) and those whose sets' bitmaps, an eighth of a byte to a quarter for each element, let them link."""
    pairs = materialize(pairs.groupBy("a", "b").agg(F.max("sure").alias("sure")), "candidate-pairs")
    open_ = pairs.where("not sure").select("a", "b")
    ends = materialize(open_.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "candidate-ends")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            sizes, maps = [], []
            for t in batch.column("text"):
                h = shingles(t.as_py(), width, hashes)
                sizes.append(len(h))
                maps.append(bitmap(h))
            yield pa.record_batch([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(maps, pa.binary())], ["node", "n", "map"])

    maps = materialize(_meet(docs.select("doc_id", "text"), ends, "inner").mapInArrow(trimmed(draw), "node long, n long, map binary"), "bitmaps")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n = [batch.column(c).to_numpy() for c in ("na", "nb")]
                keep = may_link(n[0], batch.column("ma").to_pylist(), n[1], batch.column("mb").to_pylist(), percent)
                yield pa.record_batch([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], ["a", "b"])

    side = lambda to: maps.select(F.col("node").alias(to), F.col("n").alias(f"n{to}"), F.col("map").alias(f"m{to}"))
    sized = maps.select(F.col("node").alias("b"), F.col("n").alias("_n"))
    near = open_.join(sized, "b").join(side("a"), "a").where(100 * F.least("_n", "na") >= percent * F.greatest("_n", "na")).drop("_n")
    met = near.distinct().join(side("b"), "b").select("a", "na", "ma", "b", "nb", "mb")
    return pairs.where("sure").select("a", "b").union(met.mapInArrow(trimmed(test), "a long, b long"))


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles and fp, a 128-bit fingerprint of the set (null for an empty one), of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            sizes, fps = [], []
            for t in batch.column("text"):
                s = shingles(t.as_py(), width, hashes)
                sizes.append(len(s))
                fps.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            yield pa.record_batch([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(fps, pa.binary())], ["doc_id", "n_shingles", "fp"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), "doc_id long, n_shingles long, fp binary")


def clustered_sets(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, Callable[[np.ndarray], np.ndarray]]:
    """cluster, node, n and set, a written table of the sets outside of whose clusters nothing links; and what signs a set."""
    bands = Bands(percent)
    # Under 85 % parts would hold but two or three elements each, which unrelated sets share too often.
    shared = docs.sparkSession.sparkContext.broadcast(cell_ranks(docs, width)) if percent < 85 else None

    def signatures(h: np.ndarray) -> np.ndarray:
        return bands.signatures(h) if shared is None else prefix(h, percent, shared.value)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            if batch.num_rows:
                sigs = [signatures(shingles(t.as_py(), width, hashes)) for t in batch.column("text")]
                nodes = np.repeat(batch.column("doc_id").to_numpy(), list(map(len, sigs)))
                yield _combined(np.concatenate(sigs).view(np.int64), nodes, most)

    # Rarest elements are also shared by chance, the more the larger the corpus: unless pairs are tested, all sets end up in one cluster.
    most = 1 if shared is None else PAIRED
    signed = docs.select("doc_id", "text").mapInArrow(trimmed(sign), "sig long, node long, lead long, heavy boolean")
    stars = signed.repartition("sig").sortWithinPartitions("sig").mapInArrow(trimmed(lambda batches: _stars(batches, most)), "a long, b long, sure boolean")
    likely = stars.select("a", "b") if shared is None else _likely(stars, docs, width, percent)
    clusters = connected_components(likely.distinct(), "candidates")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                sets = [shingles(t.as_py(), width, hashes) for t in part.column("text")]
                cols = [part.column("cluster"), part.column("doc_id"), pa.array(list(map(len, sets)), pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.record_batch(cols, ["cluster", "node", "n", "set"])

    nodes = clusters.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
    sets = _meet(docs.select("doc_id", "text"), nodes, "inner").mapInArrow(trimmed(load), "cluster long, node long, n long, set binary")
    return materialize(sets, "sets"), signatures


def representative_links(docs: DataFrame, width: int, percent: int, *, every: bool = False, tile_docs: int = 1024, tile_shingles: int = 4_000_000) -> DataFrame:
    """Links a, b between documents with different sets; see ``components``."""
    sets, signatures = clustered_sets(docs, width, percent)
    return links_of(sets, signatures, percent, every=every, tile_docs=tile_docs, tile_shingles=tile_shingles)


def links_of(
    sets: DataFrame,
    signatures: Callable[[np.ndarray], np.ndarray],
    percent: int,
    *,
    every: bool = False,
    tile_docs: int = 1024,
    tile_shingles: int = 4_000_000,
) -> DataFrame:
    """Links a, b between the sets of each cluster, enough to join their components, or with ``every`` all."""
    if every:
        return _compare(_dealt(sets, percent, tile_docs, tile_shingles), percent, True)
    found = materialize(_compare(_dealt(sets, percent, tile_docs, tile_shingles, own=True), percent), "tile-links")
    large = sets.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
    large = materialize(large.where(~_fits(tile_docs, tile_shingles)).select("cluster"), "large-clusters")
    if large.isEmpty():
        return found

    # Large clusters: slices are joined by the smallest set of each of their components, and what is left in different
    # components meets by signature. Near copies are one component by then, and unrelated sets share few signatures.
    rows = sets.join(large, "cluster", "left_semi")
    inner = materialize(found.join(rows.select(F.col("node").alias("a")), "a", "left_semi"), "slice-links")
    first = _components_of(rows, inner)
    between = materialize(_compare(_dealt(first.where("node = comp").drop("comp"), percent, tile_docs, tile_shingles), percent), "slice-joins")
    inner = inner.union(between)
    second = _components_of(rows, inner)
    open_ = second.groupBy("cluster").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("cluster")
    rest = materialize(second.join(materialize(open_, "open-clusters"), "cluster", "left_semi"), "open-sets")

    def resign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                sigs = [signatures(np.frombuffer(s.as_buffer(), U)) for s in part.column("set")]
                at = np.repeat(np.arange(len(sigs)), list(map(len, sigs)))
                cols = [pa.array(np.concatenate(sigs).view(np.int64)), *(part.column(c).take(pa.array(at)) for c in ("node", "comp", "n"))]
                yield pa.record_batch(cols, ["sig", "node", "comp", "n"])

    signed = materialize(rest.mapInArrow(trimmed(resign), "sig long, node long, comp long, n long"), "open-signatures")
    members = F.struct(F.count("*").alias("k"), F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.shiftrightunsigned(F.xxhash64("node"), 24)).alias("s"))
    groups = signed.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("docs"), F.sum("n").alias("shingles"), members.alias("members"))
    # The shingles of one passage are shared by the same sets: of groups with equal members one is compared.
    groups = groups.where("low <> high").groupBy("members").agg(F.min("sig").alias("sig"), F.first("docs").alias("docs"), F.first("shingles").alias("shingles"))
    groups = materialize(groups.select("sig", "shingles", _slices(tile_docs, tile_shingles).alias("slices")), "open-groups")

    # Pairs of slices of whole clusters find the same; whichever copies fewer shingles is done.
    by_group = groups.agg(F.sum(F.col("shingles") * F.col("slices"))).first()[0] or 0
    whole = rest.groupBy("cluster").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
    by_slice = whole.agg(F.sum(F.col("shingles") * _slices(tile_docs, tile_shingles))).first()[0] or 0
    if by_slice < by_group:
        return found.union(between).union(_compare(_dealt(rest, percent, tile_docs, tile_shingles), percent))
    mine = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda s: F.xxhash64("sig", F.least(s, F.col("mine")), F.greatest(s, F.col("mine"))))
    tiles = signed.select("sig", "node").join(groups, "sig").withColumn("mine", mine).select("node", F.explode(pairs).alias("tile"))
    met = materialize(tiles, "open-tiles").join(rest.select("node", "comp", "set"), "node")
    return found.union(between).union(_compare(met.select("tile", "node", "comp", "set"), percent))


def _fits(tile_docs: int, tile_shingles: int) -> Column:
    return (F.col("docs") <= tile_docs) & (F.col("shingles") <= tile_shingles)


def _slices(tile_docs: int, tile_shingles: int) -> Column:
    """In how many slices a group is cut, two of which make a tile; one if it fits."""
    cut = F.greatest(F.ceil(F.col("docs") / (tile_docs // 2)), F.ceil(F.col("shingles") / (tile_shingles // 2))).cast("int")
    return F.when(_fits(tile_docs, tile_shingles), 1).otherwise(cut)


def _components_of(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with ``comp``, the component of each node by the links, its own if it has none."""
    found = connected_components(links, "cluster-components")
    return rows.join(found.select("node", "component"), "node", "left").select(*rows.columns, F.coalesce("component", "node").alias("comp"))


def _dealt(sets: DataFrame, percent: int, tile_docs: int, tile_shingles: int, own: bool = False) -> DataFrame:
    """tile, node, comp (if given) and set: a cluster that fits is one tile; of a larger one, a tile is a pair of slices of like sizes.

    Slices go by fine size bands and a hash, and bands that may link meet; with ``own`` each slice is a tile of its own. Where ``sets``
    has ``copies`` it comes out too, with ``side``, the set's slice, and ``whole``, whether sets of one slice are to be compared in
    this tile, so that each pair is compared in one tile only.
    """
    fine = math.log(100 / percent)
    banded = sets.withColumn("band", F.floor(F.log("n") / fine).cast("int"))
    counts = banded.groupBy("cluster", "band").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
    whole = counts.groupBy("cluster").agg(F.sum("docs").alias("docs"), F.sum("shingles").alias("shingles")).select("cluster", _fits(tile_docs, tile_shingles).alias("fits"))
    cut = F.greatest(F.ceil(F.col("docs") / (tile_docs // 2)), F.ceil(F.col("shingles") / (tile_shingles // 2))).cast("int")
    sized = counts.join(whole, "cluster").select("cluster", "band", "fits", cut.alias("slices"))
    near = sized.select("cluster", F.explode(F.array(F.col("band") - 1, F.col("band") + 1)).alias("band"), "slices", F.col("band").alias("of"))
    near = near.groupBy("cluster", "band").agg(
        F.coalesce(F.max(F.when(F.col("of") < F.col("band"), F.col("slices"))), F.lit(0)).alias("below"),
        F.coalesce(F.max(F.when(F.col("of") > F.col("band"), F.col("slices"))), F.lit(0)).alias("above"),
    )
    # Written, so that sets meet their cluster's plan in a join of two plain shuffles, which AQE splits where a cluster is hot.
    plan = materialize(sized.join(near, ["cluster", "band"], "left").fillna(0, ["below", "above"]), "tile-plan")
    mine = F.pmod(F.xxhash64("node"), F.col("slices")).cast("int")
    key = lambda *c: F.xxhash64("cluster", *c)
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    if own:
        parts = F.array(key(F.col("band"), F.col("mine")))
    else:
        parts = F.concat(
            F.transform(upto(F.col("slices")), lambda s: key(F.col("band"), F.col("band"), F.least(s, F.col("mine")), F.greatest(s, F.col("mine")))),
            F.transform(upto(F.col("above")), lambda s: key(F.col("band"), F.col("band") + 1, F.col("mine"), s)),
            F.transform(upto(F.col("below")), lambda s: key(F.col("band") - 1, F.col("band"), s, F.col("mine"))),
        )
    tiles = F.when(F.col("fits"), F.array(key())).otherwise(parts)
    met = banded.join(plan, ["cluster", "band"]).withColumn("mine", mine)
    also = [c for c in ("comp",) if c in sets.columns]
    if "copies" in sets.columns:
        diagonal = key(F.col("band"), F.col("band"), F.col("mine"), F.col("mine")).alias("diagonal")
        also = ["copies", F.xxhash64("band", "mine").alias("side"), "fits", diagonal]
    dealt = met.select(F.explode(tiles).alias("tile"), "node", *also, "set")
    return dealt.withColumn("whole", F.col("fits") | (F.col("tile") == F.col("diagonal"))).drop("fits", "diagonal") if "copies" in sets.columns else dealt


def _compare(dealt: DataFrame, percent: int, every: bool = False) -> DataFrame:
    """Links a, b of all tiles; ``dealt`` has tile, node, set and, as far as components are known, comp."""
    named = "comp" in dealt.columns

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in grouped_batches(batches, "tile"):
            if tile.num_rows > 1:
                sets = [np.frombuffer(s.as_buffer(), U) for s in tile["set"]]
                found = tile_links(tile["node"].to_numpy(), sets, percent, every, tile["comp"].to_numpy() if named else None)
                if found:
                    a, b = zip(*found, strict=True)
                    yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.repartition("tile").sortWithinPartitions("tile").mapInArrow(trimmed(compare), "a long, b long")


def _short_forms(at: list[np.ndarray], columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The sets of a tile over its shingles ``at``, by how they differ from the shingles that most of them have.

    A set's short form has its other shingles and, of the common ones, those that it lacks. Returns all forms behind one another and
    where each begins, how many common ones each set lacks, and their number: of two sets ``common - lacks - lacks'`` and
    the size of their forms' intersection add up to the size of their own. Near copies have short forms.
    """
    sizes = np.array([len(x) for x in at])
    whole = np.concatenate(at)
    row = np.repeat(np.arange(len(at)), sizes)
    usual = 2 * np.bincount(whole, minlength=columns) > len(at)
    place = np.cumsum(usual) - 1
    has = np.zeros((len(at), int(usual.sum())), bool)  # at most twice the tile's shingles
    inside = usual[whole]
    has[row[inside], place[whole[inside]]] = True
    lack_row, lack = np.nonzero(~has)
    rows, forms = np.concatenate([row[~inside], lack_row]), np.concatenate([whole[~inside], np.flatnonzero(usual)[lack]])
    order = np.argsort(rows, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(at)))])
    return forms[order], starts, np.bincount(lack_row, minlength=len(at)), int(usual.sum())


def tile_counts(sets: list[np.ndarray], copies: np.ndarray, side: np.ndarray, whole: bool, percent: int) -> np.ndarray:
    """For each set of a tile the ``copies`` of all others that it links with; of one side only if the tile is ``whole``.

    As in ``tile_links`` sizes and bitmaps rule pairs out; what is left of a set's partners is intersected at once, by
    flags over the shingles of their short forms.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sizes, sets, copies, side = sizes[order], [sets[i] for i in order], copies[order], side[order]
    bits = 64
    while bits < min(4 * sizes[-1], 1 << 16):
        bits *= 2
    maps = bitmaps(sets, bits)
    distinct, at = np.unique(np.concatenate(sets), return_inverse=True)
    forms, starts, lacks, usual = _short_forms(np.split(at.astype(np.int32), np.cumsum(sizes)[:-1]), len(distinct))
    flags = np.zeros(len(distinct), np.int32)
    out = np.zeros(len(sets), np.int64)
    for i in range(len(sets) - 1):
        end = int(np.searchsorted(sizes, sizes[i] * 100 // percent, "right"))
        if end <= i + 1:
            continue
        other = maps[i + 1 : end]
        lost_i = np.bitwise_count(maps[i] & ~other).sum(axis=1, dtype=np.int64)
        lost_j = np.bitwise_count(other & ~maps[i]).sum(axis=1, dtype=np.int64)
        bound = np.minimum(sizes[i] - lost_i, sizes[i + 1 : end] - lost_j)
        open_ = 100 * bound >= percent * (sizes[i] + sizes[i + 1 : end] - bound)
        if not whole:
            open_ &= side[i + 1 : end] != side[i]
        js = np.flatnonzero(open_) + i + 1
        if not len(js):
            continue
        own = forms[starts[i] : starts[i + 1]]
        flags[own] = 1
        if 4 * len(js) > end - i - 1:
            low = starts[i + 1]
            sums = np.concatenate([[0], np.cumsum(flags[forms[low : starts[end]]])])
            shared = (sums[starts[js + 1] - low] - sums[starts[js] - low]).astype(np.int64)
        else:
            shared = np.array([flags[forms[starts[j] : starts[j + 1]]].sum() for j in js], np.int64)
        flags[own] = 0
        common = usual - lacks[i] - lacks[js] + shared
        js = js[100 * common >= percent * (sizes[i] + sizes[js] - common)]
        out[i] += copies[js].sum()
        out[js] += copies[i]
    back = np.empty_like(out)
    back[order] = out
    return back


def link_counts(sets: DataFrame, percent: int, *, tile_docs: int = 1024, tile_shingles: int = 2_000_000) -> DataFrame:
    """node and links, of each set the ``copies`` of all others that it links with; ``sets`` has cluster, node, n, copies and set.

    A cluster here is a component of links; pairs that may link by their sizes are compared, at most the square of its sets. They
    are counted in their tile and never written.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in grouped_batches(batches, "tile"):
            if tile.num_rows > 1:
                found = tile_counts(
                    [np.frombuffer(s.as_buffer(), U) for s in tile["set"]], tile["copies"].to_numpy(), tile["side"].to_numpy(), tile["whole"][0].as_py(), percent
                )
                yield pa.record_batch([pa.array(tile["node"].to_numpy()), pa.array(found)], ["node", "links"])

    dealt = _dealt(sets, percent, tile_docs, tile_shingles).repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(trimmed(count), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def _class_of(fp: Column) -> Column:
    """The first 64 bits of a set's fingerprint."""
    return F.conv(F.hex(F.substring(fp, 1, 8)), 16, -10).cast("long")


def _by_class(sets: DataFrame) -> DataFrame:
    """cluster, n, set and, in place of the document, ``node``, the set's class as in ``_class_of``; one row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = [int.from_bytes(xxhash.xxh3_128_digest(memoryview(s.as_buffer()))[:8], "big", signed=True) for s in batch.column("set")]
            yield pa.record_batch([batch.column("cluster"), pa.array(classes, pa.int64()), batch.column("n"), batch.column("set")], ["cluster", "node", "n", "set"])

    return sets.select("cluster", "n", "set").mapInArrow(trimmed(run), "cluster long, node long, n long, set binary")


def _meet(docs: DataFrame, ids: DataFrame, how: str, key: str = "doc_id", rows: int = 500_000) -> DataFrame:
    """Joins texts with rows by id; these are broadcast only if they are few (16 bytes each), else both are shuffled."""
    return docs.join(F.broadcast(ids) if ids.count() <= rows else ids, key, how)


def components(docs: DataFrame, *, width: int = 5, percent: int = 80, count_links: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and, with ``count_links``, n_links of every row of ``docs`` (doc_id, text).

    Two documents link when 100 * intersection >= percent * union of their sets of ``width``-word shingles, held as
    64-bit hashes. ``component_id`` is the smallest id that links lead to.

    Documents with equal sets are one class, and only its smallest id goes on. Representatives
    are cut into parts by the band of their sizes (see ``Bands``), or under 85 % give their rarest elements (see
    ``prefix``); any two that link share a signature. Each
    signature's first representative is paired with the others, as a star (of rarest elements that few share all pairs are taken, and those that
    sizes and bitmaps rule out dropped), and the components of these pairs are clusters, outside of which nothing can link. A cluster that fits one task is a tile, within which all
    pairs that bitmaps can't rule out are compared. A larger one is cut into slices, by fine size bands and a hash; then one set
    of each slice's components meets the others' ones; then sets of components that are still apart meet by the signatures that
    they share, or in pairs of slices if that copies less. So a large group of near copies costs its slices and their representatives, not the square of its size,
    and sets that only share a cluster with it meet it by what they have in common.

    ``n_links`` is how many other rows (with an id) have a set that links with the row's own, its copies among them. It takes all pairs of
    different sets within a component, which are compared in tiles again and counted there. Different texts that repeat an id
    count as each other's links only where their cluster has another id.

    A null text is empty, and an empty one links with nothing. A null id links with nothing, its component is
    null. Rows that repeat an id are one node with the links of each. Very long texts are compared whole, an empty table gives no rows, and
    columns besides doc_id and text are left out, whatever their names.
    """
    with arrow_rows(docs.sparkSession, 2_000):  # all that passes through Python is written before this ends
        return _components(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), width, percent, count_links)


def _components(docs: DataFrame, width: int, percent: int, count_links: bool) -> DataFrame:
    sketched = materialize(sketches(docs, width), "sketches")
    classes = materialize(
        sketched.where("fp is not null and doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")),
        "classes",
    )
    rep = F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")
    named = sketched.join(classes, "fp", "left").select("doc_id", "n_shingles", rep)
    copies = named.where("rep <> doc_id").select("doc_id").distinct()
    spare = materialize(copies.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_anti"), "copies")
    singles = _meet(docs.where("doc_id is not null and text is not null"), spare, "left_anti")
    sets, signatures = clustered_sets(singles, width, percent)
    links = links_of(sets, signatures, percent)
    links = materialize(links, "representative-links") if count_links else links
    # Ids that stand in several classes, as rows may repeat an id with another text, connect them.
    own = named.where("rep <> doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = connected_components(links.union(own), "links")
    out = ["doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")]
    if count_links:
        ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        ends = materialize(ends.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("cluster")).distinct(), "linked-sets")
        several = materialize(classes.where("copies > 1").select(_class_of(F.col("fp")).alias("node"), "copies"), "several")
        # Sets stand here once for an id; only ids that rows repeat bring one twice.
        different = _by_class(_meet(sets.drop("cluster"), ends, "inner", "node")).dropDuplicates(["cluster", "node"])
        weighed = materialize(_meet(different, several, "left", "node").fillna(1, ["copies"]), "linked-weighed")
        counts = materialize(link_counts(weighed, percent), "link-counts").withColumnRenamed("node", "class")
        told = classes.withColumn("class", _class_of(F.col("fp"))).join(counts, "class", "left")
        told = materialize(told.select("fp", "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "counted-classes")
        n_links = F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links")
        named = sketched.join(told, "fp", "left").select("doc_id", "n_shingles", rep, n_links)
        out.append("n_links")
    return named.join(found, named["doc_id"] == found["node"], "left").select(*out)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "documents").select("doc_id", "text"), width=3, percent=90, count_links=True)


OP4_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.c = e.x),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id),
k AS (SELECT x AS doc_id, count(*) AS n_links FROM e GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, coalesce(k.n_links, 0) AS n_links
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id) LEFT JOIN k USING (doc_id)
"""
