"""Language-model scoring: exact unigram counts, and a log-bilinear model fitted by noise-contrastive estimation.

Classes of words have factors that are fitted on the driver; on top of them every word with enough training tokens
has its own, fitted by blocks of the vocabulary from its own pairs.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_bytes, give_back, materialize, table, trimmed

BATCH = 2 << 20  # bytes of rows that pass to Python at once
CHUNK = 10_000_000  # bytes of texts that a task holds at a time, or one longer text
LONGEST = 32  # bytes of a word that stand for themselves; a longer one is counted by its sha256


def key(word: bytes) -> bytes:
    return word if len(word) <= LONGEST else hashlib.sha256(word).digest()


def encoded(texts: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of texts in UTF-8 with A-Z lower-cased, and all tokens as their numbers, each text closed by -1."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = split.flatten().dictionary_encode()
    found, ids = flat.dictionary.cast(pa.binary()).to_pylist(), flat.indices.to_numpy()
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    if b"" in found:  # stands where a text begins or ends with white space
        empty = found.index(b"")
        del found[empty]
        some = ids != empty
        ids, of = ids[some] - (ids[some] > empty), of[some]
    out = np.full(len(ids) + len(texts), -1, np.int32)
    out[np.arange(len(ids)) + of] = ids
    return found, out


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """``encoded`` texts of about ``CHUNK`` bytes at a time, however batches are cut."""
    held: list[pa.Array] = []
    size = 0
    for batch in batches:
        texts = batch.column("text")
        ends = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64))
        a = 0
        while a < len(texts):
            b = min(len(texts), max(a + 1, int(np.searchsorted(ends, ends[a] + CHUNK - size, "right")) - 1))
            held.append(texts.slice(a, b - a))
            size += int(ends[b] - ends[a])
            a = b
            if a < len(texts) or size >= CHUNK:
                yield encoded(pa.concat_arrays(held))
                held, size = [], 0
    if held:
        yield encoded(pa.concat_arrays(held))


def suffix_class(word_key: bytes, classes: int) -> int:
    return zlib.crc32(word_key[-3:]) % classes


def name(word_key: bytes) -> int:
    """The 64-bit hash by which a word travels; that two words of n share one has a chance of about n * n / 2**65."""
    return xxhash.xxh3_64_intdigest(word_key)


class Classes(dict):
    """Class of a word: its rank among the head words (by name), else one of ``rest`` by its last three bytes.

    Filled as words come, and emptied when it has grown to ``limit`` words.
    """

    def __init__(self, head: dict[int, int], rest: int, limit: int = 400_000) -> None:
        super().__init__()
        self.head, self.rest, self.limit = head, rest, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.limit:
            self.clear()
        k = key(word)
        self[word] = out = self.head.get(name(k), len(self.head) + suffix_class(k, self.rest))
        return out


@dataclass
class LogBilinear:
    """log P(class | previous class) ~ context[previous] . target[class] + bias[class]."""

    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    unigram: np.ndarray
    share: float = 0.1

    def log10_table(self) -> np.ndarray:
        """Normalised log10 probabilities of every class after every class, mixed with a share of the unigram."""
        s = self.context @ self.target.T + self.bias
        s -= s.max(axis=1, keepdims=True)
        p = np.exp(s)
        p /= p.sum(axis=1, keepdims=True)
        return np.log10((1 - self.share) * p + self.share * self.unigram).astype(np.float32)


def fit_nce(pairs: np.ndarray, dim: int = 32, noise: float = 25.0, steps: int = 150, rate: float = 0.05, seed: int = 7) -> LogBilinear:
    """Fits the model to a square matrix of pair counts by noise-contrastive estimation.

    The noise is the unigram; instead of drawing ``noise`` samples for every observed pair, each step takes
    their expectation over all classes, which is a matrix product. So every pair that was
    counted weighs in, and the same counts give the same model.
    """
    n = len(pairs)
    rng = np.random.default_rng(seed)
    unigram = (pairs.sum(axis=0) + 1.0) / (pairs.sum() + n)
    logs = np.log(noise * unigram).astype(np.float32)
    rows = pairs.sum(axis=1)
    total = max(1.0, rows.sum())
    scale = (n / total) ** 0.5 / np.sqrt(np.maximum(rows, 1.0) / total)  # rare contexts learn too
    data = (pairs * (scale / total)[:, None]).astype(np.float32)
    drawn = (noise * (rows * scale / total)[:, None] * unigram[None]).astype(np.float32)
    params = [
        (rng.standard_normal((n, dim)) * 0.1).astype(np.float32),
        (rng.standard_normal((n, dim)) * 0.1).astype(np.float32),
        np.log(unigram).astype(np.float32),
    ]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        context, target, bias = params
        odds = context @ target.T + (bias - logs)
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        g = data - (data + drawn) * p  # of the log-likelihood, by the score
        for i, grad in enumerate((g @ target, g.T @ context, g.sum(axis=0))):
            first[i] += 0.1 * (grad - first[i])
            second[i] += 0.01 * (grad * grad - second[i])
            step = first[i] / (1 - 0.9**t) / (np.sqrt(second[i] / (1 - 0.99**t)) + 1e-8)
            params[i] = params[i] + np.float32(rate * (1 - 0.9 * t / steps)) * step
    return LogBilinear(*params, unigram=unigram)


@dataclass
class Settings:
    """``head`` words are classes of their own and ``rest`` classes hold the others, so what is
    gathered on the driver and sent to executors is bounded by the square of their sum. Other words that
    occur ``least`` times in training have factors of their own, in a table that grows with the input."""

    head: int = 1000
    rest: int = 256
    block_bytes: int = 12 << 20
    least: int = 10
    dim: int = 16
    prior: float = 4.0


def _pair_counts(head: dict[int, int], rest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(head, rest)
        n = len(head) + rest + 1
        end = n - 1
        counts = np.zeros(n * n, np.int64)
        last = np.array([end])  # documents are chained: each ends in the class that begins the next
        for found, ids in chunks(batches):
            cls = np.array([*map(classes.__getitem__, found), end])
            c = np.concatenate([last, cls[ids]])
            counts += np.bincount(c[:-1] * n + c[1:], minlength=n * n)
            last = c[-1:]
        pairs = np.flatnonzero(counts)
        for a in range(0, len(pairs), 100_000):
            part = pairs[a : a + 100_000]
            yield pa.record_batch([pa.array(part), pa.array(counts[part])], ["pair", "n"])

    return run


def directions(vectors: np.ndarray, weights: np.ndarray, dim: int) -> np.ndarray:
    """The ``dim`` directions in which the classes' vectors differ most, each with mean 0 and variance 1 by ``weights``."""
    w = weights / weights.sum()
    x = vectors - w @ vectors
    values, axes = np.linalg.eigh((x * w[:, None]).T @ x)
    at = np.argsort(-values)[:dim]
    out = np.zeros((len(x), dim), np.float32)
    out[:, : len(at)] = x @ axes[:, at] / np.sqrt(np.maximum(values[at], 1e-6))
    return np.clip(out, -4, 4)


def tilt(data: np.ndarray, base: np.ndarray, basis: np.ndarray, prior: float, noise: float = 25.0, steps: int = 8) -> np.ndarray:
    """Factors f, a row for each row of counts, so that p(class) ~ base(class) exp(f . basis[class]), in steps of 1/32.

    Noise-contrastive estimation with ``base`` as the noise, of which the expectation is taken; ``prior`` is the weight
    of a normal prior at 0. Each step divides by the curvature at 0.
    """
    curve, axes = np.linalg.eigh((basis * base[:, None]).T @ basis)
    turned = (basis @ axes).astype(np.float32)
    across = np.ascontiguousarray(turned.T)
    base = base.astype(np.float32)
    out = np.empty((len(data), basis.shape[1]), np.int8)
    for a in range(0, len(data), 256):  # so many rows stay in the processor's cache over the steps
        part = data[a : a + 256]
        total = part.sum(axis=1, keepdims=True)
        weight = part + noise * total * base
        came = part @ turned
        scale = (0.7 / (total * np.maximum(curve, 0) + prior)).astype(np.float32)
        f = np.zeros(came.shape, np.float32)
        for _ in range(steps):
            p = f @ across
            np.clip(p, -8, 8, out=p)
            np.negative(p, out=p)
            np.exp(p, out=p)
            p *= noise
            p += 1
            np.divide(weight, p, out=p)
            f = np.clip(f + scale * (came - p @ turned - prior * f), -4, 4)
        out[a : a + 256] = np.clip(np.rint(f @ axes.T * 32), -127, 127)
    return out


def _word_pairs(head: dict[int, int], rest: int, parts: int):
    """For words outside the head: the classes that follow and precede their tokens, packed by bucket (class and part).

    A word goes by its name.
    """
    first, end = len(head), len(head) + rest
    kind = np.uint16 if end < 1 << 16 else np.uint32

    def pack(ws: list[bytes], ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        ks = list(map(key, ws))
        names = list(map(name, ks))
        cls = np.array([head.get(k, -1) for k in names] + [end], np.int32)
        rare = np.flatnonzero(cls < 0)
        if not len(rare):
            return
        cls[rare] = [first + suffix_class(ks[i], rest) for i in rare]
        named = np.array([names[i] for i in rare], np.uint64)
        bucket = (cls[rare] - first) * parts + (named % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((named, bucket))
        named, bucket = named[order], bucket[order]
        rank = np.full(len(cls), -1, np.int32)
        rank[rare[order]] = np.arange(len(rare), dtype=np.int32)
        at, c = rank[ids], cls[ids].astype(kind)
        pos = np.flatnonzero(at >= 0)
        pos = np.sort(at[pos].astype(np.int64) << 32 | pos) & 0xFFFFFFFF  # by word, then by place
        sizes = np.bincount(at[pos], minlength=len(rare)).astype(np.uint32)
        after, before, ends = c[pos + 1], c[pos - 1], np.append(0, np.cumsum(sizes, dtype=np.int64))
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        rows = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            t = slice(ends[a], ends[b])
            raw = b"".join(x.tobytes() for x in (named[a:b], sizes[a:b], after[t], before[t]))
            rows.append((int(bucket[a]), int(b - a), len(raw), pa.compress(raw, "zstd", asbytes=True)))
        yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["bucket", "words", "bytes", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, ids in chunks(batches):
            yield from pack(found, np.append(np.int32(-1), ids))

    return run, kind


def word_factors(texts: DataFrame, head: dict[int, int], size: np.ndarray, model: LogBilinear, pairs: np.ndarray, parts: int, settings: Settings) -> DataFrame:
    """name (hash of the word) and f of every word outside the head with ``least`` training tokens: its factors as a
    context and as a target (a byte each) and the log of its normaliser as a context (a float). Rows without a name
    have a class and ``z``, by which the class's words of that row change the sum over the class after each class.

    Every token of ``texts`` counts. Words meet by bucket, whose number follows the input.
    """
    rest, first = settings.rest, len(head)
    run, kind = _word_pairs(head, rest, parts)
    table_ = model.log10_table()
    targets, contexts = directions(model.target, model.unigram, settings.dim), directions(model.context, pairs.sum(axis=1) + 1.0, settings.dim)
    sent = texts.sparkSession.sparkContext.broadcast((10.0 ** table_.astype(np.float64), targets, contexts, pairs.astype(np.float32), size))
    n, least, prior = len(table_), settings.least, settings.prior

    def fit(group: pa.Table) -> pa.Table:
        probability, follow, precede, counted, sizes_ = sent.value
        label = group["bucket"][0].as_py() // parts
        got: list[list[np.ndarray]] = [[], [], [], []]
        for m, size, packed in zip(group["words"].to_pylist(), group["bytes"].to_pylist(), group["packed"], strict=True):
            raw = pa.decompress(packed.as_buffer(), size, "zstd", asbytes=True)
            tokens = (len(raw) - 12 * m) // (2 * kind().itemsize)
            got[0].append(np.frombuffer(raw, np.uint64, m))
            got[1].append(np.frombuffer(raw, np.uint32, m, 8 * m))
            got[2].append(np.frombuffer(raw, kind, tokens, 12 * m))
            got[3].append(np.frombuffer(raw, kind, tokens, 12 * m + tokens * kind().itemsize))
        named, ns, after, before = map(np.concatenate, got)
        distinct, which = np.unique(named, return_inverse=True)
        count = np.bincount(which, weights=ns).astype(np.int64)
        often = np.flatnonzero(count >= least)
        if not len(often):
            return pa.table({"name": pa.array([], pa.int64()), "f": pa.array([], pa.binary()), "class": pa.array([], pa.int32()), "z": pa.array([], pa.list_(pa.float64()))})
        index = np.full(len(distinct), -1)
        index[often] = np.arange(len(often))
        of = np.repeat(index[which], ns)
        order = np.argsort(of, kind="stable")[int((of < 0).sum()) :]
        of, after, before = of[order], after[order].astype(np.int64), before[order].astype(np.int64)
        base = probability[first + label]
        came = counted[:, first + label].astype(np.float64)
        came /= came.sum()
        fs, z = [], np.zeros(n)
        for a in range(0, len(often), 1000):
            b = min(a + 1000, len(often))
            t = slice(*np.searchsorted(of, [a, b]))
            dense = lambda c, t=t, a=a, b=b: np.bincount((of[t] - a) * n + c[t], minlength=(b - a) * n).reshape(b - a, n).astype(np.float32)
            u, d = tilt(dense(after), base, follow, prior), tilt(dense(before), came, precede, prior)
            log_z = np.log(np.exp(u / np.float32(32) @ follow.T) @ base).astype(np.float32)
            share = (count[often[a:b]] + 1) / sizes_[label]
            z += share @ np.expm1((d / np.float32(32) @ precede.T).astype(np.float64))
            fs += [x.tobytes() + y.tobytes() + w.tobytes() for x, y, w in zip(u, d, log_z, strict=True)]
        del named, ns, after, before, which, of, order, got
        give_back()
        names = [*distinct[often].view(np.int64).tolist(), None]
        rows = len(names)
        return pa.table({"name": pa.array(names, pa.int64()), "f": pa.array([*fs, None], pa.binary()), "class": pa.array([None] * (rows - 1) + [label], pa.int32()), "z": pa.array([None] * (rows - 1) + [z.tolist()], pa.list_(pa.float64()))})

    packed = texts.select("text").mapInArrow(trimmed(run), "bucket int, words int, bytes int, packed binary")
    return materialize(packed.groupBy("bucket").applyInArrow(fit, "name long, f binary, class int, z array<double>"), "word-factors")


def score_texts(docs: DataFrame, held: Column, settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """Every row with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``docs`` has ``doc_id`` and ``text``; rows for which ``held`` is true are scored but not learned from.

    Unigram counts are exact and cover all training rows. Documents are dealt to blocks of about
    ``block_bytes`` by a hash, fewer bytes where that would leave cores idle; a block counts its words, counts are added up by word, and each
    block gets back the counts of its own words alone, by name: words themselves never leave their block. So a task holds one block's texts and
    vocabulary, however large the whole vocabulary, and no vocabulary is broadcast.

    The model predicts a class from the one before it (the end of a text stands before the first word).
    Pair counts of classes are gathered from all training rows. Within a rest class a word has
    probability (c + 1) / (C + V + 1), where C counts the class's tokens, V its words, and one share
    is left for all words not seen. Words of the rest classes with ``least`` training tokens have factors of their own
    (``word_factors``): as a context one tilts the probabilities of the classes that follow, as a target its share within its
    class by the class before it. Both are normalised, so probabilities add up to 1 over classes and within
    them. Factors are written as a table, and a block gets those of its own words.

    A null or empty text is one end token. Null ids belong to training. Repeated rows are counted and scored each; those that
    share id and text lie in one block. Very long texts are read whole, each by one task. Other columns take no part. An
    empty table gives no rows; without training rows every count is 0.
    """
    with arrow_bytes(docs.sparkSession, BATCH):  # all that passes through Python is written before this ends
        return materialize(_score_texts(docs, held, settings), "lm-scores")


def _score_texts(docs: DataFrame, held: Column, settings: Settings) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held_out"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(math.ceil((total + 1) / settings.block_bytes), min(spark.sparkContext.defaultParallelism, math.ceil((total + 1) / (1 << 20))))
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def count(block: pa.Table) -> pa.Table:
        found, ids = encoded(block["text"].combine_chunks())
        ks = list(map(key, found))
        names = np.fromiter(map(name, ks), np.uint64, len(ks)).view(np.int64)
        classes = np.fromiter((suffix_class(k, settings.rest) for k in ks), np.int32, len(ks))
        words = len(ks)
        del found, ks
        learned = np.repeat(~block["held_out"].to_numpy(), np.diff(np.append(-1, np.flatnonzero(ids < 0))))
        ns = np.bincount(ids[learned & (ids >= 0)], minlength=words)
        number = block["block"][0].as_py()
        del ids, learned
        give_back()
        return pa.table({"name": names, "class": classes, "block": pa.array(np.full(words, number, np.int32)), "n": ns})

    listed = materialize(blocked.groupBy("block").applyInArrow(count, "name long, class int, block int, n long"), "block-words")
    counts = materialize(listed.groupBy("name").agg(F.sum("n").alias("c"), F.first("class").alias("class")), "word-counts")
    seen = counts.where("c > 0")
    ends = rows.where(~F.col("held_out")).count()
    top = seen.orderBy(F.desc("c"), "name").limit(settings.head).collect()
    head = {r["name"] % (1 << 64): i for i, r in enumerate(top)}
    by_class = seen.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    n_words, n_types = sum(r["c"] for r in by_class), sum(r["v"] for r in by_class)
    tokens, types = n_words + ends, n_types + (ends > 0)
    size = np.ones(settings.rest)  # C + V + 1 of each rest class, without head words
    for r in by_class:
        size[r["class"]] += r["c"] + r["v"]
    for r in top:
        size[r["class"]] -= r["c"] + 1

    n = len(head) + settings.rest + 1
    found = rows.where(~F.col("held_out")).select("text").mapInArrow(trimmed(_pair_counts(head, settings.rest)), "pair long, n long")
    got = found.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(n * n)
    pairs[got["pair"].to_numpy()] = got["n"].to_numpy()
    pairs = pairs.reshape(n, n)
    model = fit_nce(pairs)
    factors = word_factors(rows.where(~F.col("held_out")), head, size, model, pairs, math.ceil(blocks / settings.rest), settings)
    changed = factors.where("name is null").select("class", F.posexplode("z").alias("after", "z")).groupBy("class", "after").agg(F.sum("z").alias("z")).toArrow()
    sums = np.ones((n, settings.rest))
    sums[changed["after"].to_numpy(), changed["class"].to_numpy()] += changed["z"].to_numpy()
    by_pair = model.log10_table()
    by_pair[:, len(head) : n - 1] -= np.log10(sums).astype(np.float32)
    dim = settings.dim
    basis = directions(model.target, model.unigram, dim), directions(model.context, pairs.sum(axis=1) + 1.0, dim)
    shared = spark.sparkContext.broadcast((by_pair, head, size, *basis))

    def score(block: pa.Table, known: pa.Table) -> pa.Table:
        table_, head_, size_, follow, precede = shared.value
        end, first = len(table_) - 1, len(head_)
        found, i = encoded(block["text"].combine_chunks())
        ends_at = np.flatnonzero(i < 0) + 1
        ks = list(map(key, found))
        del found
        names = np.fromiter(map(name, ks), np.uint64, len(ks))
        rank = map(head_.get, names.tolist())
        cls = np.fromiter((c if c is not None else first + suffix_class(k, len(size_)) for c, k in zip(rank, ks, strict=True)), np.int32, len(ks))
        del ks
        # Rows of the join, in the words' order; the last place is the end's. The factors of row 0 are those of words that have none.
        given = known["name"].to_numpy().view(np.uint64) if known.num_rows else names[:0]
        order = np.argsort(given)
        at = order[np.searchsorted(given[order], names)]
        cs = np.append(known["c"].to_numpy()[at], ends) if len(at) else np.array([ends])
        own_f = known["f"].is_valid().to_numpy() if known.num_rows else np.zeros(0, bool)
        slot = np.append(np.where(own_f, np.cumsum(own_f), 0).astype(np.int32)[at], 0) if len(at) else np.zeros(1, np.int32)
        fs = [np.zeros((1, 2 * dim + 4), np.int8)]
        for f in known["f"].chunks:
            f = f.drop_null()
            if len(f):
                where = np.frombuffer(f.buffers()[1], np.int32)[f.offset : f.offset + len(f) + 1]
                fs.append(np.frombuffer(f.buffers()[2], np.int8)[where[0] : where[-1]].reshape(-1, 2 * dim + 4))
        raw = np.concatenate(fs)
        del fs, known, names, order, at
        log_z = np.ascontiguousarray(raw[:, 2 * dim :]).view(np.float32)[:, 0]
        within = np.append(np.where(cls < first, 0.0, np.log10((cs[:-1] + 1) / size_[np.maximum(cls - first, 0)])), 0.0)
        cls = np.append(cls, np.int32(end))
        base = np.log10((cs + 1) / (tokens + types + 1))
        starts = np.append(0, ends_at[:-1])
        out: list[list[np.ndarray]] = [[], [], []]
        d = 0
        while d < len(starts):  # some texts at a time, of some 200,000 tokens together
            d0, d = d, max(d + 1, int(np.searchsorted(ends_at, starts[d] + 200_000, "right")))
            low, high = starts[d0], ends_at[d - 1]
            each = np.empty(high - low)
            for a in range(low, high, 1 << 16):
                b = min(high, a + (1 << 16))
                own, before_ = i[a:b], np.append(i[a - 1] if a else -1, i[a : b - 1])
                c, c0, h = cls[own], cls[before_], slot[before_]
                tilted, g = -log_z[h].astype(np.float64), slot[own]
                if len(at_h := np.flatnonzero(h)):
                    tilted[at_h] += np.einsum("ij,ij->i", raw[h[at_h], :dim].astype(np.float32), follow[c[at_h]]) / 32
                if len(at_g := np.flatnonzero(g)):
                    tilted[at_g] += np.einsum("ij,ij->i", raw[g[at_g], dim : 2 * dim].astype(np.float32), precede[c0[at_g]]) / 32
                each[a - low : b - low] = table_[c0, c] + within[own] + tilted / math.log(10)
            cuts, own = starts[d0:d] - low, i[low:high]
            for to, values in zip(out, ((cs[own] > 0).astype(np.int64), base[own], each), strict=True):
                to.append(np.add.reduceat(values, cuts))
        out = [np.diff(np.append(0, ends_at)), *map(np.concatenate, out)]
        del i, cls, within, base, cs, slot, raw, log_z
        give_back()
        cols = {"n_tokens": out[0], "n_known": out[1], "train_tokens": np.full(len(out[0]), tokens, np.int64), "base_score": out[2], "score": out[3]}
        return pa.table({"doc_id": block["doc_id"], "held_out": block["held_out"], **cols})

    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"doc_id {kind['doc_id']}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    named = factors.where("name is not null").select("name", "f")
    own = listed.select("block", "name").join(counts.select("name", "c").join(named, "name", "left"), "name").select("block", "name", "c", "f")
    return blocked.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(score, schema)


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, F.lit(False))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), held_out())
